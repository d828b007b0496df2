"""License scans by conditional compression.

Sentences that speak of licensing are compressed alone and with each license text as a raw
dictionary of zstandard. The text that saves the most bytes is the likeliest origin. The
best candidates, and all that share a few words in a row with the sentence, are then confirmed
by exact wording: the words of the sentence are aligned with the license text, and what differs
inside the aligned part is reported and counted. A sentence may grant several licenses, each by
its own stretch of words. Where licenses share a sentence, the notice around it decides.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from difflib import SequenceMatcher
from functools import cache, lru_cache
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raterscope.llm.common import add_from_text, register, table

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""
# Short notices and passages of well-known licenses, as their stewards publish them.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", f"{_BSD} {_AS_IS}"],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        f"{_BSD} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        f"promote products derived from this software without specific prior written permission. {_AS_IS}",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0.", "Licensed under CC0 1.0."],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    **{
        f"CC-BY-{short}-4.0": [
            f"Licensed under CC BY-{short} 4.0.",
            f"This work is licensed under a Creative Commons Attribution-{long} 4.0 International License.",
        ]
        for short, long in (
            ("ND", "NoDerivatives"), ("NC-SA", "NonCommercial-ShareAlike"), ("NC-ND", "NonCommercial-NoDerivatives"),
        )
    },
    "all-rights-reserved": ["All rights reserved."],
}
# The names under which licenses are granted in running text.
TITLES = {
    "MIT": ["MIT License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License"],
    "ISC": ["ISC License"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International License"],
}
GRANTS = ("under the", "under the terms of the", "under either the")
JOINS = ("or the", "and the")  # these grant only beside another license of the sentence
#: What may follow a license's identifier without making it another license.
SUFFIXES = ("", "-only", "-or-later", "+")
# A sentence with one of these is a candidate.
STEMS = (b"licens", b"licenc", b"copyright", b"rights reserved", b"permission", b"redistribut",
         b"public domain", b"creative commons", b"warrant", b"free software", b"spdx")

LEVEL = 19
RANKED = 3
MOST_DIFFERENT = 0.15
LEAST_WORDS = 3
PIECE = 400  # words; longer sentences are looked at in overlapping pieces
#: Lines of one paragraph belong together: a sentence ends at an end mark and white space, or at a blank line.
END = re.compile(rb"[.!?](?=\s)|\n[ \t\r\f\v]*(?=\n)")
SPACE = re.compile(rb"\s*")
NEAR = 0.05  # templates that save less than the best by so little are confirmed as well
WINDOW = 3  # words that a sentence and a template have in common, for which the template is confirmed as well
BULLET = re.compile(r"(?:^|(?<=[:.;]))[ \t/*#;]*\(?\d[.)]\s+(?=[A-Za-z])", re.M)
#: Words that tell licenses apart; they and words with a digit must not differ.
TELLING = {
    "lesser", "library", "affero", "noncommercial", "sharealike", "noderivatives", "noderivs", "nc", "sa", "nd",
    "neither", "endorse", "promote", "advertising",
}
SPDX = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)", re.I)
COMMENT_END = re.compile(r"\*/|-->|#")
BLOCK_TYPE = "array<struct<start:int,end:int,license:string,saved:double,n_different:int,differences:array<string>>>"


def words_of(text: str) -> list[str]:
    """Lower-case words without the punctuation around them, which editors change freely."""
    return [w for w in (x.strip("\"'`()[]{}<>.,;:!*#/|-") for x in text.lower().split()) if w]


class Template(NamedTuple):
    license: str
    words: list[str]
    compressor: zstandard.ZstdCompressor
    joined: bool = False


def _template(name: str, text: str, joined: bool = False) -> Template:
    words = words_of(text)
    raw = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return Template(name, words, _compressor(raw), joined)


@cache
def _prepared() -> list[Template]:
    """Notices first, then grants of a license by its name, alone and after another."""
    out = [_template(name, text) for name, texts in TEMPLATES.items() for text in texts]
    for name, titles in TITLES.items():
        out += [_template(name, f"{start} {title}") for title in titles for start in GRANTS]
        out += [_template(name, f"{start} {title}", joined=True) for title in titles for start in JOINS]
    return out


@cache
def _identifiers() -> list[Template]:
    names = [name for name in TEMPLATES if name != "all-rights-reserved"]
    return [_template(name, f"SPDX-License-Identifier: {name}{suffix}") for name in names for suffix in SUFFIXES]


@cache
def _windows() -> dict[tuple[str, ...], set[int]]:
    """The templates that have each WINDOW words in a row."""
    out: dict[tuple[str, ...], set[int]] = {}
    for place, template in enumerate(_prepared()):
        for i in range(len(template.words) - WINDOW + 1):
            out.setdefault(tuple(template.words[i : i + WINDOW]), set()).add(place)
    return out


def _compressor(raw: zstandard.ZstdCompressionDict | None = None) -> zstandard.ZstdCompressor:
    # the smallest frame, so that sizes of short sentences can be compared
    options = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False
    )
    return zstandard.ZstdCompressor(compression_params=options, dict_data=raw)


def _aligned(part: list[str], whole: list[str]) -> tuple[list[tuple[str, str]], int, int]:
    """What differs between `part` and the stretch of `whole` that it covers, and that stretch."""
    steps = SequenceMatcher(None, whole, part, autojunk=False).get_opcodes()
    out, low, high = [], len(whole), 0
    for place, (kind, a, b, c, d) in enumerate(steps):
        outer = place in (0, len(steps) - 1)
        if kind == "delete" and outer:
            continue
        low, high = min(low, a), max(high, b)
        if kind != "equal":
            out.append((" ".join(part[c:d]), " ".join(whole[a:b])))
    return out, low, high


def differences(part: list[str], whole: list[str]) -> list[tuple[str, str]]:
    """What differs between `part` and the stretch of `whole` that it covers: words of either."""
    return _aligned(part, whole)[0]


def _weigh(found: list[tuple[str, str]]) -> int:
    return sum(max(len(side.split()) for side in pair) for pair in found)


@cache
def _alone() -> zstandard.ZstdCompressor:
    return _compressor()


def _told_apart(found: list[tuple[str, str]]) -> bool:
    """Whether a differing word has a digit or tells licenses apart."""
    for side in (side for pair in found for side in pair):
        if any(c.isdigit() for c in side) or not TELLING.isdisjoint(re.split(r"[\s-]+", side)):
            # "this library" for "this program" names the work, not the license
            if side not in ("library", "this library"):
                return True
    return False


def _same(part: list[str], found: list[tuple[str, str]]) -> bool:
    return len(part) >= LEAST_WORDS and _weigh(found) <= MOST_DIFFERENT * len(part) and not _told_apart(found)


class Hit(NamedTuple):
    """The licenses that fit one stretch of a sentence equally well; none if it is unrecognised."""

    names: tuple[str, ...]
    saved: float
    n_different: int
    differences: tuple[str, ...]


def _ranked(data: bytes, templates: list[Template]) -> list[tuple[float, int]]:
    """Share of bytes that each template saves, most first, and the template's place."""
    plain = len(_alone().compress(data))
    order = sorted((len(t.compressor.compress(data)) / plain - 1, place) for place, t in enumerate(templates))
    return [(-less, place) for less, place in order]


@lru_cache(maxsize=10_000)
def _rank(block: tuple[str, ...]) -> tuple[Hit, ...]:
    """The confirmed licenses of a sentence, each stretch of it counted for the best that fits.

    The templates that save most and those with a window of words in common are confirmed: the
    sentence may be a part of the license text, or have the whole text in it. Words with a
    digit, such as versions, and those of TELLING must not differ. If none is confirmed, there
    is one hit without names that has the differences from the nearest template.
    """
    ranked = _ranked(" ".join(block).encode(), _prepared())
    shared = set().union(*(_windows().get(block[i : i + WINDOW], ()) for i in range(len(block) - WINDOW + 1)))
    confirmed, nearest = [], None
    for number, (saved, place) in enumerate(ranked):
        if number >= RANKED and saved < ranked[0][0] - NEAR and place not in shared:
            continue
        name, words, _, joined = _prepared()[place]
        for turned in (False, True):
            if joined and not turned:
                continue
            part, whole = (words, list(block)) if turned else (list(block), words)
            found, low, high = _aligned(part, whole)
            said = tuple(f"{a} -> {b}" if turned else f"{b} -> {a}" for a, b in found)
            low, high = (low, high) if turned else (0, len(block))
            size = _weigh(found)
            if _same(part, found):
                confirmed.append((joined, size, low - high, -saved, name, low, high, said))
            elif not joined:
                nearest = min(nearest or (size, -saved, said), (size, -saved, said))
    taken: list[tuple] = []  # stretch, rank, names, saved, size, differences
    for joined, size, less, saved, name, low, high, said in sorted(confirmed):
        over = [t for t in taken if low < t[1] and t[0] < high]
        if not over and (taken or not joined):
            taken.append((low, high, (joined, size, less), {name}, -saved, size, said))
        elif over and over[0][2] == (joined, size, less):
            over[0][3].add(name)
    if not taken:
        size, saved, said = nearest or (len(block), -ranked[0][0], ())
        return (Hit((), -saved, size, said),)
    return tuple(Hit(tuple(sorted(names)), saved, size, said) for _, _, _, names, saved, size, said in sorted(taken, key=lambda t: t[0]))


@lru_cache(maxsize=1000)
def _identifier(words: tuple[str, ...]) -> tuple[str, float]:
    """The license of an SPDX line, ranked as sentences are and confirmed if no word differs, and the share saved.

    Expressions of several licenses and unknown ones are not recognised.
    """
    ranked = _ranked(" ".join(words).encode(), _identifiers())
    for number, (saved, place) in enumerate(ranked):
        if number >= RANKED and saved < ranked[0][0] - NEAR:
            break
        if _identifiers()[place].words == list(words):
            return _identifiers()[place].license, saved
    return "unrecognised", ranked[0][0]


@lru_cache(maxsize=10_000)
def _covered(name: str, words: tuple[str, ...]) -> frozenset[int]:
    """The words of the license's longest text that a sentence covers in stretches of WINDOW or more, by position."""
    found = SequenceMatcher(None, _notice(name), words, autojunk=False).get_matching_blocks()
    return frozenset(i for m in found if m.size >= WINDOW for i in range(m.a, m.a + m.size))


@cache
def _notice(name: str) -> list[str]:
    return max((t.words for t in _prepared() if t.license == name), key=len)


def _is_whole(name: str, covered: set[int]) -> bool:
    """Whether so much of the license's text is there that it counts as the same."""
    left = [w for i, w in enumerate(_notice(name)) if i not in covered]
    return len(left) <= MOST_DIFFERENT * len(_notice(name)) and not _told_apart([(" ".join(left), "")])


def _decide(sentences: list[tuple[tuple[str, ...], Hit]]) -> list[str]:
    """The license of each sentence of a text, in order, or `unrecognised`.

    Where several licenses have the same sentence, the other sentences of its notice decide,
    however far apart they stand: a license is out if a sentence of the notice fits only others
    of them, and its own text must be there as a whole. A notice ends where a clause comes that
    it already has.
    """
    out = [hit.names[0] if len(hit.names) == 1 else "unrecognised" for _, hit in sentences]
    for family in {hit.names for _, hit in sentences if len(hit.names) > 1}:
        members: list[tuple[int, frozenset[str]]] = []  # of the notice: place, licenses that fit
        covered: dict[str, set[int]] = {name: set() for name in family}

        def close(members=members, covered=covered, family=family) -> None:
            left = set(family).intersection(*(fit for _, fit in members))
            whole = [name for name in left if _is_whole(name, covered[name])]
            for place, _ in members:
                if sentences[place][1].names == family and len(whole) == 1:
                    out[place] = whole[0]
            members.clear()
            for positions in covered.values():
                positions.clear()

        for place, (words, hit) in enumerate(sentences):
            fit = frozenset(hit.names).intersection(family)
            if not hit.names and members:  # a clause that runs into other words is there as well
                for name in family:
                    covered[name] |= _covered(name, words)
            if not fit:
                continue
            new = {name: _covered(name, words) for name in fit}
            if any(2 * len(new[name] & covered[name]) > len(new[name]) for name in fit):
                close()
            members.append((place, fit))
            for name in fit:
                covered[name] |= new[name]
        close()
    return out


def scan_text(text: bytes | None) -> list[dict]:
    """The candidate sentences of a whole text, with offsets in bytes; one entry for each license of a sentence."""
    lower = (text or b"").lower()
    places = set()
    for stem in STEMS:
        at = lower.find(stem)
        while at >= 0:
            places.add(at)
            at = lower.find(stem, at + 1)
    out, sentences, end, ends = [], [], -1, None
    for at in sorted(places):
        if at < end:
            continue
        if line := SPDX.match(text, at):
            start, end = line.span()
            said = COMMENT_END.split(line[0].decode("utf-8", "replace"))[0]
            name, saved = _identifier(tuple(words_of(said)))
            out.append({"start": start, "end": end, "license": name, "saved": saved, "n_different": 0, "differences": []})
            sentences.append(((), Hit((name,), saved, 0, ())))
            continue
        if ends is None:  # found once, whatever the number of candidates
            ends = [0, *(m.end() for m in END.finditer(text)), len(text)]
        place = bisect_right(ends, at)
        start = SPACE.match(text, max(ends[place - 1], end, 0)).end()
        end = ends[place]
        if line := SPDX.search(text, start, end):
            end = line.start()
            if end <= at:
                continue
        words = words_of(BULLET.sub("", text[start:end].decode("utf-8", "replace")))
        for piece, hit in _hits(words):
            out.append({"start": start, "end": end, "license": "", "saved": hit.saved, "n_different": hit.n_different, "differences": list(hit.differences)})
            sentences.append((piece, hit))
    for block, name in zip(out, _decide(sentences), strict=True):
        block["license"] = name
    return out


def _hits(words: list[str]) -> list[tuple[tuple[str, ...], Hit]]:
    """The hits of a sentence; of overlapping pieces of a long one, each set of licenses once, by its best piece."""
    pieces = [tuple(words[i : i + PIECE]) for i in range(0, max(1, len(words) - PIECE // 2), PIECE // 2)] if words else []
    best: dict[tuple[str, ...], tuple[tuple[str, ...], Hit]] = {}
    for piece in pieces:
        for hit in _rank(piece):
            old = best.get(hit.names)
            if old is None or (hit.n_different, -hit.saved) < (old[1].n_different, -old[1].saved):
                best[hit.names] = piece, hit
    named = [x for names, x in best.items() if names]
    return named or list(best.values())


def scan(docs: DataFrame, text_col: str = "text", name: str = "blocks") -> DataFrame:
    """All columns of `docs` and an array of the candidate sentences found in each whole text.

    Each has its byte offsets, the license or `unrecognised`, the share of bytes that the
    template saves, and the differing words; a sentence with several licenses has an entry for each. Null and empty texts have none; repeated rows give
    repeated rows; an empty table gives an empty result. `name` must be free in `docs`.
    """
    kind = T._parse_datatype_string(BLOCK_TYPE)
    arrow = pa.list_(pa.struct([
        ("start", pa.int32()), ("end", pa.int32()), ("license", pa.string()), ("saved", pa.float64()),
        ("n_different", pa.int32()), ("differences", pa.list_(pa.string())),
    ]))
    compute = lambda texts: [pa.array([scan_text(t) for t in texts], arrow)]
    return add_from_text(docs, text_col, [T.StructField(name, kind)], compute)


@register()
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("blocks").alias("n_blocks"),
        F.array_join(F.array_sort(F.array_distinct("blocks.license")), ",").alias("licenses"),
        F.coalesce(F.array_max("blocks.saved"), F.lit(0.0)).alias("most_saved"),
        F.aggregate("blocks.n_different", F.lit(0), lambda a, b: a + b).alias("n_different"),
    )
