"""Fill-in-middle: texts are cut in three and the middle is moved to the end.

Cuts lie between units, which are words with the white space before them (white space at the
end of a text is one unit more). The number of units of a text, and the place of a cut, come
from its chunks: a rolling hash over the bytes ends a chunk wherever the content says so, so
passages that documents share give the same chunks. A chunk's boundary summary (does it begin
and end inside a word, how many words end in it, how many code points it has) is kept in a
cache by the chunk's bytes, so a shared chunk is looked at once per task and a hit is always
the same content. Summaries of neighbours combine by addition, with one word less where a
word runs across the border; their running sums tell in which chunk a cut lies, and only that
chunk is read again.

Python gives three numbers for each text. Form and output are column expressions.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raterscope.llm.common import free_name, register, table, text_bytes

SEED = 42
RATE = 50  # percent of documents that are cut
SPM_RATE = 80  # percent of these that begin with the suffix
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

WINDOW = 32  # bytes that the rolling hash sees
MEAN_CHUNK = 1 << 10  # bytes, a power of two
LEAST_CHUNK = 1 << 7
MOST_CHUNK = 1 << 14
PIECE = 1 << 20  # bytes hashed at once, which bounds the memory of a very long text
CACHE_BYTES = 32 << 20

BLANK = frozenset(b" \t\n\x0b\x0c\r")
#: Bytes of a code point after its first.
FOLLOWING = bytes(range(0x80, 0xC0))


def _gears() -> np.ndarray:
    """A random number for each byte value."""
    return np.random.default_rng(5).integers(0, 1 << 63, 256, np.uint64)


def chunk_ends(text: bytes, gears: np.ndarray) -> list[int]:
    """Where the chunks of a text end; the last is the text's length.

    The hash of the WINDOW bytes up to a place decides whether a chunk ends there. Places nearer
    than LEAST_CHUNK to the last end do not count, and no chunk is longer than MOST_CHUNK.
    """
    found: list[int] = []
    for start in range(0, len(text), PIECE):
        low = max(0, start - WINDOW + 1)
        rolling = gears[np.frombuffer(text, np.uint8, min(len(text), start + PIECE) - low, low)]
        width = 1
        while width < WINDOW:  # the hash of twice the width is that of both halves, one of them shifted
            rolling[width:] += rolling[:-width] << np.uint64(width)
            width *= 2
        # the top bits of the lower half depend on all bytes of the window
        cut = (rolling >> np.uint64(WINDOW - MEAN_CHUNK.bit_length())) & np.uint64(MEAN_CHUNK - 1)
        places = np.flatnonzero(cut == 0) + low + 1
        found += places[places > start].tolist()
    ends, last = [], 0
    for place in [*found, len(text)]:
        if place - last < LEAST_CHUNK and place < len(text):
            continue
        while place - last > MOST_CHUNK:
            last += MOST_CHUNK
            ends.append(last)
        if place > last:
            ends.append(place)
            last = place
    return ends


class Summary(NamedTuple):
    """What the neighbours and the sums of a text need to know of a chunk."""

    opens: bool  # its first byte belongs to a word
    closes: bool  # its last byte belongs to a word
    words: int  # runs of word bytes
    chars: int  # code points that begin in it


def summarize(chunk: bytes) -> Summary:
    return Summary(
        chunk[0] not in BLANK, chunk[-1] not in BLANK, len(chunk.split()), len(chunk.translate(None, FOLLOWING))
    )


class Summaries:
    """Summaries by content, the least recently used going first; bounded in bytes.

    The bytes themselves are the key, so chunks of equal hash but other content never mix.
    """

    def __init__(self, most_bytes: int = CACHE_BYTES):
        self.kept: OrderedDict[bytes, Summary] = OrderedDict()
        self.most_bytes, self.n_bytes, self.hits, self.misses = most_bytes, 0, 0, 0

    def of(self, chunk: bytes) -> Summary:
        found = self.kept.get(chunk)
        if found is not None:
            self.hits += 1
            self.kept.move_to_end(chunk)
            return found
        self.misses += 1
        found = self.kept[chunk] = summarize(chunk)
        self.n_bytes += len(chunk)
        while self.n_bytes > self.most_bytes and len(self.kept) > 1:
            self.n_bytes -= len(self.kept.popitem(last=False)[0])
        return found


class Text:
    """A text by the summaries of its chunks."""

    def __init__(self, text: bytes, gears: np.ndarray, summaries: Summaries):
        self.text = text
        self.ends = chunk_ends(text, gears)
        self.starts = [0, *self.ends[:-1]] if self.ends else []
        parts = [summaries.of(text[a:b]) for a, b in zip(self.starts, self.ends, strict=True)]
        # a word that runs across a border begins in the chunk before it
        before = [False, *(p.closes for p in parts)]
        begun = (p.words - (p.opens and b) for p, b in zip(parts, before, strict=False))
        self.words = list(accumulate(begun))  # words begun up to the end of each chunk
        self.chars = list(accumulate(p.chars for p in parts))
        self.parts, self.before = parts, before
        self.n_words = self.words[-1] if parts else 0
        self.n = self.n_words + bool(parts and not parts[-1].closes)

    def chars_before(self, n: int) -> int:
        """Code points of the first `n` units, which end with the n-th word or with the text."""
        if n == 0:
            return 0
        if n > self.n_words or (n == self.n_words and self.parts[-1].closes):
            return self.chars[-1]
        at = bisect_left(self.words, n)
        known = self.words[at - 1] if at else 0
        # words that begin in this chunk are numbered after one that runs into it
        place = self._end_of_word(at, n - known - 1 + (self.parts[at].opens and self.before[at]))
        while place is None:  # the word goes on in the next chunk
            at += 1
            place = self._end_of_word(at, 0) if self.parts[at].opens else 0
        start = self.starts[at]
        inside = len(self.text[start : start + place].translate(None, FOLLOWING))
        return (self.chars[at - 1] if at else 0) + inside

    def _end_of_word(self, at: int, number: int) -> int | None:
        """Where in a chunk its `number`-th run of word bytes ends; None if it meets the chunk's end."""
        chunk = self.text[self.starts[at] : self.ends[at]]
        if self.parts[at].closes and number == self.parts[at].words - 1:
            return None
        rest = chunk.split(None, number + 1)
        # what lies behind the run and its white space is the last piece, if there is one
        tail = len(rest[number + 1]) if len(rest) > number + 1 else 0
        return len(chunk[: len(chunk) - tail].rstrip())


def cuts(text: bytes, draws: tuple[int, int], gears: np.ndarray, summaries: Summaries) -> tuple[int, int, int]:
    """The number of units, and the code points before the middle and before the suffix."""
    found = Text(text, gears, summaries)
    first, second = sorted(d % (found.n + 1) for d in draws)
    return found.n, found.chars_before(first), found.chars_before(second)


def draw(id_col: Column, group: int, seed: int = SEED) -> Column:
    """The group-th eight hex digits of sha256 over seed and decimal id, as a number; a null id is blank."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def sentinel_pattern(sentinels: Sequence[str]) -> str:
    return "|".join(f"\\Q{s}\\E" for s in sentinels)


def rearranged(text: Column, form: Column, before: Column, middle: Column, sentinels: Sequence[str]) -> Column:
    """The output of each form: the text, or its three parts behind their sentinels."""
    p, s, m = map(F.lit, sentinels)
    parts = [
        F.substring(text, F.lit(1), before),
        F.substring(text, before + 1, middle),
        F.substring(text, before + middle + 1, F.char_length(text)),
    ]
    psm = F.concat(p, parts[0], s, parts[2], m, parts[1])
    spm = F.concat(s, parts[2], p, parts[0], m, parts[1])
    return F.when(form == "plain", text).when(form == "psm", psm).otherwise(spm)


def restored(output: Column, form: Column, sentinels: Sequence[str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output was made of."""
    part = F.split(output, sentinel_pattern(sentinels), -1)
    psm, spm = [F.concat(*[F.get(part, F.lit(i)) for i in order]) for order in ((1, 3, 2), (2, 3, 1))]
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    sentinels: Sequence[str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """All columns of `docs` with `n`, `form`, `prefix_chars`, `middle_chars` and `output`.

    `form` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle); numbers drawn
    from the id choose it and both cuts, so reruns and repeated rows agree, and rows without an
    id share their draws. Null and empty texts have no unit and an empty plain output. Texts that
    hold a sentinel stay plain, so `restored` gives every text back. Texts of any length are
    handled whole. An empty table gives an empty result. Columns of `docs` with the names of the
    results give way. A sentinel's first character must not come again in any of them, else
    text beside a sentinel could look like one.
    """
    firsts = {s[:1] for s in sentinels}
    if len(set(sentinels)) != 3 or "" in firsts or any(c in s[1:] for s in sentinels for c in firsts):
        raise ValueError("three different sentinels are needed, whose first characters come once in each")
    results = ("n", "form", "prefix_chars", "middle_chars", "output")
    columns = [c for c in docs.columns if c.lower() not in results]
    if id_col not in columns or text_col not in columns:
        raise ValueError("the id and the text need names other than those of the results")
    taken = [*columns, *results]
    names = [free_name(taken, f"_{x}") for x in ("text", "h1", "h2")]
    own_id = F.col(f"`{id_col}`")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in columns],
        text.alias(names[0]), draw(own_id, 0, seed).alias(names[1]), draw(own_id, 1, seed).alias(names[2]),
    )
    made = [free_name(taken, f"_{x}") for x in ("units", "first", "second")]
    schema = T.StructType([*rows.schema.fields, *(T.StructField(x, T.LongType()) for x in made)])
    place = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gears, summaries = _gears(), Summaries()
        for batch in batches:
            draws = zip(batch.column(place + 1).to_pylist(), batch.column(place + 2).to_pylist(), strict=True)
            found = [cuts(t, d, gears, summaries) for t, d in zip(text_bytes(batch.column(place)), draws, strict=True)]
            numbers = np.array(found, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, numbers.T)], names=schema.names)

    cut = rows.mapInArrow(run, schema)
    text, units, first, second = (F.col(c) for c in (names[0], *made))
    holds = text.rlike(sentinel_pattern(sentinels))
    form = (
        F.when((text == "") | holds | (F.pmod(draw(own_id, 2, seed), F.lit(100)) >= rate), "plain")
        .when(F.pmod(draw(own_id, 3, seed), F.lit(100)) < spm_rate, "spm")
        .otherwise("psm")
    )
    cut = cut.select(
        *[F.col(f"`{c}`") for c in columns], text, units.alias("n"), form.alias("form"), first, second
    )
    is_cut = F.col("form") != "plain"
    return cut.select(
        *[F.col(f"`{c}`") for c in columns], "n", "form",
        F.when(is_cut, first).alias("prefix_chars"), F.when(is_cut, second - first).alias("middle_chars"),
        rearranged(text, F.col("form"), first.cast("int"), (second - first).cast("int"), sentinels).alias("output"),
    )


SQL = r"""
with t as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || cast(doc_id as varchar)) as digest,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units
  from documents
), h as (
  select *, len(units) as n, cast('0x' || digest[1:8] as bigint) as h1, cast('0x' || digest[9:16] as bigint) as h2,
    cast('0x' || digest[17:24] as bigint) as h3, cast('0x' || digest[25:32] as bigint) as h4
  from t
), c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50
      then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form
  from h
), p as (
  select *, array_to_string(units[1:low], '') as prefix, array_to_string(units[low + 1:high], '') as middle,
    array_to_string(units[high + 1:n], '') as suffix
  from c
)
select doc_id, n, form,
  case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from p
"""


@register(SQL)
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
