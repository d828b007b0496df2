from raterscope.llm import license_scan as L
from tests.llm.cases import EN, documents, empty


def names(text):
    return [b["license"] for b in L.scan_text(text.encode())]


def test_every_template_is_found_in_prose():
    for name, texts in L.TEMPLATES.items():
        for text in texts:
            found = [x for x in names(f"{EN}\n{text}\n{EN}") if x != "unrecognised"]
            assert found and found[0] == name, (name, text)


def test_wording_differences_decide():
    assert names("Licensed under CC BY 4.0.") == ["CC-BY-4.0"]
    assert names("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0"]
    assert names("This work is licensed under the GNU General Public License, version 4.") == ["unrecognised"]
    assert names("The shop sells licensed goods to everyone.") == ["unrecognised"]
    assert names("License") == ["unrecognised"]
    assert names("no such words") == []
    block = L.scan_text(b"Released under the MIT Licence, see there.")[0]
    assert block["license"] == "unrecognised" and "license -> licence see there" in block["differences"]


def test_offsets_and_long_texts():
    text = (EN * 2000 + "\n" + "Released under the MIT License.\n" + "word " * 50_000 + "all rights reserved " + "word " * 50_000).encode()
    found = L.scan_text(text)
    assert [b["license"] for b in found] == ["MIT", "all-rights-reserved"]
    assert text[found[0]["start"] : found[0]["end"]] == b"Released under the MIT License."


def test_rows(spark):
    docs = documents(spark)
    found = {(r.doc_id, len(r.found), tuple(b.license for b in r.found)) for r in L.scan(docs, name="found").collect()}
    assert {x for x in found if x[1]} == {(13, 1, ("MIT",))}
    assert L.scan(docs, name="found").count() == docs.count()
    assert L.scan(empty(spark), name="found").count() == 0


def test_equal_to_a_plain_search(spark, sf):
    from raterscope.llm.queries import QUERIES

    phrases = {"CC-BY-NC-4.0": "CC BY-NC 4.0", "MIT": "MIT License", "GPL-3.0": "GNU General Public", "Apache-2.0": "Apache License", "all-rights-reserved": "rights reserved"}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op7_license_scan"](spark, sf).collect():
        assert set(filter(None, r.licenses.split(","))) == {k for k, p in phrases.items() if p in texts[r.doc_id]}


def test_near_misses():
    gpl = (
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU {}General "
        "Public License as published by\nthe Free Software Foundation, either version {} of the License, or\n"
        "(at your option) any later version.\n"
    )
    assert names(gpl.format("", 3)) == ["GPL-3.0"] and names(gpl.format("", 2)) == ["GPL-2.0"]
    assert names(gpl.format("Lesser ", 3)) == ["LGPL-3.0"] and names(gpl.format("Affero ", 3)) == ["AGPL-3.0"]
    cc = "This work is licensed under a Creative Commons Attribution-{} 4.0 International License."
    assert names(cc.format("NonCommercial-NoDerivatives")) == ["CC-BY-NC-ND-4.0"]
    assert names(cc.format("NonCommercial-Other-ShareAlike")) == ["unrecognised"]


def test_clause_counts():
    for name in ("BSD-2-Clause", "BSD-3-Clause"):
        text = L.TEMPLATES[name][1].replace(". R", ".\n\n2. R").replace(": R", ":\n\n1. R").replace(". N", ".\n\n3. N")
        assert {x for x in names(text) if x != "unrecognised"} == {name}
    opening = L.TEMPLATES["BSD-2-Clause"][1].split(". ")[0] + "."
    assert names(opening) == ["unrecognised"]


def test_spdx_lines():
    for line, name in (("MIT", "MIT"), ("GPL-3.0-or-later", "GPL-3.0"), ("BSD-2-Clause", "BSD-2-Clause"), ("MIT OR Apache-2.0", "unrecognised")):
        assert names(f"// SPDX-License-Identifier: {line}\nint main;") == [name]


def test_every_license_of_a_sentence():
    assert names("Licensed under the MIT License and licensed under the Apache License, Version 2.0.") == ["MIT", "Apache-2.0"]
    assert names("It is dual licensed under the MIT License or the Apache License, Version 2.0, at your option.") == ["MIT", "Apache-2.0"]
    assert names("This is released under the terms of the MIT License, see the LICENSE file.") == ["MIT"]
    # a name after "or" or "and" grants nothing alone
    assert names("We compared a license of our own and the MIT License.") == ["unrecognised"]
    assert names("Available under the GNU General Public License, version 4.") == ["unrecognised"]


def test_clauses_far_apart_and_two_notices():
    two, three = (L.TEMPLATES[n][1] for n in ("BSD-2-Clause", "BSD-3-Clause"))
    between = " The water rose and the boats went out to sea again." * 200
    spread = three.replace("distribution. N", f"distribution.{between} N").replace("permission. T", f"permission.{between} T")
    assert len(spread) > 20_000 and set(names(spread + ".")) == {"BSD-3-Clause"}
    spread = two.replace("disclaimer. R", f"disclaimer.{between} R")
    assert set(names(spread + ".")) == {"BSD-2-Clause"}
    found = names(f"{two}.{between} {three}.")
    assert found == ["BSD-2-Clause"] * 3 + ["BSD-3-Clause"] * 4


def test_long_lines_and_sentences_are_read_whole():
    filler = "stone " * 900
    assert names(f"{filler}Licensed under the MIT License {filler}licensed under the Apache License, Version 2.0 {filler}.") == ["MIT", "Apache-2.0"]
    assert names("SPDX-License-Identifier: MIT " + "x " * 1000) == ["unrecognised"]
    assert names("/* SPDX-License-Identifier: Apache-2.0 */ int x;") == ["Apache-2.0"]


def test_spdx_lines_are_ranked():
    block = L.scan_text(b"# SPDX-License-Identifier: LGPL-2.1-or-later\n")[0]
    assert block["license"] == "LGPL-2.1" and block["saved"] > 0.3
    assert L.scan_text(b"SPDX-License-Identifier: LGPL-9.1\n")[0]["license"] == "unrecognised"


def test_null_and_empty_texts():
    assert L.scan_text(None) == L.scan_text(b"") == []
