import hashlib
from collections import defaultdict

import pytest

from checks.compare import compare, connect
from raterscope.llm import line_dedup as L
from raterscope.llm.queries import ORACLE, QUERIES
from tests.llm.cases import documents, empty, own_values

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def key_of(line):
    return line.strip(BLANKS).translate(LOWER)


def brute(rows, least_documents, least_chars=1):
    """(n_lines, n_dropped, kept) of each (id, text)."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least_chars:
                holders[key_of(line)].add(("text", text or "") if i is None else ("id", i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key_of(x), ())) < least_documents]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df, **options):
    rows = L.drop_common_lines(df, **options).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in rows), key=repr)


ROWS = [
    (1, "Header\nbody one\n\n  FOOTER\t"),
    (2, "header \nbody two\nfooter\nfooter"),
    (3, "HEADER\nÄ\nbody one"),
    (4, "ä\nheader\n\n\n"),
    (5, "header"),
    (5, "header\nother text of the same id"),
    (6, None),
    (7, ""),
    (None, "footer\nbody one"),
    (None, "footer\nbody one"),
    (None, "footer"),
    (2, "header \nbody two\nfooter\nfooter"),
    (8, "\n" * 30 + "x" * 9000 + "\n" + "footer\n" * 500),
]


@pytest.mark.parametrize("least", [1, 2, 3, 5])
@pytest.mark.parametrize("hot_keys", [1, 4096])
def test_lines_as_by_hand(spark, monkeypatch, least, hot_keys):
    monkeypatch.setattr(L, "HOT_KEYS", hot_keys)
    rows = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert found(rows, least_documents=least) == brute(ROWS, least)
    assert found(rows, least_documents=least, least_chars=7) == brute(ROWS, least, 7)


def test_all_lines_gone_gives_empty_text(spark):
    rows = spark.createDataFrame([(i, "same\n same") for i in range(12)], "doc_id long, text string")
    assert found(rows) == sorted(((i, 2, 2, "") for i in range(12)), key=repr)


def test_hot_line_and_ids_as_text(spark):
    rows = [(f"d{i:04}", f"common line\nown line {i}\nin pairs {i // 2}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert found(df) == brute(rows, 10)


def test_odd_documents(spark):
    for docs in (documents(spark), empty(spark)):
        out = L.drop_common_lines(docs, least_documents=2)
        assert out.count() == docs.count() and own_values(out, ("n_lines", "kept"))
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert found(documents(spark), least_documents=2) == brute(rows, 2)
    with pytest.raises(ValueError):
        L.drop_common_lines(documents(spark), text_col="kept")


def test_query_equals_sql_and_plain_version(spark, sf):
    assert compare(QUERIES["op11_line_dedup"](spark, sf), connect(sf), ORACLE["op11_line_dedup"]) == []
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    wanted = sorted((i, n, d, hashlib.sha256(k.encode()).hexdigest()) for i, n, d, k in brute(rows, 10))
    assert sorted(tuple(r) for r in QUERIES["op11_line_dedup"](spark, sf).collect()) == wanted


def test_main_path_has_no_python(spark, sf):
    plan = QUERIES["op11_line_dedup"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
