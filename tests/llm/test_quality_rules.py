from collections import Counter

from checks.compare import compare, connect
from raterscope.llm import quality_rules as Q
from raterscope.llm.queries import ORACLE, QUERIES
from tests.llm.cases import documents, empty


def brute(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    return {
        "n_words": len(words),
        "word_chars": sum(len(w.decode()) for w in words),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(covered),
    }


def test_measures_equal_brute_force(spark, sf):
    for docs in (documents(spark), spark.read.parquet(f"{sf}/documents.parquet")):
        texts = sorted(((r.doc_id or 0, r.text) for r in docs.select("doc_id", "text").collect()), key=repr)
        found = sorted(((r.doc_id or 0, r) for r in Q.ledger(docs).collect()), key=lambda x: repr((x[0], x[1].n_words)))
        wanted = Counter((i, *brute(t).values()) for i, t in texts)
        names = list(brute(None))
        assert Counter((i, *(r[n] for n in names)) for i, r in found) == wanted


def test_policies_and_ablations(spark):
    rows = Q.ledger(documents(spark)).cache()
    base = Q.apply_policy(rows, Q.BASE).collect()
    for r in base:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed)
    strict = {r.fail_bits for r in Q.apply_policy(rows, Q.STRICT).where("kept").collect()}
    assert strict <= {0}
    bits = [r.fail_bits for r in base]
    for r in Q.ablations(rows).collect():
        mask = next(p.mask for p in Q.POLICIES if p.version == r.version)
        bit = Q.BITS[r.rule]
        assert r.n_docs == len(bits)
        assert r.n_failed == sum(bool(b & bit) for b in bits)
        assert r.n_only_by_it == sum(b & mask == bit for b in bits)
        assert r.n_kept_without == sum(b & mask & ~bit == 0 for b in bits)


def test_empty_table(spark):
    assert Q.apply_policy(Q.ledger(empty(spark)), Q.STRICT).count() == 0
    assert Q.ablations(Q.ledger(empty(spark))).count() == 0


def test_query_equals_sql(spark, sf):
    assert compare(QUERIES["op10_quality_rules"](spark, sf), connect(sf), ORACLE["op10_quality_rules"]) == []
