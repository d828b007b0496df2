"""Language identification and the quality classifier, on edge cases and held-out accuracy."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from raterscope.llm import language_id as L
from raterscope.llm import quality_classifier as C
from raterscope.llm.queries import QUERIES
from tests.llm.cases import DE, EN, LONG, documents, empty

MID = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_grams_and_kernel_equal_sets():
    texts = [b"Abc abd", "éa ab".encode(), b"zzz", b"a" * 300]
    found = [L.grams(t) for t in texts]
    sets = [{t.decode().lower()[i : i + n] for n in (1, 2, 3) for i in range(len(t.decode()) - n + 1)} for t in texts]
    assert [len(g) for g in found] == [len(s) for s in sets]
    assert all((np.diff(g) > 0).all() for g in found)
    model = L.Model(found[:3], ["x"])
    wanted = [[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets[:3]] for a in sets]
    assert np.allclose(model.kernel(found), wanted, atol=1e-6)
    assert L.grams(None) is None and L.grams(b"12 -- 3") is None


def test_language_edge_cases(spark):
    docs = documents(spark)
    model = L.train(docs)
    assert model.languages == ["de", "en"]
    found = L.identify(docs.drop("lang_pred", "score"), model).collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.text is None or not any(map(str.isalpha, r.text)))
    assert {r.lang_pred for r in found if r.doc_id in (1, 2)} == {"en"}
    assert {r.lang_pred for r in found if r.doc_id in (3, 4)} == {"de"}
    kept = L.identified(docs)
    assert kept.columns == docs.columns and {5, 6, 7, 9}.isdisjoint(r.doc_id for r in kept.collect())
    nothing = L.train(empty(spark))
    assert {(r.lang_pred, r.score) for r in L.identify(docs.select("text"), nothing).collect()} == {("und", 0.0)}
    assert L.identify(empty(spark).select("text"), model).count() == 0


def test_repeated_rows_teach_as_once(spark):
    docs = documents(spark).select("doc_id", "text", "lang")
    more = [(100 + i, f"{EN} number {i}", "en") for i in range(40)] + [(200 + i, f"{DE} nummer {i}", "de") for i in range(40)]
    once = docs.unionByName(spark.createDataFrame(more, docs.schema))
    often = once.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("again")
    one, many = (L.train(x) for x in (once, often))
    assert one.presence.shape == many.presence.shape and np.allclose(one.weights, many.weights)


def test_language_held_out_accuracy(spark):
    found = QUERIES["op9_language_id"](spark, MID).join(spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)


def test_random_indexing_equals_brute_force(spark):
    docs = spark.createDataFrame([("a b c a",), ("b",), (None,), ("",), ("c c",)], "text string")
    places, signs = C.index_vectors()
    dense = np.zeros((C.ROWS, C.WIDTH), int)
    np.put_along_axis(dense, places, signs, axis=1)
    sums, seen = np.zeros_like(dense), np.zeros(C.ROWS, int)
    for text in (b"a b c a", b"b", b"c c"):
        ids = [zlib.crc32(w) % C.ROWS for w in text.split()]
        for i, w in enumerate(ids):
            seen[w] += 1
            for j in range(max(0, i - C.WINDOW), min(len(ids), i + C.WINDOW + 1)):
                if j != i:
                    sums[w] += dense[ids[j]]
    found = C.context_sums(docs.repartition(3)).collect()
    assert {r.row: (r.n, [r[c] for c in C.COLUMNS]) for r in found} == {w: (seen[w], sums[w].tolist()) for w in np.flatnonzero(seen)}


def test_long_texts_pool_as_in_one_piece(monkeypatch):
    vectors = np.random.default_rng(0).normal(size=(C.ROWS, C.WIDTH)).astype(np.float32)
    texts = [b"x y", None, LONG.encode(), b"", b"z " * 10]
    whole = C.pooled(texts, vectors, C.WordRows())
    assert np.allclose(whole[2], C.pooled([LONG.encode()], vectors, C.WordRows())[0])
    assert (whole[[1, 3]] == 0).all()
    monkeypatch.setattr(C, "LOT", 1000)
    assert np.allclose(whole, C.pooled(texts, vectors, C.WordRows()), atol=1e-2)


def plain_pooled(text, vectors):
    """Mean, spread, lagged products and length by loops over one text's words."""
    words = re.findall(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\x09-\x0d\x20A-Za-z0-9\x80-\xff]+", text or b"")
    own = vectors[[zlib.crc32(w) % C.ROWS for w in words]].astype(float)
    n = max(1, len(words))
    mean = own.sum(axis=0) / n
    spread = np.sqrt(np.maximum((own**2).sum(axis=0) / n - mean**2, 0))
    near = [sum(float(own[i] @ own[i - lag]) for i in range(lag, len(words))) / n for lag in C.LAGS]
    return np.concatenate([mean, spread, near, [np.log1p(len(words)) / 10]])


@pytest.mark.parametrize("lot,piece", [(1 << 11, 1 << 20), (7, 50), (1, 1), (1000, 300)])
def test_pools_equal_plain_loops(monkeypatch, lot, piece):
    monkeypatch.setattr(C, "LOT", lot)
    monkeypatch.setattr(C, "PIECE", piece)
    vectors = np.random.default_rng(0).normal(size=(C.ROWS, C.WIDTH)).astype(np.float32)
    texts = [b"a b", b"", None, b"one two  three\n1a2b!? " * 9, b"   ", b"x" * 700 + b" y", "É漢 ".encode() * 20, b"z"]
    found = C.pooled(texts, vectors, C.WordRows())
    wanted = np.array([plain_pooled(t, vectors) for t in texts])
    spread = slice(C.WIDTH, 2 * C.WIDTH)
    for x in (found, wanted):
        x[:, spread] **= 2  # a root would enlarge the rounding of differences near zero
    assert np.allclose(found, wanted, atol=1e-5)


@pytest.mark.parametrize("lot,piece", [(2, 9), (5, 1), (1 << 18, 40)])
def test_contexts_do_not_depend_on_lots(spark, monkeypatch, lot, piece):
    rows = C.WordRows()
    texts = [b"a b c a d e f", None, b"", b"g h" * 30, b"a a a a a a a a"]

    def pairs():
        found = {}
        for ids, owners, old in C.lots(texts, rows, lot, C.WINDOW):
            for i in range(old, len(ids)):
                for j in range(max(0, i - C.WINDOW), i):
                    if owners[i] == owners[j]:
                        key = (int(owners[i]), int(ids[j]), int(ids[i]))
                        found[key] = found.get(key, 0) + 1
        return found

    whole = {}
    for number, text in enumerate(texts):
        ids = rows.of(text or b"")[0].tolist()
        for i in range(len(ids)):
            for j in range(max(0, i - C.WINDOW), i):
                whole[number, ids[j], ids[i]] = whole.get((number, ids[j], ids[i]), 0) + 1
    monkeypatch.setattr(C, "PIECE", piece)
    assert pairs() == whole


def test_quality_edge_cases(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, int(i % 2), None) for i in range(1, 15)] + [(None, 1, 1), (3, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    vectors = C.word_vectors(C.context_sums(docs))
    network = C.train(docs, labels, vectors)
    found = C.score(docs.drop("score"), vectors, network).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert C.good_documents(docs, labels).columns == docs.columns
    for some, value in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        constant = C.train(docs, some, vectors)
        assert {r.score for r in C.score(docs.select("text"), vectors, constant).collect()} == {value}
    none = C.word_vectors(C.context_sums(empty(spark)))
    assert C.score(empty(spark).select("text"), none, network).count() == 0


def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{MID}/labels.parquet")
    found = QUERIES["op1_quality_classifier"](spark, MID).join(docs, "doc_id").collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.3) for r in found)
    held = [r for r in found if r.held_out]
    good = [r.score for r in held if r.quality == 1]
    bad = [r.score for r in held if r.quality == 0]
    order = np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])
    assert order > 0.9
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9


def test_labels_are_no_inputs(spark):
    """Scores of held-out rows do not change with their labels."""
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 15)], "doc_id long, quality int")
    vectors = C.word_vectors(C.context_sums(docs))
    used = labels.where("doc_id <> 3")
    flipped = labels.withColumn("quality", F.when(F.col("doc_id") == 3, 1 - F.col("quality")).otherwise(F.col("quality"))).where("doc_id <> 3")
    a, b = (sorted(r.score for r in C.score(docs.select("text"), vectors, C.train(docs, x, vectors)).collect()) for x in (used, flipped))
    assert a == pytest.approx(b)
