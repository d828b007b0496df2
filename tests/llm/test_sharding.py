import zlib

import numpy as np

from raterscope.llm import sharding as S
from raterscope.llm.queries import QUERIES
from tests.llm.cases import documents, empty, own_values


def check_law(found, n, shards):
    by = {}
    for r in found:
        by.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, by.values())) == n
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


def test_exact_sizes_and_gapless_slots(spark, sf, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_CELL", 5)
    docs = documents(spark).repartition(5)
    found = S.assign(docs, 4)
    assert found.columns.count("shard") == 1 and "text" in found.columns
    check_law(found.collect(), docs.count(), 4)
    assert own_values(found, ("shard", "slot"))
    real = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").repartition(7)
    check_law(S.assign(real, 24).collect(), real.count(), 24)


def test_empty_table_and_more_shards_than_rows(spark):
    assert S.assign(empty(spark), 3).count() == 0
    few = spark.range(2).withColumnRenamed("id", "doc_id")
    check_law(S.assign(few, 5).collect(), 2, 5)


def test_matrix_has_both_margins():
    for sizes in ([5, 0, 9, 3], [2 * 10**9, 7]):
        if sum(sizes) > 10**9:
            left = np.array([10**9, 10**9, 7], np.int64)
            got = S._draw(np.random.default_rng(1), left, 1000)
            assert got.sum() == 1000 and (got <= left).all() and got[2] < 7
            continue
        m = S.communication_matrix(sizes, 4, 1)
        assert m.sum(axis=1).tolist() == sizes
        assert np.ptp(m.sum(axis=0)) <= 1


def test_permutation_is_uniform(spark):
    """Each row is equally likely in each shard, over seeds."""
    rows = spark.range(8, numPartitions=2).withColumnRenamed("id", "doc_id")
    counts = np.zeros((8, 2))
    for seed in range(40):
        for r in S.assign(rows, 2, seed=seed).collect():
            counts[r.doc_id, r.shard] += 1
    assert (counts.sum(axis=1) == 40).all()
    assert counts.min() >= 8


def test_written_shards_keep_the_order(spark, tmp_path):
    path = str(tmp_path / "shards")
    S.write_shards(S.assign(spark.range(50).withColumnRenamed("id", "doc_id"), 3), path)
    for shard in range(3):
        slots = [r.slot for r in spark.read.parquet(f"{path}/shard={shard}").collect()]
        assert slots == sorted(slots)


def test_query_equals_plain_sizes_and_checksums(spark, sf):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op4_sharding"](spark, sf).collect()
    check_law(found, len(docs), 24)
    wanted = sorted((i, len(t) + 8, zlib.crc32(t), "rows", None) for i, t in docs.items())
    assert sorted((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in found) == wanted
