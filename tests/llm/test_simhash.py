import numpy as np
import pytest
import xxhash

from raterscope.llm import simhash as S
from tests.llm.cases import documents, empty, own_values


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 4:
                root[find(i)] = find(j)
    low = {}
    for i, name in enumerate(ids):
        if name is not None:
            low[find(i)] = min(low.get(find(i), name), name)
    return [low.get(find(i)) for i in range(len(fps))]


def test_fingerprints_equal_brute_force(spark):
    docs = documents(spark)
    for r in S.fingerprints(docs.withColumnRenamed("doc_id", "k").withColumn("doc_id", docs.text), "doc_id").collect():
        if r.doc_id is None or len(r.doc_id) < 50_000:
            assert r.fp % 2**64 == brute_fingerprint(r.doc_id)


@pytest.mark.parametrize("bucket", [256, 2])
def test_components_equal_brute_force(spark, sf, bucket):
    """A bucket of 2 sends nearly all through the path for large buckets."""
    for docs in (documents(spark), spark.read.parquet(f"{sf}/documents.parquet")):
        found = S.near_duplicates(docs, bucket=bucket).collect()
        assert len(found) == docs.count()
        wanted = brute_components([r.fp for r in found], [r.doc_id for r in found])
        assert [r.component_id for r in found] == wanted


@pytest.mark.parametrize("bucket", [256, 8])
def test_chains_and_dense_groups(spark, monkeypatch, bucket):
    draw = np.random.default_rng(5)
    fps = [int(draw.integers(0, 2**63))]
    for _ in range(60):  # a chain: each four bits from the last
        fps.append(fps[-1] ^ sum(1 << int(b) for b in draw.choice(64, 4, replace=False)))
    centre = int(draw.integers(0, 2**63))
    fps += [centre ^ sum(1 << int(b) for b in draw.choice(64, int(draw.integers(0, 4)), replace=False)) for _ in range(80)]
    ids = draw.permutation(len(fps)).tolist()
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    rows = spark.createDataFrame(list(zip(ids, signed, strict=True)), "doc_id long, fp long").repartition(4)
    monkeypatch.setattr(S, "fingerprints", lambda docs, *_: docs)
    found = {r.doc_id: r.component_id for r in S.near_duplicates(rows, bucket=bucket).collect()}
    assert [found[i] for i in ids] == brute_components(fps, ids)


def test_keep_one(spark):
    """One row for each component, by smallest id; rows without an id give way to those with one."""
    docs = documents(spark)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns and own_values(kept)
    rows = docs.collect()
    homes = brute_components([brute_fingerprint(r.text) for r in rows], range(len(rows)))
    last = lambda r: (r.doc_id is None, r.doc_id or 0)
    wanted = [min(last(r) for r, h in zip(rows, homes, strict=True) if h == home) for home in set(homes)]
    assert sorted(map(last, kept.collect())) == sorted(wanted)


def test_keep_one_of_clashing_and_missing_ids(spark):
    words = [f"w{i}" for i in range(200)]
    text, other = " ".join(words), " ".join(reversed(words))
    rows = [(None, text, 1), (None, text, 2), (1, other, 5), (1, other, 4), (1, text, 7), (2, text, 1), (None, None, 1), (None, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra int").repartition(3)
    found = {tuple(r) for r in S.keep_one(docs).collect()}
    assert found == {(1, other, 4), (1, text, 7), (None, "", 0)}
    alone = spark.createDataFrame([(None, text), (None, text), (None, other)], "doc_id long, text string")
    assert sorted(r.text for r in S.keep_one(alone).collect()) == sorted([text, other])
    assert S.keep_one(empty(spark)).count() == 0


def test_empty_table_and_bad_blocks(spark):
    assert S.near_duplicates(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        S.near_duplicates(empty(spark), blocks=6)
