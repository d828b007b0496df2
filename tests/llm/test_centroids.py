import hashlib
import math
import random

import numpy as np
import pytest

from checks.compare import compare, connect
from raterscope.llm import centroids as C
from raterscope.llm.queries import ORACLE, QUERIES


def brute(rows, n_clusters=40, rounds=5, width=64):
    """cluster and squared distance by row, and the centroids, by plain loops over whole numbers."""
    kept = [
        (i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    own = [p for _, p in sorted(kept, key=name)[:n_clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def nearest(p):
        return min((far(p, c), k) for k, c in enumerate(own))

    for _ in range(rounds):
        members = [[] for _ in own]
        for _, p in kept:
            members[nearest(p)[1]].append(p)
        own = [tuple(sum(x) // len(m) for x in zip(*m, strict=True)) if m else c for m, c in zip(members, own, strict=True)]
    return [(i, nearest(p)[1], nearest(p)[0]) for i, p in kept], own


def run(spark, rows, kind="double", **options):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, cluster string, near int, point string") if rows and len(rows[0]) == 5 else (
        spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    )
    found, centroids = C.cluster_vectors(df, **options)
    return found.collect(), centroids


@pytest.mark.parametrize("seed,scale", [(0, 1.0), (1, 0.02), (2, 5000.0)])
def test_equals_plain_loops(spark, seed, scale):
    draw = random.Random(seed)
    middles = [[draw.gauss(0, scale) for _ in range(4)] for _ in range(6)]
    rows = [(i, [draw.gauss(m, scale / 4) for m in draw.choice(middles)]) for i in range(400)]
    found, centroids = run(spark, rows, n_clusters=9, rounds=4, width=4)
    wanted, own = brute(rows, 9, 4, 4)
    assert sorted((r.id, r.cluster, r.distance) for r in found) == sorted(wanted)
    assert [tuple(c) for c in centroids.tolist()] == own


def test_bounds_never_exceed_distances():
    draw = np.random.default_rng(3)
    for size in (1, 300, C.LARGEST):
        points = draw.integers(-size, size, (500, 64), endpoint=True)
        points[:40] = points[40:80]  # distance zero
        own = C.prepared(points[:40], C.choose_pivots(points[:40]))
        bounds = C.lower_bounds(np.sqrt(C.squares(points, C.choose_pivots(points[:40]))), own)
        exact = np.array([[int(((p - c).astype(object) ** 2).sum()) for c in points[:40]] for p in points], object)
        assert (bounds <= exact.astype(float)).all()
    near = np.sqrt(C.squares(points, C.choose_pivots(points[:40])))
    cluster, distance, measured = C.assign(points, near, own)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_bounds_spare_distances():
    draw = np.random.default_rng(4)
    middles = draw.integers(-250, 250, (40, 64))
    points = middles[draw.integers(0, 40, 4000)] + draw.integers(-20, 20, (4000, 64))
    pivots = C.choose_pivots(middles)
    _, _, measured = C.assign(points, np.sqrt(C.squares(points, pivots)), C.prepared(middles, pivots))
    assert measured < 0.25 * 40 * len(points)


def test_ties_repeats_empty_clusters_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.0]), (4, [0.0, 0.0]), (4, [0.0, 0.0]), (None, [2.0, 2.0]), (None, [2.0, 2.0]),
            (5, None), (6, []), (7, [1.0]), (8, [nan, 0.0]), (9, [inf, 0.0]), (10, [None, 1.0]), (11, [-0.0, 0.001]), (12, [1.0, 2.0, 3.0])]
    for n_clusters in (1, 3, 7, 40):
        found, centroids = run(spark, rows, n_clusters=n_clusters, rounds=3, width=2)
        wanted, own = brute(rows, n_clusters, 3, 2)
        assert sorted(map(repr, ((r.id, r.cluster, r.distance) for r in found))) == sorted(map(repr, wanted))
        assert [tuple(c) for c in centroids.tolist()] == own
    clashing = [(i, v, "x", 1, "y") for i, v in rows]
    assert len(run(spark, clashing, width=2)[0]) == len(wanted)
    too_large = [(1, [1e300, 0.0]), (2, [1.0, 1.0])]
    assert [(r.id, r.distance) for r in run(spark, too_large, width=2)[0]] == [(2, 0)]


def test_all_equal_and_none(spark):
    found, centroids = run(spark, [(i, [0.25, -0.3]) for i in range(50)], width=2)
    assert {(r.cluster, r.distance) for r in found} == {(0, 0)} and len(centroids) == 40
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    found, centroids = C.cluster_vectors(df)
    assert found.collect() == [] and len(centroids) == 0


def test_query_equals_sql_and_plain_loops(spark, sf):
    query = QUERIES["op13_centroids"](spark, sf)
    assert compare(query, connect(sf), ORACLE["op13_centroids"]) == []
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    wanted, own = brute(rows)
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    got = {(r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in query.collect()}
    assert got == {(i, k, d, digest(own[k])) for i, k, d in wanted}
