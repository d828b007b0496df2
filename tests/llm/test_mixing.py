import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from raterscope.llm import mixing as M
from raterscope.llm.queries import ORACLE, QUERIES
from tests.llm.cases import documents, empty


def brute_targets(sizes, cycle=(3, 1, 2), share=1.5, most=2):
    """Share by weight, cap, reshare what is left among the others, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    done, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if weight[s] * level > most * sizes[s]]
        if not above:
            return done | {s: weight[s] * level for s in open_}
        for s in above:
            done[s] = most * sizes[s]
            left -= done[s]
            open_.discard(s)
    return done


@pytest.mark.parametrize("seed", range(3))
def test_targets_equal_iterated_sharing(spark, seed):
    draw = random.Random(seed)
    sizes = {f"s{i}": draw.choice([0, 3, 50, 1000, 40_000]) for i in range(9)} | {None: 77}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in M.source_targets(rows).collect()}
    wanted = brute_targets(sizes)
    assert found.keys() == wanted.keys()
    assert all(math.isclose(found[s], wanted[s], rel_tol=1e-9, abs_tol=1e-9) for s in wanted)


def test_taken_words_come_near_targets(spark):
    docs = documents(spark)
    found = M.mix(docs, M.text_quality(F.col("text"))).collect()
    assert len(found) == docs.count()
    for source in {r.doc.source for r in found}:
        own = [r for r in found if r.doc.source == source]
        largest = max(r.size for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * largest  # repeated rows are taken alike
        assert all(r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in own)
        assert own[0].source_size == sum(r.size for r in own)
    again = M.mix(docs.repartition(3), M.text_quality(F.col("text"))).collect()
    key = lambda r: (r.doc.doc_id or 0, r.size, r.taken)
    assert sorted(map(key, found)) == sorted(map(key, again))
    assert M.repeat(M.mix(docs, F.lit(1.0))).columns == docs.columns


def test_empty_table(spark):
    assert M.mix(empty(spark), F.lit(1.0)).count() == 0


def test_better_documents_are_taken_first(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.lit("s").alias("source"))
    weight = F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.1)
    found = M.mix(rows, weight, share=0.5).groupBy(F.col("doc.doc_id") % 2).agg(F.sum("copies")).collect()
    taken = dict(map(tuple, found))
    assert taken[0] + taken[1] == pytest.approx(2000, abs=2)
    assert taken[0] > 3 * taken[1]


@pytest.mark.parametrize("name", ["op3_mixing", "op5_url_filters"])
def test_queries_equal_sql(spark, sf, name):
    assert compare(QUERIES[name](spark, sf), connect(sf), ORACLE[name]) == []


def test_no_python_in_the_plan(spark, sf):
    plan = QUERIES["op3_mixing"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("weight", [1.0, 0.3, 0.05, 2.0**-15])
def test_buckets_stay_small_and_in_order(spark, weight):
    n = 200_000
    keys = spark.range(n).select(M.sampling_key(F.col("id").cast("string"), F.lit(weight)).alias("key"))
    found = [(r.key, r.b) for r in keys.select("key", M.bucket_of(F.col("key")).alias("b")).orderBy("key").collect()]
    buckets = [b for _, b in found]
    assert buckets == sorted(buckets) and 0 <= buckets[0] and buckets[-1] < M.LEVEL**2
    # the proven bound is 2 * (LEAST_POWER + 1) / LEVEL^2 of the rows, about a hundred of these
    assert max(Counter(buckets).values()) < 1.6 * n * 2 * (M.LEAST_POWER + 1) / M.LEVEL**2
