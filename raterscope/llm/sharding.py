"""Uniform shuffle into shards of exact sizes through a communication matrix.

Rows lie in partitions. How many rows of partition p go to shard s follows the multivariate
hypergeometric law of a uniform random permutation; the matrix of these counts is drawn
first, exactly. Each partition then permutes its rows and deals the first of them to shard
0, the next to shard 1 and so on; after the exchange each shard permutes what it got. Shard
sizes are exact and every permutation is equally likely, without a global sort.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from raterscope.llm.common import free_name, hash_unit, register, table
from raterscope.session import stored

ROWS_PER_CELL = 1 << 16


def communication_matrix(sizes: list[int], n_shards: int, seed: int) -> np.ndarray:
    """Counts by partition and shard: rows sum to `sizes`, columns to shares at most one apart."""
    total = int(sum(sizes))
    left = np.array([total // n_shards + (s < total % n_shards) for s in range(n_shards)], np.int64)
    draw = np.random.default_rng(seed)
    matrix = np.zeros((len(sizes), n_shards), np.int64)
    for p, size in enumerate(sizes):
        matrix[p] = _draw(draw, left, int(size))
        left -= matrix[p]
    return matrix


def _draw(draw: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """How many of n rows, drawn without replacement, have each of the colours `left`."""
    total = int(left.sum())
    if total < 10**9:  # the limit of numpy's exact sampler
        return draw.multivariate_hypergeometric(left, n, method="marginals")
    chosen = np.zeros(0, np.int64)
    while len(chosen) < n:  # a uniform n-subset of the places, repeats drawn anew
        chosen = np.unique(np.concatenate([chosen, draw.integers(0, total, n - len(chosen))]))
    return np.bincount(np.searchsorted(np.cumsum(left), chosen, side="right"), minlength=len(left))


def assign(docs: DataFrame, n_shards: int, seed: int = 7) -> DataFrame:
    """All columns of `docs` with `shard` (0 to n_shards - 1) and `slot` (0, 1, ... in a shard).

    Shard sizes differ by one row at most. Any row may be null, empty or repeated: rows are
    told apart by their place in the stored copy, which is written once to the shared folder,
    so a recomputed task deals the same. An empty table gives an empty result. Columns of
    `docs` named `shard` or `slot` give way. The driver sees one count per partition.
    """
    columns = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    own = []  # names of helper columns
    for name in ("_part", "_place", "_rank", "_ends", "_key2", "_cell", "_before", "_inside", "_n"):
        own.append(free_name([*columns, *own], name))
    part, place, rank, ends_of, key2, cell, before, inside, n = own
    rows = stored(
        docs.select(*[F.col(f"`{c}`") for c in columns])
        .withColumn(part, F.spark_partition_id())
        .withColumn(place, F.monotonically_increasing_id()),
        "sharding",
    )
    counts = rows.groupBy(part).count().collect()
    counts = sorted((r[0], r[1]) for r in counts)
    matrix = communication_matrix([m for _, m in counts], n_shards, seed)
    ends = rows.sparkSession.createDataFrame(
        [(p, [int(x) for x in np.cumsum(m)]) for (p, _), m in zip(counts, matrix, strict=True)],
        f"`{part}` int, `{ends_of}` array<long>",
    )
    permuted = W.partitionBy(part).orderBy(_key(place, seed, 1), place)
    dealt = (
        rows.withColumn(rank, F.row_number().over(permuted))
        .join(ends, part)
        .withColumn("shard", F.size(F.filter(ends_of, lambda end: end < F.col(rank))))
        .withColumn(key2, _key(place, seed, 2))
    )
    # a shard is cut by its second random key into cells that one task can sort
    total = sum(m for _, m in counts)
    cells = max(1, -(-total // (n_shards * ROWS_PER_CELL)))
    dealt = dealt.withColumn(cell, F.floor(F.col(key2) * cells))
    sizes = dealt.groupBy("shard", cell).agg(F.count("*").alias(n))
    earlier = W.partitionBy("shard").orderBy(cell).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("shard", cell, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    in_cell = W.partitionBy("shard", cell).orderBy(key2, place)
    return (
        dealt.withColumn(inside, F.row_number().over(in_cell) - 1)
        .join(offsets, ["shard", cell])
        .select(*[F.col(f"`{c}`") for c in columns], "shard", (F.col(before) + F.col(inside)).cast("long").alias("slot"))
    )


def _key(place: str, seed: int, step: int) -> Column:
    return hash_unit(F.col(place), F.lit(step), seed=seed)


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard; rows lie in the order of their slots."""
    ordered = assigned.repartition("shard").sortWithinPartitions("shard", "slot")
    ordered.write.mode("overwrite").partitionBy("shard").parquet(path)


@register()
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return assign(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
