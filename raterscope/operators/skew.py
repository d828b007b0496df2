"""Joins that stay balanced when a few keys hold much of the data.

`lookup` joins fact rows to a table with one row per key and a size column. Every key above
`ROWS_PER_SLICE` rows is cut into slices: the fact row picks a slice by hashing other
columns, and the table row is repeated once per slice. The keys that are cut and their slice
counts are broadcast; there are at most (all rows / ROWS_PER_SLICE) of them, which is half a
million for a trillion rows.

`attach` joins a dimension and leaves the strategy to Catalyst: a broadcast where the
optimizer knows the dimension to be small, else a sort-merge join whose large partitions
adaptive execution splits.

The joins of `lookup` compare keys null-safely. Besides treating null as a key of its own, this
keeps Spark from adding not-null filters to one side, so a table aggregated from the fact rows
reuses the shuffle of those rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SLICE = 2_000_000


#: Values of `short_hash`; two random bytes a row in a shuffle, as random bytes do not compress.
SHORT_HASHES = 1 << 16


def short_hash(*columns: str | Column) -> Column:
    """A small hash that leads sort orders: few rows of other keys share it within one task.

    Its bits are masked, as `pmod` may be null for all Spark knows and would add a filter to one side of a join.
    """
    return F.xxhash64(*columns).bitwiseAND(F.lit(SHORT_HASHES - 1).cast("long"))


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join on keys with null equal to null; the key columns come from the left.

    The keys' hash is compared first, so a sort-merge join sorts by one number.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys}).withColumn(
        "_right_hash", short_hash(*[F.col(f"_right_{k}") for k in keys])
    )
    condition = reduce(
        and_,
        [F.col("_left_hash") == F.col("_right_hash")]
        + [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys],
    )
    return (
        left.withColumn("_left_hash", short_hash(*keys))
        .join(renamed, condition, how)
        .drop("_left_hash", "_right_hash", *[f"_right_{k}" for k in keys])
    )


def hot_keys(sizes: DataFrame, keys: Sequence[str], size: str, rows_per_slice: int) -> DataFrame:
    """All keys above `rows_per_slice` rows, with their slice count."""
    return sizes.where(F.col(size) > rows_per_slice).select(
        *keys, F.ceil(F.col(size) / rows_per_slice).cast("int").alias("_slices")
    )


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    size: str,
    spread: Sequence[str],
    how: str = "left",
    rows_per_slice: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Join `table` (unique on `keys`) to `rows`; `size` is the number of rows per key."""
    keys = list(keys)
    sizes = table if sizes is None else sizes
    hot = F.broadcast(hot_keys(sizes, keys, size, rows_per_slice or ROWS_PER_SLICE))
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    left = (
        join_null_safe(rows, hot, keys)
        .withColumn("_slice", F.pmod(F.xxhash64(*spread), slices).cast("int"))
        .drop("_slices")
    )
    right = (
        join_null_safe(table, hot, keys)
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices")
    )
    return join_null_safe(left, right, keys + ["_slice"], how).drop("_slice")


def attach(
    rows: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join a dimension that is unique on `keys`: the columns of `rows`, then its others."""
    keys = list(keys)
    joined = rows.join(dimension.dropna(subset=keys), keys, how)
    more = [] if how in ("left_semi", "left_anti") else [c for c in dimension.columns if c not in keys]
    return joined.select(*[F.col(f"`{c}`") for c in (*rows.columns, *more)])
