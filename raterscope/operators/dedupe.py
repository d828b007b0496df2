"""Keep one row per key.

`row_number() = 1` lets Spark put a group limit on the map side of the shuffle, so
every task sends at most one row per key however often a key is copied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raterscope.operators.skew import short_hash

LABEL_KEY = ["project_id", "reporting_week", "job_id", "rater_id", "parent_label"]
OUTCOME_KEY = ["project_id", "reporting_week", "job_id", "rater_id", "auditor_id", "job_correct"]
RUBRIC_KEY = OUTCOME_KEY + ["rubric"]


def keep_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lowest row of each key, ordered by every other column with nulls last."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return top_per_group(df, keys, rest, 1)


def keep_last(df: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """The row with the highest position of each key."""
    return top_per_group(df, keys, [F.col(c).desc_nulls_last() for c in position], 1)


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The first `n` rows of each key in the given order.

    The key's hash leads the partition columns: the sorts before and after the shuffle
    then compare one number, and look at the key and order columns only where rows collide.
    """
    window = Window.partitionBy("_hash", *keys).orderBy(*order)
    return (
        df.withColumn("_hash", short_hash(*keys))
        .withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") <= n)
        .drop("_rank", "_hash")
    )
