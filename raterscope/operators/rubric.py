"""Rubric penalties: inference from manual scores, naming, and scoring of long rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raterscope.functions.clean import normalize_penalty, slug
from raterscope.operators.skew import attach, lookup
from raterscope.session import checkpoint_dir

DEFAULT_ENTRY = "default_rubric"
DEFAULT_PENALTY = -1.0


def infer_penalties(
    records: DataFrame,
    scope: Sequence[str] = (),
    provided: dict[str, float] | None = None,
) -> DataFrame:
    """Penalty of every rubric entry that the manual scores determine.

    `records` has the scope columns, `row_id`, `items` (array of struct(entry, factor))
    and `score`. A record deducts 100 - score = sum(factor * penalty). Each round solves
    the records with exactly one unknown entry; the lowest row id wins a conflict, and a
    provided penalty is never replaced. Rounds stop when nothing new is solved, so there
    are at most as many as entries. With consistent scores the order does not matter; with
    conflicting ones the earliest round wins.

    Records with the same items and deduction are merged first (map-side), which leaves
    the few distinct scoring patterns for the rounds. Each round is checkpointed.
    """
    spark = records.sparkSession
    checkpoint_dir(spark)
    scope = list(scope)
    patterns = (
        records.where(F.col("score").isNotNull())
        .select(
            *scope,
            "row_id",
            F.array_sort("items").alias("items"),
            (100 - F.col("score")).alias("deduction"),
        )
        .groupBy(*scope, "items", "deduction")
        .agg(F.min("row_id").alias("row_id"))
    )
    items = patterns.select(*scope, "row_id", "deduction", F.inline("items")).checkpoint()
    known = _seeds(items, scope, provided or {})
    while True:
        solved = _solve_round(items, known, scope).checkpoint()
        if solved.isEmpty():
            return known
        known = known.unionByName(solved)


def _seeds(items: DataFrame, scope: list[str], provided: dict[str, float]) -> DataFrame:
    """The provided penalties, once per scope."""
    scopes = items.select(*scope).distinct() if scope else items.select(F.lit(1)).limit(1)
    literals = [F.lit(x) for k, v in provided.items() for x in (k, float(v))]
    given = F.create_map(*literals).cast("map<string,double>")
    return scopes.select(*scope, F.explode(given).alias("entry", "penalty"))


def _solve_round(items: DataFrame, known: DataFrame, scope: list[str]) -> DataFrame:
    joined = attach(items, known, scope + ["entry"])
    penalty = F.col("penalty")
    open_entry = penalty.isNull()
    per_record = joined.groupBy(*scope, "row_id").agg(
        F.max("deduction").alias("deduction"),
        F.sum(F.coalesce(F.col("factor") * penalty, F.lit(0.0))).alias("explained"),
        F.count_if(open_entry).alias("open_entries"),
        F.max(F.when(open_entry, F.col("entry"))).alias("entry"),
        F.max(F.when(open_entry, F.col("factor"))).alias("factor"),
    )
    one_open = (F.col("open_entries") == 1) & (F.col("factor") != 0)
    value = (F.col("deduction") - F.col("explained")) / F.col("factor")
    return (
        per_record.where(one_open)
        .withColumn("value", value)
        .groupBy(*scope, "entry")
        .agg(F.min_by("value", "row_id").alias("penalty"))
    )


def name_rubric(
    penalties: DataFrame, scope: Sequence[str] = (), names: dict[str, str] | None = None
) -> DataFrame:
    """Add `rubric`, the short name of an entry; repeats get _2, _3 in entry order.

    Configured names come first.
    """
    scope = list(scope)
    given = F.lit(None).cast("string")
    if names:
        literals = [F.lit(x) for pair in names.items() for x in pair]
        given = F.try_element_at(F.create_map(*literals), F.col("entry"))
    window = Window.partitionBy(*scope, "_slug").orderBy(F.col("_given").isNull(), "entry")
    return (
        penalties.withColumn("_given", given)
        .withColumn("_slug", slug(F.coalesce("_given", "entry")))
        .withColumn("_n", F.row_number().over(window))
        .withColumn(
            "rubric",
            F.when(F.col("_n") == 1, F.col("_slug")).otherwise(
                F.concat("_slug", F.lit("_"), F.col("_n").cast("string"))
            ),
        )
        .drop("_given", "_slug", "_n")
    )


def rubric_score(factor: Column, penalty: Column) -> Column:
    return F.bround(-factor * penalty, 3)


def rubric_rows(
    df: DataFrame,
    rubric: DataFrame,
    scope: Sequence[str],
    spread: Sequence[str],
    factors: str = "factors",
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Every row x every rubric entry of its scope plus the default entry.

    `factors` is the row's map entry -> factor; absent entries count 0. `rubric` has the
    scope columns, `entry`, `rubric` and `penalty`. The default entry has factor 1. A scope
    with a large part of the rows is cut into slices.
    """
    scope = list(scope)
    sizes = df.groupBy(*scope).agg(F.count("*").alias("_rows"))
    default = sizes.select(
        *scope,
        F.lit(DEFAULT_ENTRY).alias("entry"),
        F.lit(DEFAULT_ENTRY).alias("rubric"),
        F.lit(DEFAULT_PENALTY).alias("rubric_penalty"),
    )
    penalty = F.coalesce(normalize_penalty(F.col("penalty")), F.lit(0.0))
    entries = rubric.select(
        *scope, "entry", "rubric", penalty.alias("rubric_penalty")
    ).unionByName(default)
    joined = lookup(
        df, entries, scope, "_rows", spread, "inner", rows_per_slice=rows_per_slice, sizes=sizes
    )
    found = F.try_element_at(F.col(factors), F.col("entry")).cast("int")
    factor = F.when(F.col("entry") == DEFAULT_ENTRY, 1).otherwise(F.coalesce(found, F.lit(0)))
    return (
        joined.withColumn("factor", factor)
        .withColumn("rubric_score", rubric_score(F.col("factor"), F.col("rubric_penalty")))
        .drop("entry", factors)
    )
