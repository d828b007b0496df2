"""Wide or nested answers to long rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raterscope.operators.skew import lookup


def expand_labels(df: DataFrame, entries: str) -> DataFrame:
    """One row per entry of an array of struct(key, value)."""
    return df.select("*", F.inline(entries)).drop(entries)


def label_universe(df: DataFrame, file_keys: Sequence[str], maps: Sequence[str]) -> DataFrame:
    """The distinct labels of each source file, one row per label."""
    names = F.explode(F.array_distinct(F.flatten(F.array(*[F.map_keys(c) for c in maps]))))
    return df.select(*file_keys, names.alias("parent_label")).distinct()


def align_labels(
    df: DataFrame,
    file_keys: Sequence[str],
    spread: Sequence[str],
    rater: str = "rater_map",
    auditor: str | None = None,
    rater_labels_only: bool = True,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Every row x every label of its file, with both sides' answers ('' when missing).

    Answers stay in the row's own map, so the only join is to the labels of the file. A
    file with a large part of the rows is cut into slices, each with its copy of the labels.
    """
    file_keys = list(file_keys)
    maps = [rater] if auditor is None or rater_labels_only else [rater, auditor]
    sizes = df.groupBy(*file_keys).agg(F.count("*").alias("_rows"))
    long = lookup(
        df,
        label_universe(df, file_keys, maps),
        file_keys,
        "_rows",
        spread,
        "inner",
        rows_per_slice=rows_per_slice,
        sizes=sizes,
    )
    answers = {"rater_response": _answer(rater)}
    if auditor:
        answers["auditor_response"] = _answer(auditor)
    return long.withColumns(answers).drop(*[c for c in (rater, auditor) if c])


def _answer(side: str) -> Column:
    return F.coalesce(F.try_element_at(F.col(side), F.col("parent_label")), F.lit(""))


def unpivot_labels(df: DataFrame, base: Sequence[str], labels: Sequence[dict]) -> DataFrame:
    """Long rows from configured columns.

    Each label is a dict of `parent_label` and one Column per output field.
    """
    fields = [k for k in labels[0] if k != "parent_label"]
    rows = [
        F.struct(
            F.lit(item["parent_label"]).alias("parent_label"),
            *[item[f].alias(f) for f in fields],
        )
        for item in labels
    ]
    return df.select(*base, F.inline(F.array(*rows)))
