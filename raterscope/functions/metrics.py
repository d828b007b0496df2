"""Quality formulas over aggregated counts. All are null on a zero denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONFUSION = {"tp_count": "TP", "tn_count": "TN", "fp_count": "FP", "fn_count": "FN"}
SCORE_DIGITS = 6


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part / whole)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)


def precision(tp: Column, fp: Column) -> Column:
    return ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return ratio(tp, tp + fn)


def above_target(score: Column, target: Column) -> Column:
    """1 when the score reaches the target; a missing score or target counts as 0."""
    return F.when(score >= target, 1).otherwise(0)


def confusion_counts() -> list[Column]:
    """One conditional count per confusion cell."""
    return [
        F.count_if(F.col("confusion_type") == cell).alias(name) for name, cell in CONFUSION.items()
    ]


def no_confusion() -> list[Column]:
    """Zero cells for methodologies that have no confusion matrix."""
    return [F.lit(0).cast("bigint").alias(name) for name in CONFUSION]


def confusion_scores(prefix: str) -> list[Column]:
    """`<prefix>_f1score`, `<prefix>_precision`, `<prefix>_recall` from the count columns."""
    tp, fp, fn = F.col("tp_count"), F.col("fp_count"), F.col("fn_count")
    return [
        f1(tp, fp, fn).alias(f"{prefix}_f1score"),
        precision(tp, fp).alias(f"{prefix}_precision"),
        recall(tp, fn).alias(f"{prefix}_recall"),
    ]


def zero_scores(prefix: str) -> list[Column]:
    return [F.lit(0.0).alias(f"{prefix}_{name}") for name in ("f1score", "precision", "recall")]


def rounded(*names: str) -> list[Column]:
    return [F.round(F.col(name), SCORE_DIGITS).alias(name) for name in names]


def binary_confusion(
    label: Column, rater: Column, auditor: Column, positives: dict[str, str]
) -> tuple[Column, Column]:
    """(is_label_binary, confusion_type); the positive value is matched exactly."""
    expected = _lookup(label, positives)
    rater_yes = F.coalesce(rater, F.lit("")) == expected
    auditor_yes = F.coalesce(auditor, F.lit("")) == expected
    cell = (
        F.when(expected.isNull(), "")
        .when(rater_yes & auditor_yes, "TP")
        .when(rater_yes, "FP")
        .when(auditor_yes, "FN")
        .otherwise("TN")
    )
    return expected.isNotNull(), cell


def responses_match(
    rater: Column, auditor: Column, case_sensitive: bool = False, strip: bool = True
) -> Column:
    sides = [F.coalesce(c, F.lit("")) for c in (rater, auditor)]
    if strip:
        sides = [F.trim(c) for c in sides]
    if not case_sensitive:
        sides = [F.lower(c) for c in sides]
    return sides[0] == sides[1]


def label_weight(label: Column, weights: dict[str, float]) -> Column:
    return F.coalesce(_lookup(label, {k: float(v) for k, v in weights.items()}), F.lit(1.0))


def _lookup(key: Column, mapping: dict) -> Column:
    if not mapping:
        return F.lit(None)
    literals = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*literals), key)
