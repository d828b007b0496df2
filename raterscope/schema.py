"""The column contract of the canonical copy of normalised long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The canonical column list, in its published order.
CANONICAL = {
    "project_id": T.StringType(),
    "reporting_week": T.DateType(),
    "content_week": T.DateType(),
    "workflow": T.StringType(),
    "job_date": T.DateType(),
    "rater_id": T.StringType(),
    "auditor_id": T.StringType(),
    "job_id": T.StringType(),
    "job_overall_correct": T.BooleanType(),
    "job_manual_score": T.DoubleType(),
    "label": T.StringType(),
    "rater_response": T.StringType(),
    "auditor_response": T.StringType(),
    "is_correct": T.BooleanType(),
    "is_label_binary": T.BooleanType(),
    "confusion_type": T.StringType(),
    "weight": T.DoubleType(),
    "rubric_credit": T.DoubleType(),
}

# Source column that feeds a canonical column under another name.
CANONICAL_SOURCES = {
    "job_overall_correct": ["job_correct"],
    "job_manual_score": ["overall_score"],
    "label": ["rubric", "parent_label"],
    "rubric_credit": ["rubric_score"],
    "weight": ["factor"],
}


def _typed(df: DataFrame, name: str, dtype: T.DataType) -> Column:
    source = F.col(name) if name in df.columns else F.lit(None)
    return source.cast(dtype).alias(name)


def to_canonical(df: DataFrame) -> DataFrame:
    """Canonical 18-column copy of any normalised table, plus its methodology."""
    renames = {}
    for target, sources in CANONICAL_SOURCES.items():
        found = next((s for s in sources if s in df.columns), None)
        if found:
            renames[target] = found
    columns = [
        (F.col(renames.get(name, name)) if renames.get(name, name) in df.columns else F.lit(None))
        .cast(dtype)
        .alias(name)
        for name, dtype in CANONICAL.items()
    ]
    methodology = "rubric" if "rubric" in df.columns else "label"
    return df.select(*columns, F.lit(methodology).alias("methodology"))
