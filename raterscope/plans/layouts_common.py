"""Steps shared by the layout normalisers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raterscope.functions import clean
from raterscope.functions import metrics as m

CARRIED = ("project_id", "reporting_week", "source_file")
POSITION = ("block_start", "row_pos")


def with_source(df: DataFrame) -> DataFrame:
    """Make sure a raw table names its file and the order of its rows."""
    if "source_file" not in df.columns:
        df = df.withColumn("source_file", F.lit(""))
    if "row_pos" not in df.columns:
        df = df.withColumn("row_pos", F.monotonically_increasing_id())
    return df


def carried(df: DataFrame) -> list[str]:
    return [c for c in CARRIED if c in df.columns]


def positions(df: DataFrame) -> list[str]:
    return [c for c in POSITION if c in df.columns]


def checked(
    df: DataFrame, ids: Sequence[str], day: Column, strip: bool = False, **more: Column
) -> DataFrame:
    """Replace ids by their valid form (null when invalid) and add `job_date`, each made once."""
    made = {n: clean.valid_id(F.col(n), strip) for n in ids}
    return clean.once(df, made | {"job_date": clean.lenient_date(day)} | more)


def rule(key: str, *fallbacks: str, required: bool = True) -> dict:
    """A role's configuration key and default headers."""
    return {"config_key": f"{key}_column", "fallbacks": list(fallbacks), "required": required}


def any_null(names: Sequence[str]) -> Column:
    condition = F.lit(False)
    for name in names:
        condition = condition | F.col(name).isNull()
    return condition


def blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""


def audit_flags(df: DataFrame, config: dict) -> DataFrame:
    """Binary flag, confusion cell, correctness and weight of long audit rows."""
    positives = {
        item["label_name"]: str(item["binary_positive_value"])
        for item in config.get("binary_labels", [])
    }
    label, rater, auditor = (
        F.col(c) for c in ("parent_label", "rater_response", "auditor_response")
    )
    is_binary, cell = m.binary_confusion(label, rater, auditor, positives)
    return df.withColumns(
        {
            "is_label_binary": is_binary,
            "confusion_type": cell,
            "is_correct": m.responses_match(rater, auditor),
            "weight": m.label_weight(label, config.get("label_weights", {})),
        }
    )
