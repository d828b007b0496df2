"""Normalisers of layouts that hold a job outcome and rubric entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raterscope.functions import clean, payload
from raterscope.operators import rubric as rb
from raterscope.plans.layouts_common import any_null, carried, checked, positions, rule, with_source
from raterscope.session import stored


# Configuration keys and default headers of the wide rubric layout.
WIDE_RULES = {
    "rater_id": rule("rater_id", "SRT Annotator ID"),
    "auditor_id": rule("auditor_id", "Vendor Auditor ID"),
    "job_date": rule("submission_date", "Time (PT)"),
    "job_id": rule("job_id", "SRT Job ID"),
    "status": rule("vendor_tag", "Vendor Tag"),
    "workflow": rule("workflow", "Rubric Name", "Queue Name", required=False),
    "manual_score": rule("manual_score", "Vendor Manual QA Score", required=False),
}

# Headers of the wide rubric layout that are not rubric entries.
WIDE_INFO_COLUMNS = [
    "Annotator ID", "SRT Annotator ID", "Name", "Response ID", "SRT Queue ID", "Queue Name",
    "Queue ID", "SRT Job ID", "Time (PT)", "Annotation Link", "Rubric ID", "Rubric Name",
    "Vendor Manual QA Score", "Vendor Tag", "Vendor Auditor ID", "Vendor Review Sample",
    "Vendor Comment",
]

# Configuration keys and default headers of the JSON rubric layout.
JSON_RULES = {
    "rater_id": rule("rater_id", "annotator_id"),
    "auditor_id": rule("auditor_id", "auditor_id"),
    "job_date": rule("submission_date", "original_submission_time"),
    "job_id": rule("job_id", "task_id"),
    "status": rule("audit_status", "audit_status"),
    "workflow": rule("workflow", "task_name", required=False),
    "manual_score": rule("manual_score", "QA_score", required=False),
    "job_rubric": rule("rubric", "rubric_answer", required=False),
}

WIDE_APPROVED = "Approved"
JSON_APPROVED = "AUDIT_APPROVED"
ROLES = ["workflow", "job_date", "rater_id", "auditor_id", "job_id"]


def normalize_outcome_wide_rubric(df: DataFrame, config: dict) -> DataFrame:
    """One column per rubric entry; non-zero numbers are factors."""
    return finish_outcome(stored(tag_outcome_wide(df, config), "outcome-rows"), config, WIDE_APPROVED)


def tag_outcome_wide(df: DataFrame, config: dict) -> DataFrame:
    mapped = clean.map_columns(with_source(df), WIDE_RULES, config.get("info_columns"))
    known = {*WIDE_INFO_COLUMNS, *WIDE_RULES, *carried(mapped), *positions(mapped)}
    entries = [c for c in mapped.columns if c not in known]
    pairs = F.array(
        *[
            F.struct(F.lit(c.strip()).alias("entry"), clean.number(F.col(f"`{c}`")).alias("factor"))
            for c in entries
        ]
    )
    # A blank or zero cell is no item of the row.
    items = F.filter(pairs, lambda p: p["factor"] != 0)
    return _tagged_items(mapped, items, config)


def normalize_outcome_json_rubric(df: DataFrame, config: dict) -> DataFrame:
    """Rubric as a JSON question list; the factor is the number of "Yes" answers."""
    return finish_outcome(stored(tag_outcome_json(df, config), "outcome-rows"), config, JSON_APPROVED)


def tag_outcome_json(df: DataFrame, config: dict) -> DataFrame:
    mapped = clean.map_columns(with_source(df), JSON_RULES, config.get("info_columns"))
    if "job_rubric" not in mapped.columns:
        mapped = mapped.withColumn("job_rubric", F.lit(None).cast("string"))
    items = F.transform(
        F.map_entries(payload.rubric_answers(F.col("job_rubric"))),
        lambda e: F.struct(
            F.trim(e["key"]).alias("entry"), e["value"].cast("double").alias("factor")
        ),
    )
    return _tagged_items(mapped, items, config)


def outcome_rejects(df: DataFrame, config: dict, layout: str) -> DataFrame:
    """Tagged rows of the `wide` or `json` layout, for reject counts."""
    rules = WIDE_RULES if layout == "wide" else JSON_RULES
    return _tag(clean.map_columns(with_source(df), rules, config.get("info_columns")), config)


def _tag(mapped: DataFrame, config: dict) -> DataFrame:
    """Typed ids, date and status, and the reject reason."""
    checks: list[tuple[str, Column]] = []
    token = config.get("organization_token")
    if token and "auditor_organization" in mapped.columns:
        inside = F.contains(F.col("auditor_organization"), F.lit(token))
        checks.append(("other_organization", ~F.coalesce(inside, F.lit(False))))
    if config.get("drop_self_audits", False):
        checks.append(("self_audit", F.col("_same_person")))
    ids = ["rater_id", "auditor_id", "job_id"]
    typed = mapped.withColumn("_same_person", F.col("auditor_id").eqNullSafe(F.col("rater_id")))
    typed = checked(typed, ids, F.col("job_date"), strip=True, status=F.trim("status"))
    checks += [
        ("invalid_date", F.col("job_date").isNull()),
        ("invalid_id", any_null(ids)),
        ("not_audited", F.coalesce(F.col("status"), F.lit("")) == ""),
    ]
    return clean.tag_rejects(typed, checks).drop("_same_person")


def _tagged_items(mapped: DataFrame, items: Column, config: dict) -> DataFrame:
    """What the finish needs of each row, tagged: place, roles, status, items and score."""
    if "manual_score" in mapped.columns:
        score = clean.number(F.col("manual_score"))
    else:
        score = F.lit(None).cast("double")
    columns = [*carried(mapped), *positions(mapped), *ROLES, "status"]
    columns += [c for c in ("auditor_organization",) if c in mapped.columns]
    return _tag(mapped.select(*columns, items.alias("items"), score.alias("score")), config)


def finish_outcome(tagged: DataFrame, config: dict, approved: str) -> DataFrame:
    """Rubric of each file from all its rows, then long rows of the accepted ones.

    The penalties are inferred before rows are rejected: a row with a bad date still
    tells what an entry costs. `tagged` is read several times, so it comes from a stored table.
    """
    scope, order = carried(tagged), positions(tagged)
    records = tagged.select(*scope, F.struct(*order).alias("row_id"), "items", "score")
    configured = config.get("rubric", [])
    penalties = {
        r["rubric_extended"]: r["rubric_penalty"]
        for r in configured
        if r.get("rubric_penalty") is not None
    }
    names = {r["rubric_extended"]: r["rubric_name"] for r in configured if r.get("rubric_name")}
    rubric = rb.name_rubric(rb.infer_penalties(records, scope, penalties), scope, names)
    kept = clean.accepted(tagged).select(
        *scope,
        *ROLES,
        F.coalesce(F.col("status") == approved, F.lit(False)).alias("job_correct"),
        (F.col("score") / 100).alias("job_manual_score"),
        F.map_from_entries("items").alias("factors"),
    )
    return rb.rubric_rows(kept, rubric, scope, ["job_id", "rater_id"])
