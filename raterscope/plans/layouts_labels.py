"""Normalisers of layouts that hold label answers: decision JSON, auditor-keyed JSON,
long audit rows, configured columns, and the relevance project."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raterscope.functions import clean, payload
from raterscope.functions import metrics as m
from raterscope.operators import dedupe, reshape
from raterscope.operators.rubric import DEFAULT_ENTRY, DEFAULT_PENALTY
from raterscope.plans.layouts_common import (
    any_null,
    audit_flags,
    blank,
    carried,
    checked,
    positions,
    rule,
    with_source,
)
from raterscope.session import stored

# --- decision JSON ---------------------------------------------------------------------


def _needs_auditor(config: dict) -> bool:
    return config.get("quality_methodology") in ("audit", "golden")


def tag_decision_json(df: DataFrame, config: dict) -> DataFrame:
    """Typed columns, parsed label lists, and the reject reason of each raw row."""
    df = with_source(df)
    extracted = config.get("use_extracted", False)
    sides = {"rater": "extracted_label" if extracted else "decision_data"}
    ids = ["job_id", "rater_id"]
    columns = {"rater_id": "actor_id", "job_id": "job_id", "workflow": "queue_name"}
    if _needs_auditor(config):
        sides["auditor"] = "quality_extracted_label" if extracted else "quality_decision_data"
        columns["auditor_id"] = "quality_actor_id"
        ids.append("auditor_id")
    typed = df.select(
        *carried(df),
        *positions(df),
        "review_ds",
        *[F.col(source).alias(name) for name, source in columns.items()],
        *[F.col(source).alias(f"{side}_text") for side, source in sides.items()],
    )
    typed = checked(typed, ids, F.col("review_ds")).drop("review_ds")
    if "auditor" in sides and config.get("ignore_missing_auditor_id", False):
        typed = typed.withColumn("auditor_id", clean.auditor_or_placeholder(F.col("auditor_id")))
    queues = list(config.get("excluded_queues", []))
    excluded = F.coalesce(F.col("workflow").isin(queues), F.lit(False)) if queues else F.lit(False)
    empty = F.lit(False)
    for side in sides:
        empty = empty | blank(f"{side}_text")
    cheap = [
        ("invalid_date", F.col("job_date").isNull()),
        ("invalid_id", any_null(ids)),
        ("empty_payload", empty),
        ("excluded_queue", excluded),
    ]
    # payloads are parsed only of rows that pass all other checks
    parse = payload.flat_labels if extracted else payload.decision_labels
    passed = clean.tag_rejects(typed, cheap).withColumnRenamed("reject_reason", "_cheap")
    parsed = clean.once(
        passed,
        {f"{s}_labels": F.when(F.col("_cheap").isNull(), parse(F.col(f"{s}_text"))) for s in sides},
    )
    broken = any_null([f"{side}_labels" for side in sides])
    return parsed.withColumn(
        "reject_reason", F.coalesce("_cheap", F.when(broken, F.lit("invalid_json")))
    ).drop("_cheap", *[f"{side}_text" for side in sides])


def normalize_decision_json(df: DataFrame, config: dict) -> DataFrame:
    """Long audit or multi rows; per file, the last row of a rater and job counts."""
    return finish_decision_json(tag_decision_json(df, config), config)


def finish_decision_json(tagged: DataFrame, config: dict) -> DataFrame:
    """Long rows of tagged ones.

    A row rejected for its JSON never displaces an accepted one: accepted rows sort first
    and the reject test follows the dedupe. The parsed rows are stored, because the label
    list of a file and its rows both come from them; each payload is parsed once.
    """
    audit = _needs_auditor(config)
    sides = ["rater", "auditor"] if audit else ["rater"]
    excluded = config.get("excluded_labels", [])
    tagged = tagged.withColumns(
        {f"{side}_map": payload.label_map(F.col(f"{side}_labels"), excluded) for side in sides}
    )
    files = carried(tagged)
    order = [F.col("reject_reason").isNull().desc()] + [
        F.col(c).desc() for c in positions(tagged)
    ]
    last = dedupe.top_per_group(tagged, files + ["rater_id", "job_id"], order, 1)
    rows = clean.accepted(last).drop(*[f"{side}_labels" for side in sides], *positions(tagged))
    rows = stored(rows, "decision-rows")
    long = reshape.align_labels(
        rows, files, ["job_id", "rater_id"], "rater_map", "auditor_map" if audit else None
    )
    if audit:
        return audit_flags(long, config)
    weight = m.label_weight(F.col("parent_label"), config.get("label_weights", {}))
    return long.withColumn("weight", weight)


# --- auditor-keyed JSON ----------------------------------------------------------------

COMBINED_ROUTING = "combined_routing"


def tag_auditor_keyed_json(df: DataFrame) -> DataFrame:
    """Last row per file, rater and job, with its reject reason."""
    df = with_source(clean.strip_header(df))
    typed = df.where(~F.col("routing_name").eqNullSafe(COMBINED_ROUTING)).select(
        *carried(df),
        *positions(df),
        "sample_ds",
        F.col("routing_name").alias("workflow"),
        F.col("entity_id").alias("job_id"),
        "rater_id",
        "rater_decision_data",
        "auditor_decision_data",
    )
    typed = clean.once(typed, {"job_date": clean.lenient_date(F.col("sample_ds"))}).drop("sample_ds")
    # Undated rows are dropped before the dedupe, so they sort last and are counted after it.
    order = [F.col("job_date").isNotNull().desc()] + [F.col(c).desc() for c in positions(typed)]
    last = dedupe.top_per_group(typed, carried(typed) + ["rater_id", "job_id"], order, 1)
    # payloads are parsed after the dedupe, and only of dated rows
    dated = F.col("job_date").isNotNull()
    parsed = clean.once(
        last,
        {
            "rater_labels": F.when(dated, payload.listed_labels(F.col("rater_decision_data"))),
            "keyed": F.when(dated, payload.auditor_keyed_labels(F.col("auditor_decision_data"))),
            "rater_id": clean.valid_id(F.col("rater_id")),
            "job_id": clean.valid_id(F.col("job_id")),
        },
    )
    typed = parsed.withColumns(
        {"auditor_id": F.col("keyed.auditor_id"), "auditor_labels": F.col("keyed.labels")}
    ).drop("keyed", "rater_decision_data", "auditor_decision_data")
    return clean.tag_rejects(
        typed,
        [
            ("invalid_date", F.col("job_date").isNull()),
            ("invalid_json", any_null(["rater_labels", "auditor_labels"])),
            ("invalid_id", any_null(["rater_id", "job_id"])),
        ],
    )


def normalize_auditor_keyed_json(df: DataFrame, config: dict) -> DataFrame:
    """Long audit rows over the union of rater and auditor labels of each file."""
    return finish_auditor_keyed_json(tag_auditor_keyed_json(df), config)


def finish_auditor_keyed_json(tagged: DataFrame, config: dict) -> DataFrame:
    excluded = config.get("excluded_labels", [])
    rows = clean.accepted(tagged).drop(*positions(tagged)).withColumns(
        {
            f"{side}_map": payload.label_map(F.col(f"{side}_labels"), excluded)
            for side in ("rater", "auditor")
        }
    ).drop("rater_labels", "auditor_labels")
    rows = stored(rows, "keyed-rows")
    long = reshape.align_labels(
        rows,
        carried(rows),
        ["job_id", "rater_id"],
        "rater_map",
        "auditor_map",
        rater_labels_only=False,
    )
    return audit_flags(long, config)


# --- long audit rows -------------------------------------------------------------------


# Configuration keys and default headers of the long audit layout.
LONG_AUDIT_RULES = {
    "rater_id": rule("actor_id", "actor_id"),
    "auditor_id": rule("reviewer_id", "reviewer_id"),
    "rater_response": rule("actor_response", "actor_answer"),
    "auditor_response": rule("reviewer_response", "reviewer_answer"),
    "job_date": rule("job_date", "job_date"),
    "job_id": rule("job_id", "job_id"),
    "workflow": rule("workflow", "queue", required=False),
    "parent_label": rule("label", "label"),
}


def tag_long_audit(df: DataFrame, config: dict) -> DataFrame:
    df = clean.map_columns(df, LONG_AUDIT_RULES, config.get("info_columns"))
    ids = ["rater_id", "auditor_id", "job_id"]
    typed = checked(
        df.select(*carried(df), *LONG_AUDIT_RULES), ids, F.col("job_date"), strip=True
    )
    return clean.tag_rejects(
        typed, [("invalid_date", F.col("job_date").isNull()), ("invalid_id", any_null(ids))]
    )


def normalize_long_audit(df: DataFrame, config: dict) -> DataFrame:
    """Rows that already hold one label each."""
    return finish_long_audit(tag_long_audit(df, config), config)


def finish_long_audit(tagged: DataFrame, config: dict) -> DataFrame:
    return audit_flags(clean.accepted(tagged), config)


# --- configured columns ----------------------------------------------------------------


def normalize_by_config(df: DataFrame, config: dict) -> DataFrame:
    """Any layout described by column names: audit, multi (wide or long) or outcome."""
    return finish_by_config(tag_by_config(df, config), config)


def finish_by_config(tagged: DataFrame, config: dict) -> DataFrame:
    method = config.get("quality_methodology")
    if method == "outcome":
        return _configured_outcome(tagged, config)
    if method == "audit":
        return _configured_audit(tagged, config)
    if method == "multi" and config.get("data_structure") == "unpivoted":
        return _configured_long(tagged, config)
    if method == "multi" and config.get("data_structure") == "pivoted":
        return _configured_wide(tagged, config)
    raise ValueError(f"unknown methodology or data structure: {method!r}")


def tag_by_config(df: DataFrame, config: dict) -> DataFrame:
    """Role columns beside all raw columns, with the reject reason."""
    info = config.get("info_columns", {})
    ids = ["rater_id", "job_id"] + (["auditor_id"] if config.get("quality_methodology") in ("audit", "outcome") else [])
    missing = [f"{role}_column" for role in ids if f"{role}_column" not in info]
    if missing:
        raise ValueError(f"the configuration names no {missing}")
    roles = {role: info[f"{role}_column"] for role in ids}
    made: dict[str, Column] = {
        role: clean.valid_id(F.col(f"`{column}`")) for role, column in roles.items()
    }
    workflow = info.get("workflow_column")
    made["workflow"] = F.col(f"`{workflow}`") if workflow else F.lit(clean.DEFAULT_WORKFLOW)
    day = info.get("job_date_column")
    if day:
        made["job_date"] = clean.lenient_date(F.col(f"`{day}`"))
    elif config.get("reporting_week"):
        made["job_date"] = F.lit(config["reporting_week"]).cast("date")
    else:  # a layout without dates is dated by the week it was delivered for
        week = F.col("reporting_week") if "reporting_week" in df.columns else F.lit(None)
        made["job_date"] = week.cast("date")
    return clean.tag_rejects(
        clean.once(df, made),
        [("invalid_date", F.col("job_date").isNull()), ("invalid_id", any_null(ids))],
    )


def _configured_base(tagged: DataFrame) -> tuple[DataFrame, list[str]]:
    rows = clean.accepted(tagged)
    roles = ["workflow", "job_date", "rater_id", "auditor_id", "job_id"]
    return rows, [c for c in carried(rows) + roles if c in rows.columns]


def _configured_weights(config: dict) -> dict[str, float]:
    return {item["label_name"]: item.get("weight", 1.0) for item in config["labels"]}


def answer_columns(rater: Column, auditor: Column, kind: str) -> tuple[Column, Column]:
    """(rater answer, outcome) of a configured label.

    `answer` compares both sides exactly. `agreement` reads the auditor's yes as the
    rater's answer being right; `disagreement` reads it as being wrong. An outcome that
    cannot be read is null.
    """
    if kind == "answer":
        return rater, F.coalesce(rater, F.lit("")) == F.coalesce(auditor, F.lit(""))
    yes = clean.boolish(auditor)
    if kind == "agreement":
        return F.when(yes, auditor), yes
    if kind == "disagreement":
        return F.when(F.coalesce(yes, F.lit(False)), F.lit(None)).otherwise(auditor), ~yes
    raise ValueError(f"unknown auditor column type: {kind!r}")


def _configured_audit(tagged: DataFrame, config: dict) -> DataFrame:
    rows, base = _configured_base(tagged)
    labels = []
    for item in config["labels"]:
        auditor = F.col(f"`{item['auditor_label_column']}`")
        source = item.get("rater_label_column")
        rater = F.col(f"`{source}`") if source else F.lit(None).cast("string")
        answer, outcome = answer_columns(rater, auditor, item["auditor_column_type"])
        labels.append(
            {
                "parent_label": item["label_name"],
                "rater_response": answer,
                "auditor_response": auditor,
                "is_correct": outcome,
            }
        )
    long = reshape.unpivot_labels(rows, base, labels).where(F.col("is_correct").isNotNull())
    return long.withColumns(
        {
            "is_label_binary": F.lit(False),
            "confusion_type": F.lit(None).cast("string"),
            "weight": m.label_weight(F.col("parent_label"), _configured_weights(config)),
        }
    )


def _configured_wide(tagged: DataFrame, config: dict) -> DataFrame:
    rows, base = _configured_base(tagged)
    labels = [
        {
            "parent_label": item["label_name"],
            "rater_response": F.col(f"`{item['rater_label_column']}`"),
        }
        for item in config["labels"]
    ]
    weight = m.label_weight(F.col("parent_label"), _configured_weights(config))
    return reshape.unpivot_labels(rows, base, labels).withColumn("weight", weight)


def _configured_long(tagged: DataFrame, config: dict) -> DataFrame:
    rows, base = _configured_base(tagged)
    long = rows.select(
        *base,
        F.col(f"`{config['label_column']}`").alias("parent_label"),
        F.col(f"`{config['rater_response_column']}`").alias("rater_response"),
    )
    weight = m.label_weight(F.col("parent_label"), config.get("label_weights", {}))
    kept = clean.exclude_values(long, "parent_label", config.get("excluded_labels", []))
    return kept.withColumn("weight", weight)


def _configured_outcome(tagged: DataFrame, config: dict) -> DataFrame:
    rows, base = _configured_base(tagged)
    status = F.coalesce(F.col(f"`{config['outcome_column']}`"), F.lit(""))
    hit = clean.outcome_flag(
        status,
        str(config.get("positive_outcome", True)),
        config.get("positive_outcome_case_sensitive", False),
    )
    flagged = rows.withColumn("job_correct", hit)
    if config.get("discard_if_empty", True):
        flagged = flagged.where(F.col("job_correct").isNotNull())
    else:
        flagged = flagged.withColumn("job_correct", F.coalesce("job_correct", F.lit(False)))
    return flagged.select(
        *base,
        "job_correct",
        F.lit(None).cast("double").alias("job_manual_score"),
        F.lit(DEFAULT_ENTRY).alias("rubric"),
        F.lit(1).alias("factor"),
        F.lit(DEFAULT_PENALTY).alias("rubric_penalty"),
        F.lit(1.0).alias("rubric_score"),
    )


# --- relevance project -----------------------------------------------------------------

# Answer codes and their display values.
RELEVANCE_CODES = {
    "rating_v1_0_no": "Not Related",
    "rating_v1_1_yes": "Somewhat Related",
    "rating_v1_2_yes": "Relevant",
    "prod_language": "Cannot Decide_Product Language",
    "ad_language": "Cannot Decide_Ad Language",
    "ad_unknown": "Cannot Decide_Ad Unknown",
    "prod_unknown": "Cannot Decide_Product Unknown",
    "prod_issue": "Cannot Decide_Product Issue",
    "ad_issue": "Cannot Decide_Ad Issue",
    "can_not_rate": "Cannot Decide",
    "no_rate_other_reason": "Cannot Decide_Other",
    "Doesn't understand the language the product uses": "Product Language",
    "Doesn't understand the language the ad uses": "Ad Language",
    "Don't know what the ad is promoting": "Ad Unknown",
    "Don't know what the product is promoting": "Product Unknown",
    "Product is not rendering correctly": "Product Issue",
    "Ad is not rendering correctly": "Ad Issue",
    "N/A": "",
}


def derive_relevance_answers(df: DataFrame, codes: dict[str, str] | None = None) -> DataFrame:
    """Rater and auditor answers of the two labels, from the auditor's questionnaire."""
    if "reason_other" not in df.columns:
        df = df.withColumn("reason_other", F.lit("N/A"))
    rated, other = F.col("extracted_label"), F.col("reason_other")
    agreed = _is_text("q2_contributor_correct", "yes")
    no_reason = (rated == "can_not_rate") & (F.lower(other) == "n/a")
    rater_reason = F.when(no_reason, F.lit("Other")).otherwise(other)
    copies_reason = agreed & blank("q3_choice") & blank("q4_cannot_decide")
    shown = {
        "r_relevance": rated,
        "a_relevance": F.when(agreed, rated).otherwise(F.col("q3_choice")),
        "r_cannot_decide_reason": rater_reason,
        "a_cannot_decide_reason": F.when(copies_reason, rater_reason).otherwise(
            F.col("q4_cannot_decide")
        ),
    }
    mapping = RELEVANCE_CODES if codes is None else codes
    return df.withColumns({name: clean.code_map(c, mapping) for name, c in shown.items()})


def _is_text(name: str, value: str) -> Column:
    return F.coalesce(F.lower(F.col(name)) == value, F.lit(False))


def tag_adhoc_relevance(df: DataFrame) -> DataFrame:
    df = df.withColumnsRenamed(
        {"actor_id": "rater_id", "_worker_id": "auditor_id", "_country": "workflow"}
    )
    ids = ["job_id", "rater_id", "auditor_id"]
    return clean.tag_rejects(
        checked(df, ids, F.col("review_ds")),
        [
            ("invalid_date", F.col("job_date").isNull()),
            ("not_reviewed", ~_is_text("q1_ad_load", "yes")),
            ("invalid_id", any_null(ids)),
        ],
    )


def normalize_adhoc_relevance(df: DataFrame, config: dict | None = None) -> DataFrame:
    """Two labels per job: relevance is compared, the reason is informative (weight 0)."""
    return finish_adhoc_relevance(tag_adhoc_relevance(df))


def finish_adhoc_relevance(tagged: DataFrame) -> DataFrame:
    rows = derive_relevance_answers(clean.accepted(tagged))
    base = carried(rows) + ["workflow", "job_date", "job_id", "rater_id", "auditor_id"]

    def side(prefix: str, label: str) -> Column:
        return F.coalesce(F.col(f"{prefix}_{label}"), F.lit(""))

    labels = [
        {
            "parent_label": label,
            "rater_response": side("r", label),
            "auditor_response": side("a", label),
        }
        for label in ("relevance", "cannot_decide_reason")
    ]
    is_reason = F.col("parent_label") == "cannot_decide_reason"
    return reshape.unpivot_labels(rows, base, labels).withColumns(
        {
            "is_label_binary": F.lit(False),
            "confusion_type": F.lit(None).cast("string"),
            "is_correct": is_reason | (F.col("rater_response") == F.col("auditor_response")),
            "weight": F.when(is_reason, 0.0).otherwise(1.0),
        }
    )
