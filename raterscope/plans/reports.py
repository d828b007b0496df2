"""Quality reports over all projects and weeks in one plan.

Every report takes a normalised long table (and `targets(project_id, target)` where a
target matters) and groups by `week_ending`, the reporting week of the source folder.
The three `*_rows` functions apply the row guard and the dedupe; a caller that builds
several reports writes their result once and passes it with `prepared=True`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raterscope.functions import metrics as m
from raterscope.operators import consensus, dedupe
from raterscope.operators.skew import attach, lookup

DEFAULT_LABEL = "default_label"
PIPELINE_ERROR_LABEL = "pipeline_error"
EMPTY_TEXT = "<empty>"

PROJECT = ["week_ending", "project_id"]
WORKFLOW = PROJECT + ["workflow"]
RATER = WORKFLOW + ["rater_id"]
JOB = WORKFLOW + ["job_id"]
AUDITOR_ROW = ["auditor_id", "_audits"]

SCORES = ("score", "f1score", "precision", "recall")


# --- row preparation -------------------------------------------------------------


def label_guard() -> Column:
    label = F.col("parent_label")
    return label.isNotNull() & ~label.isin("", PIPELINE_ERROR_LABEL)


def audit_rows(rows: DataFrame) -> DataFrame:
    """Audited label rows, one per (project, week, job, rater, label)."""
    guarded = rows.where(label_guard() & (F.col("auditor_id") != ""))
    return _week_ending(dedupe.keep_first(guarded, dedupe.LABEL_KEY))


def multi_rows(rows: DataFrame) -> DataFrame:
    """Deduplicated multi-review rows with their consensus answer."""
    unique = dedupe.keep_first(rows.where(label_guard()), dedupe.LABEL_KEY)
    return _week_ending(consensus.with_consensus(unique))


def outcome_rows(rows: DataFrame, keys: Sequence[str] = tuple(dedupe.OUTCOME_KEY)) -> DataFrame:
    """Decided job outcomes, one per (project, week, job, rater, auditor, outcome)."""
    return _week_ending(dedupe.keep_first(rows.where(F.col("job_correct").isNotNull()), keys))


def _week_ending(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("reporting_week", "week_ending")


def _flag_sum(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("weight")).otherwise(0.0))


# --- workflow summaries ----------------------------------------------------------


def audit_workflow_summary(
    rows: DataFrame, targets: DataFrame, prepared: bool = False
) -> DataFrame:
    rows = rows if prepared else audit_rows(rows)
    per_job = _beside_auditors(
        rows,
        [*RATER, "job_id"],
        F.sum("weight").alias("tot_labels"),
        _flag_sum(F.col("is_correct")).alias("correct_labels"),
        *m.confusion_counts(),
    )
    has_f1 = F.col("tp_count") + F.col("fp_count") + F.col("fn_count") > 0
    per_rater = per_job.groupBy(*RATER, *AUDITOR_ROW).agg(
        F.count("*").alias("jobs"),
        F.count("*").alias("audited"),
        F.count_if(has_f1).alias("audited_f1"),
        *[F.sum(c).alias(c) for c in ("tot_labels", "correct_labels", *m.CONFUSION)],
    )
    scored = per_rater.withColumns(
        {
            "rater_score": m.ratio(F.col("correct_labels"), F.col("tot_labels")),
            **dict(zip(_names("rater")[1:], m.confusion_scores("rater"))),
        }
    )
    return _workflow_report(scored, targets)


def multi_workflow_summary(
    rows: DataFrame, targets: DataFrame, prepared: bool = False
) -> DataFrame:
    rows = rows if prepared else multi_rows(rows)
    per_job = rows.groupBy(*RATER, "job_id").agg(
        F.max("is_determined").alias("audited"), *_consensus_totals()
    )
    scored = (
        per_job.groupBy(*RATER)
        .agg(
            F.count("*").alias("jobs"),
            F.sum("audited").alias("audited"),
            F.lit(0).cast("bigint").alias("audited_f1"),
            F.sum("tot_labels").alias("tot_labels"),
            F.sum("correct_labels").alias("correct_labels"),
        )
        .withColumn("rater_score", m.ratio(F.col("correct_labels"), F.col("tot_labels")))
        .withColumn("rater_f1score", F.lit(None).cast("double"))
        .withColumns({"auditor_id": F.lit(None).cast("string"), "_audits": F.lit(0)})
    )
    return _workflow_report(scored, targets)


def outcome_workflow_summary(
    rows: DataFrame, targets: DataFrame, prepared: bool = False
) -> DataFrame:
    rows = rows if prepared else outcome_rows(rows)
    scored = (
        _beside_auditors(
            rows,
            RATER,
            F.count("*").alias("jobs"),
            F.count("*").alias("audited"),
            F.lit(0).cast("bigint").alias("audited_f1"),
            F.count("*").cast("double").alias("tot_labels"),
            F.count_if("job_correct").cast("double").alias("correct_labels"),
        )
        .withColumn("rater_score", m.ratio(F.col("correct_labels"), F.col("tot_labels")))
        .withColumn("rater_f1score", F.lit(0.0))
    )
    return _workflow_report(scored, targets)


def audit_auditor_count(rows: DataFrame, prepared: bool = False) -> DataFrame:
    rows = rows if prepared else audit_rows(rows)
    return rows.groupBy(*WORKFLOW).agg(F.count_distinct("auditor_id").alias("auditor_count"))


def _beside_auditors(rows: DataFrame, keys: Sequence[str], *sums: Column) -> DataFrame:
    """`sums` by `keys` (RATER and more), and one row for each auditor of a workflow, `_audits` 1.

    Both sets leave one aggregation, which counts distinct auditors exactly without preparing
    the rows a second time and without a join; an auditor's rows are merged before the shuffle.
    """
    sets = [list(keys), [*WORKFLOW, "auditor_id"]]
    return rows.groupingSets(sets, *keys, "auditor_id").agg(F.grouping("rater_id").alias("_audits"), *sums)


def _workflow_report(scored: DataFrame, targets: DataFrame) -> DataFrame:
    """Rater rows to workflow rows; the project score is the plain mean of workflows.

    Rows with `_audits` 1 stand for an auditor and count nowhere else.
    """
    of_rater = F.col("_audits") == 0
    measures = [c for c in scored.columns if c not in (*RATER, *AUDITOR_ROW)]
    scored = scored.withColumns({c: F.when(of_rater, F.col(c)) for c in measures})
    with_target = attach(scored, targets, ["project_id"])
    target = F.col("target")
    workflow_scores = [m.ratio(F.sum("correct_labels"), F.sum("tot_labels")).alias("workflow_score")]
    if "rater_precision" in scored.columns:
        workflow_scores += [
            F.avg(f"rater_{s}").alias(f"workflow_{s}") for s in SCORES[1:]
        ]
    else:
        workflow_scores += m.zero_scores("workflow")
    per_workflow = with_target.groupBy(*WORKFLOW).agg(
        F.count_if(of_rater).alias("rater_count"),
        F.count_if(~of_rater & F.col("auditor_id").isNotNull()).alias("auditor_count"),
        F.sum("jobs").alias("job_instances"),
        F.sum("audited").alias("audited_instances"),
        F.sum("audited_f1").alias("audited_instances_f1"),
        F.max("target").alias("target_goal"),
        F.sum(m.above_target(F.col("rater_score"), target)).alias("raters_above_target"),
        F.sum(m.above_target(F.col("rater_f1score"), target)).alias("raters_above_target_f1"),
        *workflow_scores,
    )
    project = Window.partitionBy(*PROJECT)
    means = {f"project_{s}": F.avg(f"workflow_{s}").over(project) for s in SCORES}
    return per_workflow.withColumns(means).select(
        *WORKFLOW,
        "rater_count",
        "auditor_count",
        "job_instances",
        "audited_instances",
        "audited_instances_f1",
        "target_goal",
        "raters_above_target",
        "raters_above_target_f1",
        *m.rounded(*_names("workflow"), *_names("project")),
    )


# --- rater x label summaries -----------------------------------------------------


def audit_rater_label_summary(rows: DataFrame, prepared: bool = False) -> DataFrame:
    rows = rows if prepared else audit_rows(rows)
    counts = rows.groupBy(*RATER, "parent_label").agg(
        F.sum("weight").alias("tot_labels"),
        _flag_sum(F.col("is_correct")).alias("correct_labels"),
        *m.confusion_counts(),
    )
    return _rater_label_report(counts, m.confusion_scores("rater_label"))


def multi_rater_label_summary(rows: DataFrame, prepared: bool = False) -> DataFrame:
    rows = rows if prepared else multi_rows(rows)
    counts = rows.groupBy(*RATER, "parent_label").agg(*_consensus_totals())
    return _rater_label_report(
        counts.select("*", *m.no_confusion()), m.confusion_scores("rater_label")
    )


def outcome_rater_label_summary(rows: DataFrame, prepared: bool = False) -> DataFrame:
    rows = rows if prepared else outcome_rows(rows)
    counts = rows.groupBy(*RATER).agg(
        F.count("*").cast("double").alias("tot_labels"),
        F.count_if("job_correct").cast("double").alias("correct_labels"),
    )
    return _rater_label_report(
        counts.select("*", F.lit(DEFAULT_LABEL).alias("parent_label"), *m.no_confusion()),
        m.zero_scores("rater_label"),
    )


def _rater_label_report(counts: DataFrame, label_scores: list[Column]) -> DataFrame:
    """Label scores plus their mean per rater; the window holds one row per label."""
    # the counts meet by rater before they become scores, which take more room in a shuffle
    scored = counts.repartition(*RATER).select(
        "*",
        m.ratio(F.col("correct_labels"), F.col("tot_labels")).alias("rater_label_score"),
        *label_scores,
    )
    rater = Window.partitionBy(*RATER)
    means = {f"rater_{s}": F.avg(f"rater_label_{s}").over(rater) for s in SCORES}
    return scored.withColumns(means).select(
        *RATER,
        "parent_label",
        "tot_labels",
        "correct_labels",
        *m.CONFUSION,
        *m.rounded(*_names("rater_label"), *_names("rater")),
    )


# --- job x label summaries -------------------------------------------------------


def audit_job_label_summary(rows: DataFrame, prepared: bool = False) -> DataFrame:
    rows = rows if prepared else audit_rows(rows)
    counts = rows.groupBy(*JOB, "parent_label").agg(
        F.count("*").alias("rater_count"),
        _flag_sum(F.col("is_correct")).alias("correct_rater_count"),
        _flag_sum(~F.col("is_correct")).alias("incorrect_rater_count"),
        *m.confusion_counts(),
    )
    return _job_label_report(counts, m.confusion_scores("job_label"))


def multi_job_label_summary(rows: DataFrame, prepared: bool = False) -> DataFrame:
    rows = rows if prepared else multi_rows(rows)
    counts = rows.groupBy(*JOB, "parent_label").agg(
        F.sum("is_determined").alias("rater_count"),
        _flag_sum(F.col("is_agreeing") == 1).alias("correct_rater_count"),
        _flag_sum(F.col("is_agreeing") == 0).alias("incorrect_rater_count"),
    )
    return _job_label_report(
        counts.select("*", *m.no_confusion()), m.confusion_scores("job_label")
    )


def outcome_job_label_summary(rows: DataFrame, prepared: bool = False) -> DataFrame:
    rows = rows if prepared else outcome_rows(rows)
    counts = rows.groupBy(*JOB).agg(
        F.count("*").alias("rater_count"),
        F.count_if("job_correct").cast("double").alias("correct_rater_count"),
        F.count_if(~F.col("job_correct")).cast("double").alias("incorrect_rater_count"),
    )
    return _job_label_report(
        counts.select("*", F.lit(DEFAULT_LABEL).alias("parent_label"), *m.no_confusion()),
        m.zero_scores("job_label"),
    )


def _job_label_report(counts: DataFrame, label_scores: list[Column]) -> DataFrame:
    """Job scores as the mean over its labels.

    The label score divides a weighted count by the plain number of raters; that mix is
    part of the report's definition.
    """
    scored = counts.select(
        "*",
        m.ratio(F.col("correct_rater_count"), F.col("rater_count")).alias("job_label_score"),
        *label_scores,
    )
    job = Window.partitionBy(*JOB)
    means = {f"job_{s}": F.avg(f"job_label_{s}").over(job) for s in SCORES}
    return scored.withColumns(means).select(
        *JOB,
        "parent_label",
        "rater_count",
        "correct_rater_count",
        "incorrect_rater_count",
        *m.CONFUSION,
        *m.rounded(*_names("job")),
    )


# --- error contribution ----------------------------------------------------------


def audit_error_contribution(rows: DataFrame, prepared: bool = False) -> DataFrame:
    rows = rows if prepared else audit_rows(rows)
    wrong = rows.where(~F.col("is_correct"))
    return _error_report(wrong.withColumn("ground_truth", F.col("auditor_response")))


def multi_error_contribution(rows: DataFrame, prepared: bool = False) -> DataFrame:
    rows = rows if prepared else multi_rows(rows)
    wrong = rows.where(F.col("is_agreeing") == 0)
    return _error_report(wrong.withColumn("ground_truth", F.col("consensus_response")))


def outcome_error_contribution(rows: DataFrame, prepared: bool = False) -> DataFrame:
    rows = rows if prepared else outcome_rows(rows)
    return _error_report(rows.where(~F.col("job_correct")).withColumns(_outcome_constants()))


def _error_report(wrong: DataFrame) -> DataFrame:
    """Errors per answer pair and their share of the label's errors in the week.

    Free-text answers can make one label hold most pairs, so the label total is an
    aggregate joined back in slices, not a window over all pairs of the label.
    """
    label = PROJECT + ["parent_label"]
    pairs = wrong.groupBy(*label, "rater_response", "ground_truth").agg(
        F.count("*").alias("error_count")
    )
    totals = pairs.groupBy(*label).agg(
        F.sum("error_count").alias("weekly_label_error_count"), F.count("*").alias("_pairs")
    )
    spread = ["rater_response", "ground_truth"]
    return (
        lookup(pairs, totals, label, "_pairs", spread)
        .withColumn(
            "weekly_error_contribution",
            m.ratio(F.col("error_count"), F.col("weekly_label_error_count")),
        )
        .select(
            *label,
            _shown("rater_response"),
            _shown("ground_truth"),
            "error_count",
            "weekly_label_error_count",
            *m.rounded("weekly_error_contribution"),
        )
    )


# --- incorrect samples -----------------------------------------------------------


def audit_incorrect_sample(
    rows: DataFrame, prepared: bool = False, n: int | None = None
) -> DataFrame:
    rows = rows if prepared else audit_rows(rows)
    wrong = rows.where(~F.col("is_correct")).withColumn("ground_truth", F.col("auditor_response"))
    return _sample(wrong, n)


def multi_incorrect_sample(
    rows: DataFrame, prepared: bool = False, n: int | None = None
) -> DataFrame:
    rows = rows if prepared else multi_rows(rows)
    wrong = rows.where(F.col("is_agreeing") == 0).withColumns(
        {
            "ground_truth": F.col("consensus_response"),
            "confusion_type": F.lit(""),
            "is_correct": F.lit(False),
        }
    )
    return _sample(wrong, n)


def outcome_incorrect_sample(
    rows: DataFrame, prepared: bool = False, n: int | None = None
) -> DataFrame:
    rows = rows if prepared else outcome_rows(rows)
    wrong = rows.where(~F.col("job_correct")).withColumns(
        {
            **_outcome_constants(),
            "confusion_type": F.lit(""),
            "is_correct": F.col("job_correct"),
        }
    )
    distinct_keys = [*RATER, "job_id", "parent_label", "rater_response", "ground_truth"]
    return _sample(wrong.select(*distinct_keys, "confusion_type", "is_correct").distinct(), n)


def _sample(wrong: DataFrame, n: int | None) -> DataFrame:
    """All wrong rows, or the first `n` of each week and project in a total order."""
    columns = [
        "week_ending", "project_id", "workflow", "rater_id", "job_id", "parent_label",
        "rater_response", "ground_truth", "confusion_type", "is_correct",
    ]
    shown = wrong.withColumns(
        {c: _blank_to_text(c) for c in ("rater_response", "ground_truth")}
    ).select(*columns)
    if n is None:
        return shown
    order = [F.col(c).asc_nulls_last() for c in columns[2:]]
    return dedupe.top_per_group(shown, PROJECT, order, n)


def outcome_rubric_detail(rows: DataFrame) -> DataFrame:
    """One row per job outcome and rubric entry."""
    return outcome_rows(rows, dedupe.RUBRIC_KEY).select(
        "project_id", "week_ending", "workflow", "rater_id", "auditor_id", "job_id",
        "job_correct", "job_manual_score", "rubric", "factor", "rubric_penalty", "rubric_score",
    )


# --- helpers ---------------------------------------------------------------------


def _names(prefix: str) -> list[str]:
    return [f"{prefix}_{s}" for s in SCORES]


def _consensus_totals() -> list[Column]:
    """Weighted totals of determined labels; agreement is null (skipped) elsewhere."""
    counted = F.col("weight") * F.col("is_determined")
    return [
        F.sum(counted).alias("tot_labels"),
        F.sum(counted * F.col("is_agreeing")).alias("correct_labels"),
    ]


def _outcome_constants() -> dict[str, Column]:
    return {
        "parent_label": F.lit(DEFAULT_LABEL),
        "rater_response": F.lit("n/a"),
        "ground_truth": F.lit("Incorrect Annotation"),
    }


def _blank_to_text(name: str) -> Column:
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(EMPTY_TEXT))


def _shown(name: str) -> Column:
    return _blank_to_text(name).alias(name)


AUDIT_REPORTS = {
    "workflow_summary": audit_workflow_summary,
    "rater_label_summary": audit_rater_label_summary,
    "job_label_summary": audit_job_label_summary,
    "error_contribution": audit_error_contribution,
    "incorrect_sample": audit_incorrect_sample,
}
MULTI_REPORTS = {
    "workflow_summary": multi_workflow_summary,
    "rater_label_summary": multi_rater_label_summary,
    "job_label_summary": multi_job_label_summary,
    "error_contribution": multi_error_contribution,
    "incorrect_sample": multi_incorrect_sample,
}
OUTCOME_REPORTS = {
    "workflow_summary": outcome_workflow_summary,
    "rater_label_summary": outcome_rater_label_summary,
    "job_label_summary": outcome_job_label_summary,
    "error_contribution": outcome_error_contribution,
    "incorrect_sample": outcome_incorrect_sample,
}
