"""Market and contributor roll-ups, and catalogues of workflows and labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raterscope.functions import clean
from raterscope.functions import metrics as m
from raterscope.operators.skew import attach, join_null_safe

COUNTS = ["total_count", "audit_count", "tp_count", "fp_count", "tn_count", "fn_count"]
RATES = [f"unweighted_{s}" for s in ("accuracy", "f1", "precision", "recall")]
COMBINED = "combined"
POSITIVE = "positive"


@dataclass(frozen=True)
class MarketConfig:
    """What differs between market roll-ups."""

    target: float
    combined_label: str
    language_token: int = 2
    upper_language: bool = True
    project_id: str = ""
    week_ending: str | None = None


def latest_sample(df: DataFrame) -> DataFrame:
    """Rows of the last sample date of each label family."""
    last = df.groupBy("main_label").agg(F.max("sample_ds").alias("_last"))
    return attach(df, last, ["main_label"]).where("sample_ds = _last").drop("_last")


def _language(config: MarketConfig) -> Column:
    return clean.token_upper(
        F.col("routing_name"), config.language_token, config.upper_language
    ).alias("lang")


def market_overview(overview: DataFrame, config: MarketConfig) -> DataFrame:
    """Last-sample rows of the positive categories with their language."""
    return (
        latest_sample(overview)
        .where(clean.contains_ignore_case(F.col("label_category_name"), POSITIVE))
        .select("sample_ds", "routing_name", _language(config), "main_label", *RATES)
    )


def rater_label_market(raters: DataFrame, config: MarketConfig) -> DataFrame:
    """Last-sample rater rows per label family with target, validity and positivity."""
    audits = F.col("tp_count") + F.col("fp_count") + F.col("fn_count")
    rows = latest_sample(raters).withColumn("audit_count", audits)
    return _with_flags(
        rows.select(
            "sample_ds", "rater_id", _language(config), "main_label", *COUNTS, *RATES,
            m.ratio(F.col("tp_count") + F.col("fp_count"), F.col("total_count")).alias("positivity"),
        ),
        config,
    )


def _with_flags(df: DataFrame, config: MarketConfig) -> DataFrame:
    return df.withColumns(
        {
            "above_target": F.coalesce(F.col("unweighted_f1") >= config.target, F.lit(False)),
            "has_valid_score": F.col("audit_count") > 0,
        }
    )


def _sums_and_means() -> list[Column]:
    return [F.sum(c).alias(c) for c in COUNTS] + [
        F.avg(c).alias(c) for c in (*RATES, "positivity")
    ]


def rater_combined(rater_label: DataFrame, config: MarketConfig) -> DataFrame:
    """Rater rows over all label families; rows without a language are left out."""
    keys = ["sample_ds", "rater_id", "lang"]
    per_rater = rater_label.dropna(subset=keys).groupBy(*keys).agg(*_sums_and_means())
    labelled = per_rater.withColumn("main_label", F.lit(config.combined_label))
    return _with_flags(labelled, config)


def _raters_per(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rater counts and means of the rows with a valid score."""
    valid = df.where("has_valid_score").dropna(subset=keys)
    grouped = valid.groupBy(*keys).agg(
        F.count("rater_id").alias("rater_count"),
        F.count_if("above_target").alias("raters_above_target"),
        *_sums_and_means(),
    )
    share = m.ratio(F.col("raters_above_target"), F.col("rater_count"))
    return grouped.withColumn("raters_above_target_perc", share)


def market_raters(rater_rows: DataFrame) -> DataFrame:
    return _raters_per(rater_rows, ["sample_ds", "lang"])


def overall_label(overview: DataFrame) -> DataFrame:
    """Rows of the combined routing, one per label family."""
    rows = overview.where(clean.contains_ignore_case(F.col("routing_name"), COMBINED))
    return rows.drop("lang").withColumnRenamed("routing_name", "lang")


def overall_combined(
    overview: DataFrame, rater_rows: DataFrame, config: MarketConfig
) -> DataFrame:
    """Mean over label families of the combined routing, with the rater totals beside it."""
    means = (
        overall_label(overview)
        .dropna(subset=["sample_ds", "lang"])
        .groupBy("sample_ds", "lang")
        .agg(*[F.avg(c).alias(c) for c in RATES])
        .withColumn("main_label", F.lit(config.combined_label))
    )
    totals = (
        market_raters(rater_rows)
        .groupBy("sample_ds")
        .agg(*[F.sum(c).alias(c) for c in ("audit_count", "rater_count", "raters_above_target")])
    )
    share = m.ratio(F.col("raters_above_target"), F.col("rater_count"))
    return means.join(totals, "sample_ds", "left").withColumn("raters_above_target_perc", share)


def market_label(overview: DataFrame) -> DataFrame:
    """Rows of single markets, one per label family."""
    combined = clean.contains_ignore_case(F.col("routing_name"), COMBINED)
    return overview.where(~combined).drop("routing_name")


def market_combined(
    overview: DataFrame, rater_rows: DataFrame, config: MarketConfig
) -> DataFrame:
    """Mean over label families per market, with the market's rater totals."""
    keys = ["sample_ds", "lang"]
    means = (
        market_label(overview)
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(*[F.avg(c).alias(c) for c in RATES])
        .withColumn("main_label", F.lit(config.combined_label))
    )
    totals = market_raters(rater_rows).select(
        *keys, "rater_count", "raters_above_target", "raters_above_target_perc", "audit_count",
        "positivity",
    )
    return means.join(totals, keys, "left")


_REPORT_NAMES = {"accuracy": "score", "f1": "f1score", "precision": "precision", "recall": "recall"}


def _renamed(prefix: str) -> dict[str, str]:
    return {f"unweighted_{k}": f"{prefix}_{v}" for k, v in _REPORT_NAMES.items()}


def _report_keys(config: MarketConfig) -> list[Column]:
    return [
        F.lit(config.week_ending).cast("date").alias("week_ending"),
        F.lit(config.project_id).alias("project_id"),
    ]


def market_dashboard_workflow(
    market: DataFrame, overall: DataFrame, config: MarketConfig
) -> DataFrame:
    """Market rows in the shape of the workflow report, with the overall means."""
    keys = ["sample_ds", "main_label"]
    project = overall.select(*keys, *RATES).withColumnsRenamed(_renamed("project"))
    joined = market.withColumnsRenamed(_renamed("workflow")).join(project, keys, "left")
    return joined.select(
        *_report_keys(config),
        F.col("lang").alias("workflow"),
        "rater_count",
        F.lit(None).cast("bigint").alias("auditor_count"),
        F.lit(None).cast("bigint").alias("job_instances"),
        F.col("audit_count").alias("audited_instances"),
        F.col("audit_count").alias("audited_instances_f1"),
        F.lit(config.target).alias("target_goal"),
        "raters_above_target",
        F.col("raters_above_target").alias("raters_above_target_f1"),
        *_renamed("workflow").values(),
        *_renamed("project").values(),
    )


def market_dashboard_rater(
    rater_label: DataFrame, rater_rows: DataFrame, config: MarketConfig
) -> DataFrame:
    """Rater-label rows in the shape of the rater report, with the rater means.

    The join key has no language: a rater with several languages repeats.
    """
    keys = ["sample_ds", "rater_id"]
    means = rater_rows.select(*keys, *RATES).withColumnsRenamed(_renamed("rater"))
    joined = rater_label.withColumnsRenamed(_renamed("rater_label")).join(means, keys, "left")
    return joined.select(
        *_report_keys(config),
        F.col("lang").alias("workflow"),
        "rater_id",
        F.col("main_label").alias("parent_label"),
        F.col("total_count").alias("tot_labels"),
        (F.col("tp_count") + F.col("tn_count")).alias("correct_labels"),
        "audit_count",
        *m.CONFUSION,
        *_renamed("rater_label").values(),
        *_renamed("rater").values(),
    )


def market_rollup(
    overview: DataFrame, raters: DataFrame, config: MarketConfig
) -> dict[str, DataFrame]:
    """All tables of a market roll-up by name."""
    over = market_overview(overview, config)
    by_label = rater_label_market(raters, config)
    by_rater = rater_combined(by_label, config)
    market = market_combined(over, by_rater, config)
    overall = overall_combined(over, by_rater, config)
    return {
        "overall_label": overall_label(over),
        "overall_combined": overall,
        "rater_label": by_label,
        "rater_combined": by_rater,
        "market_label": market_label(over),
        "market_combined": market,
        "dashboard_workflow": market_dashboard_workflow(market, overall, config),
        "dashboard_rater": market_dashboard_rater(by_label, by_rater, config),
    }


def single_family_rollup(
    overview: DataFrame, raters: DataFrame, config: MarketConfig
) -> dict[str, DataFrame]:
    """All tables of the roll-up of a project with one label family.

    Its rows are used as they are: rater rows are counted per routing, not merged over them,
    and overall and market rows are one per routing and positive category, not averaged. The
    overall positivity is the mean of the markets'.
    """
    label = F.lit(config.combined_label)
    over = market_overview(overview.withColumn("main_label", label), config)
    rows = rater_label_market(raters.withColumn("main_label", label), config)
    by_market = _raters_per(rows, ["sample_ds", "lang"]).withColumn("main_label", label)
    shown = ["rater_count", "raters_above_target", "raters_above_target_perc", "audit_count", "positivity"]
    market = market_label(over).join(by_market.select("sample_ds", "lang", *shown), ["sample_ds", "lang"], "left")
    totals = by_market.groupBy("sample_ds", "main_label").agg(
        *[F.sum(c).alias(c) for c in ("audit_count", "rater_count", "raters_above_target")],
        F.avg("positivity").alias("positivity"),
    )
    overall = overall_label(over).join(totals, ["sample_ds", "main_label"], "left").withColumn(
        "raters_above_target_perc", m.ratio(F.col("raters_above_target"), F.col("rater_count"))
    )
    return {
        "overall": overall,
        "market": market,
        "rater": rows,
        # one label: the project's means are joined by the date and its label
        "dashboard_workflow": market_dashboard_workflow(market, overall, config),
        "dashboard_rater": market_dashboard_rater(rows, rows, config),
    }


# --- contributors --------------------------------------------------------------------------

CONTRIBUTOR_SUMS = ["tot_labels", "correct_labels", "tp_count", "fp_count", "tn_count", "fn_count"]
CONTRIBUTOR_MEANS = ["rater_score", "rater_f1score", "rater_precision", "rater_recall"]

# Display names of the contributor table.
CONTRIBUTOR_HEADERS = {
    "week_ending": "Week Ending",
    "project_id": "Project ID",
    "project_name": "Project Name",
    "segment": "Segment",
    "rater_id": "Contributor ID",
    "tot_labels": "Total Labels",
    "correct_labels": "Correct Labels",
    "tp_count": "True Positives",
    "fp_count": "False Positives",
    "tn_count": "True Negatives",
    "fn_count": "False Negatives",
    "rater_accuracy": "Accuracy",
    "rater_agreement": "Agreement",
    "rater_f1score": "F1 Score",
    "rater_precision": "Precision",
    "rater_recall": "Recall",
    "target_goal": "Target Goal",
}


def project_main(project: Column) -> Column:
    """Project id without its segment suffix."""
    return F.regexp_replace(project, "n[0-9]$", "")


def project_segment(project: Column) -> Column:
    return F.coalesce(
        F.nullif(F.regexp_extract(project, "n([0-9])$", 1), F.lit("")), F.lit("1")
    )


def contributor_rollup(
    rater_reports: DataFrame, projects: DataFrame, week: str | None = None
) -> DataFrame:
    """One row per week, project, segment and rater over all rater-label reports.

    `projects`: project_id, project_name, project_metric, target of the active projects. The
    score counts as agreement or accuracy by the project's metric; the other one is null.
    """
    if week:
        rater_reports = rater_reports.where(F.col("week_ending") == F.lit(week).cast("date"))
    info = projects.select(
        "project_id", "project_name", F.lower("project_metric").alias("_metric"),
        F.col("target").alias("target_goal"),
    )
    # a join that tells Spark the id is not null would put that filter below one of the two places where the
    # reports use their deduplicated rows, and the rows would be made and shuffled twice
    joined = join_null_safe(rater_reports, info.dropna(subset=["project_id"]), ["project_id"], "inner")
    keys = ["week_ending", "project_id", "segment", "rater_id"]
    split = joined.withColumns(
        {"segment": project_segment(F.col("project_id")), "project_id": project_main(F.col("project_id"))}
    )
    grouped = split.groupBy(*keys, "project_name", "_metric", "target_goal").agg(
        *[F.sum(c).alias(c) for c in CONTRIBUTOR_SUMS],
        *[F.avg(c).alias(c) for c in CONTRIBUTOR_MEANS],
    )
    agreement = F.col("_metric") == "agreement"
    return grouped.select(
        *keys[:2],
        "project_name",
        *keys[2:],
        *CONTRIBUTOR_SUMS,
        F.when(~F.coalesce(agreement, F.lit(False)), F.col("rater_score")).alias("rater_accuracy"),
        F.when(agreement, F.col("rater_score")).alias("rater_agreement"),
        *CONTRIBUTOR_MEANS[1:],
        "target_goal",
    )


def contributor_display(rollup: DataFrame) -> DataFrame:
    """Display names, and ids with a leading apostrophe so that sheets keep them as text."""
    shown = rollup.withColumn("rater_id", F.concat(F.lit("'"), F.col("rater_id")))
    return shown.select(*[F.col(c).alias(n) for c, n in CONTRIBUTOR_HEADERS.items()])


# --- catalogues ----------------------------------------------------------------------------


def catalog_workflows(*tables: DataFrame) -> DataFrame:
    """Distinct (project, workflow) of long tables of any base."""
    return _catalog([t.select("project_id", "workflow") for t in tables])


def catalog_labels(*tables: DataFrame) -> DataFrame:
    """Distinct (project, label): the label, or the rubric entry of outcome tables."""
    return _catalog(
        [
            t.select("project_id", F.col("rubric" if "rubric" in t.columns else "parent_label").alias("label"))
            for t in tables
        ]
    )


def _catalog(parts: list[DataFrame]) -> DataFrame:
    out = parts[0].distinct()
    for part in parts[1:]:
        out = out.unionByName(part.distinct())
    return out.distinct()


def new_entries(
    catalog: DataFrame, known: DataFrame, projects: DataFrame, column: str
) -> DataFrame:
    """Catalogue entries absent from the map, with the project name; other map columns blank."""
    keys = ["project_id", column]
    fresh = catalog.join(known.select(*keys).distinct(), keys, "left_anti")
    named = attach(fresh, projects.select("project_id", "project_name"), ["project_id"])
    others = [c for c in known.columns if c not in ("project_id", "project_name", column)]
    return named.select(
        "project_name", *keys, *[F.lit("").alias(c) for c in others]
    )
