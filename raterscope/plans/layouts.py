"""Registry of layout normalisers and the steps around them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raterscope.functions import clean
from raterscope.operators.skew import attach
from raterscope.plans import layouts_labels as labels
from raterscope.plans import layouts_outcome as outcome

Normalizer = Callable[[DataFrame, dict], DataFrame]

# The `module` names that project configurations use.
MODULES: dict[str, Normalizer] = {
    "UQD": labels.normalize_decision_json,
    "CVS": labels.normalize_auditor_keyed_json,
    "HALO": outcome.normalize_outcome_wide_rubric,
    "GALA": outcome.normalize_outcome_json_rubric,
    "SPOTCHECK": labels.normalize_long_audit,
    "GENERIC": labels.normalize_by_config,
}

_BUILT_IN = dict(MODULES)
ADHOC: dict[str, Normalizer] = {}

#: The two steps of each normaliser: raw rows to tagged ones (`reject_reason`, null where accepted),
#: and tagged rows, stored in between, to long ones. Rejects are so counted without reading twice.
Steps = tuple[Normalizer, Normalizer]
STEPS: dict[str, Steps] = {
    "UQD": (labels.tag_decision_json, labels.finish_decision_json),
    "CVS": (lambda df, _: labels.tag_auditor_keyed_json(df), labels.finish_auditor_keyed_json),
    "HALO": (outcome.tag_outcome_wide, lambda t, c: outcome.finish_outcome(t, c, outcome.WIDE_APPROVED)),
    "GALA": (outcome.tag_outcome_json, lambda t, c: outcome.finish_outcome(t, c, outcome.JSON_APPROVED)),
    "SPOTCHECK": (labels.tag_long_audit, labels.finish_long_audit),
    "GENERIC": (labels.tag_by_config, labels.finish_by_config),
}
RELEVANCE: Steps = (lambda df, _: labels.tag_adhoc_relevance(df), lambda t, _: labels.finish_adhoc_relevance(t))
ADHOC_STEPS: dict[str, Steps] = {}


def register(name: str, normalizer: Normalizer, project_id: str | None = None) -> None:
    """Add a module, or the ad-hoc normaliser of one project."""
    if project_id:
        ADHOC[project_id] = normalizer
    else:
        MODULES[name] = normalizer


def find(module: str | None, project_id: str | None = None) -> Normalizer:
    if not module:
        raise ValueError("the project configuration names no module")
    if module in MODULES:
        return MODULES[module]
    if module == "ADHOC":
        if project_id in ADHOC:
            return ADHOC[project_id]
        raise ValueError(f"no ad-hoc normaliser registered for project {project_id!r}")
    raise ValueError(f"unknown module {module!r}")


def find_steps(module: str | None, project_id: str | None = None) -> Steps:
    """The steps of a module. A normaliser without steps of its own accepts all rows."""
    if module == "ADHOC" and project_id in ADHOC_STEPS:
        return ADHOC_STEPS[project_id]
    if module in STEPS and MODULES[module] is _BUILT_IN[module]:
        return STEPS[module]
    whole = find(module, project_id)
    accept = lambda df, _: df.withColumn("reject_reason", F.lit(None).cast("string"))
    return accept, lambda tagged, config: whole(clean.accepted(tagged), config)


def normalize(
    df: DataFrame,
    project_config: dict,
    project_id: str | None = None,
    roster: DataFrame | None = None,
    emails: DataFrame | None = None,
) -> DataFrame:
    """Raw rows of one layout to the long table, for all files at once.

    Replacements first, then rater ids from e-mails, the layout's normaliser, markets from
    the roster, and the content week.
    """
    config = project_config.get("module_config", {})
    df = clean.preprocess(df, config)
    if emails is not None:
        df = map_emails(df, emails)
    long = find(project_config.get("module"), project_id)(df, config)
    if roster is not None:
        long = workflow_from_roster(long, roster)
    return long.withColumn("content_week", clean.content_week(F.col("job_date")))


def map_emails(df: DataFrame, emails: DataFrame, column: str = "Email") -> DataFrame:
    """Add `srtid` by e-mail (`emails`: email, rater_id); rows without a match are dropped."""
    keyed = df.withColumn("_email", F.lower(F.trim(F.col(column))))
    ids = emails.select(F.col("email").alias("_email"), F.col("rater_id").alias("srtid"))
    return attach(keyed, ids, ["_email"], "inner").drop("_email")


def workflow_from_roster(long: DataFrame, roster: DataFrame) -> DataFrame:
    """Replace the workflow by the rater's market; raters outside the roster are dropped."""
    markets = roster.select("rater_id", F.col("market").alias("_market"))
    joined = attach(long.drop("workflow"), markets, ["rater_id"], "inner")
    return joined.withColumnRenamed("_market", "workflow").select(*long.columns)


UNMAPPED = "UNMAPPED"


def roster_counts(long: DataFrame, roster: DataFrame) -> DataFrame:
    """Rows per market, with rows of raters outside the roster under UNMAPPED."""
    joined = attach(long.select("rater_id"), roster.select("rater_id", "market"), ["rater_id"])
    market = F.coalesce(F.col("market"), F.lit(UNMAPPED)).alias("market")
    return joined.groupBy(market).agg(F.count("*").alias("row_count"))
