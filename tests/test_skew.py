"""Hot keys: sliced joins give the same rows as plain ones, and no task gets a whole key."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from raterscope.operators import consensus, dedupe, reshape, skew


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def facts(spark):
    """One key holds a third of the rows, one key is null, the others are small."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None))
    key = key.otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
    return spark.range(3000).select("id", key.cast("string").alias("key"))


def test_lookup_equals_plain_join(facts):
    table = facts.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = skew.lookup(facts, table, ["key"], "n", ["id"], rows_per_slice=100)
    want = skew.join_null_safe(facts, table, ["key"])
    assert rows_of(got.select("id", "key", "n", "top")) == rows_of(want.select("id", "key", "n", "top"))
    assert got.where("key is null and n is null").count() == 0


def test_every_hot_key_is_cut(facts):
    sizes = facts.groupBy("key").agg(F.count("*").alias("n"))
    hot = {r.key: r._slices for r in skew.hot_keys(sizes, ["key"], "n", 100).collect()}
    assert hot == {"hot": 10}
    all_of_them = {r.key for r in skew.hot_keys(sizes, ["key"], "n", 5).collect()}
    assert all_of_them == {r.key for r in sizes.where("n > 5").collect()}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_attach_gives_the_same_rows_and_columns_for_any_strategy(spark, facts, how):
    dim = facts.where("key is not null").select(F.upper("key").alias("name"), "key").distinct()
    small = skew.attach(facts, dim.hint("broadcast"), ["key"], how)
    large = skew.attach(facts, dim.hint("merge"), ["key"], how)
    assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" in plan(large)
    assert small.columns == large.columns == ["id", "key", *([] if how == "left_semi" else ["name"])]
    assert rows_of(small) == rows_of(large)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def votes(spark, n):
    """n raters on one job and label (60% agree), and small jobs of three raters."""
    hot = spark.range(n).select(
        F.lit("hot").alias("job_id"), F.col("id").cast("string").alias("rater_id"),
        F.when(F.col("id") % 5 < 3, "yes").otherwise(F.col("id").cast("string")).alias("rater_response"),
    )
    small = spark.range(n).select(
        F.concat(F.lit("j"), F.floor(F.col("id") / 3).cast("string")).alias("job_id"),
        F.col("id").cast("string").alias("rater_id"),
        F.when(F.col("id") % 7 == 0, "no").otherwise("yes").alias("rater_response"),
    )
    return hot.unionByName(small).withColumns(
        {
            "reporting_week": F.lit("2025-07-04").cast("date"), "project_id": F.lit("p"),
            "parent_label": F.lit("l"),
        }
    )


def test_consensus_of_a_hot_job(spark):
    rows = votes(spark, 1000)
    plain, sliced = consensus.with_consensus(rows), consensus.with_consensus(rows, rows_per_slice=50)
    columns = ["job_id", "rater_id", "rater_response", "consensus_response", "is_determined", "is_agreeing"]
    assert rows_of(plain.select(columns)) == rows_of(sliced.select(columns))
    hot = sliced.where("job_id = 'hot'").groupBy("consensus_response").agg(F.sum("is_agreeing").alias("n"))
    assert [(r.consensus_response, r.n) for r in hot.collect()] == [("yes", 600)]


@pytest.mark.parametrize(
    ("answers", "want"),
    [
        (["a"], None), (["a", "b"], None), (["a", "a"], "a"), (["a", "a", "b"], "a"),
        (["a", "a", "b", "b"], None), ([None, None, "a"], None), (["a", "a", None], "a"), (["", "", "a"], ""),
    ],
)
def test_majority_rules(spark, answers, want):
    data = [("p", "2025-07-04", "j", "l", str(i), a) for i, a in enumerate(answers)]
    schema = "project_id string, reporting_week string, job_id string, parent_label string, rater_id string, rater_response string"
    out = consensus.with_consensus(spark.createDataFrame(data, schema)).collect()
    assert {r.consensus_response for r in out} == {want}
    if want is not None:
        assert sum(r.is_agreeing for r in out) == answers.count(want)


def test_dedupe_limits_rows_before_the_shuffle(spark):
    same = F.when(F.col("id") >= 0, "same")
    rows = spark.range(1000).select(same.alias("k"), F.col("id").alias("v"))
    unique = dedupe.keep_first(rows, ["k"])
    assert [r.v for r in unique.collect()] == [0]
    text = plan(dedupe.keep_first(rows, ["k"]))
    limits = [line for line in text.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2  # one on each side of the exchange
    again = dedupe.keep_first(unique, ["k"])
    assert rows_of(again) == rows_of(unique)


def test_align_slices_a_large_file(spark):
    rows = spark.range(600).select(
        F.when(F.col("id") < 400, "big").otherwise("small").alias("source_file"),
        F.col("id"),
        F.create_map(F.concat(F.lit("l"), (F.col("id") % 4).cast("string")), F.lit("x")).alias("rater_map"),
    )
    plain = reshape.align_labels(rows, ["source_file"], ["id"])
    sliced = reshape.align_labels(rows, ["source_file"], ["id"], rows_per_slice=50)
    assert plain.count() == 600 * 4
    columns = ["source_file", "id", "parent_label", "rater_response"]
    assert rows_of(plain.select(columns)) == rows_of(sliced.select(columns))


def test_auditors_are_counted_in_the_aggregation_of_the_raters(spark, sf):
    from checks.audit import audit_long, targets

    from raterscope.plans import reports

    rows = audit_long(spark, sf)
    df = reports.audit_workflow_summary(rows, targets(spark, sf))
    before, after = (x._jdf.queryExecution().optimizedPlan().toString() for x in (rows, df))
    more = {node: after.count(f"{node} ") - before.count(f"{node} ") for node in ("WindowGroupLimit", "Join", "Expand")}
    # the dedupe of the label rows is planned once, and nothing is joined but the targets
    assert more == {"WindowGroupLimit": 1, "Join": 1, "Expand": 1}


def test_auditor_counts_with_nulls_and_shared_auditors(spark):
    from raterscope.plans import reports

    def row(workflow, rater, job, auditor, correct):
        return (None if workflow is None else str(workflow), "w", "p", rater, job, auditor, correct)

    rows = spark.createDataFrame(
        [
            row(1, "a", "j1", "x", True), row(1, "a", "j2", "y", False), row(1, "b", "j1", "x", True),
            row(1, "b", "j3", None, True), row(1, None, "j4", "z", False), row(None, "a", "j5", None, True),
        ],
        "workflow string, week_ending string, project_id string, rater_id string, job_id string, auditor_id string, job_correct boolean",
    )
    targets = spark.createDataFrame([("p", 0.9)], "project_id string, target double")
    got = {r.workflow: r for r in reports.outcome_workflow_summary(rows, targets, prepared=True).collect()}
    one, none = got["1"], got[None]
    assert (one.rater_count, one.auditor_count, one.job_instances, one.raters_above_target) == (3, 3, 5, 1)
    assert (none.rater_count, none.auditor_count, none.job_instances, none.raters_above_target) == (1, 0, 1, 1)
    assert one.workflow_score == 0.6 and one.target_goal == 0.9
    assert reports.outcome_workflow_summary(rows.limit(0), targets, prepared=True).count() == 0


def test_bytes_per_task_are_bounded_and_smaller_settings_stay(spark):
    from raterscope.session import TASK_BYTES, TASK_SETTINGS, bound_tasks

    before = {name: spark.conf.get(name) for name in TASK_SETTINGS}
    try:
        spark.conf.set(TASK_SETTINGS[0], "128m")
        spark.conf.set(TASK_SETTINGS[1], "1m")
        bound_tasks(spark)
        assert int(spark.conf.get(TASK_SETTINGS[0])) == TASK_BYTES
        assert spark.conf.get(TASK_SETTINGS[1]) == "1m"
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
