"""Contributors and consensus: rows are shuffled once, and joins keep their rows."""

import datetime

from checks import fixtures as fx
from raterscope.plans import reports, rollups

WEEK = datetime.date(2025, 7, 4)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().treeString()


def test_contributors_shuffle_the_deduplicated_rows_once(spark, tmp_path):
    rows = [("m1", WEEK, "w", WEEK, f"r{i % 3}", f"j{i % 4}", "a", "xy"[i % 2], 1.0) for i in range(24)]
    names = "project_id string, reporting_week date, workflow string, job_date date, rater_id string, job_id string, parent_label string, rater_response string, weight double"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "rows"))
    projects = spark.createDataFrame([("m1", "Mint", "agreement", 0.9)], "project_id string, project_name string, project_metric string, target double")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("false", "-1")):
            spark.conf.set(k, v)
        report = reports.multi_rater_label_summary(spark.read.parquet(str(tmp_path / "rows")))
        table = rollups.contributor_rollup(report, projects)
        plan = _plan(table)
        assert len([line for line in plan.splitlines() if "- Exchange hashpartitioning(_hash" in line]) == 1
        assert {r.project_id for r in table.collect()} == {"m1"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_projects_without_an_id_join_no_report(spark):
    names = "week_ending date, project_id string, rater_id string, " + ", ".join(f"{c} double" for c in (*rollups.CONTRIBUTOR_SUMS, *rollups.CONTRIBUTOR_MEANS))
    known = spark.createDataFrame([(WEEK, p, "r", *[1.0] * 10) for p in ("p1", None, "p3")], names)
    projects = spark.createDataFrame([("p1", "a", "accuracy", 0.5), (None, "b", "accuracy", 0.5)], "project_id string, project_name string, project_metric string, target double")
    assert [r.project_id for r in rollups.contributor_rollup(known, projects).collect()] == ["p1"]


def test_jobs_without_a_majority_have_no_answer(spark):
    from raterscope.operators.consensus import with_consensus

    answers = {"one": ["x"], "tie": ["x", "y"], "most": ["x", "x", "y"], None: ["z", "z"]}
    rows = [(WEEK, "m", job, "a", f"r{i}", answer) for job, given in answers.items() for i, answer in enumerate(given)]
    df = spark.createDataFrame(rows, "reporting_week date, project_id string, job_id string, parent_label string, rater_id string, rater_response string")
    for slices in (None, 1):
        found = {(r.job_id, r.consensus_response, r.is_determined) for r in with_consensus(df, slices).collect()}
        assert found == {("one", None, 0), ("tie", None, 0), ("most", "x", 1), (None, "z", 1)}
        assert with_consensus(df, slices).count() == len(rows)


def test_orders_beside_lines_are_moved_by_their_join_only(spark, sf, monkeypatch):
    spreads = []
    monkeypatch.setattr(fx, "spread", lambda df: spreads.append(sorted(df.columns)[0][:2]) or df)
    for view in ("v_audit", "v_multi", "v_outcome", "v_files"):
        fx.view(spark, sf, view)
    # lines, lines, lines and orders that lines are joined to, orders alone
    assert sorted(spreads) == ["l_", "l_", "l_", "o_", "o_"]


def test_the_display_shows_every_row_and_column_of_the_rollup(spark, tmp_path):
    from checks import QUERIES

    day = datetime.date(1996, 3, 1)
    lines = [  # suppliers 3 and 6 rate for the first and second segment of p0
        (order, line, supplier, 1, 2.0, 0.02, flag, "F", day)
        for order, line, supplier, flag in ((1, 1, 3, "A"), (1, 2, 3, "N"), (2, 1, 3, "N"), (3, 1, 6, "A"))
    ]
    names = "l_orderkey long, l_linenumber long, l_suppkey long, l_partkey long, l_quantity double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"
    spark.createDataFrame(lines, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = [(key, 1, "F", day, "1-URGENT") for key in (1, 2, 3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    rollup = QUERIES["contributor_rollup"](spark, str(tmp_path))
    shown = QUERIES["contributor_display"](spark, str(tmp_path))
    assert shown.columns == list(rollups.CONTRIBUTOR_HEADERS.values())
    rows = {tuple(r) for r in shown.collect()}
    assert rows == {(*r[:4], f"'{r.rater_id}", *r[5:]) for r in rollup.select(*rollups.CONTRIBUTOR_HEADERS).collect()}
    p0 = {(r["Project Name"], r.Segment, r["Contributor ID"], r["True Positives"], r["True Negatives"], r.Accuracy) for r in shown.collect() if r["Project ID"] == "p0"}
    assert p0 == {("Pine", "1", "'10000000003", 1, 2, 1.0), ("Pine 2", "2", "'10000000006", 1, 0, 1.0)}
