"""What a run reads and writes: once, and only where it is needed."""

import datetime

from pyspark.sql import functions as F

from raterscope.sources import files, lake, raw
from raterscope.streaming import incremental

WEEK = datetime.date(2025, 7, 4)
HEADER = "actor_id,job_id,answer"
PATTERN = r"/project_id=([^/]+)/reporting_week=(\d{4}-\d{2}-\d{2})/([^/]+)$"
SCHEME = {"pattern": PATTERN, "week_format": "yyyy-MM-dd"}


def _folder(root, **texts):
    for project, text in texts.items():
        folder = root / f"project_id={project}" / "reporting_week=2025-07-04"
        folder.mkdir(parents=True)
        (folder / "f.csv").write_text(text)
    return str(root)


def test_only_files_that_may_hold_malformed_rows_are_counted(spark, tmp_path):
    root = _folder(
        tmp_path / "raw", good=f"{HEADER}\n1,2,3\n\n4,5,6\n", quoted=f'{HEADER}\n1,"2,x","say ""a, b"""\n',
        short=f"{HEADER}\n1,2,3\n4,5\n", long=f"{HEADER}\n1,2,3,4\n", broken=f'{HEADER}\n1,"a\nb",3\n',
    )
    found = files.manifest(spark, root, **SCHEME)
    full = {r.project_id: r.full_rows for r in found.collect()}
    assert full == {"good": True, "quoted": True, "short": False, "long": False, "broken": False}
    rows = incremental.raw_rows(found, HEADER.split(","), **SCHEME)
    counts = {r.source_file: r.malformed_rows for r in raw.malformed_counts(rows).collect()}
    some = incremental.raw_rows(raw.may_be_malformed(found), HEADER.split(","), **SCHEME)
    assert {r.source_file: r.malformed_rows for r in raw.malformed_counts(some).collect()} == counts
    assert sorted(path.split("project_id=")[1].split("/")[0] for path in counts) == ["long", "short"]


def test_keys_are_taken_from_the_path_once_per_file(spark, tmp_path):
    root = _folder(tmp_path / "raw folder", a=f"{HEADER}\n1,2,3\n4,5,6\n", b=f"{HEADER}\n7,8,9\n")
    found = files.manifest(spark, root, **SCHEME)
    rows = incremental.raw_rows(found, HEADER.split(","), **SCHEME)
    assert sorted((r.project_id, r.reporting_week, r.actor_id) for r in rows.collect()) == [("a", WEEK, "1"), ("a", WEEK, "4"), ("b", WEEK, "7")]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("regexp_extract")


def test_replaced_weeks_are_written_without_a_copy(spark, tmp_path, monkeypatch):
    root, later = str(tmp_path / "lake"), datetime.date(2025, 7, 11)
    names = "project_id string, reporting_week date, content_week date, n int"
    first = spark.createDataFrame([("a", WEEK, WEEK, 1), ("a", WEEK, later, 2), ("b", WEEK, WEEK, 3)], names)
    weeks = first.select("project_id", "reporting_week").distinct()
    kept = []
    monkeypatch.setattr(lake, "stored", lambda df, name, plain=lake.stored: kept.append(df.columns) or plain(df, name))
    lake.replace_weeks(first, root, "audit", weeks)
    assert kept == []
    second = spark.createDataFrame([("a", WEEK, WEEK, 4), ("a", WEEK, None, 5)], names)
    lake.replace_weeks(second, root, "audit", weeks.where("project_id = 'a'"))
    assert all("n" not in columns for columns in kept)
    rows = {(r.project_id, r.content_week, r.n) for r in lake.scan(spark, root).collect()}
    assert rows == {("a", WEEK, 4), ("a", None, 5), ("b", WEEK, 3)}
    lake.replace_weeks(second.limit(0), root, "audit", weeks)
    assert lake.scan(spark, root).count() == 0


def test_a_report_is_written_once_and_empties_its_weeks(spark, tmp_path):
    out, later = str(tmp_path), datetime.date(2025, 7, 11)
    table = spark.createDataFrame([("a", WEEK, 1), ("a", later, 2)], "project_id string, week_ending date, n int")
    weeks = table.select("project_id", "week_ending")
    incremental.write_report(table, out, "report", weeks)
    calls = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda n: calls.add(1) or n, "int").asNondeterministic()
    incremental.write_report(table.where("n = 1").withColumn("n", counted("n")), out, "report", weeks)
    assert calls.value == 1
    assert [(r.week_ending, r.n) for r in lake.read_table(spark, f"{out}/report").collect()] == [(WEEK, 1)]


def test_changed_files_hold_lines_of_every_status(spark, tmp_path):
    from checks import QUERIES

    lines = [
        (order, 1, supplier, 1, 0.02 if status else 0.0, "A", status, datetime.datetime(year, 3, 1))
        for order, (supplier, year, status) in enumerate(
            [(supplier, year, status) for supplier in (3, 1, 2) for year in (1996, 1998) for status in ("F", "O", "O", None)]
        )
    ]
    names = "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = {(r.project_id, r.reporting_week.year): (r.row_count, r.correct_count) for r in QUERIES["incremental_changes"](spark, str(tmp_path)).collect()}
    assert found == {(p, year): (4, 3) for p in ("007", "12E4", "p2") for year in (1996, 1998) if (p, year) != ("p2", 1998)}
