"""Real folders: readers, manifest, snapshots, the stream, and the whole run."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.audit import audit_long, targets
from checks import fixtures as fx
from raterscope.plans import daily, layouts_labels, reports
from raterscope.functions import clean
from raterscope.sources import files, lake, ledger
from raterscope.sources import raw as raw_files
from raterscope.streaming import incremental

HEADER = "job_id,reviewer_id,question,answer"
COLUMNS = HEADER.split(",")


@pytest.fixture
def raw(tmp_path):
    def add(week, name, text, project="p1_Pine wood"):
        folder = tmp_path / "raw" / project / f"WE {week}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())

    add("2025.07.04", "a.csv", f'{HEADER}\n1,2,"q, one","line\nbreak"\n3,,"say ""hi""",\n')
    add("2025.07.04", "empty.csv", f"{HEADER}\n")
    add("2025.07.04", "notused.csv", f"{HEADER}\n1,2,3,4\n")
    add("2025.07.11", "b.csv", f"{HEADER}\n5,6,q,a\n")
    add("2025.07.11", "c.txt", f"{HEADER}\n5,6,q,a\n")
    return tmp_path, add


def test_csv_values_and_positions(spark, raw):
    root, _ = raw
    path = str(root / "raw" / "p1_Pine wood" / "WE 2025.07.04" / "a.csv")
    rows = lake.read_raw_csv(spark, path, COLUMNS).orderBy("row_pos").collect()
    assert [tuple(r)[:4] for r in rows] == [("1", "2", "q, one", "line\nbreak"), ("3", "", 'say "hi"', "")]
    assert all(r.source_file.endswith("a.csv") for r in rows)


def facts_of(spark, *paths):
    return raw_files.file_facts(spark, [str(p) for p in paths])


def test_files_are_read_by_their_own_header(spark, raw):
    root, add = raw
    folder = root / "raw" / "p1_Pine wood" / "WE 2025.07.18"
    add("2025.07.18", "d.csv", 'job_id,reviewer_id,"que\\"stion",answer\n1,2,"a \\"b\\" c",\xe9\n'.encode("latin-1"))
    add("2025.07.18", "e.CSV", "answer,more,job_id\nno,x,2\n\xe9t\xe9,y,3\n".encode("latin-1"))
    add("2025.07.18", "f.csv", "job_id,answer\n4,yes\n5\n6,no,7\n8,caff\u00e8\n")
    facts = facts_of(spark, folder / "d.csv", folder / "e.CSV", folder / "f.csv")
    kinds = {r.path.rsplit("/", 1)[1]: (r.is_utf8, r.permissive, r.data_rows) for r in facts.collect()}
    assert kinds == {"d.csv": (False, True, 1), "e.CSV": (False, False, 2), "f.csv": (True, False, 4)}
    rows = raw_files.read_by_header(facts, ["job_id", "answer", "more"], optional=["more"])
    good = {(r.job_id, r.answer, r.more) for r in raw_files.well_formed(rows).collect()}
    assert good == {("1", "\xe9", ""), ("2", "no", "x"), ("3", "\xe9t\xe9", "y"), ("4", "yes", ""), ("8", "caff\u00e8", "")}
    assert [(r.source_file.rsplit("/", 1)[1], r.malformed_rows) for r in raw_files.malformed_counts(rows).collect()] == [("f.csv", 2)]
    with pytest.raises(ValueError, match="more"):
        raw_files.read_by_header(facts, ["job_id", "more"])
    assert raw_files.read_by_header(facts.limit(0), ["job_id"]).count() == 0


def test_files_whose_lines_are_rows_are_read_by_many_tasks(spark, raw):
    root, add = raw
    folder = root / "raw" / "p1_Pine wood" / "WE 2025.08.01"
    rows = [f'{i},"q ""{i}"", x",caf\u00e8' for i in range(5000)]
    bodies = {
        "plain.csv": "\n".join(rows) + "\n",
        "crlf.csv": "\r\n".join(rows) + "\r\n\r\n",
        "short.csv": "\n".join([*rows, "7", ""]),
        "quoted.csv": "\n".join([*rows, '1,"line', 'break",x']),
        "stray.csv": "\n".join([*rows, '1,5" pipe,"two', 'lines" x,3']),
        "return.csv": "\n".join([*rows, "1,a\rb,c"]),
        "blank.csv": "\n".join([*rows, " \t ", "1,2,3"]),
        "long.csv": "1," + "x" * 300_000 + ',"' + 'y""' * 100_000 + '"\n',
    }
    for name, body in bodies.items():
        add("2025.08.01", name, ("a,b,c\r\n" if name == "crlf.csv" else "a,b,c\n") + body)
    facts = facts_of(spark, *(folder / name for name in bodies))
    found = {r.path.rsplit("/", 1)[1]: (r.line_rows, r.data_rows, tuple(r.header)) for r in facts.collect()}
    assert {name for name, f in found.items() if f[0]} == {"plain.csv", "crlf.csv", "short.csv", "long.csv"}
    assert {name: f[1] for name, f in found.items()} == {
        "plain.csv": 5000, "crlf.csv": 5000, "short.csv": 5001, "quoted.csv": 5002, "stray.csv": 5002,
        "return.csv": 5002, "blank.csv": 5002, "long.csv": 1,
    }
    assert {f[2] for f in found.values()} == {("a", "b", "c")}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        one = raw_files.read_by_header(facts.where("path like '%/plain.csv'"), ["a", "b", "c"])
        assert one.rdd.getNumPartitions() > 1
        for name in bodies:
            own = facts.where(F.col("path").endswith("/" + name))
            whole = raw_files.read_by_header(own.withColumn("line_rows", F.lit(False)), ["a", "b", "c"])
            parts = raw_files.read_by_header(own, ["a", "b", "c"])
            order = [tuple(r)[:5] for r in parts.orderBy("block_start", "row_pos").collect()]
            assert order == [tuple(r)[:5] for r in whole.orderBy("row_pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_manifest(spark, raw):
    root, add = raw
    add("2025.07.11", "x.xlsx", "binary")
    add("2025.07.11", "upper.CSV", f"{HEADER}\n7,8,q,a\n")
    rows = files.manifest(spark, str(root / "raw")).collect()
    ready = {(r.project_id, r.data_week, r.filename, r.layout) for r in rows if r.state == "ready"}
    assert ready == {
        ("p1", date(2025, 7, 4), "a.csv", "MULTI-UNPIVOTED"), ("p1", date(2025, 7, 11), "b.csv", "MULTI-UNPIVOTED"),
        ("p1", date(2025, 7, 11), "upper.CSV", "MULTI-UNPIVOTED"),
    }
    assert {(r.filename, r.state) for r in rows if r.state != "ready"} == {
        ("empty.csv", "no_rows"), ("notused.csv", "not_used"), ("c.txt", "unknown_type"), ("x.xlsx", "unreadable"),
    }


def test_folder_hash_reacts_to_size_name_and_flag(spark):
    def hashes(data, active="True"):
        df = spark.createDataFrame(data, "project_id string, data_week date, filename string, size_bytes bigint")
        return files.folder_hashes(df, F.lit(active)).first().folder_hash

    week = date(2025, 7, 4)
    base = [("p", week, f"f{i}.csv", i) for i in range(50)]
    assert hashes(base) == hashes(base[::-1])
    assert len({hashes(base), hashes(base[1:]), hashes([*base[1:], ("p", week, "f0.csv", 9)]), hashes(base, "False")}) == 4


def test_snapshots(spark, raw):
    root, add = raw

    def take():
        found = files.manifest(spark, str(root / "raw")).where("state = 'ready'")
        found = files.match_names(found, {"ends_with": ".csv"})
        found = found.withColumn("dataset_format", files.dataset_format(F.col("layout"), F.lit("MULTI-UNPIVOTED")))
        weeks = ledger.week_rows(found, files.folder_hashes(found))
        return ledger.append_snapshot(spark, str(root / "snap"), weeks, found)

    assert ledger.last_snapshot_id(spark, str(root / "snap")) is None
    assert take() == 1
    add("2025.07.11", "late.csv", f"{HEADER}\n7,8,q,a\n")
    assert take() == 2
    store = str(root / "snap")
    assert ledger.previous_snapshot_id(spark, store, 2) == 1
    one, two = (ledger.read_snapshot(spark, store, n) for n in (1, 2))
    changed = ledger.changed_weeks(one, two).select("project_id", "data_week").collect()
    assert [tuple(r) for r in changed] == [("p1", date(2025, 7, 11))]
    f1, f2 = (ledger.read_snapshot(spark, store, n, "files") for n in (1, 2))
    assert [r.filename for r in ledger.new_files(f1, f2).collect()] == ["late.csv"]
    again = ledger.files_to_enqueue(f2, "p1", "2025-07-11")
    assert {r.filename for r in again.collect()} == {"b.csv", "late.csv"}


def test_stream_ingests_each_file_once(spark, raw):
    root, add = raw
    store, marks, seen = str(root / "lake"), str(root / "marks"), []

    def run():
        rows = lambda batch: batch.drop("block_start", "row_pos").withColumn("content_week", F.col("reporting_week"))
        incremental.ingest_new_files(
            spark, str(root / "raw"), COLUMNS, rows, store, "multi", marks, lambda weeks: seen.append({tuple(r) for r in weeks.collect()})
        )
        return lake.scan(spark, store).where("job_id <> ''").count()

    assert run() == 3  # a.csv (2) and b.csv
    assert run() == 3
    add("2025.07.11", "late.CSV", "answer,job_id,reviewer_id,question\na,7,8,q\n")
    assert run() == 4
    assert seen[-1] == {("p1", date(2025, 7, 11))}
    assert {r.answer for r in lake.scan(spark, store, week="2025-07-11").collect()} == {"a"}


def test_param_sql(spark):
    df = spark.range(5).withColumn("flag", F.col("id") > 2)
    text = "SELECT id, flag FROM {input_path} WHERE id >= {low}"
    out = lake.param_sql(spark, text, df, auto_limit=True, limit_rows=2, booleans_as_text=True, low=1)
    assert out.count() == 2 and dict(out.dtypes)["flag"] == "string"
    assert lake.param_sql(spark, text + "\nlimit 3", df, auto_limit=True, limit_rows=1, low=0).count() == 3
    assert lake.param_sql(spark, "with t as (select * from {input_path}) select * from t", df, True, 1).count() == 5
    with pytest.raises(ValueError, match="low"):
        lake.param_sql(spark, text, df)


def test_describe_and_scan_files(spark, sf):
    df = fx.view(spark, sf, "v_audit")
    described = {r.col_name: r.data_type for r in lake.describe(df).collect()}
    assert described["reporting_week"] == "date" and described["weight"] == "double"
    scanned = lake.scan_files(spark, spark.read.parquet(f"{sf}/orders.parquet"))
    assert [r.length > 0 for r in scanned.collect()] == [True]


def test_reports_of_changed_weeks_equal_a_full_build(spark, sf, tmp_path):
    """Reports rebuilt for one week after the others equal reports built at once."""
    rows = audit_long(spark, sf).withColumn("content_week", clean.content_week(F.col("job_date")))
    year = F.expr("cast(date_trunc('year', job_date) as date)")
    lake.write_long(rows.withColumn("content_week", year), str(tmp_path / "lake"), "audit")
    stored = lake.scan(spark, str(tmp_path / "lake"))
    weeks = stored.select("project_id", "reporting_week").distinct()
    last = weeks.agg(F.max("reporting_week")).first()[0]
    out = str(tmp_path / "out")
    first = daily.rebuild_reports(spark, stored, "A", targets(spark, sf), out, weeks.where(F.col("reporting_week") != last))
    daily.rebuild_reports(spark, stored, "A", targets(spark, sf), out, weeks.where(F.col("reporting_week") == last))
    assert len(first) == 5
    full = reports.audit_workflow_summary(stored.drop("base"), targets(spark, sf))
    kept = spark.read.parquet(f"{out}/A_workflow_summary")
    columns = full.columns
    assert kept.select(columns).exceptAll(full).count() == 0 and kept.count() == full.count()
    shares = spark.read.parquet(f"{out}/A_error_contribution")
    sums = shares.groupBy("week_ending", "project_id", "parent_label").agg(F.sum("weekly_error_contribution").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1) > 1e-4).count() == 0
    projects = fx.view(spark, sf, "v_projects").select(
        F.col("_project_id").alias("project_id"), F.col("_project_name").alias("project_name"),
        F.col("_project_metric").alias("project_metric"),
    ).join(targets(spark, sf), "project_id")
    assert daily.contributor_table(spark, out, ["A"], projects).count() > 0


def test_confusion_cells_cover_binary_rows(spark, sf):
    rows = audit_long(spark, sf)
    cells = rows.where("confusion_type <> ''").count()
    assert cells == rows.where("is_label_binary").count()
    assert layouts_labels.LONG_AUDIT_RULES["workflow"]["required"] is False


SHEET = "actor_id,reviewer_id,job_id,job_date,queue,label,actor_answer,reviewer_answer"


def test_full_run_rebuilds_touched_weeks_only(spark, raw):
    """Two deliveries: the second one rebuilds its own week, and the numbers follow."""
    root, add = raw
    folder = "s1_Sheet"
    names = {k: str(root / k) for k in ("lake", "out", "marks")}
    goals = spark.createDataFrame([("s1", 0.5)], "project_id string, target double")

    def line(rater, job, day, mine, theirs):
        return f"1000000000{rater},20000000001,3000000000{job},{day},q,flag,{mine},{theirs}\n"

    def go():
        def normalize(batch):
            rows = layouts_labels.normalize_long_audit(batch, {})
            return rows.withColumn("content_week", clean.content_week(F.col("job_date")))

        return daily.run(
            spark, str(root / "raw" / folder), SHEET.split(","), normalize, "audit", goals, names["lake"], names["out"], names["marks"]
        )

    def scores():
        report = spark.read.parquet(f"{names['out']}/A_workflow_summary")
        return {str(r.week_ending): (r.job_instances, r.workflow_score) for r in report.collect()}

    add("2025.07.04", "a.csv", SHEET + "\n" + line(1, 1, "2025-07-01", "A", "A") + line(1, 2, "2025-07-02", "A", "B"), folder)
    add("2025.07.11", "b.csv", SHEET + "\n" + line(1, 3, "2025-07-08", "A", "a "), folder)
    assert go()
    assert scores() == {"2025-07-04": (2, 0.5), "2025-07-11": (1, 1.0)}
    assert not go()
    # A late row keeps the reporting week of its folder.
    add("2025.07.11", "late.csv", SHEET + "\n" + line(2, 4, "2025-07-01", "A", "B"), folder)
    assert go()
    assert scores() == {"2025-07-04": (2, 0.5), "2025-07-11": (2, 0.5)}
    fixed = spark.read.parquet(f"{names['out']}/A_workflow_summary").where("week_ending = '2025-07-11'")
    override = fixed.withColumn("workflow_score", F.lit(0.25)).withColumn("project_id", F.lit("s1"))
    daily.override_report(spark.createDataFrame(override.collect(), override.schema), names["out"], "A_workflow_summary")
    assert scores() == {"2025-07-11": (2, 0.25)}


def test_multi_and_outcome_reports_are_written(spark, sf, tmp_path):
    for code, view, count in (("M", "v_multi", 5), ("H", "v_outcome", 6)):
        rows = fx.view(spark, sf, view).withColumn("base", F.lit(code))
        names = daily.rebuild_reports(spark, rows, code, targets(spark, sf), str(tmp_path))
        assert len(names) == count
        assert all(spark.read.parquet(f"{tmp_path}/{n}").count() > 0 for n in names)


def test_coverage_counts_repeated_and_missing_weeks_as_a_join_does(spark):
    weeks = spark.sql("""select * from values ('a', date'2024-01-05'), ('a', date'2024-01-05'), ('a', date'2024-01-12'),
        ('a', date'1969-12-31'), ('a', date'2024-01-10'), ('a', null), (null, date'2024-01-05'), ('b', date'2024-01-05') as t(project_id, week_ending)""")
    found = spark.sql("""select * from values ('a', date'2024-01-05', 2), ('a', date'2024-01-05', 3), ('a', date'1969-12-31', 0), ('a', date'2024-01-10', null),
        ('a', date'2030-01-04', 9), ('a', null, 9), (null, date'2024-01-05', 9) as t(project_id, week_ending, valid_files_number)""")
    got = {r.project_id: tuple(r)[1:] for r in files.coverage(weeks, found).collect()}
    assert got == {"a": (8, 4, 10, date(2024, 1, 5)), None: (1, 0, 0, None), "b": (1, 0, 0, None)}


def test_coverage_shuffles_blocks_of_weeks(spark):
    spans = spark.sql("select concat('p', cast(id as string)) as project_id, date'2000-01-07' as a, date'2019-12-27' as b from range(50)")
    weeks = files.week_calendar(spans, ["project_id"], "a", "b")
    plan = files.coverage(weeks, weeks.withColumn("valid_files_number", F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    first = next(i for i, line in enumerate(lines) if "Generate" in line)
    below = max(i for i, line in enumerate(lines[:first]) if "Exchange" in line)
    assert any("count" in line for line in lines[below:first])


def test_written_csv_files_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lake, "ROWS_PER_FILE", 10)
    path = str(tmp_path / "csv")
    lake.write_csv(spark.range(95).select(F.concat(F.col("id").cast("string"), F.lit("\nx")).alias("a")).coalesce(1), path)
    rows = lake.read_raw_csv(spark, path, ["a"])
    assert rows.count() == 95
    assert rows.groupBy("source_file").count().agg(F.max("count")).first()[0] <= 10
