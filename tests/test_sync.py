"""The run over several layouts on small folders: grouping, failures, settings, backfill, rosters."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from raterscope.plans import layouts, sync
from raterscope.sources import files, lake, ledger

SHEET = "actor_id,reviewer_id,job_id,job_date,queue,label,actor_answer,reviewer_answer"


def sheet(n, mine="A", theirs="A", day="2025-07-01"):
    return f"10000000001,20000000001,3000000000{n},{day},q,flag,{mine},{theirs}\n"


@pytest.fixture
def place(tmp_path):
    def add(project, week, name, text):
        folder = tmp_path / "raw" / f"{project}_Name" / f"WE {week}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)

    return tmp_path, add


def run(spark, root, projects, **more):
    goals = spark.createDataFrame([(p.project_id, 0.5) for p in projects], "project_id string, target double")
    return sync.sync(spark, str(root / "raw"), str(root / "state"), str(root / "lake"), str(root / "out"), projects, goals, **more)


def events(spark, root):
    last = ledger.latest_state(spark.read.parquet(str(root / "state" / "events")))
    return {r.item_id: (r.status, r.reason, r.row_count, r.content_weeks, r.output_names) for r in last.collect()}


def test_layouts_failures_and_backfill(spark, place):
    root, add = place
    audit = sync.Project("a1", "audit", {"module": "SPOTCHECK"}, naming={"begins_with": "in_", "contains": ["x"], "ends_with": ".csv"})
    halo = sync.Project("h1", "halo", {"module": "HALO"}, layout="HALO")
    projects = [audit, halo, sync.Project("b1", "audit", {})]
    add("a1", "2025.07.04", "in_x.csv", SHEET + "\n" + sheet(1) + sheet(2, theirs="B") + "1,2,3\n" + sheet("9x"))
    add("a1", "2025.07.04", "in_ax_late.csv", SHEET.replace("queue", "workflow_name") + "\n" + sheet(3, day="2025-06-24"))
    add("a1", "2025.07.04", "out_x.csv", SHEET + "\n" + sheet(7))  # another name
    add("a1", "2025.07.04", "in_x_bad.csv", SHEET.replace("job_date", "day") + "\n" + sheet(8))
    header = "SRT Annotator ID,Vendor Auditor ID,SRT Job ID,Time (PT),Vendor Tag,Vendor Manual QA Score,Tone"
    add("h1", "2025.07.04", "h.csv", f"{header}\n10000000001,20000000001,30000000001,2025-07-02,Approved,75,1\n10000000001,20000000001,30000000002,2025-07-02,Rejected,100,0\n")
    add("h1", "2025.07.04", "other.csv", SHEET + "\n" + sheet(7))  # not the declared layout
    add("b1", "2025.07.04", "b.csv", SHEET + "\n" + sheet(7))
    add("u9", "2025.07.04", "u.csv", SHEET + "\n" + sheet(7))
    (root / "raw" / "lost.csv").write_text(SHEET + "\n" + sheet(7))
    assert run(spark, root, projects)
    found = events(spark, root)
    assert found["a1/2025-07-04/in_x.csv"] == ("synced", None, 2, [date(2025, 7, 4)], ["a1_2025-07-04_inx000000000000000000_C20250704.parquet"])
    assert found["a1/2025-07-04/in_ax_late.csv"][:4] == ("synced", None, 1, [date(2025, 6, 27)])
    assert found["h1/2025-07-04/h.csv"][:3] == ("synced", None, 4)  # two jobs by two entries
    reasons = {k: v[1] for k, v in found.items() if v[0] == "failed"}
    assert reasons == {
        "a1/2025-07-04/in_x_bad.csv": "ValueError: no column for job_date: tried ['job_date']",
        "b1/2025-07-04/b.csv": "ValueError: the project configuration names no module",
        "u9/2025-07-04/u.csv": "unknown project", "lost.csv": "no project or week in the path",
    }
    assert "a1/2025-07-04/out_x.csv" not in found and "h1/2025-07-04/other.csv" not in found
    rejects = {(r.source_file.rsplit("/", 1)[1], r.reject_reason): r.row_count for r in lake.read_table(spark, f"{root}/out/rejects").collect()}
    assert rejects == {
        ("in_x.csv", "accepted"): 2, ("in_x.csv", "malformed_row"): 1, ("in_x.csv", "invalid_id"): 1, ("in_ax_late.csv", "accepted"): 1,
        ("h.csv", "accepted"): 2,
    }
    score = lake.read_table(spark, f"{root}/out/A_workflow_summary").agg(F.sum("job_instances")).first()[0]
    assert score == 3
    assert lake.scan(spark, f"{root}/lake/H").count() == 4
    assert not run(spark, root, projects)

    # backfill of one week: everything again, from the files as they are
    again = spark.createDataFrame([("a1", date(2025, 7, 4))], "project_id string, data_week date")
    assert run(spark, root, projects, again=again)
    assert lake.scan(spark, f"{root}/lake/A").count() == 3
    assert spark.read.parquet(f"{root}/state/events").where("item_id = 'a1/2025-07-04/in_x.csv' and status = 'synced'").count() == 2

    # the mended and the removed file
    add("a1", "2025.07.04", "in_x_bad.csv", SHEET + "\n" + sheet(8) + sheet(9))
    (root / "raw" / "h1_Name" / "WE 2025.07.04" / "h.csv").unlink()
    assert run(spark, root, projects)
    found = events(spark, root)
    assert found["a1/2025-07-04/in_x_bad.csv"][:3] == ("synced", None, 2) and found["h1/2025-07-04/h.csv"][0] == "removed"
    assert lake.scan(spark, f"{root}/lake/A").count() == 5 and lake.scan(spark, f"{root}/lake/H").count() == 0
    labels = {(r.project_id, r.label) for r in sync.catalogue(spark, f"{root}/out", "label").collect()}
    assert labels == {("a1", "flag")}


def test_rosters_emails_and_contributors(spark, place):
    root, add = place
    roster = spark.createDataFrame([("10000000001", "de-DE")], "rater_id string, market string")
    mails = spark.createDataFrame([("ann@example.org", "10000000001")], "email string, rater_id string")
    config = {"module": "SPOTCHECK", "module_config": {"info_columns": {"actor_id_column": "srtid"}}}
    projects = [sync.Project("a1", "audit", {"module": "SPOTCHECK"}, roster=roster), sync.Project("a1n2", "audit", config, emails=mails)]
    other = sheet(2).replace("10000000001", "10000000002")
    add("a1", "2025.07.04", "a.csv", SHEET + "\n" + sheet(1) + other)
    mailed = SHEET.replace("actor_id", "Email")
    add("a1n2", "2025.07.04", "m.csv", mailed + "\n" + sheet(3, theirs="B").replace("10000000001", "Ann@Example.org ") + sheet(4).replace("10000000001", "nobody@example.org"))
    dim = spark.createDataFrame([("a1", "One", "accuracy", 0.5), ("a1n2", "One", "accuracy", 0.5)], "project_id string, project_name string, project_metric string, target double")
    assert run(spark, root, projects, dim=dim)
    rows = lake.scan(spark, f"{root}/lake/A").select("project_id", "rater_id", "workflow").collect()
    assert sorted(map(tuple, rows)) == [("a1", "10000000001", "de-DE"), ("a1n2", "10000000001", "q")]
    table = {(r.segment, r.rater_id): (r.tot_labels, r.rater_accuracy) for r in sync.contributors(spark, f"{root}/out").collect()}
    assert table == {("1", "10000000001"): (1.0, 1.0), ("2", "10000000001"): (1.0, 0.0)}
    # one segment changes; the other one's rows of the week stay
    add("a1", "2025.07.04", "b.csv", SHEET + "\n" + sheet(5, theirs="B"))
    assert run(spark, root, projects, dim=dim)
    table = {(r.segment, r.rater_id): (r.tot_labels, r.rater_accuracy) for r in sync.contributors(spark, f"{root}/out", "2025-07-04").collect()}
    assert table == {("1", "10000000001"): (2.0, 0.5), ("2", "10000000001"): (1.0, 0.0)}


def test_name_settings_in_columns_equal_those_of_one_project(spark):
    names = ["file_1_2.csv", "file_2_1.csv", "file_12.csv", "file_", "x", "1", "file_1.csv", "file_1_2.csv.csv", "", "1212.csv"]
    settings = [
        {}, {"begins_with": "file_"}, {"contains": ["1", "2"]}, {"begins_with": "file_", "contains": ["1", "2"], "ends_with": ".csv"},
        {"ends_with": ".csv"}, {"contains": "2"}, {"begins_with": "1", "ends_with": "1"}, {"contains": ["12", "12"], "ends_with": ".csv"},
    ]
    df = spark.createDataFrame([(n,) for n in names], "filename string")
    for s in settings:
        parts = s.get("contains", [])
        parts = [parts] if isinstance(parts, str) else parts
        own = sync.name_fits_columns(
            F.col("filename"), F.lit(s.get("begins_with", "")), F.array(*map(F.lit, parts)).cast("array<string>"), F.lit(s.get("ends_with", "")))
        rows = df.select("filename", own.alias("a"), files.name_fits(F.col("filename"), s).alias("b")).collect()
        assert all(r.a == r.b for r in rows), (s, rows)


def test_projects_of_the_dimension(spark):
    dim = spark.createDataFrame(
        [("p1", "audit", '{"module": "UQD", "dataset_type": "UQD", "files_filter": {"begins_with": "in"}}'), ("p2", "multi", "{broken"), ("p3", None, None), ("p4", "halo", "[1]")],
        "project_id string, project_base string, project_config string")
    found = {p.project_id: p for p in sync.projects_from(dim)}
    assert (found["p1"].layout, found["p1"].naming, found["p1"].config["module"]) == ("UQD", {"begins_with": "in"}, "UQD")
    assert found["p2"].config == found["p3"].config == found["p4"].config == {}


def test_steps_of_registered_modules(spark):
    try:
        layouts.register("OWN", lambda df, config: df.withColumn("seen", F.lit(config["x"])))
        tag, finish = layouts.find_steps("OWN")
        out = finish(tag(spark.range(2), {"x": 1}), {"x": 1})
        assert out.columns == ["id", "seen"] and out.count() == 2
    finally:
        del layouts.MODULES["OWN"]
    with pytest.raises(ValueError, match="unknown module"):
        layouts.find_steps("NONE")
