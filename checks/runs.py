"""Runs over several layouts, kept state by week, market weeks, and edited files in a stream."""

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.audit import audit_long
from checks.files import HIVE_KEYS, IDS, _deliver, _normalize, SHEET_COLUMNS, _sheet
from checks.registry import ORACLE, check
from checks.rollups import CONFIG, ROLLUP_SQL, _rated, _round
from raterscope.functions.clean import DEFAULT_WORKFLOW
from raterscope.operators.rubric import DEFAULT_ENTRY
from raterscope.plans import reports, rollups, sync
from raterscope.session import scratch_path, stored
from raterscope.sources import dimension, lake, ledger
from raterscope.streaming import changes
from raterscope.streaming.incremental import write_report

KEYS = {"pattern": HIVE_KEYS, "week_format": "yyyy-MM-dd"}

# --- one run over several layouts ------------------------------------------------------------

# Four kinds of raw rows by supplier: label sheets, answers of several reviewers, wide rubrics, and
# projects that cannot be read. Dates are cut to years, so partitions stay as few as in real folders.
KINDS = """select l_orderkey, l_linenumber, l_suppkey, l_partkey, l_tax, l_returnflag, l_linestatus,
  case l_suppkey % 5 when 0 then '007' when 1 then '12E4' when 2 then 'm1' when 3 then 'h1' else case when l_suppkey % 2 = 0 then 'x1' else 'z1' end end as project_id,
  FRI(cast(date_trunc('year', l_shipdate) as date)) as week, year(l_shipdate) as y from lineitem where l_linestatus = 'F'"""

FEED = f"""select project_id, week as reporting_week, y, l_tax, cast(10000000000 + l_suppkey as string) as actor_id,
  cast(20000000000 + l_partkey % 40 as string) as reviewer_id,
  case when l_partkey % 50 = 0 then 'x' else cast(30000000000 + l_orderkey as string) end as job_id,
  concat(cast(y as string), '-01-01') as job_date, concat('queue_', cast(l_suppkey % 4 as string)) as queue,
  concat('label_', cast(l_linenumber as string)) as label, l_returnflag as actor_answer,
  case when l_tax = 0 then '' else l_returnflag end as reviewer_answer from ({KINDS}) k"""

CONFIGS = {
    "007": ("audit", {"module": "SPOTCHECK"}),
    "12E4": ("audit", {"module": "SPOTCHECK", "module_config": {"binary_labels": []}}),
    "m1": ("multi", {"module": "GENERIC", "module_config": {
        "quality_methodology": "multi", "data_structure": "unpivoted", "label_column": "question", "rater_response_column": "answer",
        "info_columns": {"rater_id_column": "person", "job_id_column": "job", "job_date_column": "day"}}}),
    "h1": ("halo", {"module": "GENERIC", "module_config": {
        "quality_methodology": "outcome", "outcome_column": "verdict", "positive_outcome": "good",
        "info_columns": {"rater_id_column": "person", "auditor_id_column": "judge", "job_id_column": "job", "job_date_column": "day"}}}),
    "x1": ("audit", {"module": "NOPE"}),
}
PROJECTS = [sync.Project(name, base, config) for name, (base, config) in CONFIGS.items()]

MULTI_NAMES = {"job": "job_id", "person": "actor_id", "day": "job_date", "question": "label", "answer": "actor_answer"}
OUTCOME_NAMES = {"person": "actor_id", "judge": "reviewer_id", "job": "job_id", "day": "job_date"}


def _feed(spark, sf):
    rows = fx.query(spark, sf, FEED)
    named = {**{k: F.col(v) for k, v in {**MULTI_NAMES, **OUTCOME_NAMES}.items()}}
    return rows.withColumns(named).withColumn("verdict", F.when(F.col("l_tax") == 0, "bad").otherwise("good"))


def _raw_folder(spark, sf, root):
    """The first delivery: sheets of 12E4 from 1997 on lack their date."""
    rows = _feed(spark, sf)
    for name, columns in (("007", SHEET_COLUMNS), ("m1", list(MULTI_NAMES)), ("h1", [*OUTCOME_NAMES, "verdict"]),
                          ("x1", SHEET_COLUMNS), ("z1", SHEET_COLUMNS)):
        _deliver(rows.where(F.col("project_id") == name), root, columns, "append")
    late = (F.col("project_id") == "12E4") & (F.col("y") >= 1997)
    _deliver(rows.where((F.col("project_id") == "12E4") & ~late), root, SHEET_COLUMNS[::-1], "append")
    _deliver(rows.where(late), root, [c for c in SHEET_COLUMNS if c != "job_date"], "append")
    return rows


def _sync(spark, sf, root, names, **more):
    goals = spark.createDataFrame([(p.project_id, 0.5) for p in PROJECTS], "project_id string, target double")
    return sync.sync(spark, root, names["state"], names["lake"], names["out"], PROJECTS, goals, **KEYS, **more)


RUN_SQL = f"""k as ({KINDS}),
good as (select *, l_partkey % 50 <> 0 as valid from k where project_id in ('007', 'm1', 'h1') or (project_id = '12E4' and y < 1998)),
w as (select distinct project_id, week, y from k)"""


@check(f"""with {RUN_SQL}
select 'lake' as kind, project_id, week, case project_id when 'm1' then 'M' when 'h1' then 'H' else 'A' end as detail, count(*) as row_count
from good where valid group by all
union all select 'rejects', project_id, week, case when valid then 'accepted' else 'invalid_id' end, count(*) from good group by all
union all select 'events', project_id, week, case when project_id in ('x1', 'z1') or (project_id = '12E4' and y >= 1998) then 'failed' else 'synced' end, 1 from w""")
def full_run_layouts(spark, sf):
    """Three bases and two configurations of one layout; bad files fail alone, and one is mended."""
    root = scratch_path(spark, "raw")
    names = {k: scratch_path(spark, k) for k in ("state", "lake", "out")}
    rows = _raw_folder(spark, sf, root)
    if not _sync(spark, sf, root, names):
        raise AssertionError("the first run found nothing")
    _deliver(rows.where((F.col("project_id") == "12E4") & (F.col("y") == 1997)), root, SHEET_COLUMNS, "overwrite")
    if not _sync(spark, sf, root, names) or _sync(spark, sf, root, names):
        raise AssertionError("the second run must find the mended week, the third nothing")
    week = F.col("reporting_week").alias("week")
    parts = [
        lake.scan(spark, f"{names['lake']}/{code}", base=code).groupBy(F.lit("lake").alias("kind"), "project_id", week, F.col("base").alias("detail"))
        .agg(F.count("*").alias("row_count")) for code in sync.BASES
    ]
    rejects = lake.read_table(spark, f"{names['out']}/rejects")
    parts.append(rejects.groupBy(F.lit("rejects").alias("kind"), "project_id", F.col("week_ending").alias("week"), F.col("reject_reason").alias("detail")).agg(F.sum("row_count").alias("row_count")))
    # the mended files have other names, so the events of those they took the place of end as removed
    events = ledger.latest_state(spark.read.parquet(f"{names['state']}/events")).where("status <> 'removed'")
    dated = events.withColumn("week", F.split("item_id", "/")[1].cast("date"))
    parts.append(dated.groupBy(F.lit("events").alias("kind"), "project_id", "week", F.col("status").alias("detail")).agg(F.count("*").alias("row_count")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# In the second delivery the later weeks of p0 keep two workflows only, and p1 loses those weeks.
KEPT_ROWS = """select project_id, reporting_week, workflow, parent_label as label from v_audit
  where not (project_id = 'p0' and year(reporting_week) >= 1997 and workflow not in ('1-URGENT', '5-LOW')) and not (project_id = 'p1' and year(reporting_week) >= 1997)
union all select project_id, reporting_week, workflow, parent_label from v_multi
union all select project_id, reporting_week, workflow, rubric from v_outcome"""


@check(f"""select project_id, 'workflow' as catalogue, workflow as entry, min(reporting_week) as first_week, max(reporting_week) as last_week
from ({KEPT_ROWS}) k group by all
union all select project_id, 'label', label, min(reporting_week), max(reporting_week) from ({KEPT_ROWS}) l group by all""")
def kept_catalogues(spark, sf):
    """Catalogues kept by week: what only a replaced or emptied week had goes with it."""
    out = scratch_path(spark, "out")
    views = {"A": ("v_audit", "parent_label"), "M": ("v_multi", "parent_label"), "H": ("v_outcome", "rubric")}
    # the views are joins of the raw tables: each is made once, as the lake would hold it
    long = {
        code: stored(fx.view(spark, sf, view).select("project_id", "reporting_week", "workflow", label), f"long-{code}")
        for code, (view, label) in views.items()
    }
    keys = ["project_id", F.col("reporting_week").alias("week_ending")]
    every = [rows.select(*keys).distinct() for rows in long.values()]
    sync.update_catalogues(out, long, every[0].unionByName(every[1]).unionByName(every[2]).distinct())
    late = F.year("reporting_week") >= 1997
    first = long["A"].where(late & (F.col("project_id") == "p0") & F.col("workflow").isin("1-URGENT", "5-LOW"))
    touched = long["A"].where(late & F.col("project_id").isin("p0", "p1")).select(*keys).distinct()
    sync.update_catalogues(out, {"A": first}, touched)
    parts = [
        sync.catalogue(spark, out, name).select("project_id", F.lit(name).alias("catalogue"), F.col(name).alias("entry"), "first_week", "last_week")
        for name in sync.CATALOGUES
    ]
    return parts[0].unionByName(parts[1])


# --- contributors by week ----------------------------------------------------------------------


@check(ROLLUP_SQL)
def contributor_weeks(spark, sf):
    """Rater reports arrive in two deliveries; the second corrects the last week of the first."""
    out = scratch_path(spark, "out")
    dim = dimension.project_dim(fx.view(spark, sf, "v_projects"), active_only=True)
    projects = dim.join(dimension.targets(dim), "project_id")
    tables = {"A": reports.audit_rater_label_summary(audit_long(spark, sf)), "M": reports.multi_rater_label_summary(fx.view(spark, sf, "v_multi"))}
    # the deliveries and their weeks come from the reports made once
    tables = {code: stored(table, f"report-{code}") for code, table in tables.items()}
    middle = F.lit("1996-01-05").cast("date")
    keys = ["project_id", "week_ending"]
    for delivery in (1, 2):
        ours = F.col("week_ending") <= middle if delivery == 1 else F.col("week_ending") >= middle
        touched = None
        for code, table in tables.items():
            wrong = F.when(F.lit(delivery == 1) & (F.col("week_ending") == middle), 2).otherwise(1)
            part = table.where(ours).withColumn("tot_labels", F.col("tot_labels") * wrong)
            write_report(part, out, f"{code}_rater_label_summary")
            weeks = part.select(*keys).distinct()
            touched = weeks if touched is None else touched.unionByName(weeks)
        sync.update_contributors(spark, out, list(tables), projects, touched.distinct())
    means = ["rater_accuracy", "rater_agreement", *rollups.CONTRIBUTOR_MEANS[1:]]
    table = sync.contributors(spark, out)
    return table.withColumns({c: F.round(c, 12) for c in means})


# --- market weeks --------------------------------------------------------------------------------


def _named_csv(spark, rows, folder, name):
    """One CSV file of a given name."""
    path = scratch_path(spark, "csv")
    rows.repartition(1).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    of = spark._jvm.org.apache.hadoop.fs.Path
    system = of(path).getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in system.listStatus(of(path)) if s.getPath().getName().startswith("part-"))
    system.mkdirs(of(folder))
    system.rename(part, of(f"{folder}/{name}"))


def _replace_files(spark, new, old):
    """Move the CSV files of a folder in place of another's, under its names as far as these go."""
    of = spark._jvm.org.apache.hadoop.fs.Path
    system = of(old).getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(folder):
        return sorted(s.getPath().getName() for s in system.listStatus(of(folder)) if s.getPath().getName().endswith(".csv"))

    names, moved = listed(old), listed(new)
    system.delete(of(old), True)
    system.mkdirs(of(old))
    for i, name in enumerate(moved):
        system.rename(of(f"{new}/{name}"), of(f"{old}/{names[i] if i < len(names) else name}"))


def market_weeks(spark, sf):
    """Of two delivered weeks one lacks a file: only the complete one replaces its report."""
    root, out, state, store = (scratch_path(spark, n) for n in ("raw", "out", "state", "lake"))
    sides = {"overview": _rated(fx.view(spark, sf, "v_market_overview")), "raters": _rated(fx.view(spark, sf, "v_market_raters"))}
    labels = [r.main_label for r in sides["overview"].select("main_label").distinct().orderBy("main_label").collect()]
    families = {kind: {f"{kind}_{i}_{{date}}.csv": label for i, label in enumerate(labels)} for kind in sides}
    for week, stamp in (("2025-07-04", "2025-07-07"), ("2025-07-11", "2025-07-14")):
        for kind, rows in sides.items():
            for name, label in families[kind].items():
                if week == "2025-07-11" and kind == "raters" and label == labels[-1]:
                    continue
                own = rows.where(F.col("main_label") == label).select(*sync.MARKET_COLUMNS[kind])
                _named_csv(spark, own, f"{root}/project_id=cb/reporting_week={week}", name.replace("{date}", stamp))
    market = sync.Market("cb", families["overview"], families["raters"], CONFIG)
    goals = spark.createDataFrame([], "project_id string, target double")
    if not sync.sync(spark, root, state, store, out, [], goals, markets=[market], **KEYS):
        raise AssertionError("the run found nothing")
    ready = {str(r.week_ending): (r.missing_files, r.is_ready) for r in lake.read_table(spark, f"{out}/market_readiness").collect()}
    if ready != {"2025-07-04": (0, True), "2025-07-11": (1, False)}:
        raise AssertionError(f"readiness: {ready}")
    return _round(lake.read_table(spark, f"{out}/A_workflow_summary"))


check(None)(market_weeks)
ORACLE["market_weeks"] = ORACLE["market_dashboard_workflow"]


# --- edited and removed files in a stream ----------------------------------------------------------


@check(f"""select * from (select {IDS} as project_id, FRI(cast(date_trunc('year', l_shipdate) as date)) as reporting_week,
  FRI(cast(date_trunc('year', l_shipdate) as date)) as content_week, count(*) as row_count,
  count(*) filter (where l_tax <> 0) as correct_count from lineitem where l_partkey % 50 <> 0 group by all) t
where not (project_id = 'p2' and year(reporting_week) >= 1998)""")
def incremental_changes(spark, sf):
    """A delivery, its edit under the same name, removed weeks, and a run that finds nothing."""
    root, log, store, marks = (scratch_path(spark, n) for n in ("raw", "log", "lake", "marks"))
    sheet = _sheet(spark, sf)
    seen = []

    def go():
        before = len(seen)
        changes.ingest_changes(
            spark, root, log, SHEET_COLUMNS, _normalize, store, "audit", marks, lambda weeks: seen.append(weeks.count()), **KEYS
        )
        return sum(seen[before:])

    weeks = stored(sheet.select("project_id", "reporting_week").distinct(), "weeks")
    wrong = sheet.withColumn("actor_answer", F.when(F.col("project_id") == "007", F.lit("wrong")).otherwise(F.col("actor_answer")))
    _deliver(wrong, root, SHEET_COLUMNS, "overwrite")
    counts = [go()]
    of = spark._jvm.org.apache.hadoop.fs.Path
    system = of(root).getFileSystem(spark._jsc.hadoopConfiguration())
    fixed = scratch_path(spark, "fixed")
    _deliver(sheet.where("project_id = '007'"), fixed, SHEET_COLUMNS)
    for r in weeks.where("project_id = '007'").collect():  # the corrected files take the names of the wrong ones
        folder = f"project_id=007/reporting_week={r.reporting_week}"
        _replace_files(spark, f"{fixed}/{folder}", f"{root}/{folder}")
    counts.append(go())
    late = weeks.where("project_id = 'p2' and year(reporting_week) >= 1998").collect()
    for r in late:
        system.delete(of(f"{root}/project_id=p2/reporting_week={r.reporting_week}"), True)
    counts += [go(), go()]
    wanted = [weeks.count(), weeks.where("project_id = '007'").count(), len(late), 0]
    if counts != wanted:
        raise AssertionError(f"touched weeks: {counts}, not {wanted}")
    return (
        lake.scan(spark, store, base="audit").groupBy("project_id", "reporting_week", "content_week")
        .agg(F.count("*").alias("row_count"), F.count_if("is_correct").alias("correct_count"))
    )
