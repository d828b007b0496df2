"""Sources, sinks, manifests, snapshots and incremental ingest."""

from pyspark.sql import functions as F

from checks.audit import audit_long
from checks.registry import check
from checks import fixtures as fx
from raterscope.functions import clean
from raterscope.session import scratch_path, stored
from raterscope.sources import files as ff
from raterscope.sources import lake, ledger, raw
from raterscope.streaming import incremental

# --- readers and sinks -------------------------------------------------------------------

PAYLOAD_TEXT = [
    "actor_id", "quality_actor_id", "job_id", "review_ds", "queue_name", "decision_data", "quality_decision_data",
]


@check(f"""select {", ".join(PAYLOAD_TEXT)}, case row_pos % 3 when 0 then '' when 1 then concat('two', chr(10), 'lines, "quoted"') else 'plain' end as remark
from v_payload""")
def csv_roundtrip(spark, sf):
    """Write all-string rows as CSV and read them back: quotes, breaks, blanks survive."""
    remark = "case row_pos % 3 when 0 then '' when 1 then concat('two', chr(10), 'lines, \"quoted\"') else 'plain' end"
    rows = fx.view(spark, sf, "v_payload").withColumn("remark", F.expr(remark))
    columns = [*PAYLOAD_TEXT, "remark"]
    path = scratch_path(spark, "csv")
    lake.write_csv(rows.select(*columns), path)
    return lake.read_raw_csv(spark, path, columns).select(*columns)


LAKE = """select {0} as project_id, reporting_week, {1} as base, {2} as content_week, count(*) as row_count,
  sum(weight) as weight from {3} group by all"""


YEAR = "cast(date_trunc('year', job_date) as date)"


@check(LAKE.format("project_id", "'A'", f"FRI({YEAR})", "v_audit"))
def parquet_partition_roundtrip(spark, sf):
    """Write the lake, then write one week's projects again: only their partitions change."""
    path = scratch_path(spark, "lake")
    # Years keep the number of partitions near that of real folders.
    year = clean.content_week(F.expr(YEAR))
    rows = audit_long(spark, sf).withColumn("content_week", year)
    broken = rows.withColumn(
        "weight", F.when(F.col("project_id").endswith("n2"), F.col("weight") + 1).otherwise(F.col("weight"))
    )
    lake.write_long(broken, path, "audit")
    lake.write_long(rows.where(F.col("project_id").endswith("n2")), path, "audit")
    return (
        lake.scan(spark, path)
        .groupBy("project_id", "reporting_week", "base", "content_week")
        .agg(F.count("*").alias("row_count"), F.sum("weight").alias("weight"))
    )


@check("""select case project_id when 'm0' then '007' when 'm1' then '12E4' else project_id end as project_id, reporting_week,
  count(*) as row_count, sum(weight) as weight from v_multi group by all""")
def partition_scan(spark, sf):
    """One lake of two bases; a scan of one base prunes to its partitions."""
    path = scratch_path(spark, "lake")
    year = clean.content_week(F.expr(YEAR))
    for view, base in (("v_audit", "audit"), ("v_multi", "multi")):
        ids = F.expr("case project_id when 'm0' then '007' when 'm1' then '12E4' else project_id end")
        rows = fx.view(spark, sf, view).withColumns({"content_week": year, "project_id": ids})
        lake.write_long(rows, path, base)
    if lake.scan(spark, path, project_id="007").limit(1).count() != 1:
        raise AssertionError("the id 007 was not found")
    return (
        lake.scan(spark, path, base="multi")
        .groupBy("project_id", "reporting_week")
        .agg(F.count("*").alias("row_count"), F.sum("weight").alias("weight"))
    )


@check("""select project_id, parent_label, cast(is_label_binary as varchar) as is_label_binary, count(*) as row_count,
  sum(weight) as weight from v_audit where weight >= 0.5 and rater_response <> 'R' group by all""")
def param_sql(spark, sf):
    text = """select project_id, parent_label, is_label_binary, count(*) as row_count, sum(weight) as weight
      from {input_path} where weight >= {min_weight} and rater_response <> { skipped }
      group by project_id, parent_label, is_label_binary"""
    return lake.param_sql(
        spark, text, fx.view(spark, sf, "v_audit"), booleans_as_text=True, min_weight=0.5, skipped="R"
    )


# --- manifests ---------------------------------------------------------------------------

# One file per order: names, sizes and data rows vary, some are not eligible.
LISTING = """select concat('/raw/p', cast(o.o_custkey % 3 as string), '_Project name/WE ', replace(cast(FRI(cast(date_trunc('month', o.o_orderdate) as date)) as string), '-', '.'),
    '/', case o.o_custkey % 10 when 0 then 'NotUsed ' else '' end, 'file_', cast(o.o_orderkey as string),
    case o.o_orderkey % 6 when 0 then '.CSV' when 1 then '.xlsx' when 2 then '.txt' else '.csv' end) as path,
  case when o.o_orderkey % 11 = 0 then cast(0 as bigint) else cast(floor(o.o_totalprice) as bigint) end as size_bytes,
  coalesce(c.n, 0) as data_rows
from orders o left join (select l_orderkey, count(*) as n from lineitem where l_quantity < 20 group by l_orderkey) c on o.o_orderkey = c.l_orderkey"""


@check(f"""with l as ({LISTING})
select path, split_part(path, '/', 5) as filename, size_bytes, data_rows from l
where size_bytes > 0 and data_rows >= 1 and path not like '%NotUsed%' and lower(path[-4:]) in ('.csv', 'xlsx')""")
def file_manifest(spark, sf):
    listed = ff.eligible(ff.with_path_keys(fx.query(spark, sf, LISTING)))
    return listed.select("path", "filename", "size_bytes", "data_rows")


@check(f"""with l as ({LISTING})
select path, substr(split_part(path, '/', 3), 1, 2) as project_id,
  cast(replace(substr(split_part(path, '/', 4), 4), '.', '-') as date) as data_week, split_part(path, '/', 5) as filename from l""")
def path_keys(spark, sf):
    keyed = ff.with_path_keys(fx.query(spark, sf, LISTING))
    return keyed.select("path", "project_id", "data_week", "filename")


FILTER = {"begins_with": "file_", "contains": ["1", "2"], "ends_with": ".csv"}


@check("""select filename, case when filename like 'file\\_%1%2%.csv' escape '\\' then 'match' else 'no_match' end as naming_filter from v_files""")
def filename_pattern(spark, sf):
    return ff.match_names(fx.view(spark, sf, "v_files"), FILTER).select("filename", "naming_filter")


@check("""select filename, rpad(left(regexp_replace(filename, '[^a-zA-Z0-9]', '', 'g'), 21), 21, '0') as label,
  concat(project_id, '_', cast(data_week as varchar), '_', rpad(left(regexp_replace(replace(filename, '.csv', ''), '[^a-zA-Z0-9]', '', 'g'), 21), 21, '0'),
    '_C', replace(cast(data_week as varchar), '-', ''), '.parquet') as output_name from v_files""")
def clean_filename(spark, sf):
    week = F.col("data_week")
    return fx.view(spark, sf, "v_files").select(
        "filename", ff.clean_label(F.col("filename")).alias("label"),
        ff.output_name(F.col("project_id"), week, F.col("filename"), week).alias("output_name"),
    )


# Header lines of the known layouts and of broken ones, with quotes, blanks and extra names.
HEADERS = """select concat('file_', cast(o_orderkey as string)) as path, o_custkey % 8 as kind, case o_custkey % 8
  when 0 then 'SRT Annotator ID,Vendor Auditor ID,SRT Job ID,Time (PT),Vendor Tag,"Clear, exact"'
  when 1 then ' annotator_id, auditor_id ,task_id,task_name,audit_status,rubric_answer,QA_score,original_submission_time'
  when 2 then 'answer,question,job_id,reviewer_id'
  when 3 then 'actor_id,quality_actor_id,job_id,review_ds,queue_name,decision_data,quality_decision_data,extracted_label'
  when 4 then 'actor_id,quality_actor_id,job_id,review_ds,queue_name,decision_data'
  when 5 then concat('job_id,reviewer_id,question,answer,_unit_id,_created_at,_worker_id,_tainted,_channel,extra_', cast(o_orderkey % 10 as string))
  when 6 then 'Job_ID,reviewer_id,question,answer' else '"job_id","reviewer_id","question","answer","a, b"' end as header_line from orders"""
DECLARED = "case when o_kind = 7 then null when o_kind in (2, 3, 4) then 'UQD' else 'HALO' end"


@check(f"""with h as ({HEADERS}),
l as (select path, kind as o_kind, case kind when 0 then 'HALO' when 1 then 'GALA' when 2 then 'MULTI-UNPIVOTED' when 3 then 'UQD'
    when 5 then 'ADAP' when 7 then 'MULTI-UNPIVOTED' end as layout from h),
d as (select *, {DECLARED} as declared from l)
select path, layout, case when declared is null then 'invalid:not_declared' when layout is not distinct from declared then declared
  else concat('invalid:', declared) end as dataset_format from d""")
def layout_classify(spark, sf):
    rows = fx.query(spark, sf, HEADERS).withColumnRenamed("kind", "o_kind")
    named = ff.classify(rows.withColumn("header", ff.header_names(F.col("header_line"))))
    declared = F.expr(DECLARED)
    return named.select("path", "layout", ff.dataset_format(F.col("layout"), declared).alias("dataset_format"))


PLAIN_HEADERS = """select p_partkey, concat(replace(p_name, ' ', ','), ',', replace(p_type, ' ', ','), ',', p_brand) as header_line from part"""


@check(f"""select p_partkey, md5(array_to_string(list_sort(string_split(header_line, ',')), '|')) as header_hash from ({PLAIN_HEADERS}) h""")
def header_hash(spark, sf):
    rows = fx.query(spark, sf, PLAIN_HEADERS)
    header = ff.header_names(F.col("header_line"))
    return rows.select("p_partkey", ff.header_hash(header).alias("header_hash"))


@check("""select project_id, data_week, filename, md5(concat(filename, cast(size_bytes as varchar))) as hash from v_files""")
def file_fingerprint(spark, sf):
    rows = ff.with_fingerprint(fx.view(spark, sf, "v_files"))
    return rows.select("project_id", "data_week", "filename", "hash")


FOLDERS = """e{0} as (select project_id, data_week, concat(filename, ':', cast(size_bytes as varchar)) as entry from v_files where {1}),
b{0} as (select project_id, data_week, left(md5(entry), 3) as bucket, md5(string_agg(entry, '' order by entry)) as h from e{0} group by all),
folder{0} as (select project_id, data_week, md5(concat('WE ', replace(cast(data_week as varchar), '-', '.'), 'True',
  string_agg(concat(bucket, h), '' order by concat(bucket, h)))) as folder_hash from b{0} group by project_id, data_week)"""
CURRENT, PREVIOUS = FOLDERS.format("_cur", "true"), FOLDERS.format("_prev", "arrival = 'F'")


@check(f"with {CURRENT} select * from folder_cur")
def folder_fingerprint(spark, sf):
    return ff.folder_hashes(fx.view(spark, sf, "v_files"))


# --- snapshots ---------------------------------------------------------------------------


def _files(spark, sf, previous=False):
    rows = fx.view(spark, sf, "v_files")
    rows = rows.where("arrival = 'F'") if previous else rows
    tagged = ff.with_fingerprint(ff.match_names(rows, {"begins_with": "file_"}))
    return tagged.withColumn("dataset_format", F.when(F.col("size_bytes") % 10 == 0, "invalid:UQD").otherwise("UQD"))


def _weeks(spark, sf, previous=False):
    rows = _files(spark, sf, previous)
    return ledger.week_rows(rows, ff.folder_hashes(rows))


COUNTS = """n{0} as (select project_id, data_week, count(*) as file_number, count(*) filter (where size_bytes % 10 <> 0) as valid_files_number
  from v_files where {1} group by all),
w{0} as (select * from n{0} join folder{0} using (project_id, data_week))"""
CUR = f"{CURRENT},\n{COUNTS.format('_cur', 'true')}"
PREV = PREVIOUS + ",\n" + COUNTS.format("_prev", "arrival = 'F'")


@check(f"""with {CUR}
select project_id, data_week, file_number, valid_files_number, folder_hash, 2 as snapshot_id from w_cur""")
def snapshot_latest(spark, sf):
    """Append two snapshots and read the last one back."""
    root = scratch_path(spark, "snapshots")
    for previous in (True, False):
        ledger.append_snapshot(spark, root, _weeks(spark, sf, previous), _files(spark, sf, previous))
    snapshots = spark.read.parquet(f"{root}/weeks")
    return ledger.latest(snapshots).select(
        "project_id", "data_week", "file_number", "valid_files_number", "folder_hash", "snapshot_id"
    )


@check(f"""with {CUR},
{PREV}
select w_cur.project_id, w_cur.data_week, w_cur.folder_hash, w_cur.folder_hash is not distinct from w_prev.folder_hash as is_carried,
  case when w_cur.folder_hash is not distinct from w_prev.folder_hash then w_prev.file_number else -w_cur.file_number end as file_number
from w_cur left join w_prev using (project_id, data_week)""")
def snapshot_carry_forward(spark, sf):
    current = _weeks(spark, sf).withColumn("file_number", -F.col("file_number"))
    carried = ledger.carry_forward(current, _weeks(spark, sf, previous=True), ["file_number"])
    return carried.select("project_id", "data_week", "folder_hash", "is_carried", "file_number")


@check(f"""with {CUR},
{PREV}
select w_cur.project_id, w_cur.data_week, w_prev.folder_hash as previous_hash, w_cur.folder_hash
from w_cur left join w_prev using (project_id, data_week)
where w_cur.valid_files_number > 0 and w_prev.folder_hash is distinct from w_cur.folder_hash""")
def snapshot_diff(spark, sf):
    changed = ledger.changed_weeks(_weeks(spark, sf, previous=True), _weeks(spark, sf))
    return changed.select("project_id", "data_week", "previous_hash", "folder_hash")


@check("""select project_id, data_week, filename, md5(concat(filename, cast(size_bytes as varchar))) as hash from v_files where arrival <> 'F'""")
def new_files_diff(spark, sf):
    fresh = ledger.new_files(_files(spark, sf, previous=True), _files(spark, sf))
    return fresh.select("project_id", "data_week", "filename", "hash")


@check("""select project_id, data_week, filename from v_files where size_bytes % 10 <> 0""")
def backfill_select(spark, sf):
    """Every project's valid files, asked for one project at a time."""
    rows = _files(spark, sf)
    parts = [ledger.files_to_enqueue(rows, p) for p in ("p0", "p1", "p2")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("project_id", "data_week", "filename")


# Events of one work item per order: queued, then done or failed, then synced if done.
EVENTS = """select o_orderkey as item_id, 1 as seq, 'enqueued' as status, concat('p', cast(o_custkey % 3 as string)) as project_id from orders
union all select o_orderkey, 2, case when o_orderkey % 10 = 0 then 'failed' else 'transformed' end, concat('p', cast(o_custkey % 3 as string)) from orders where o_orderstatus <> 'P'
union all select o_orderkey, 3, 'synced', concat('p', cast(o_custkey % 3 as string)) from orders where o_orderstatus = 'F' and o_orderkey % 10 <> 0"""


@check(f"""with s as (select * from (select *, row_number() over (partition by item_id order by seq desc) as k from ({EVENTS}) e) t where k = 1)
select status, count(*) as item_count, cast(null as bigint) as oldest_item from s group by 1
union all select 'oldest', cast(null as bigint), min(item_id) from s where status = 'enqueued'""")
def ledger_latest_state(spark, sf):
    root = scratch_path(spark, "events")
    ledger.append_events(fx.query(spark, sf, EVENTS), root)
    events = spark.read.parquet(root)
    counts = ledger.state_counts(events).withColumn("oldest_item", F.lit(None).cast("bigint"))
    first = ledger.oldest(events).select(
        F.lit("oldest").alias("status"), F.lit(None).cast("bigint").alias("item_count"),
        F.col("item_id").alias("oldest_item"),
    )
    return counts.unionByName(first)


# --- calendars ---------------------------------------------------------------------------

SPANS = """select concat('c', cast(o_custkey as string)) as project_id, min(cast(o_orderdate as date)) as first_day,
  max(cast(o_orderdate as date)) as last_day from orders group by o_custkey"""
CALENDAR = f"""cal as (select project_id, unnest(generate_series(cast(FRI(first_day) as timestamp), cast(FRI(last_day) as timestamp), interval 7 day))::date as week_ending
  from ({SPANS}) s)"""


@check(f"with {CALENDAR} select project_id, week_ending from cal")
def week_calendar(spark, sf):
    return ff.week_calendar(fx.query(spark, sf, SPANS), ["project_id"], "first_day", "last_day")


ARRIVED = """select concat('c', cast(o_custkey as string)) as project_id, FRI(cast(o_orderdate as date)) as week_ending,
  count(*) filter (where o_orderstatus <> 'P') as valid_files_number from orders group by 1, 2"""


@check(f"""with {CALENDAR},
a as ({ARRIVED}),
j as (select cal.*, coalesce(valid_files_number, 0) as n from cal left join a using (project_id, week_ending))
select project_id, count(*) as weeks, count(*) filter (where n > 0) as weeks_with_data, cast(sum(n) as bigint) as total_files,
  max(week_ending) filter (where n > 0) as last_valid_week from j group by 1""")
def coverage_report(spark, sf):
    return ff.coverage(week_calendar(spark, sf), fx.query(spark, sf, ARRIVED))


TEMPLATES = {
    "p0": ["cb_overview_{date}.csv", "cb_raters_{date}.csv"], "p1": ["eb_overview_{date}.csv"], "p2": ["eb_raters_{date}.csv"],
}
# A delivered file per order, dated three days after its week; some kinds never arrive.
DELIVERED = """select project_id, week_ending, concat(case project_id when 'p0' then 'cb_' else 'eb_' end,
    case when k % 2 = 0 then 'overview_' else 'raters_' end, cast(week_ending + 3 as string), '.csv') as filename from (
  select concat('p', cast(o_custkey % 3 as string)) as project_id, FRI(cast(o_orderdate as date)) as week_ending, o_orderkey as k from orders) d"""


@check(f"""with d as ({DELIVERED}),
w as (select distinct project_id, week_ending from d),
r as (select project_id, week_ending, unnest(case project_id when 'p0' then ['cb_overview_', 'cb_raters_'] when 'p1' then ['eb_overview_'] else ['eb_raters_'] end) as stem from w),
m as (select r.project_id, r.week_ending, exists (select 1 from d where d.project_id = r.project_id and d.week_ending = r.week_ending
    and d.filename = concat(r.stem, cast(r.week_ending + 3 as varchar), '.csv')) as here from r)
select project_id, week_ending, count(*) filter (where not here) as missing_files, bool_and(here) as is_ready from m group by all""")
def required_files_ready(spark, sf):
    delivered = fx.query(spark, sf, DELIVERED.replace("week_ending + 3", "date_add(week_ending, 3)"))
    weeks = delivered.select("project_id", "week_ending").distinct()
    return ff.missing_files(ff.required_files(weeks, TEMPLATES), delivered)


# --- incremental ingest --------------------------------------------------------------------

RAW_SHEET = """select concat('p', cast(l_suppkey % 3 as string)) as project_id, FRI(cast(date_trunc('year', l_shipdate) as date)) as reporting_week,
  cast(10000000000 + l_suppkey as string) as actor_id, cast(20000000000 + l_partkey % 40 as string) as reviewer_id,
  case when l_partkey % 50 = 0 then 'x' else cast(30000000000 + l_orderkey as string) end as job_id,
  cast(cast(l_shipdate as date) as string) as job_date, concat('queue_', cast(l_suppkey % 4 as string)) as queue,
  concat('label_', cast(l_linenumber as string)) as label, l_returnflag as actor_answer,
  case when l_tax = 0 then '' else l_returnflag end as reviewer_answer, l_linestatus as arrival from lineitem"""
SHEET_COLUMNS = ["actor_id", "reviewer_id", "job_id", "job_date", "queue", "label", "actor_answer", "reviewer_answer"]
HIVE_KEYS = r"/project_id=([^/]+)/reporting_week=(\d{4}-\d{2}-\d{2})/([^/]+)$"


# Ids that a reader which guesses types would change.
IDS = """case l_suppkey % 3 when 0 then '007' when 1 then '12E4' else 'p2' end"""
INGESTED = f"""select {IDS} as project_id, FRI(cast(date_trunc('year', l_shipdate) as date)) as reporting_week,
  FRI(cast(date_trunc('year', l_shipdate) as date)) as content_week, count(*) as row_count,
  count(*) filter (where l_tax <> 0) as correct_count from lineitem where l_partkey % 50 <> 0 group by all"""


def _sheet(spark, sf):
    ids = F.expr("case project_id when 'p0' then '007' when 'p1' then '12E4' else project_id end")
    return fx.query(spark, sf, RAW_SHEET).withColumn("project_id", ids)


def _deliver(rows, root, columns, mode="append"):
    """CSV files by project and week, with the columns in the given order; several of a large week."""
    (
        rows.select("project_id", "reporting_week", *columns)
        .hint("rebalance", F.col("project_id"), F.col("reporting_week"))
        .write.mode(mode).option("header", True).option("emptyValue", "").option("partitionOverwriteMode", "dynamic")
        .partitionBy("project_id", "reporting_week").csv(root)
    )


def _normalize(rows):
    from raterscope.plans.layouts_labels import normalize_long_audit

    # years keep the number of partitions near that of real folders
    return normalize_long_audit(rows, {}).withColumn("content_week", clean.content_week(F.expr(YEAR)))


@check(INGESTED)
def incremental_ingest(spark, sf):
    """Two deliveries with other column orders, three runs of the stream."""
    root, store, marks = (scratch_path(spark, n) for n in ("raw", "lake", "stream"))
    sheet = _sheet(spark, sf)
    for delivery, columns in (("F", SHEET_COLUMNS), ("O", SHEET_COLUMNS[::-1]), (None, None)):
        if delivery:
            _deliver(sheet.where(F.col("arrival") == delivery), root, columns)
        incremental.ingest_new_files(
            spark, root, SHEET_COLUMNS, _normalize, store, "audit", marks, pattern=HIVE_KEYS, week_format="yyyy-MM-dd"
        )
    return (
        lake.scan(spark, store, base="audit")
        .groupBy("project_id", "reporting_week", "content_week")
        .agg(F.count("*").alias("row_count"), F.count_if("is_correct").alias("correct_count"))
    )


@check(f"""select {", ".join(PAYLOAD_TEXT)}, case row_pos % 3 when 0 then '' else concat('caf', chr(232), row_pos) end as remark
from v_payload""")
def csv_mixed_headers(spark, sf):
    """Files with other column orders, further columns, an absent column, and Latin-1 bytes."""
    rows = fx.view(spark, sf, "v_payload").withColumn(
        "remark", F.expr("case row_pos % 3 when 0 then '' else concat('caf', char(232), row_pos) end")
    )
    columns = [*PAYLOAD_TEXT, "remark"]
    root = scratch_path(spark, "csv")
    shapes = [("UTF-8", columns[:-1]), ("UTF-8", columns[::-1]), ("ISO-8859-1", [*columns, "extra"])]
    for kind, (encoding, names) in enumerate(shapes):
        part = rows.where(F.col("row_pos") % 3 == kind).withColumn("extra", F.lit("x, y"))
        (
            part.select(*names).write.mode("overwrite").option("header", True).option("escape", '"')
            .option("emptyValue", "").option("encoding", encoding).csv(f"{root}/{kind}")
        )
    listed = ff.scan_folder(spark, root).where(F.lower("path").endswith(".csv"))
    facts = raw.file_facts(spark, [r.path for r in listed.select("path").collect()])
    read = raw.read_by_header(facts, columns, optional=["remark"])
    return raw.well_formed(read).select(*columns)


@check(f"""with f as (select project_id, data_week, count(*) as files from (select {IDS.replace("l_suppkey", "o_custkey")} as project_id,
    FRI(cast(date_trunc('year', o_orderdate) as date)) as data_week from orders) t group by all)
select project_id, data_week, 'ready' as state, project_id = '007' as is_opened from f""")
def manifest_scan(spark, sf):
    """After one project's files grew, a second listing opens its folders only."""
    root = scratch_path(spark, "raw")
    week = "FRI(cast(date_trunc('year', o_orderdate) as date))"
    rows = fx.query(spark, sf, f"select {IDS.replace('l_suppkey', 'o_custkey')} as project_id, {week} as reporting_week, cast(o_orderkey as string) as job_id from orders")
    _deliver(rows, root, ["job_id"])
    keys = {"pattern": HIVE_KEYS, "week_format": "yyyy-MM-dd"}
    first = stored(ff.manifest(spark, root, **keys), "manifest")
    _deliver(rows.where("project_id = '007'").withColumn("job_id", F.concat("job_id", F.lit("0"))), root, ["job_id"], "overwrite")
    second = ff.manifest(spark, root, first, **keys).where("state <> 'unknown_type'")
    return second.groupBy("project_id", "data_week").agg(
        F.max("state").alias("state"), F.bool_and("is_opened").alias("is_opened")
    )


# The last state of three deliveries: project 007 was edited, early weeks of p2 were emptied.
LAST = f"""select * from (select {IDS} as project_id, FRI(cast(date_trunc('year', l_shipdate) as date)) as week, l_tax, l_orderkey, l_suppkey,
    l_linenumber, l_returnflag, l_partkey, l_shipdate from lineitem
  where l_partkey % 50 <> 0 and l_linestatus = 'F') t where not (project_id = 'p2' and year(week) < 1997)"""

# Reports keep one row of each job, rater and label of a week: the first by answers, auditor and date.
REPORTED = f"""select * from (select *, row_number() over (partition by project_id, week, l_orderkey, l_suppkey, l_linenumber
    order by l_returnflag, case when l_tax = 0 then '' else l_returnflag end, l_partkey % 40, l_shipdate) as place from ({LAST}) l) r where place = 1"""


@check(f"""select 'lake' as kind, project_id, week, count(*) as row_count from ({LAST}) a group by all
union all select 'report', project_id, week, count(*) from ({REPORTED}) b where l_tax = 0 group by all""")
def full_run(spark, sf):
    """New, edited and emptied weeks, each run by the snapshot difference; the fourth finds nothing."""
    from raterscope.plans import daily

    root, state, store, out = (scratch_path(spark, n) for n in ("raw", "state", "lake", "out"))
    sheet = _sheet(spark, sf).where("arrival = 'F'")
    early = (F.col("project_id") == "p2") & (F.year("reporting_week") < 1997)
    wrong = F.when(F.col("project_id") == "007", F.lit("wrong answer")).otherwise(F.col("actor_answer"))
    goals = spark.createDataFrame([("007", 0.5), ("12E4", 0.5), ("p2", 0.5)], "project_id string, target double")
    deliveries = [
        (sheet.withColumn("actor_answer", wrong), SHEET_COLUMNS),
        (sheet.where("project_id = '007'"), SHEET_COLUMNS[::-1]),
        (sheet.where(early).withColumn("job_id", F.lit("no id")), SHEET_COLUMNS),
        None,
    ]
    changed = []
    for delivery in deliveries:
        if delivery:
            _deliver(*[delivery[0], root, delivery[1]], mode="overwrite")
        changed.append(
            daily.full_run(
                spark, root, state, store, out, SHEET_COLUMNS, _normalize, "audit", goals,
                pattern=HIVE_KEYS, week_format="yyyy-MM-dd",
            )
        )
    if changed != [True, True, True, False]:
        raise AssertionError(f"runs that changed something: {changed}")
    rows = lake.scan(spark, store, base="audit").select(F.lit("lake").alias("kind"), "project_id", F.col("reporting_week").alias("week"))
    report = lake.read_table(spark, f"{out}/A_incorrect_sample").select(F.lit("report").alias("kind"), "project_id", F.col("week_ending").alias("week"))
    return rows.unionByName(report).groupBy("kind", "project_id", "week").agg(F.count("*").alias("row_count"))


# --- further sinks and row limits ------------------------------------------------------------


@check(f"""select project_id, reporting_week, 'A' as base, FRI({YEAR}) as content_week, 'label' as methodology, count(*) as row_count from v_audit group by all""")
def canonical_sink(spark, sf):
    path = scratch_path(spark, "canonical")
    rows = audit_long(spark, sf).withColumn("content_week", clean.content_week(F.expr(YEAR)))
    lake.write_canonical(rows, path, "audit")
    return (
        lake.scan(spark, path).groupBy("project_id", "reporting_week", "base", "content_week", "methodology")
        .agg(F.count("*").alias("row_count"))
    )


@check("""select count(*) as row_count, min(kept) as least, max(kept) as most from (
  select project_id, least(count(*), 1000) as kept from v_audit where project_id = 'p0' group by 1) t""")
def param_sql_limit(spark, sf):
    """The automatic limit, as the feature is; a query with its own limit keeps that."""
    rows = fx.view(spark, sf, "v_audit")
    text = "select project_id, job_id from {input_path} where project_id = {project}"
    limited = lake.param_sql(spark, text, rows, auto_limit=True, project="p0")
    own = lake.param_sql(spark, text + "\nLIMIT 5", rows, auto_limit=True, limit_rows=2, project="p0")
    n = limited.agg(F.count("*").alias("kept"))
    if own.count() != 5:
        raise AssertionError("the query's own limit was not kept")
    return n.select(F.lit(1).cast("long").alias("row_count"), F.col("kept").alias("least"), F.col("kept").alias("most"))


@check("""select project_id, reporting_week as week_ending, cast(count(*) as bigint) as row_count from v_audit
where project_id <> 'p0' or reporting_week >= (select min(reporting_week) from v_audit where project_id = 'p0') + 700 group by all""")
def override_partitions(spark, sf):
    """A roll-up replaces all weeks of its project, also those it has no row of."""
    from raterscope.plans import daily

    out = scratch_path(spark, "out")
    rows = fx.view(spark, sf, "v_audit").groupBy("project_id", F.col("reporting_week").alias("week_ending")).agg(F.count("*").alias("row_count"))
    incremental.write_report(rows.withColumn("row_count", F.col("row_count") * F.when(F.col("project_id") == "p0", 2).otherwise(1)), out, "report")
    first = rows.where("project_id = 'p0'").agg(F.min("week_ending").alias("first"))
    later = rows.where("project_id = 'p0'").join(F.broadcast(first), F.col("week_ending") >= F.date_add("first", 700)).drop("first")
    daily.override_report(later, out, "report")
    return lake.read_table(spark, f"{out}/report").select("project_id", "week_ending", "row_count")
