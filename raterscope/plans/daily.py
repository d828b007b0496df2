"""The full run: new files, long rows, reports of the touched weeks, roll-up."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raterscope.plans import reports
from raterscope.plans.rollups import contributor_rollup
from raterscope.session import scratch_path, stored
from raterscope.sources import files, lake, ledger
from raterscope.streaming.incremental import (
    affected_rows,
    ingest_new_files,
    load_weeks,
    write_report,
)

_PREPARE = {
    "A": (reports.audit_rows, reports.AUDIT_REPORTS),
    "M": (reports.multi_rows, reports.MULTI_REPORTS),
    "H": (reports.outcome_rows, reports.OUTCOME_REPORTS),
}


def rebuild_reports(
    spark: SparkSession,
    lake_rows: DataFrame,
    code: str,
    targets: DataFrame,
    out: str,
    weeks: DataFrame | None = None,
) -> list[str]:
    """Build all reports of a base, for the given weeks or for all, once per week.

    The deduplicated rows are written to the shared folder and read by every report. Of the
    given weeks, those without a report row lose the rows they had.
    """
    rows = lake_rows.where(F.col("base") == code)
    if weeks is not None:
        rows = affected_rows(rows, weeks)
        weeks = weeks.withColumnRenamed("reporting_week", "week_ending")
    prepare, builders = _PREPARE[code]
    path = scratch_path(spark, f"prepared-{code}")
    prepare(rows).write.parquet(path)
    prepared = spark.read.parquet(path)
    names = []
    for name, build in builders.items():
        takes_target = name == "workflow_summary"
        report = build(prepared, targets, prepared=True) if takes_target else build(prepared, prepared=True)
        full = f"{code}_{name}"
        write_report(report, out, full, weeks)
        names.append(full)
    if code == "H":
        write_report(reports.outcome_rubric_detail(rows), out, "H_rubric_detail", weeks)
        names.append("H_rubric_detail")
    return names


def contributor_table(spark: SparkSession, out: str, codes: list[str], projects: DataFrame) -> DataFrame:
    """The contributor roll-up from the stored rater reports."""
    tables = [lake.read_table(spark, f"{out}/{code}_rater_label_summary") for code in codes]
    known = tables[0]
    for table in tables[1:]:
        known = known.unionByName(table, allowMissingColumns=True)
    return contributor_rollup(known, projects)


def override_report(rollup: DataFrame, out: str, name: str) -> None:
    """Replace the report partitions of a project's weeks by roll-up output.

    Weeks of those projects that the roll-up has no row of are emptied.
    """
    spark = rollup.sparkSession
    ours = rollup.select("project_id").distinct()
    known = lake.read_table(spark, f"{out}/{name}").join(ours, "project_id", "left_semi")
    write_report(rollup, out, name, stored(known.select("project_id", "week_ending").distinct(), "weeks"))


def run(
    spark: SparkSession,
    raw_root: str,
    columns: Sequence[str],
    normalize: Callable[[DataFrame], DataFrame],
    base: str,
    targets: DataFrame,
    lake_root: str,
    out: str,
    marks: str,
    optional: Sequence[str] = (),
) -> bool:
    """Ingest what arrived on a raw stream and rebuild the reports it touches.

    Returns whether anything changed, so that roll-ups run only then.
    """
    code = lake.base_code(base)
    rebuilt = []

    def on_weeks(weeks: DataFrame) -> None:
        rows = lake.scan(spark, lake_root, base=code)
        rebuilt.extend(rebuild_reports(spark, rows, code, targets, out, weeks))

    ingest_new_files(
        spark, raw_root, columns, normalize, lake_root, base, marks, on_weeks, optional
    )
    return bool(rebuilt)


def full_run(
    spark: SparkSession,
    raw_root: str,
    state: str,
    lake_root: str,
    out: str,
    columns: Sequence[str],
    normalize: Callable[[DataFrame], DataFrame],
    base: str,
    targets: DataFrame,
    projects: DataFrame | None = None,
    optional: Sequence[str] = (),
    naming: dict | None = None,
    declared: str | None = None,
    rejects: Callable[[DataFrame], DataFrame] | None = None,
    again: DataFrame | None = None,
    pattern: str = files.PATH_KEYS,
    week_format: str = files.WEEK_FORMAT,
) -> bool:
    """Snapshot, diff, ingest, reports, roll-up; returns whether anything changed.

    Weeks whose folder differs from the last snapshot are loaded anew from all their current
    files, whether these are new, edited or gone; `again` (project_id, data_week) adds weeks to
    load once more. Their reports are rebuilt, and emptied where nothing is left. The ledger
    gets an event for each file, `<out>/rejects` the counts of `rejects` (a tagger of raw rows)
    and of malformed rows. The snapshot is appended last: a run that fails is done over.
    """
    code, week = lake.base_code(base), ["project_id", "data_week"]
    number = ledger.last_snapshot_id(spark, state)
    before = None if number is None else ledger.read_snapshot(spark, state, number, "files")
    found = files.manifest(spark, raw_root, before, pattern, week_format)
    layout = F.lit(declared) if declared else F.col("layout")
    found = files.match_names(found, naming or {}).withColumn(
        "dataset_format",
        F.when(F.col("state") != "ready", F.concat(F.lit("invalid:"), F.col("state")))
        .when(F.lit(declared is None), F.lit("any"))
        .otherwise(files.dataset_format(F.col("layout"), layout)),
    )
    found = stored(found, "manifest")
    hashes = stored(files.folder_hashes(found), "folders")
    old = files.folder_hashes(before) if before is not None else hashes.limit(0)
    touched = hashes.select(*week, F.lit(1).alias("_side"), "folder_hash").unionByName(
        old.select(*week, F.lit(2).alias("_side"), "folder_hash")
    )
    # a folder that is as it was has the same hash on both sides
    touched = touched.groupBy(*week, "folder_hash").agg(F.count_distinct("_side").alias("n")).where("n = 1")
    weeks = touched.select(*week)
    if again is not None:
        weeks = weeks.unionByName(again.select(*week))
    weeks = stored(weeks.dropna().distinct(), "touched")
    if not weeks.limit(1).count():
        return False
    usable = found.where((F.col("state") == "ready") & ledger.is_valid_file())
    usable = stored(usable.join(weeks, week, "left_semi"), "usable")
    ours = weeks.withColumnRenamed("data_week", "reporting_week")
    item = F.concat_ws("/", "project_id", F.col("data_week").cast("string"), "filename")
    events = usable.select(item.alias("item_id"), "project_id", "hash")
    log = lambda seq, status: ledger.append_events(
        events.withColumns({"seq": F.lit((number or 0) * 10 + seq), "status": F.lit(status)}), f"{state}/events"
    )
    log(1, "enqueued")
    bad = load_weeks(usable, ours, normalize, lake_root, base, columns, optional, pattern, week_format)
    log(2, "transformed")
    counts = bad.select("source_file", F.lit("malformed_row").alias("reject_reason"), F.col("malformed_rows").alias("row_count"))
    if rejects is not None:
        from raterscope.functions import clean
        from raterscope.sources import raw
        from raterscope.streaming.incremental import raw_rows

        rows = raw.well_formed(raw_rows(usable, columns, optional, pattern, week_format))
        counts = counts.unionByName(clean.reject_stats(rejects(rows), ["source_file"]))
    counts.write.mode("append").parquet(f"{out}/rejects")
    rebuild_reports(spark, lake.scan(spark, lake_root, base=code), code, targets, out, ours)
    log(3, "synced")
    if projects is not None:
        rollup = contributor_table(spark, out, [code], projects)
        stored(rollup, "contributors").write.mode("overwrite").parquet(f"{out}/contributor_rollup")
    snapshot = ledger.week_rows(found, hashes)
    ledger.append_snapshot(spark, state, snapshot, found.drop("is_opened"))
    return True
