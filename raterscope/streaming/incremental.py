"""Ingest raw files as they arrive, and rebuild only the reports they touch.

A file-source stream finds new files and remembers them in its checkpoint, so a run with
`availableNow` handles what arrived since the last one. The unit of work is the delivery week:
all current files of a touched (project, week) are read by header name and replace its
partitions of the lake, so a retried batch, a re-delivered file or a removed one never leaves
rows behind. A file edited under its old name is not new to a stream; `plans.daily.full_run`
finds it by comparing snapshots.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raterscope.operators.skew import attach
from raterscope.session import stored
from raterscope.sources import lake as store
from raterscope.sources import raw
from raterscope.sources.files import CSV_GLOB, PATH_KEYS, WEEK_FORMAT, manifest, with_path_keys

WEEK = ["project_id", "reporting_week"]


def arrivals(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """A stream of the paths of new CSV files; contents are not read."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", CSV_GLOB)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(root).select("path")


def raw_rows(
    files: DataFrame,
    columns: Sequence[str],
    optional: Sequence[str] = (),
    pattern: str = PATH_KEYS,
    week_format: str = WEEK_FORMAT,
) -> DataFrame:
    """Rows of the files with project and reporting week; malformed ones keep their mark.

    The reporting week is the folder's; late rows keep it and get their own content week.
    """
    rows = raw.read_by_header(files, columns, optional).drop("path", "filename", *WEEK, "data_week")
    # taken from the path once per file; the driver lists these paths as well, so they fit a broadcast
    keys = with_path_keys(files.select("path").distinct(), pattern, week_format).select(
        F.col("path").alias("source_file"), "project_id", F.col("data_week").alias("reporting_week")
    )
    return rows.join(F.broadcast(keys), "source_file", "left").select(*rows.columns, *WEEK)


def load_weeks(
    files: DataFrame,
    weeks: DataFrame,
    normalize: Callable[[DataFrame], DataFrame],
    lake: str,
    base: str,
    columns: Sequence[str],
    optional: Sequence[str] = (),
    pattern: str = PATH_KEYS,
    week_format: str = WEEK_FORMAT,
) -> DataFrame:
    """Replace the lake's rows of the weeks by those of their files; counts of malformed rows."""
    rows = raw_rows(files, columns, optional, pattern, week_format)
    store.replace_weeks(normalize(raw.well_formed(rows)), lake, base, weeks)
    return raw.malformed_counts(raw_rows(raw.may_be_malformed(files), columns, optional, pattern, week_format))


def ingest_new_files(
    spark: SparkSession,
    root: str,
    columns: Sequence[str],
    normalize: Callable[[DataFrame], DataFrame],
    lake: str,
    base: str,
    checkpoint: str,
    on_weeks: Callable[[DataFrame], None] | None = None,
    optional: Sequence[str] = (),
    pattern: str = PATH_KEYS,
    week_format: str = WEEK_FORMAT,
    max_files: int | None = None,
) -> None:
    """Bring the weeks of all files that arrived up to date in the lake; returns when done.

    `on_weeks` gets the distinct (project_id, reporting_week) of each batch. A batch lists the
    folders of its own files only.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
        folders = batch.select(folder.alias("folder")).distinct().collect()
        folders = [raw.readable(r.folder) for r in folders]
        if not folders:
            return
        found = manifest(batch.sparkSession, folders, pattern=pattern, week_format=week_format)
        found = stored(found, "manifest")
        weeks = stored(found.select("project_id", F.col("data_week").alias("reporting_week")).distinct(), "touched")
        ready = found.where("state = 'ready'")
        load_weeks(ready, weeks, normalize, lake, base, columns, optional, pattern, week_format)
        if on_weeks:
            on_weeks(weeks)

    query = (
        arrivals(spark, root, max_files)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()


def affected_rows(lake_rows: DataFrame, weeks: DataFrame) -> DataFrame:
    """Lake rows of the touched project-weeks; partition pruning reads only those."""
    return attach(lake_rows, weeks, WEEK, "left_semi")


def write_report(report: DataFrame, root: str, name: str, weeks: DataFrame | None = None) -> None:
    """Replace the report's partitions of the weeks it holds.

    With `weeks` (project_id, week_ending), those that the report has no row of are emptied.
    """
    keys = ["project_id", "week_ending"]

    def write() -> None:
        (
            report.hint("rebalance", *[F.col(c) for c in keys])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .parquet(f"{root}/{name}")
        )

    if weeks is None:
        write()
    else:
        store.overwrite_weeks(report.sparkSession, f"{root}/{name}", keys, weeks.select(*keys), write)
