"""A stream that sees edited and removed files: it follows a log of changes, not the paths.

A file source remembers paths, so a file that changes under its old name is not new to it. Here
each listing of the folders is compared with the last known state of every (project, week, file),
and what differs is appended to a log: new, edited (another fingerprint) or removed. The log only
grows, so a stream over it handles every change once, also one that brings back an older
fingerprint. Listings read names, sizes and times, never contents.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raterscope.operators.dedupe import top_per_group
from raterscope.operators.skew import attach, join_null_safe
from raterscope.session import stored
from raterscope.sources import files, lake
from raterscope.streaming.incremental import load_weeks

FILE_KEY = ["project_id", "data_week", "filename"]
FOLDER = FILE_KEY[:2]

SCHEMA = T.StructType(
    [
        T.StructField("project_id", T.StringType()),
        T.StructField("data_week", T.DateType()),
        T.StructField("filename", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("hash", T.StringType()),
        T.StructField("change", T.StringType()),
        T.StructField("number", T.LongType()),
    ]
)


def known_files(log: DataFrame) -> DataFrame:
    """The last state of every file of a change log; removed ones are left out."""
    order = [F.col("number").desc()]
    last = top_per_group(log, FILE_KEY, order, 1)
    return last.where("change <> 'removed'")


def record_changes(
    spark: SparkSession,
    root: str,
    log: str,
    pattern: str = files.PATH_KEYS,
    week_format: str = files.WEEK_FORMAT,
    use_time: bool = True,
) -> bool:
    """Append what changed below `root` since the last entry of the log; whether anything did.

    With `use_time` a file's time of change is part of its fingerprint, so an edit that leaves
    its size alone shows. Files that are not CSV, are marked as not used or have no bytes count
    as absent, as do those whose folders name no project or week.
    """
    listed = files.with_fingerprint(files.scan_folder(spark, root, pattern, week_format), use_time)
    listed = listed.withColumn("state", files.file_state(opened=False)).where("state = 'ready'")
    now = stored(listed.dropna(subset=FOLDER).select(*FILE_KEY, "path", "hash"), "listing")
    if lake.exists(spark, log):
        entries = spark.read.schema(SCHEMA).parquet(log)
        known = stored(known_files(entries), "known-files")
        number = (entries.agg(F.max("number")).first()[0] or 0) + 1
    else:
        known, number = spark.createDataFrame([], SCHEMA), 1
    before = known.select(*FILE_KEY, F.col("hash").alias("_hash"))
    both = attach(now, before, FILE_KEY)
    fresh = both.where("_hash is null or _hash <> hash").withColumn(
        "change", F.when(F.col("_hash").isNull(), "new").otherwise("edited")
    )
    gone = join_null_safe(known, now.select(*FILE_KEY), FILE_KEY, "left_anti").withColumn("change", F.lit("removed"))
    names = [*FILE_KEY, "path", "hash", "change"]
    changes = stored(fresh.select(*names).unionByName(gone.select(*names)), "changes")
    if not changes.limit(1).count():
        return False
    changes.withColumn("number", F.lit(number).cast("long")).select(SCHEMA.names).write.mode("append").parquet(log)
    return True


def ingest_changes(
    spark: SparkSession,
    root: str,
    log: str,
    columns: Sequence[str],
    normalize: Callable[[DataFrame], DataFrame],
    lake_root: str,
    base: str,
    marks: str,
    on_weeks: Callable[[DataFrame], None] | None = None,
    optional: Sequence[str] = (),
    pattern: str = files.PATH_KEYS,
    week_format: str = files.WEEK_FORMAT,
    max_files: int | None = None,
) -> None:
    """Record what changed, then bring the weeks of all changes not yet handled up to date.

    A touched week is replaced by the rows of the files it now has; one whose last file went is
    emptied. `on_weeks` gets the touched (project_id, reporting_week) of each batch. A batch
    that fails is handled again by the next call.
    """
    record_changes(spark, root, log, pattern, week_format)
    if not lake.exists(spark, log):
        return

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        weeks = stored(batch.select(*FOLDER).distinct(), "touched")
        if not weeks.limit(1).count():
            return
        current = known_files(session.read.schema(SCHEMA).parquet(log))
        ours = join_null_safe(current, weeks, FOLDER, "left_semi")
        paths = [r.path for r in ours.select("path").collect()]
        renamed = weeks.withColumnRenamed("data_week", "reporting_week")
        if paths:
            from raterscope.sources.raw import file_facts

            facts = stored(file_facts(session, paths), "facts")
            load_weeks(facts, renamed, normalize, lake_root, base, columns, optional, pattern, week_format)
        else:
            code = lake.base_code(base)
            rows = lake.read_table(session, lake_root).limit(0) if lake.exists(session, lake_root) else None
            if rows is not None:
                lake.clear_partitions(session, lake_root, lake.PARTITIONS, renamed.withColumn("base", F.lit(code)), rows)
        if on_weeks:
            on_weeks(renamed)

    reader = spark.readStream.schema(SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.parquet(log).writeStream.trigger(availableNow=True)
        .option("checkpointLocation", marks).foreachBatch(handle).start()
    )
    query.awaitTermination()
