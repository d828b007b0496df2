"""Snapshots of the raw folders and the append-only log of ingested files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raterscope.operators.dedupe import top_per_group
from raterscope.operators.skew import attach

WEEK_KEY = ["project_id", "data_week"]


# --- snapshots --------------------------------------------------------------------------
#
# A snapshot is two tables under one root, both partitioned by snapshot_id: `weeks` (one
# row per project and week) and `files` (one row per file). Files stay rows, so a folder
# of any size is never gathered into one value.


def is_valid_file() -> Column:
    """The name fits the project's filter and the header fits its declared layout."""
    return (F.col("naming_filter") == "match") & ~F.coalesce(
        F.col("dataset_format").startswith("invalid:"), F.lit(True)
    )


def week_rows(files: DataFrame, folder_hashes: DataFrame) -> DataFrame:
    """Folder hash and file counts of every project and week."""
    counts = files.groupBy(*WEEK_KEY).agg(
        F.count("*").alias("file_number"),
        F.count_if(is_valid_file()).alias("valid_files_number"),
    )
    return counts.join(folder_hashes, WEEK_KEY).withColumns(
        {
            "has_any_data": F.col("file_number") > 0,
            "has_weekly_data": F.col("valid_files_number") > 0,
        }
    )


def append_snapshot(spark: SparkSession, root: str, weeks: DataFrame, files: DataFrame) -> int:
    """Append both tables under the next snapshot id and return it.

    The weeks are written last: a snapshot without weeks is unfinished and never read.
    """
    number = (last_snapshot_id(spark, root) or 0) + 1
    for name, rows in (("files", files), ("weeks", weeks)):
        stamped = rows.withColumns(
            {"snapshot_id": F.lit(number), "taken_at": F.current_timestamp()}
        )
        (
            stamped.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("snapshot_id")
            .parquet(f"{root}/{name}")
        )
    return number


def last_snapshot_id(spark: SparkSession, root: str) -> int | None:
    return _highest_id(spark, root, F.lit(True))


def previous_snapshot_id(spark: SparkSession, root: str, number: int) -> int | None:
    return _highest_id(spark, root, F.col("snapshot_id") < number)


def _highest_id(spark: SparkSession, root: str, condition: Column) -> int | None:
    """Read from partition names only; None before the first snapshot."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/weeks")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    ids = spark.read.schema("snapshot_id int").parquet(f"{root}/weeks").where(condition)
    return ids.agg(F.max("snapshot_id")).first()[0]


def read_snapshot(spark: SparkSession, root: str, number: int, table: str = "weeks") -> DataFrame:
    return spark.read.parquet(f"{root}/{table}").where(F.col("snapshot_id") == number)


def latest(snapshots: DataFrame) -> DataFrame:
    """Rows of the highest snapshot id."""
    top = snapshots.agg(F.max("snapshot_id").alias("snapshot_id"))  # exactly one row
    return snapshots.join(F.broadcast(top), "snapshot_id", "left_semi")


def carry_forward(current: DataFrame, previous: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Where a folder's hash is unchanged, take the previous row's columns."""
    names = {c: f"_prev_{c}" for c in ("folder_hash", *columns)}
    prev = previous.select(*WEEK_KEY, *[F.col(c).alias(n) for c, n in names.items()])
    same = F.col("folder_hash").eqNullSafe(F.col("_prev_folder_hash"))
    joined = current.join(prev, WEEK_KEY, "left")
    taken = {c: F.when(same, F.col(names[c])).otherwise(F.col(c)) for c in columns}
    return joined.withColumns({**taken, "is_carried": same}).drop(*names.values())


def changed_weeks(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Weeks with data whose folder hash differs from the previous one or is new.

    The comparison is null-safe: a week without a previous row is a change.
    """
    prev = previous.select(*WEEK_KEY, F.col("folder_hash").alias("previous_hash"))
    joined = prev.join(current.where("has_weekly_data"), WEEK_KEY, "right")
    return joined.where(~F.col("previous_hash").eqNullSafe(F.col("folder_hash")))


def new_files(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Files whose hash the previous snapshot of their week lacks."""
    return current.join(previous.select(*WEEK_KEY, "hash"), [*WEEK_KEY, "hash"], "left_anti")


def files_to_enqueue(
    files: DataFrame, project_id: str, data_week: str | None = None
) -> DataFrame:
    """All valid files of a project, or of one of its weeks, for another run."""
    chosen = files.where((F.col("project_id") == project_id) & is_valid_file())
    if data_week:
        chosen = chosen.where(F.col("data_week") == F.lit(data_week).cast("date"))
    return chosen


def active_only(entries: DataFrame, projects: DataFrame) -> DataFrame:
    """Entries of projects whose status is Active."""
    active = projects.where(F.col("project_status") == "Active").select("project_id")
    return attach(entries, active, ["project_id"], "left_semi")


# --- event log --------------------------------------------------------------------------

# States of a work item, in order. `plans.sync` adds `removed` for files that are gone.
STATES = ["enqueued", "processing", "transformed", "failed", "synced"]


def append_events(events: DataFrame, root: str) -> None:
    """Append (item, seq, status, ...) events; nothing is ever rewritten."""
    events.write.mode("append").parquet(root)


def latest_state(events: DataFrame, item: str = "item_id", order: str = "seq") -> DataFrame:
    """The last event of every item."""
    ties = [F.col(c).asc_nulls_last() for c in events.columns if c not in (item, order)]
    return top_per_group(events, [item], [F.col(order).desc(), *ties], 1)


def state_counts(events: DataFrame) -> DataFrame:
    return latest_state(events).groupBy("status").agg(F.count("*").alias("item_count"))


def oldest(events: DataFrame, status: str = "enqueued", n: int = 1) -> DataFrame:
    """The oldest items in a state, by numeric id."""
    waiting = latest_state(events).where(F.col("status") == status)
    return waiting.orderBy(F.col("item_id").cast("bigint")).limit(n)
