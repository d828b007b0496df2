"""Raw readers, the partitioned lake of long tables, and ad-hoc SQL over it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raterscope.operators.skew import join_null_safe
from raterscope.schema import to_canonical
from raterscope.session import stored

PARTITIONS = ["project_id", "reporting_week", "base", "content_week"]

# Header fragments that ask for the permissive parse.
SUSPICIOUS_HEADER = r"\\\"|\\,\"|//"


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_raw_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    permissive: bool = False,
    multiline: bool = True,
    spread_rows: bool = False,
) -> DataFrame:
    """CSV with every column a string, blanks as '', and each row's file and position.

    The strict parse fails on malformed lines. The permissive one reads backslash escapes
    and Latin-1; `sources.raw` finds out which files need it. `multiline=False` lets
    Spark split files that have no line breaks inside quotes; a file that cannot be split is
    read by one task. `spread_rows` then deals its rows to all cores, at the price of a shuffle.
    """
    reader = (
        spark.read.schema(string_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .option("mode", "FAILFAST")
    )
    if permissive:
        reader = reader.option("escape", "\\").option("encoding", "ISO-8859-1")
    else:
        reader = reader.option("escape", '"')
    rows = with_positions(reader.csv(paths)).na.fill("", list(columns))
    return spread(rows) if spread_rows else rows


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a plain scan to all cores when it has fewer tasks than cores.

    Helps where few unsplittable files feed costly parsing. A scan of many files has more
    tasks than the cluster has cores and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def with_positions(df: DataFrame) -> DataFrame:
    """Add source_file, block_start and row_pos, which order the rows of a file."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_pos"),
    )


#: Rows of one written CSV file: a file with line breaks inside quotes is read by one task.
ROWS_PER_FILE = 200_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (
        df.write.mode(mode)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("lineSep", "\n")
        .csv(path)
    )


def base_code(base: str | None) -> str:
    """First letter of the base, upper-cased."""
    return (base or "").strip()[:1].upper()


def write_long(df: DataFrame, root: str, base: str) -> None:
    """Replace the partitions the rows belong to; other partitions stay.

    Rows are hashed to their partition values and spread over a second key, so a large
    project-week is written by several tasks and small ones make few files.
    """
    rows = df.withColumn("base", F.lit(base_code(base)))
    (
        rows.hint("rebalance", *[F.col(c) for c in PARTITIONS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(root)
    )


def write_canonical(df: DataFrame, root: str, base: str) -> None:
    """The canonical-schema copy of a long table."""
    write_long(to_canonical(df), root, base)


#: Partition columns have these types on every read: ids such as `007` and `12E4` stay text.
KEY_TYPES = {
    "project_id": T.StringType(), "base": T.StringType(), "reporting_week": T.DateType(),
    "content_week": T.DateType(), "week_ending": T.DateType(),
}


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """A partitioned table (lake or report) with its partition columns in their own types."""
    found = spark.read.parquet(root).schema
    fields = [T.StructField(f.name, KEY_TYPES.get(f.name, f.dataType), f.nullable) for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(root)


def exists(spark: SparkSession, root: str) -> bool:
    """Whether a folder holds anything to read; the marks of a write without rows do not count."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in system.listStatus(path))


def clear_partitions(spark: SparkSession, root: str, keys: Sequence[str], weeks: DataFrame, written: DataFrame) -> None:
    """Remove the partitions of the touched weeks (`weeks`) that `written` has no row of.

    `keys` are the table's partition columns, outermost first. One job finds the partitions; their
    folders are removed through the file system, so the number of jobs does not grow with them.
    A file without rows stays under the null partition, so a table that lost all rows keeps its
    schema.
    """
    if not exists(spark, root):
        return
    touched = read_table(spark, root).join(weeks, weeks.columns, "left_semi").select(*keys).distinct()
    stale = touched.join(written.select(*keys).distinct(), list(keys), "left_anti").collect()
    _remove_partitions(spark, root, keys, stale)


def held_partitions(spark: SparkSession, root: str, keys: Sequence[str], weeks: DataFrame) -> DataFrame | None:
    """The partitions of the touched weeks with the first file name of each; None where nothing is there."""
    if not exists(spark, root):
        return None
    table = read_table(spark, root).select(*keys, F.col("_metadata.file_name").alias("_file"))
    return table.join(weeks, weeks.columns, "left_semi").groupBy(*keys).agg(F.min("_file").alias("_file"))


def overwrite_weeks(
    spark: SparkSession, root: str, keys: Sequence[str], weeks: DataFrame, write: Callable[[], None]
) -> None:
    """Call `write`, a dynamic overwrite, then remove the partitions of the touched weeks that it left as they were.

    An overwritten partition has files of new names, so the rows need not be stored to be looked at
    twice, and a table that was not there costs no look at all.
    """
    before = held_partitions(spark, root, keys, weeks)
    before = None if before is None else stored(before, "held")
    write()
    if before is not None:
        after = held_partitions(spark, root, keys, weeks)
        same = join_null_safe(after, before, [*keys, "_file"], "left_semi")
        _remove_partitions(spark, root, keys, same.select(*keys).collect())


def _remove_partitions(spark: SparkSession, root: str, keys: Sequence[str], stale: Sequence) -> None:
    """Remove partition folders; the schema stays."""
    if not stale:
        return
    table = read_table(spark, root)
    anchor = "/".join([root, *(f"{k}={NULL_PARTITION}" for k in keys), "schema"])
    if not exists(spark, anchor):
        data = [f for f in table.schema if f.name not in keys]
        spark.createDataFrame([], T.StructType(data)).coalesce(1).write.mode("overwrite").parquet(anchor)
    system = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for row in stale:
        folder = "/".join([root, *(f"{k}={_escape(row[k])}" for k in keys)])
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)


#: The name Spark gives a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _escape(value) -> str:
    """A partition value as Spark writes it into a path."""
    if value is None or value == "":
        return NULL_PARTITION
    return "".join(f"%{ord(c):02X}" if c in '"#%\'*/:=?\\{[]^' or ord(c) < 32 or c == "\x7f" else c for c in str(value))


def replace_weeks(rows: DataFrame, root: str, base: str, weeks: DataFrame) -> None:
    """Write all rows of the given (project_id, reporting_week); what lay there before goes."""
    ours = weeks.select("project_id", "reporting_week").withColumn("base", F.lit(base_code(base)))
    overwrite_weeks(rows.sparkSession, root, PARTITIONS, ours, lambda: write_long(rows, root, base))


def scan(
    spark: SparkSession,
    root: str,
    project_id: str | None = None,
    base: str | None = None,
    week: str | None = None,
) -> DataFrame:
    """Lake rows of a project, base and week; a missing argument means all."""
    df = read_table(spark, root)
    if project_id:
        df = df.where(F.col("project_id") == project_id)
    if base:
        df = df.where(F.col("base") == base_code(base))
    if week:
        df = df.where(F.col("reporting_week") == F.lit(week).cast("date"))
    return df


def scan_files(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Path, size and time of the files a scan touches."""
    files = df.inputFiles()
    return (
        spark.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
        if files
        else spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    )


def describe(df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "col_name string, data_type string")


def param_sql(
    spark: SparkSession,
    text: str,
    input_path: DataFrame,
    auto_limit: bool = False,
    limit_rows: int = 1000,
    booleans_as_text: bool = False,
    **parameters,
) -> DataFrame:
    """SQL in which `{input_path}` is the table and other `{name}` tokens are bound values.

    An unknown token is an error. The limit is added only to a plain SELECT whose analysed plan
    has none on top.
    """
    pieces, used = [], {}
    for before, token, _, _ in Formatter().parse(text or ""):
        pieces.append(before)
        name = (token or "").strip().lower()
        if name == "input_path":
            pieces.append("{input_path}")
        elif token is not None:
            if name not in parameters:
                raise ValueError(f"no value for the parameter {name!r}")
            used[name] = parameters[name]
            pieces.append(f":{name}")
    sql = "".join(pieces).strip()
    df = spark.sql(sql, args=used, input_path=input_path)
    if auto_limit and sql[:6].lower() == "select" and not _has_limit(df):
        df = df.limit(int(limit_rows))
    if booleans_as_text:
        flags = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
        df = df.withColumns({c: F.col(c).cast("string") for c in flags}) if flags else df
    return df


def _has_limit(df: DataFrame) -> bool:
    plan = df._jdf.queryExecution().analyzed().toString().lstrip()
    return plan.startswith(("GlobalLimit", "LocalLimit", "Offset"))
