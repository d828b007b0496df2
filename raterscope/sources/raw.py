"""Raw CSV files read by header name, each with the parse that its own bytes ask for."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raterscope.sources.files import header_names
from raterscope.sources.lake import SUSPICIOUS_HEADER, string_schema, with_positions

CORRUPT = "malformed"
#: A line whose fields are each free of quotes, or quoted as a whole with inner quotes doubled. Loops are
#: possessive, so long lines cost no stack.
FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
WHOLE_LINE = rf"^{FIELD}(?:,{FIELD})*+\z"


def readable(path: str) -> str:
    """A path as readers take it; file metadata gives it with blanks and the like escaped."""
    return unquote(path)


def file_facts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """`path`, `header_line`, `header`, `data_rows`, `is_utf8`, `permissive`, `line_rows`, `full_rows`, in one pass.

    Lines come as the bytes they are, so text that is not UTF-8 shows and its header is read
    as Latin-1. Blank lines are no data rows. Lines end at a line feed; carriage returns
    elsewhere than before it end lines as well. `line_rows` tells that every line is a row of its
    own: all are well formed (`WHOLE_LINE`), so no quotes hold a line break, none is of white
    space only and none has a carriage return inside. `full_rows` tells that each of them has as
    many fields as the header, so that none can be malformed.
    """
    lines = spark.read.option("lineSep", "\n").text([readable(p) for p in paths]).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_pos"),
    )
    first = F.when(F.col("block_start") == 0, F.col("line_pos"))
    # byte by byte: quotes, commas and blanks are the same bytes in both encodings
    bytewise = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    pieces = F.split(bytewise, "\r")
    # most lines have neither carriage returns nor quotes and need no pattern
    returns = bytewise.contains("\r")
    line = F.when(returns, F.regexp_replace(bytewise, r"\r\z", "")).otherwise(bytewise)
    whole = ~line.contains('"') | line.rlike(WHOLE_LINE)
    plain = ~line.contains("\r") & ((line == "") | line.rlike(r"[^\x00-\x20]")) & whole
    rows = F.when(returns, F.size(F.filter(pieces, lambda x: F.trim(x) != ""))).otherwise((F.trim(bytewise) != "").cast("int"))
    start = F.when(returns, pieces[0]).otherwise(bytewise)
    unquoted = F.when(line.contains('"'), F.regexp_replace(line, '"[^"]*+"', "")).otherwise(line)
    commas = F.octet_length(unquoted) - F.octet_length(F.replace(unquoted, F.lit(",")))
    fields = F.when(line != "", commas + 1)
    facts = lines.groupBy("path").agg(
        F.min_by(F.encode(start, "ISO-8859-1"), first).alias("_first"),
        (F.sum(rows) - 1).alias("data_rows"),
        F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"),
        F.bool_and(plain).alias("_plain"),
        F.min(fields).alias("_least"),
        F.max(fields).alias("_most"),
    )
    line = F.when(F.col("is_utf8"), F.decode("_first", "UTF-8")).otherwise(F.decode("_first", "ISO-8859-1"))
    known = facts.withColumn("header_line", line).select(
        "path",
        "header_line",
        header_names(F.col("header_line")).alias("header"),
        "data_rows",
        "is_utf8",
        F.col("header_line").rlike(SUSPICIOUS_HEADER).alias("permissive"),
        (F.col("_plain") & ~F.col("header_line").rlike(SUSPICIOUS_HEADER)).alias("line_rows"),
        "_least",
        "_most",
    )
    as_wide = (F.col("_least") == F.size("header")) & (F.col("_most") == F.size("header"))
    return known.withColumn("full_rows", F.coalesce(F.col("line_rows") & as_wide, F.lit(False))).drop("_least", "_most")


def read_by_header(
    facts: DataFrame, columns: Sequence[str], optional: Sequence[str] = ()
) -> DataFrame:
    """Rows of all files of `facts` with `columns` as strings, blanks as '', and their position.

    Files with the same header, encoding and parse are one scan, which many tasks share out within
    each file whose lines are rows (`line_rows`); others are read by one task a file. Columns are taken by
    name: order and further columns do not matter, an absent optional column is blank. A file
    that lacks another column is an error. Rows that do not fit their header keep their text in
    `malformed`; all others have a null there. The driver sees paths and headers only.
    """
    spark = facts.sparkSession
    groups = facts.groupBy("header", "is_utf8", "permissive", F.coalesce("line_rows", F.lit(False)).alias("line_rows")).agg(F.sort_array(F.collect_list("path")).alias("paths"))
    scans = [_scan(spark, g, columns, optional) for g in groups.collect()]
    if not scans:
        names = [*columns, CORRUPT, "source_file"]
        empty = spark.createDataFrame([], string_schema(names))
        return empty.withColumns({"block_start": F.lit(0).cast("long"), "row_pos": F.lit(0).cast("long")})
    rows = scans[0]
    for more in scans[1:]:
        rows = rows.unionByName(more)
    return rows


def _scan(spark: SparkSession, group, columns: Sequence[str], optional: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in group.header and c not in optional]
    if missing:
        raise ValueError(f"no column {missing} in {group.paths[0]}")
    places = [f"c{i}" for i in range(len(group.header))]
    reader = (
        spark.read.schema(string_schema([*places, CORRUPT]))
        .option("header", True)
        .option("multiLine", not group.line_rows)
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("escape", "\\" if group.permissive else '"')
        .option("encoding", "UTF-8" if group.is_utf8 else "ISO-8859-1")
    )
    rows = with_positions(reader.csv([readable(p) for p in group.paths]))
    taken = [
        F.coalesce(F.col(f"c{group.header.index(c)}"), F.lit("")).alias(c) if c in group.header else F.lit("").alias(c)
        for c in columns
    ]
    # a row read among others keeps the line break after it
    marked = F.regexp_replace(CORRUPT, r"[\r\n]+$", "").alias(CORRUPT)
    return rows.select(*taken, marked, "source_file", "block_start", "row_pos")


def well_formed(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def may_be_malformed(facts: DataFrame) -> DataFrame:
    """The files that are not known to hold well-formed rows only (`full_rows`)."""
    if "full_rows" not in facts.columns:
        return facts
    return facts.where(~F.coalesce(F.col("full_rows"), F.lit(False)))


def malformed_counts(rows: DataFrame) -> DataFrame:
    """Malformed rows of each file that has some."""
    # Spark refuses a query of the marks alone, so the count looks at the texts as well
    texts = [c for c in rows.columns if c not in (CORRUPT, "source_file", "block_start", "row_pos")]
    marked = F.when(F.col(CORRUPT).isNotNull(), F.length(F.concat_ws("", *texts)))
    return rows.groupBy("source_file").agg(F.count(marked).alias("malformed_rows")).where("malformed_rows > 0")
