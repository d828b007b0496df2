"""File manifests: which raw files exist, what they look like, what changed.

All functions work on DataFrames of file facts, so they run the same on a real folder
scan (`scan_folder`) and on a stored listing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raterscope.functions.clean import content_week
from raterscope.operators.skew import join_null_safe
from raterscope.session import stored

# Header signatures of the known layouts, tried in this order.
SIGNATURES = {
    "HALO": ["SRT Annotator ID", "Vendor Auditor ID", "SRT Job ID", "Time (PT)", "Vendor Tag"],
    "GALA": [
        "annotator_id", "auditor_id", "task_id", "task_name", "audit_status", "rubric_answer",
        "QA_score", "original_submission_time",
    ],
    "ADAP": ["_unit_id", "_created_at", "_worker_id", "_tainted", "_channel"],
    "SPOTCHECK": [
        "project_id", "queue", "job_id", "actor_id", "review_date", "label", "ground_truth",
        "is_spotcheck",
    ],
    "UQD": [
        "actor_id", "quality_actor_id", "job_id", "review_ds", "queue_name", "decision_data",
        "quality_decision_data", "extracted_label",
    ],
    "CVS": [
        "sample_ds", "entity_id", "rater_id", "routing_name", "rater_decision_data",
        "auditor_decision_data", "confusion_type", "config",
    ],
    "UQD-LIKE": [
        "actor_id", "decision_data", "decision_id", "job_final_derived_state", "job_id",
        "last_review_ds", "queue_name",
    ],
    "HALO-LIKE": [
        "Annotator ID", "Annotation Date And Time", "Annotation Job ID", "Annotation AHT s",
        "Audit Date And Time", "Is Job Successful?",
    ],
    "MULTI-UNPIVOTED": ["job_id", "reviewer_id", "question", "answer"],
}

#: The name pattern of CSV files in either case, for Spark's file sources.
CSV_GLOB = "*.[cC][sS][vV]"
EXTENSIONS = (".csv", ".xls", ".xlsx")
SKIP_WORD = "notused"
LABEL_LENGTH = 21
HASH_DIGITS = 3


# --- folder scan -----------------------------------------------------------------------


def scan_folder(
    spark: SparkSession,
    root: str | list[str],
    pattern: str | None = None,
    week_format: str | None = None,
) -> DataFrame:
    """path, filename, size_bytes, modified and the keys in the path; contents are not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("modified"),
        )
    )
    return with_path_keys(listed, pattern or PATH_KEYS, week_format or WEEK_FORMAT)


PATH_KEYS = r"/([^/_]+)_[^/]*/WE (\d{4}\.\d{2}\.\d{2})/([^/]+)$"
WEEK_FORMAT = "yyyy.MM.dd"


def with_path_keys(
    files: DataFrame, pattern: str = PATH_KEYS, week_format: str = WEEK_FORMAT
) -> DataFrame:
    """Project id, week and filename from `<project id>_<name>/WE yyyy.MM.dd/<file>`.

    Another folder scheme is given as a pattern with those three groups.
    """
    path = F.replace(F.col("path"), F.lit("%20"), F.lit(" "))

    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))

    return files.withColumns(
        {
            "project_id": part(1),
            "data_week": F.try_to_date(part(2), week_format),
            "filename": F.element_at(F.split(path, "/"), -1),
        }
    )


def header_names(line: Column) -> Column:
    """Trimmed names of a CSV header line; commas inside quotes do not split.

    A quote inside quotes is written twice or after a backslash.
    """
    outside_quotes = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    line = F.replace(F.regexp_replace(line, "^\\x{FEFF}", ""), F.lit('\\"'), F.lit('""'))
    return F.transform(
        F.split(line, outside_quotes),
        lambda c: F.trim(F.replace(F.regexp_replace(F.trim(c), '^"|"$', ""), F.lit('""'), F.lit('"'))),
    )


def eligible(files: DataFrame) -> DataFrame:
    """Files with a known extension, a usable name, some bytes and, if counted, a data row."""
    name = F.lower("filename")
    known = name.endswith(EXTENSIONS[0])
    for extension in EXTENSIONS[1:]:
        known = known | name.endswith(extension)
    keep = known & ~F.contains(name, F.lit(SKIP_WORD)) & (F.col("size_bytes") > 0)
    if "data_rows" in files.columns:
        keep = keep & (F.col("data_rows") >= 1)
    return files.where(keep)


#: What is kept of an opened file, besides what its listing says.
FACTS = ["header_line", "header", "data_rows", "is_utf8", "permissive", "line_rows", "full_rows"]


def file_state(opened: bool = True) -> Column:
    """Why a file is used (`ready`) or not; before files are opened, by name and size only."""
    name = F.lower("filename")
    known = F.lit(False)
    for extension in EXTENSIONS:
        known = known | name.endswith(extension)
    state = (
        F.when(~known, "unknown_type")
        .when(F.contains(name, F.lit(SKIP_WORD)), "not_used")
        .when(F.col("size_bytes") <= 0, "empty")
        .when(~name.endswith(".csv"), "unreadable")
    )
    if opened:
        state = state.when(F.coalesce(F.col("data_rows"), F.lit(0)) < 1, "no_rows")
    return state.otherwise("ready")


def manifest(
    spark: SparkSession,
    root: str | list[str],
    previous: DataFrame | None = None,
    pattern: str | None = None,
    week_format: str | None = None,
) -> DataFrame:
    """All files of a folder tree with fingerprint, `state` and, if ready, layout and header.

    Names and sizes are listed first. With the `previous` manifest, only files of folders whose
    fingerprint changed are opened (`is_opened`); the others keep what was found then.
    """
    from raterscope.sources.raw import file_facts

    listed = scan_folder(spark, root, pattern, week_format)
    listed = stored(with_fingerprint(listed.withColumn("state", file_state(opened=False))), "listing")
    week = ["project_id", "data_week"]
    fresh = listed.where("state = 'ready'")
    known = None
    if previous is not None:
        for fact in ("line_rows", "full_rows"):
            if fact not in previous.columns:  # a manifest from before this fact was kept
                previous = previous.withColumn(fact, F.lit(False))
        same = folder_hashes(listed).join(folder_hashes(previous), [*week, "folder_hash"], "left_semi").select(*week)
        known = join_null_safe(fresh, same, week, "left_semi").join(
            previous.select(*week, "filename", *FACTS), [*week, "filename"], "left"
        )
        fresh = join_null_safe(fresh, same, week, "left_anti")
    paths = [r.path for r in fresh.select("path").collect()]
    opened = fresh.join(file_facts(spark, paths), "path", "left") if paths else None
    parts = [p.withColumn("is_opened", F.lit(flag)) for p, flag in ((opened, True), (known, False)) if p is not None]
    others = listed.where("state <> 'ready'").withColumn("is_opened", F.lit(False))
    found = others
    for part in parts:
        found = found.unionByName(part, allowMissingColumns=True)
    if not parts:
        found = found.withColumns({c: F.lit(None).cast(kind) for c, kind in zip(FACTS, ["string", "array<string>", "bigint", "boolean", "boolean", "boolean", "boolean"], strict=True)})
    found = found.withColumn("state", F.when(F.col("state") == "ready", file_state()).otherwise(F.col("state")))
    return classify(found)


# --- names ------------------------------------------------------------------------------


def name_fits(name: Column, config: dict) -> Column:
    """Whether a name begins with, then contains in order, and ends with the configured texts."""
    parts = config.get("contains") or []
    parts = [parts] if isinstance(parts, str) else list(parts)
    start, end = config.get("begins_with") or "", config.get("ends_with") or ""
    fits = name.startswith(start) & name.endswith(end)
    # each part is looked for after the end of the one before it, in front of the ending
    at = F.lit(len(start) + 1)
    for part in parts:
        found = F.position(F.lit(part), name, at)
        fits, at = fits & (found > 0), found + len(part)
    return fits & (at - 1 + len(end) <= F.length(name))


def match_names(files: DataFrame, config: dict) -> DataFrame:
    hit = name_fits(F.col("filename"), config)
    return files.withColumn("naming_filter", F.when(hit, "match").otherwise("no_match"))


def clean_label(name: Column, length: int = LABEL_LENGTH) -> Column:
    """Alphanumerics of a name, cut or padded with zeros to a fixed length.

    It is the published naming, for display. Names that share their beginning share the label,
    so nothing is keyed or written by it.
    """
    return F.rpad(F.regexp_replace(name, "[^a-zA-Z0-9]", ""), length, "0")


def output_name(project: Column, week: Column, filename: Column, content: Column) -> Column:
    stem = F.regexp_replace(filename, r"\.[^.]*$", "")
    return F.concat(
        project, F.lit("_"), F.date_format(week, "yyyy-MM-dd"), F.lit("_"), clean_label(stem),
        F.lit("_C"), F.date_format(content, "yyyyMMdd"), F.lit(".parquet"),
    )


# --- layouts ----------------------------------------------------------------------------


def classify(files: DataFrame, signatures: dict[str, list[str]] | None = None) -> DataFrame:
    """Add `layout`: the first signature whose columns are all in `header`, else null."""
    chosen = signatures or SIGNATURES
    layout = F.coalesce(
        *[
            F.when(
                F.size(F.array_except(F.array(*[F.lit(c) for c in required]), "header")) == 0,
                F.lit(name),
            )
            for name, required in chosen.items()
        ]
    )
    return files.withColumn("layout", layout)


def dataset_format(layout: Column, declared: Column) -> Column:
    """The declared layout if the header has it, else an `invalid:` tag."""
    return (
        F.when(declared.isNull(), F.lit("invalid:not_declared"))
        .when(layout.eqNullSafe(declared), declared)
        .otherwise(F.concat(F.lit("invalid:"), declared))
    )


# --- fingerprints -----------------------------------------------------------------------


def header_hash(header: Column) -> Column:
    return F.md5(F.trim(F.array_join(F.array_sort(header), "|")))


def file_hash(filename: Column, size: Column, modified: Column | None = None) -> Column:
    """md5 of name and size; `modified` adds the time, so same-size edits show."""
    parts = [filename, size.cast("string")]
    if modified is not None:
        parts.append(modified.cast("string"))
    return F.md5(F.concat(*parts))


def with_fingerprint(files: DataFrame, use_time: bool = False) -> DataFrame:
    modified = F.col("modified") if use_time else None
    return files.withColumn("hash", file_hash(F.col("filename"), F.col("size_bytes"), modified))


def folder_hashes(files: DataFrame, active: Column | None = None) -> DataFrame:
    """One fingerprint per project and week, in two levels.

    The sorted `name:size` entries are hashed in buckets of their own md5, and the bucket
    hashes, at most 16 ** HASH_DIGITS of them, with the folder name and the active flag.
    So no task sorts all names of a folder, and any change of a name, a size or the flag
    changes the fingerprint.
    """
    entry = F.concat("filename", F.lit(":"), F.col("size_bytes").cast("string"))
    flag = F.lit("True") if active is None else active.cast("string")
    folder = F.concat(F.lit("WE "), F.date_format("data_week", "yyyy.MM.dd"))
    keys = ["project_id", "data_week", "_active"]
    buckets = (
        files.select("project_id", "data_week", flag.alias("_active"), entry.alias("_entry"))
        .withColumn("_bucket", F.substring(F.md5("_entry"), 1, HASH_DIGITS))
        .groupBy(*keys, "_bucket")
        .agg(F.md5(F.array_join(F.array_sort(F.collect_list("_entry")), "")).alias("_hash"))
    )
    listed = F.array_sort(F.collect_list(F.concat("_bucket", "_hash")))
    return buckets.groupBy(*keys).agg(F.array_join(listed, "").alias("_all")).select(
        "project_id",
        "data_week",
        F.md5(F.concat(folder, F.col("_active"), F.col("_all"))).alias("folder_hash"),
    )


# --- calendars and completeness -----------------------------------------------------------


def week_calendar(spans: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Fridays from the first to the last week of each span; an open end means today.

    Spans are dealt to all shuffle partitions first: each becomes hundreds of rows, so a task that
    has few bytes of spans may have gigabytes of weeks.
    """
    tasks = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = spans.repartition(tasks)
    first = content_week(F.col(start))
    last = content_week(F.coalesce(F.col(end), F.current_date()))
    weeks = F.sequence(first, last, F.expr("interval 7 days"))
    return spans.where(first <= last).select(*keys, F.explode(weeks).alias("week_ending"))


def required_files(weeks: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """Files a roll-up needs for each (project_id, week_ending): dated three days later."""
    stamp = F.date_format(F.date_add("week_ending", 3), "yyyy-MM-dd")
    per_project = [
        weeks.where(F.col("project_id") == project).withColumn(
            "filename",
            F.explode(F.array(*[F.replace(F.lit(n), F.lit("{date}"), stamp) for n in names])),
        )
        for project, names in templates.items()
    ]
    out = per_project[0]
    for more in per_project[1:]:
        out = out.unionByName(more)
    return out


def missing_files(required: DataFrame, files: DataFrame) -> DataFrame:
    """Per (project, week): how many required files are missing, and whether it is ready."""
    keys = ["project_id", "week_ending", "filename"]
    present = files.select(*keys).distinct().withColumn("_present", F.lit(True))
    return (
        required.join(present, keys, "left")
        .groupBy("project_id", "week_ending")
        .agg(F.count_if(F.col("_present").isNull()).alias("missing_files"))
        .withColumn("is_ready", F.col("missing_files") == 0)
    )


#: Weeks of one project that share a row while a calendar meets a snapshot.
BLOCK_WEEKS = 16


def coverage(weeks: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Per project: calendar weeks, weeks with valid files, files, last week with data.

    The weeks of a calendar are counted in blocks of BLOCK_WEEKS before they meet the snapshot, so
    one row of counts is shuffled in place of a block's weeks. Repeated weeks and repeated snapshot
    rows count as often as in a join of the two.
    """
    block = ["project_id", "_weekday", "_block"]
    blocks = _in_blocks(weeks.select("project_id", "week_ending")).groupBy(*block).agg(
        F.count("*").alias("_weeks"),
        F.array(*[F.count_if(F.col("_place") == i) for i in range(BLOCK_WEEKS)]).alias("_counts"),
    )
    listed = _in_blocks(snapshot.select("project_id", "week_ending", "valid_files_number", F.lit(1).alias("_listed")))
    joined = blocks.join(listed, block, "left").withColumn("_same", F.get("_counts", F.col("_place")))
    filled = F.coalesce(F.col("valid_files_number"), F.lit(0)) > 0
    per_week = joined.groupBy(*block, "_weeks", "week_ending", "_same").agg(
        F.count("_listed").alias("_rows"),
        F.count_if(filled).alias("_filled"),
        F.sum("valid_files_number").alias("_files"),
    )
    same = F.col("_same")
    per_block = per_week.groupBy(*block).agg(
        (F.max("_weeks") + F.coalesce(F.sum(same * (F.col("_rows") - 1)), F.lit(0))).alias("weeks"),
        F.coalesce(F.sum(same * F.col("_filled")), F.lit(0)).alias("weeks_with_data"),
        F.coalesce(F.sum(same * F.col("_files")), F.lit(0)).alias("total_files"),
        F.max(F.when((same > 0) & (F.col("_filled") > 0), F.col("week_ending"))).alias("last_valid_week"),
    )
    return per_block.groupBy("project_id").agg(
        *[F.sum(c).alias(c) for c in ("weeks", "weeks_with_data", "total_files")],
        F.max("last_valid_week").alias("last_valid_week"),
    )


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Weekday, block of weeks and place in the block of each row's `week_ending`."""
    day = F.datediff(F.col("week_ending"), F.lit("1970-01-01").cast("date"))
    week = F.floor(day / 7)
    return rows.withColumns({
        "_weekday": F.pmod(day, F.lit(7)), "_block": F.floor(week / BLOCK_WEEKS),
        "_place": F.pmod(week, F.lit(BLOCK_WEEKS)).cast("int"),
    })
