"""One run over all projects, whatever their layouts: lake, rejects, reports, roll-ups, catalogues.

Files are grouped by what decides how they are read: the module and configuration of their
project, and their header. Each group is read once, tagged and normalised as one table; a
group that cannot be read marks its own files as failed, with the reason, and all others go
on. There are as many groups as kinds of files, not as many as files.

Everything that is kept is kept by project and week, and only the touched weeks are written:
long rows, reject counts, reports, contributor rows, and the distinct labels of a week, from
which catalogues are read. A rerun after a failure replaces the same partitions.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raterscope.functions import clean
from raterscope.operators.skew import attach, join_null_safe
from raterscope.plans import daily, layouts, rollups
from raterscope.session import stored
from raterscope.sources import files, lake, ledger, raw
from raterscope.streaming.incremental import WEEK, raw_rows, write_report

BASES = ("A", "M", "H")
FOLDER = ["project_id", "data_week"]
#: Columns that reading adds; a raw column of such a name is not read.
OWN_COLUMNS = {"project_id", "reporting_week", "data_week", "path", "filename", "source_file", "block_start", "row_pos", raw.CORRUPT}


@dataclass(frozen=True)
class Project:
    """What the run needs to know of a project; `config` has its module and module_config."""

    project_id: str
    base: str
    config: Mapping = field(default_factory=dict)
    layout: str | None = None
    naming: Mapping = field(default_factory=dict)
    roster: DataFrame | None = None
    emails: DataFrame | None = None

    def group_key(self) -> tuple:
        """Projects of the same key are read and normalised together."""
        module = self.config.get("module")
        own = self.project_id if module == "ADHOC" else None
        text = json.dumps(self.config, sort_keys=True, default=str)
        return lake.base_code(self.base), text, own, id(self.roster), id(self.emails)


def projects_from(dim: DataFrame) -> list[Project]:
    """Projects of the dimension (see `dimension.project_dim`); broken configuration text names no module."""
    out = []
    for r in dim.select("project_id", "project_base", "project_config").distinct().collect():  # a row per project
        try:
            config = json.loads(r.project_config or "{}")
        except ValueError:
            config = {}
        config = config if isinstance(config, dict) else {}
        out.append(Project(r.project_id, r.project_base or "", config, config.get("dataset_type"), config.get("files_filter") or {}))
    return out


@dataclass(frozen=True)
class Market:
    """A project whose reports come from market exports, once all files of a week are there.

    `overview` and `raters` give the label family of each required file by its name template.
    """

    project_id: str
    overview: Mapping[str, str]
    raters: Mapping[str, str]
    config: rollups.MarketConfig
    base: str = "audit"


# --- which files, which weeks ------------------------------------------------------------------


def declared_files(found: DataFrame, projects: Sequence[Project]) -> DataFrame:
    """`naming_filter` and `dataset_format` of each file by its own project's settings.

    The settings are a row per project and are joined as rows, so they may be many.
    """
    spark = found.sparkSession
    rows = []
    for p in projects:
        parts = p.naming.get("contains") or []
        parts = [parts] if isinstance(parts, str) else list(parts)
        rows.append((p.project_id, p.layout, p.naming.get("begins_with") or "", parts, p.naming.get("ends_with") or ""))
    schema = "project_id string, _declared string, _start string, _parts array<string>, _end string"
    joined = attach(found, spark.createDataFrame(rows, schema), ["project_id"])
    known = F.col("_start").isNotNull()
    layout = F.when(F.col("_declared").isNull(), F.lit("any")).otherwise(files.dataset_format(F.col("layout"), F.col("_declared")))
    kind = F.when(F.col("state") != "ready", F.concat(F.lit("invalid:"), F.col("state"))).when(~known, "invalid:unknown_project").otherwise(layout)
    fits = F.coalesce(name_fits_columns(F.col("filename"), F.col("_start"), F.col("_parts"), F.col("_end")), F.lit(False))
    return joined.withColumns(
        {"naming_filter": F.when(fits | ~known, "match").otherwise("no_match"), "dataset_format": kind}
    ).drop("_declared", "_start", "_parts", "_end")


def name_fits_columns(name: Column, start: Column, parts: Column, end: Column) -> Column:
    """`files.name_fits` with its settings in columns; zero stands for a part that was not found."""

    def after(at: Column, part: Column) -> Column:
        found = F.position(part, name, at)
        return F.when((at > 0) & (found > 0), found + F.length(part)).otherwise(F.lit(0))

    at = F.aggregate(parts, F.length(start) + 1, after)
    return F.startswith(name, start) & F.endswith(name, end) & (at > 0) & (at - 1 + F.length(end) <= F.length(name))


def touched_folders(found: DataFrame, before: DataFrame | None, again: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """`project_id`, `data_week` of folders that differ from the last snapshot, and all folder hashes.

    Files whose folders name no project or week are one folder with null keys.
    """
    hashes = stored(files.folder_hashes(found), "folders")
    old = files.folder_hashes(before) if before is not None else hashes.limit(0)
    sides = hashes.withColumn("_side", F.lit(1)).unionByName(old.withColumn("_side", F.lit(2)))
    differ = sides.groupBy(*FOLDER, "folder_hash").agg(F.count_distinct("_side").alias("n")).where("n = 1")
    weeks = differ.select(*FOLDER)
    if again is not None:
        weeks = weeks.unionByName(again.select(*FOLDER))
    return stored(weeks.distinct(), "touched"), hashes


# --- groups of files ---------------------------------------------------------------------------


@dataclass
class Group:
    """Files that are read alike."""

    number: int
    projects: list[Project]
    header: list[str]

    @property
    def code(self) -> str:
        return lake.base_code(self.projects[0].base)


def groups_of(usable: DataFrame, projects: Sequence[Project]) -> tuple[DataFrame, list[Group]]:
    """The files with their `group_number`, and the groups: one per configuration and header."""
    spark = usable.sparkSession
    keys: dict[tuple, list[Project]] = {}
    for p in projects:
        keys.setdefault(p.group_key(), []).append(p)
    members = list(keys.values())
    numbers = [(p.project_id, i) for i, own in enumerate(members) for p in own]
    numbered = attach(usable, spark.createDataFrame(numbers, "project_id string, _key int"), ["project_id"], "inner")
    numbered = stored(numbered.withColumn("_header", F.to_json("header")), "numbered")
    kinds = [(r[0], r[1]) for r in numbered.select("_key", "_header").distinct().orderBy("_key", "_header").collect()]
    groups = [Group(i, members[key], json.loads(header)) for i, (key, header) in enumerate(kinds)]
    table = spark.createDataFrame([(i, k, h) for i, (k, h) in enumerate(kinds)], "group_number int, _key int, _header string")
    return attach(numbered, table, ["_key", "_header"], "inner").drop("_key", "_header"), groups


def normalize_group(group: Group, facts: DataFrame, pattern: str, week_format: str) -> tuple[DataFrame, DataFrame]:
    """Stored long rows of a group's files, and their reject counts.

    The files are parsed once, into a stored table. Tagged rows are stored as well: the long
    rows and the counts both come from them.
    """
    first = group.projects[0]
    config = first.config.get("module_config") or {}
    tag, finish = layouts.find_steps(first.config.get("module"), first.project_id)
    columns = [c for c in dict.fromkeys(group.header) if c and c not in OWN_COLUMNS]
    rows = stored(raw_rows(facts, columns, (), pattern, week_format), "raw-rows")
    good = clean.preprocess(raw.well_formed(rows), config)
    if first.emails is not None:
        good = layouts.map_emails(good, first.emails)
    tagged = stored(tag(good, config), "tagged-rows")
    long = finish(tagged, config)
    if first.roster is not None:
        long = layouts.workflow_from_roster(long, first.roster)
    long = stored(long.withColumn("content_week", clean.content_week(F.col("job_date"))), "long-rows")
    keys = [*WEEK, "source_file"]
    # the count of marks looks at a text as well: a query of the marks alone is refused by some readers
    broken = rows.where(F.col(raw.CORRUPT).isNotNull()).groupBy(*keys).agg(F.count("*").alias("row_count"))
    counts = clean.reject_stats(tagged, keys).unionByName(broken.withColumn("reject_reason", F.lit("malformed_row")))
    return long, counts


def normalize_groups(
    numbered: DataFrame, groups: list[Group], pattern: str, week_format: str
) -> tuple[dict[str, DataFrame], DataFrame | None, dict[int, str]]:
    """Long rows by base, reject counts, and the reason of each group that failed."""
    long: dict[str, DataFrame] = {}
    counts = None
    failed: dict[int, str] = {}
    for group in groups:
        facts = numbered.where(F.col("group_number") == group.number)
        try:
            if group.code not in BASES:
                raise ValueError(f"unknown base {group.projects[0].base!r}")
            rows, stats = normalize_group(group, facts, pattern, week_format)
        except Exception as error:  # whatever a file or a configuration does, other groups go on
            failed[group.number] = f"{type(error).__name__}: {error}".splitlines()[0][:500]
            continue
        known = long.get(group.code)
        long[group.code] = rows if known is None else known.unionByName(rows, allowMissingColumns=True)
        counts = stats if counts is None else counts.unionByName(stats)
    return long, counts, failed


# --- what is kept by week ------------------------------------------------------------------------


def file_outcomes(numbered: DataFrame, long: Mapping[str, DataFrame], failed: Mapping[int, str]) -> DataFrame:
    """Each file's end state: rows, content weeks and names of its output, or the reason it failed."""
    spark = numbered.sparkSession
    reasons = spark.createDataFrame(list(failed.items()), "group_number int, reason string")
    out = attach(numbered, reasons, ["group_number"])
    made = None
    for rows in long.values():
        part = rows.groupBy("source_file", "content_week").agg(F.count("*").alias("n"))
        made = part if made is None else made.unionByName(part)
    if made is None:
        made = spark.createDataFrame([], "source_file string, content_week date, n long")
    weeks = made.groupBy(F.col("source_file").alias("path")).agg(
        F.sum("n").alias("row_count"), F.sort_array(F.collect_list("content_week")).alias("content_weeks")
    )
    out = out.join(weeks, "path", "left")
    week = F.col("data_week")
    names = F.transform("content_weeks", lambda w: files.output_name(F.col("project_id"), week, F.col("filename"), w))
    status = F.when(F.col("reason").isNull(), "transformed").otherwise("failed")
    return out.select(
        item_id().alias("item_id"), "project_id", "hash", status.alias("status"), "reason",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("content_weeks", F.array().cast("array<date>")).alias("content_weeks"),
        F.coalesce(names, F.array().cast("array<string>")).alias("output_names"),
    )


def item_id() -> Column:
    return F.concat_ws("/", "project_id", F.col("data_week").cast("string"), "filename")


def update_contributors(spark: SparkSession, out: str, codes: Sequence[str], projects: DataFrame, weeks: DataFrame) -> None:
    """Replace the contributor rows of the touched weeks; a project's segments are one table row set.

    Reads the rater reports of those weeks only. `weeks` has `project_id` and `week_ending`.
    """
    ours = weeks.select("week_ending", rollups.project_main(F.col("project_id")).alias("project_id")).distinct()
    ours = stored(ours, "contributor-weeks")
    known = None
    for code in codes:
        root = f"{out}/{code}_rater_label_summary"
        if lake.exists(spark, root):
            report = lake.read_table(spark, root).withColumn("_main", rollups.project_main(F.col("project_id")))
            report = attach(report, ours.withColumnRenamed("project_id", "_main"), ["week_ending", "_main"], "left_semi").drop("_main")
            known = report if known is None else known.unionByName(report, allowMissingColumns=True)
    if known is not None:
        write_report(rollups.contributor_rollup(known, projects), out, "contributors", ours)


def contributors(spark: SparkSession, out: str, week: str | None = None) -> DataFrame:
    """The kept contributor table, whole or of one week."""
    rows = lake.read_table(spark, f"{out}/contributors")
    return rows.where(F.col("week_ending") == F.lit(week).cast("date")) if week else rows


CATALOGUES = {"workflow": "workflow", "label": "label"}


def update_catalogues(out: str, long: Mapping[str, DataFrame], weeks: DataFrame) -> None:
    """Replace the distinct workflows and labels of the touched weeks.

    A week that lost its rows takes out what only it had. `weeks` has `project_id`, `week_ending`.
    """
    spark = weeks.sparkSession
    for name in CATALOGUES:
        parts = []
        for rows in long.values():
            source = name if name == "workflow" else "rubric" if "rubric" in rows.columns else "parent_label"
            parts.append(rows.select("project_id", F.col("reporting_week").alias("week_ending"), F.col(source).alias(name)))
        found = spark.createDataFrame([], f"project_id string, week_ending date, {name} string")
        for part in parts:
            found = found.unionByName(part.distinct())
        write_report(found.distinct(), out, f"catalog_{name}", weeks)


def catalogue(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Entries of the `workflow` or `label` catalogue with the first and last week they were seen in."""
    kept = lake.read_table(spark, f"{out}/catalog_{name}")
    return kept.groupBy("project_id", name).agg(F.min("week_ending").alias("first_week"), F.max("week_ending").alias("last_week"))


# --- market roll-ups ---------------------------------------------------------------------------

MARKET_COUNTS = ["total_count", "tp_count", "fp_count", "tn_count", "fn_count"]
MARKET_COLUMNS = {
    "overview": ["sample_ds", "routing_name", "label_category_name", *rollups.RATES],
    "raters": ["sample_ds", "rater_id", "routing_name", *MARKET_COUNTS, *rollups.RATES],
}


def market_readiness(found: DataFrame, markets: Sequence[Market], weeks: DataFrame) -> DataFrame:
    """`project_id`, `week_ending`, `missing_files`, `is_ready` of the touched weeks of market projects."""
    templates = {m.project_id: [*m.overview, *m.raters] for m in markets}
    required = files.required_files(weeks.select("project_id", F.col("data_week").alias("week_ending")), templates)
    there = found.where("state = 'ready'").withColumnRenamed("data_week", "week_ending")
    return files.missing_files(required, there)


def market_rows(facts: DataFrame, families: Mapping[str, str], kind: str, week: str, pattern: str, week_format: str) -> DataFrame:
    """Typed rows of one kind of market file of a week, with the label family of each file."""
    stamp = F.date_format(F.date_add(F.lit(week).cast("date"), 3), "yyyy-MM-dd")
    family = F.coalesce(*[
        F.when(F.col("filename") == F.replace(F.lit(name), F.lit("{date}"), stamp), F.lit(label)) for name, label in families.items()
    ])
    named = facts.withColumn("main_label", family).where(F.col("main_label").isNotNull())
    rows = raw.well_formed(raw_rows(named, MARKET_COLUMNS[kind], (), pattern, week_format))
    rows = attach(rows, named.select(F.col("path").alias("source_file"), "main_label"), ["source_file"], "inner")
    numbers = {c: F.expr(f"try_cast(`{c}` as double)") for c in rollups.RATES}
    if kind == "raters":
        numbers |= {c: F.expr(f"try_cast(`{c}` as bigint)") for c in MARKET_COUNTS}
    return rows.withColumns(numbers)


def run_markets(
    found: DataFrame, markets: Sequence[Market], weeks: DataFrame, out: str, pattern: str, week_format: str
) -> DataFrame | None:
    """Replace the reports of market weeks whose files are complete; others stay as they are.

    The readiness of the touched weeks is kept in `<out>/market_readiness`. Each complete week is
    one plan, as its last sample date is its own; all weeks of a market are written at once.
    Returns the replaced weeks.
    """
    if not markets:
        return None
    spark = found.sparkSession
    ours = weeks.where(F.col("project_id").isin([m.project_id for m in markets]) & F.col("data_week").isNotNull())
    readiness = stored(market_readiness(found, markets, ours), "readiness")
    write_report(readiness, out, "market_readiness", ours.withColumnRenamed("data_week", "week_ending"))
    ready = readiness.where("is_ready").select("project_id", F.col("week_ending").cast("string").alias("week"))
    by_project: dict[str, list[str]] = {}
    for r in ready.orderBy("project_id", "week").collect():  # touched weeks of the market projects
        by_project.setdefault(r.project_id, []).append(r.week)
    replaced = None
    for market in markets:
        tables: dict[str, DataFrame] = {}
        for week in by_project.get(market.project_id, []):
            own = found.where((F.col("project_id") == market.project_id) & (F.col("data_week") == F.lit(week).cast("date")) & (F.col("state") == "ready"))
            sides = [market_rows(own, getattr(market, kind), kind, week, pattern, week_format) for kind in ("overview", "raters")]
            config = rollups.MarketConfig(**{**market.config.__dict__, "project_id": market.project_id, "week_ending": week})
            single = len({*market.overview.values(), *market.raters.values()}) == 1
            made = (rollups.single_family_rollup if single else rollups.market_rollup)(*sides, config)
            for name, report in (("workflow_summary", "dashboard_workflow"), ("rater_label_summary", "dashboard_rater")):
                tables[name] = made[report] if name not in tables else tables[name].unionByName(made[report])
        if not tables:
            continue
        done = spark.createDataFrame([(market.project_id, w) for w in by_project[market.project_id]], "project_id string, week string")
        done = done.select("project_id", F.col("week").cast("date").alias("week_ending"))
        for name, table in tables.items():
            write_report(table, out, f"{lake.base_code(market.base)}_{name}", done)
        replaced = done if replaced is None else replaced.unionByName(done)
    return replaced


# --- the run ---------------------------------------------------------------------------------------


def sync(
    spark: SparkSession,
    raw_root: str,
    state: str,
    lake_root: str,
    out: str,
    projects: Sequence[Project],
    targets: DataFrame,
    dim: DataFrame | None = None,
    markets: Sequence[Market] = (),
    again: DataFrame | None = None,
    pattern: str = files.PATH_KEYS,
    week_format: str = files.WEEK_FORMAT,
) -> bool:
    """Bring lake, rejects, reports, roll-ups and catalogues up to date; whether anything changed.

    A week whose folder differs from the last snapshot, or that `again` (project_id, data_week)
    names, is loaded anew from all its current files. Lakes lie under `<lake_root>/<base>`. Every
    file of such a week gets its events: enqueued, then transformed (with rows, content weeks
    and output names) and synced, or failed with a reason; a file that is gone is removed. Files of unknown projects, and files
    whose folders name no project or week, fail as well. `dim` (project_id, project_name,
    project_metric, target) adds the contributor table. The snapshot is appended last, so a run
    that is ended is done over.
    """
    number = ledger.last_snapshot_id(spark, state)
    before = None if number is None else ledger.read_snapshot(spark, state, number, "files")
    found = files.manifest(spark, raw_root, before, pattern, week_format)
    found = stored(declared_files(found, projects), "manifest")
    folders, hashes = touched_folders(found, before, again)
    if not folders.limit(1).count():
        return False
    market_ids = [m.project_id for m in markets]
    in_touched = join_null_safe(found, folders, FOLDER, "left_semi")
    ordinary = in_touched.where(~F.coalesce(F.col("project_id").isin(market_ids), F.lit(False)) & (F.col("state") == "ready"))
    weeks = folders.where("project_id is not null and data_week is not null")
    weeks = weeks.where(~F.col("project_id").isin(market_ids)).withColumnRenamed("data_week", "reporting_week")
    ending = weeks.withColumnRenamed("reporting_week", "week_ending")

    homeless = F.col("project_id").isNull() | F.col("data_week").isNull()
    usable = stored(ordinary.where(ledger.is_valid_file() & ~homeless), "usable")
    stray = ordinary.where(homeless | (F.col("dataset_format") == "invalid:unknown_project"))
    first = (number or 0) * 10

    def log(rows: DataFrame, step: int) -> None:
        ledger.append_events(rows.withColumn("seq", F.lit(first + step)), f"{state}/events")

    blank = {
        "reason": F.lit(None).cast("string"), "row_count": F.lit(0).cast("long"),
        "content_weeks": F.array().cast("array<date>"), "output_names": F.array().cast("array<string>"),
    }
    listed = usable.select(item_id().alias("item_id"), "project_id", "hash", F.lit("enqueued").alias("status"), *[c.alias(n) for n, c in blank.items()])
    log(listed, 1)
    numbered, groups = groups_of(usable, projects)
    numbered = stored(numbered, "groups")
    long, counts, failed = normalize_groups(numbered, groups, pattern, week_format)
    for code in BASES:
        root = f"{lake_root}/{code}"
        if code in long:
            lake.replace_weeks(long[code], root, code, weeks)
        elif lake.exists(spark, root):
            lake.clear_partitions(spark, root, lake.PARTITIONS, weeks.withColumn("base", F.lit(code)), lake.read_table(spark, root).limit(0))
    ends = stored(file_outcomes(numbered, long, failed), "outcomes")
    reason = F.when(homeless, "no project or week in the path").otherwise("unknown project")
    lost = stray.select(item_id().alias("item_id"), "project_id", "hash", F.lit("failed").alias("status"), *[
        (reason if n == "reason" else c).alias(n) for n, c in blank.items()])
    ends_of = ends.unionByName(lost)
    if before is not None:
        had = join_null_safe(before.where("state = 'ready'"), folders, FOLDER, "left_semi")
        gone = join_null_safe(had, found, [*FOLDER, "filename"], "left_anti")
        ends_of = ends_of.unionByName(gone.select(item_id().alias("item_id"), "project_id", "hash", F.lit("removed").alias("status"), *[c.alias(n) for n, c in blank.items()]))
    log(ends_of, 2)

    if counts is None:
        counts = spark.createDataFrame([], "project_id string, reporting_week date, source_file string, reject_reason string, row_count long")
    write_report(counts.withColumnRenamed("reporting_week", "week_ending"), out, "rejects", ending)
    codes = [c for c in BASES if lake.exists(spark, f"{lake_root}/{c}")]
    for code in codes:
        daily.rebuild_reports(spark, lake.scan(spark, f"{lake_root}/{code}", base=code), code, targets, out, weeks)
    update_catalogues(out, long, ending)
    replaced = run_markets(found, markets, folders, out, pattern, week_format)
    if dim is not None:
        every = ending if replaced is None else ending.unionByName(replaced)
        codes = sorted({*codes, *(lake.base_code(m.base) for m in markets)} & {"A", "M"})
        update_contributors(spark, out, codes, dim, every)
    log(ends.where("status = 'transformed'").withColumn("status", F.lit("synced")), 3)
    snapshot = ledger.week_rows(found, hashes)
    ledger.append_snapshot(spark, state, snapshot, found.drop("is_opened"))
    return True
