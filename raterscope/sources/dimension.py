"""Project dimension, rater roster and e-mail map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raterscope.functions.clean import normalize_target
from raterscope.operators.dedupe import keep_last

# Earliest data date, and statuses that hide a project.
DEFAULT_START = "2025-07-01"
HIDDEN_STATUSES = ["Hidden", "Deprecated"]

CONFIG_SCHEMA = T.StructType(
    [
        T.StructField("module", T.StringType()),
        T.StructField("dataset_type", T.StringType()),
        T.StructField(
            "files_filter",
            T.StructType(
                [
                    T.StructField("begins_with", T.StringType()),
                    T.StructField("contains", T.ArrayType(T.StringType())),
                    T.StructField("ends_with", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "module_config",
            T.StructType(
                [
                    T.StructField("quality_methodology", T.StringType()),
                    T.StructField("excluded_labels", T.ArrayType(T.StringType())),
                    T.StructField("label_weights", T.MapType(T.StringType(), T.DoubleType())),
                ]
            ),
        ),
    ]
)


def project_dim(raw: DataFrame, active_only: bool = False) -> DataFrame:
    """The `_`-prefixed columns without prefix; hidden projects are dropped."""
    columns = [F.col(c).alias(c[1:]) for c in raw.columns if c.startswith("_")]
    dim = raw.select(*columns).where(
        ~F.coalesce(F.col("project_status").isin(HIDDEN_STATUSES), F.lit(False))
    )
    return dim.where(F.col("project_status") == "Active") if active_only else dim


def targets(dim: DataFrame) -> DataFrame:
    """project_id and its target as a share."""
    return dim.select("project_id", normalize_target(F.col("project_target")).alias("target"))


def metadata(dim: DataFrame, default_start: str = DEFAULT_START) -> DataFrame:
    """Start date not before the default, end date, target, and the parsed configuration.

    Bad configuration text gives a null struct.
    """
    start = F.try_to_date(F.col("project_start_date").cast("string"), "yyyy-MM-dd")
    default = F.lit(default_start).cast("date")
    added: dict[str, Column] = {
        "project_start_date": F.greatest(F.coalesce(start, default), default),
        "project_end_date": F.try_to_date(F.col("project_end_date").cast("string"), "yyyy-MM-dd"),
        "project_target": normalize_target(F.col("project_target")),
    }
    if "project_config" in dim.columns:
        added["config"] = F.from_json("project_config", CONFIG_SCHEMA)
    return dim.withColumns(added)


# --- roles by column profile ---------------------------------------------------------------

# Name hints and value patterns of the roles.
ID_HINTS = ["srt", "id", "contributor", "rater"]
ID_VALUE = r"^[#']?\d{10,}$"
MARKET_HINTS = ["market"]
MARKET_VALUE = r"(?i)^[a-z]{2}-[a-z]{2}$"
EMAIL_HINTS = ["email", "e-mail", "mail"]
EMAIL_VALUE = r"(?i)^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"

ROSTER_ROLES = {"market": (MARKET_HINTS, MARKET_VALUE), "rater_id": (ID_HINTS, ID_VALUE)}


def column_profile(df: DataFrame, roles: dict[str, tuple[Sequence[str], str]]) -> DataFrame:
    """One row per candidate (role, column): values and how many match the role's pattern.

    All candidates are counted in one pass.
    """
    candidates = [
        (role, i, name, pattern)
        for role, (hints, pattern) in roles.items()
        for i, name in enumerate(df.columns)
        if any(hint in name.lower() for hint in hints)
    ]
    counts = []
    for k, (_, _, name, pattern) in enumerate(candidates):
        value = F.trim(F.col(f"`{name}`").cast("string"))
        counts += [F.count(value).alias(f"n{k}"), F.count_if(value.rlike(pattern)).alias(f"m{k}")]
    rows = [
        F.struct(
            F.lit(role).alias("role"),
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.col(f"n{k}").alias("value_count"),
            F.col(f"m{k}").alias("match_count"),
        )
        for k, (role, i, name, _) in enumerate(candidates)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def infer_role_columns(df: DataFrame, roles: dict[str, tuple[Sequence[str], str]]) -> DataFrame:
    """The first column of each role whose name hints at it and half of whose values match."""
    half = F.floor(F.col("value_count") / 2)
    fitting = column_profile(df, roles).where(F.col("match_count") >= half)
    return fitting.groupBy("role").agg(F.min_by("column_name", "position").alias("column_name"))


def _chosen(df: DataFrame, roles: dict[str, tuple[Sequence[str], str]]) -> dict[str, str]:
    found = {r.role: r.column_name for r in infer_role_columns(df, roles).collect()}
    missing = [role for role in roles if role not in found]
    if missing:
        raise ValueError(f"no column fits {missing}")
    return found


def _bare_id(raw: Column) -> Column:
    return F.regexp_replace(F.trim(raw), "^[#']", "")


def roster_map(df: DataFrame, position: str = "row_pos") -> DataFrame:
    """rater_id -> market of a roster with unknown headers; the last row of a rater wins."""
    names = _chosen(df.drop(position), ROSTER_ROLES)
    pairs = df.select(
        _bare_id(F.col(f"`{names['rater_id']}`")).alias("rater_id"),
        F.col(f"`{names['market']}`").alias("market"),
        position,
    )
    return keep_last(pairs, ["rater_id"], [position]).drop(position)


def email_map(df: DataFrame, position: str = "row_pos") -> DataFrame:
    """email -> rater_id; columns named after mail are tried first, then any other."""
    ids = _chosen(df.drop(position), {"rater_id": (ID_HINTS, ID_VALUE)})
    values = df.drop(position)
    try:
        mail = _chosen(values, {"email": (EMAIL_HINTS, EMAIL_VALUE)})
    except ValueError:
        mail = _chosen(values, {"email": ([""], EMAIL_VALUE)})
    pairs = df.select(
        F.lower(F.trim(F.col(f"`{mail['email']}`"))).alias("email"),
        _bare_id(F.col(f"`{ids['rater_id']}`")).alias("rater_id"),
        position,
    ).where(F.col("email").rlike(EMAIL_VALUE))
    return keep_last(pairs, ["email"], [position]).drop(position)
