"""Cleaning expressions for all-string raw columns. None of them raises under ANSI mode."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Answers that count as yes and as no.
TRUE_TOKENS = ["1", "true", "yes", "y", "t", "agree", "correct"]
FALSE_TOKENS = ["0", "false", "no", "n", "f", "disagree", "incorrect"]

# Fixed value: stands in for a missing auditor where the project allows one.
MISSING_AUDITOR = "999999999999"

EXCEL_EPOCH = "1899-12-30"
DEFAULT_WORKFLOW = "default_workflow"

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


# --- dates and weeks ---------------------------------------------------------------


# Month names, in order; the first three letters stand for each.
MONTHS = [
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december",
]
_MONTH = "((?:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + r"|sept)\b\.?)"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_WEEKDAY = r"^(?i)(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?"
_CLOCK = r"(?:[,\s]+\d{1,2}:\d{2}.*)?$"

#: Spellings of a date: a pattern, and year, month and day taken from its groups.
_NUMERIC = [
    (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[T ].*)?$", "$1-$2-$3"),
    (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?:[T ,].*)?$", "$3-$1-$2"),
    (r"^(\d{1,2})[-/.](\d{1,2})[-/.]([0-5]\d|6[0-8])(?:[T ,].*)?$", "20$3-$1-$2"),
    (r"^(\d{1,2})[-/.](\d{1,2})[-/.](69|[7-9]\d)(?:[T ,].*)?$", "19$3-$1-$2"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
]
_NAMED = [
    (_WEEKDAY + _MONTH + r"[,\s]+" + _DAY + r"[,\s]+(\d{4})" + _CLOCK, "$3-$1-$2"),
    (_WEEKDAY + _DAY + r"[,\s]+" + _MONTH + r"[,\s]+(\d{4})" + _CLOCK, "$3-$2-$1"),
]


def lenient_date(raw: Column) -> Column:
    """Date from the accepted spellings, else null.

    Accepts year-first and month-first numeric dates (day first where the first number
    exceeds 12; years of two digits from 1969 on) with an optional time, compact yyyyMMdd,
    month names in either order with ordinals, and spreadsheet serial numbers. Wrap it in
    `once` where a filter follows.
    """
    text = F.trim(raw)
    year_first = F.translate(text, "/.", "--").try_cast("date")
    # a lambda keeps the other spellings out of the generated code, which is too long to be compiled with them
    other = F.get(F.transform(F.array(text), _other_date), F.lit(0))
    return (
        F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), text.try_cast("date"))
        .when(text.rlike(r"^\d{4}[-/.]\d\d[-/.]\d\d\z"), year_first)
        .otherwise(other)
    )


def _other_date(text: Column) -> Column:
    """Date of a trimmed text in any accepted spelling."""

    def spelled(spellings) -> Column:
        """The parts in the order year-month-day, of the first pattern that fits."""
        return F.coalesce(
            *[F.when(text.rlike(p), F.regexp_replace(text, p, parts)) for p, parts in spellings]
        )

    parts = F.split(spelled(_NAMED), "-")
    short = F.lower(F.substring(F.get(parts, F.lit(1)), 1, 3))
    place = F.instr(F.lit("".join(m[:3] for m in MONTHS)), short)
    number_of = ((place + 2) / 3).cast("int").cast("string")
    named = F.concat_ws("-", F.get(parts, F.lit(0)), number_of, F.get(parts, F.lit(2)))
    candidate = F.when(text.rlike("[A-Za-z]{3}") & ~text.rlike(r"^\d{4}"), named).otherwise(spelled(_NUMERIC))
    day_first = F.regexp_replace(candidate, r"^(\d{4})-(\d+)-(\d+)$", "$1-$3-$2")
    serial = F.floor(text.try_cast("double")).cast("int")
    return (
        F.when(text.rlike(r"^\d{5}(\.\d+)?$"), F.date_add(F.lit(EXCEL_EPOCH).cast("date"), serial))
        .otherwise(
            F.coalesce(
                F.try_to_date(candidate, "yyyy-M-d"),
                # only dates that start with month or day may be turned
                F.when(text.rlike(r"^\d{1,2}[-/.]"), F.try_to_date(day_first, "yyyy-M-d")),
            )
        )
    )


def content_week(day: Column) -> Column:
    """The Friday on or after the day."""
    return F.next_day(F.date_sub(day, 1), "Friday")


def distinct_content_weeks(df: DataFrame, column: str) -> DataFrame:
    weeks = df.select(content_week(F.col(column)).alias("content_week"))
    return weeks.where(F.col("content_week").isNotNull()).distinct().orderBy("content_week")


# --- ids and numbers ---------------------------------------------------------------


def valid_id(raw: Column, strip_apostrophes: bool = False) -> Column:
    """The trimmed id if it is all digits and longer than ten, else null."""
    text = F.btrim(raw, F.lit("'")) if strip_apostrophes else raw
    text = F.trim(text)
    return F.when(text.rlike(r"^[0-9]{11,}$"), text)


def auditor_or_placeholder(auditor: Column) -> Column:
    return F.coalesce(auditor, F.lit(MISSING_AUDITOR))


def number(raw: Column) -> Column:
    """Double from plain or exponent notation, else null."""
    text = F.trim(raw)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def percent_score(raw: Column) -> Column:
    return number(raw) / 100


def normalize_target(raw: Column) -> Column:
    """`85%`, `0.85` and `85` all give 0.85."""
    text = F.trim(raw.cast("string"))
    value = number(text)
    return F.when(text.endswith("%"), number(F.regexp_replace(text, "%", "")) / 100).otherwise(
        F.when(value > 1, value / 100).otherwise(value)
    )


def normalize_penalty(raw: Column) -> Column:
    """Penalty as a share: percent sign dropped, comma decimals read, >= 1 divided by 100."""
    value = number(F.regexp_replace(F.regexp_replace(raw.cast("string"), r"%+\s*$", ""), ",", "."))
    return F.when(value >= 1, value / 100).otherwise(value)


def boolish(raw: Column) -> Column:
    """Three-valued reading of free text: yes/no words, numbers (non-zero is true)."""
    text = F.lower(F.trim(raw))
    value = number(F.regexp_replace(text, ",", "."))
    return (
        F.when(value.isNotNull(), value != 0)
        .when(text.isin(TRUE_TOKENS), True)
        .when(text.isin(FALSE_TOKENS), False)
    )


# --- text ----------------------------------------------------------------------------


def clean_text(raw: Column) -> Column:
    """One-line text: breaks to spaces, marks and control characters dropped, unquoted."""
    text = F.coalesce(raw, F.lit(""))
    text = F.regexp_replace(text, "\\r\\n|[\\r\\n\\x{2028}\\x{2029}]", " ")
    text = F.regexp_replace(text, "[\\x{200E}\\x{200F}\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]", "")
    text = F.trim(F.regexp_replace(text, "[ \\t\\x{00A0}]+", " "))
    quoted = (F.length(text) >= 2) & text.rlike("^(\".*\"|'.*')$")
    return F.when(quoted, F.trim(text.substr(F.lit(2), F.length(text) - 2))).otherwise(text)


def sanitize_text(raw: Column) -> Column:
    """Keep line breaks (as LF) and tabs, drop other control characters."""
    text = F.regexp_replace(F.coalesce(raw, F.lit("")), "\\r\\n?", "\n")
    return F.regexp_replace(text, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]", "")


def slug(raw: Column) -> Column:
    text = F.translate(F.lower(F.trim(raw)), "/- ", "___")
    text = F.regexp_replace(F.regexp_replace(text, "[^a-z0-9_]+", ""), "_+", "_")
    return F.btrim(text, F.lit("_"))


def token_upper(raw: Column, n: int, upper: bool = True) -> Column:
    """The nth `_`-separated token, null past the end."""
    token = F.get(F.split(raw, "_"), F.lit(n))
    return F.upper(token) if upper else token


def contains_ignore_case(raw: Column, word: str) -> Column:
    return F.coalesce(F.contains(F.lower(raw), F.lit(word.lower())), F.lit(False))


def code_map(raw: Column, mapping: dict[str, str]) -> Column:
    """Display value of a code; other values pass unchanged."""
    literals = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*literals), raw), raw)


# --- row steps -------------------------------------------------------------------------


def strip_header(df: DataFrame, lower: bool = False) -> DataFrame:
    names = [c.strip() for c in df.columns]
    return df.toDF(*[n.lower() if lower else n for n in names])


def preprocess(df: DataFrame, config: dict) -> DataFrame:
    """Configured renames, then literal replacements, then pattern replacements."""
    for item in config.get("rename_columns", []):
        if item.get("from") in df.columns and item.get("to"):
            df = df.withColumnRenamed(item["from"], item["to"])
    for item in config.get("replace_strings", []):
        if item.get("find"):
            find, put = F.lit(item["find"]), F.lit(item.get("replace", ""))
            df = _over_columns(df, item, lambda c: F.replace(c, find, put))
    for item in config.get("replace_regex", []):
        if item.get("pattern"):
            pattern, put = item["pattern"], _java_replacement(item.get("replace", ""))
            df = _over_columns(df, item, lambda c: F.regexp_replace(c, pattern, put))
    return df


def _over_columns(df: DataFrame, item: dict, change) -> DataFrame:
    names = [c for c in item.get("columns", []) if c in df.columns]
    return df.withColumns({c: change(F.col(f"`{c}`")) for c in names}) if names else df


def _java_replacement(text: str) -> str:
    """Group references `\\1` and `\\g<1>` become `$1`; a plain dollar is escaped."""
    text = text.replace("$", r"\$")
    return re.sub(r"\\g<(\w+)>|\\(\d+)", lambda m: f"${m.group(1) or m.group(2)}", text)


def map_columns(
    df: DataFrame, rules: dict[str, dict], info: dict[str, str] | None = None
) -> DataFrame:
    """Rename columns to roles: the configured name, else the first fallback present.

    A missing required role is an error; a missing workflow becomes a constant.
    """
    info = info or {}
    renames: dict[str, str] = {}
    for role, rule in rules.items():
        names = [info.get(rule["config_key"]), *rule["fallbacks"]]
        found = next((n for n in names if n and n in df.columns), None)
        if found:
            renames[found] = role
        elif rule["required"]:
            raise ValueError(f"no column for {role}: tried {[n for n in names if n]}")
        elif role == "workflow":
            df = df.withColumn("workflow", F.lit(DEFAULT_WORKFLOW))
    return df.withColumnsRenamed(renames)


def exclude_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Drop listed values; null stays."""
    return df.where(~F.coalesce(F.col(column).isin(list(values)), F.lit(False))) if values else df


def audited_by(df: DataFrame, organization: str, token: str) -> DataFrame:
    """Rows whose auditor organisation contains the token and whose auditor is not the rater."""
    inside = F.coalesce(F.contains(F.col(organization), F.lit(token)), F.lit(False))
    return df.where(inside & ~F.col("auditor_id").eqNullSafe(F.col("rater_id")))


def outcome_flag(raw: Column, positive: str, case_sensitive: bool = True) -> Column:
    """Whether the trimmed status is the positive one; null when blank."""
    text = F.trim(raw)
    hit = text == positive if case_sensitive else F.lower(text) == positive.lower()
    return F.when(F.coalesce(text, F.lit("")) != "", hit)


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns that are computed once per row.

    Filters and further columns use the made values: Catalyst does not copy the expressions
    out of a generator, as it copies those of a projection into the filters above it.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*rest, F.inline(F.array(made)))


# --- reject accounting -----------------------------------------------------------------


def tag_rejects(df: DataFrame, checks: Iterable[tuple[str, Column]]) -> DataFrame:
    """Add `reject_reason`: the first check that holds, null for accepted rows."""
    reason = F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in checks])
    return df.withColumn("reject_reason", reason)


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")


def reject_stats(tagged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per reject reason; accepted rows are counted under `accepted`."""
    reason = F.coalesce(F.col("reject_reason"), F.lit("accepted")).alias("reject_reason")
    return tagged.groupBy(*keys, reason).agg(F.count("*").alias("row_count"))
