"""URL filters: allow and block rules by host and path, looked up by hash prefix.

A rule is written `host/path`. It fits its host and all subdomains of it, if the url's path
starts with the rule's path. Each distinct (host, path) of the urls is expanded into the host
suffixes and path prefixes that could be a rule; the expressions are joined to the rules on
the first hex digits of their SHA-256, and a match counts only if the full digests are equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raterscope.llm.common import free_name, register, table

#: The rules of the registered query.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """After the first :// up to a slash, question mark, hash sign or the end; A-Z in lower case."""
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to a question mark, hash sign or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules as rows: `verdict`, `rule`. The host ends at the first slash of the rule."""
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def digest(host: Column, path: Column) -> Column:
    """SHA-256 of host and path; a zero byte lies between them, so no two pairs read alike."""
    return F.sha2(F.concat(host, F.lit("\0"), path), 256)


def shapes(rules: DataFrame) -> tuple[list[int], list[int]]:
    """The label counts of the rules' hosts and the lengths of their paths.

    Two short lists of numbers: a host has fewer than 128 labels and a path of a rule is
    shorter than 4096 characters, which is checked.
    """
    found = rules.agg(
        F.collect_set(F.size(F.split("_host", "\\."))).alias("labels"),
        F.collect_set(F.length("_path")).alias("lengths"),
    ).first()
    if any(n > 127 for n in found.labels) or any(n > 4095 for n in found.lengths):
        raise ValueError("a rule's host has over 127 labels, or its path over 4095 characters")
    return sorted(found.labels), sorted(found.lengths)


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """`host`, `path`, `rule`, `verdict` for each row of `pages`, beside all its other columns.

    The longest fitting rule wins; of two equally long ones the one with the longer host, then
    block before allow. Urls that no rule fits, null urls and urls without :// get the default
    verdict and a null rule. Repeated rows stay; columns of `pages` with the four names give way.
    Rules may repeat and null rules fit nothing.
    """
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = pages.select(
        *[F.col(f"`{c}`") for c in kept], host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    )
    parts = (
        rules.where(F.col("rule").isNotNull() & F.col("verdict").isNotNull())
        .withColumn("_host", F.substring_index("rule", "/", 1))
        .withColumn("_path", F.expr("substring(rule, length(_host) + 1)"))
    )
    labels, lengths = shapes(parts)
    hashed = (
        parts.withColumn("_digest", digest(F.col("_host"), F.col("_path")))
        .groupBy("_digest", "rule", "_host")
        .agg(F.max("verdict").alias("verdict"))  # block, if both are given
        .withColumn("_prefix", F.substring("_digest", 1, PREFIX_DIGITS))
    )
    n_labels = F.size(F.split("host", "\\."))
    suffixes = F.array_distinct(
        F.array(*[F.when(n_labels >= n, F.substring_index("host", ".", -n)) for n in labels])
    )
    prefixes = F.array(
        *[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]
    )
    expressions = (
        rows.select("host", "path")
        .distinct()
        .withColumn("_suffix", F.explode(F.array_compact(suffixes)))
        .withColumn("_start", F.explode(F.array_compact(prefixes)))
        .withColumn("_found", digest(F.col("_suffix"), F.col("_start")))
        .withColumn("_prefix", F.substring("_found", 1, PREFIX_DIGITS))
    )
    found = free_name(kept, "_best")
    best = (
        expressions.join(hashed, "_prefix")
        .where(F.col("_found") == F.col("_digest"))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length("rule").alias("n"), F.length("_host").alias("m"), "verdict", "rule"
                )
            ).alias(found)
        )
    )
    return rows.join(best, ["host", "path"], "left").select(
        *[F.col(f"`{c}`") for c in kept], "host", "path", F.col(f"{found}.rule").alias("rule"),
        F.coalesce(f"{found}.verdict", F.lit(default)).alias("verdict"),
    )


SQL = """
with p as (
  select page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), r(verdict, rule, rule_host, rule_path) as (values
  ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
  ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')
)
select p.page_id, p.host, p.path,
  arg_max(r.rule, length(r.rule)) as rule,
  coalesce(arg_max(r.verdict, length(r.rule)), 'allow') as verdict
from p left join r
  on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host))
  and starts_with(p.path, r.rule_path)
group by p.page_id, p.host, p.path
"""


@register(SQL)
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rule_table(spark, RULES)).drop("url")
