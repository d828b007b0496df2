"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements and one long
whose bit r is set if the document fails rule r. A policy is a mask of the rules that it
enforces, so applying another version, or asking what a rule alone rejects, needs only bit
operations on the ledger and never the texts again.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raterscope.llm.common import register, table, text_bytes

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_lower", "n_top_word",
]
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
WINDOW = 8

#: Rules in the order of their bits: a rule's name and the condition under which a document fails.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "shouting": "n_upper > n_lower",
    "one_word": "10 * n_top_word > 4 * n_words",
}
BITS = {name: 1 << bit for bit, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of the filter: the rules it enforces."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[name] for name in self.rules)


BASE = Policy(1, ("few_words", "repeated_windows"))
STRICT = Policy(2, tuple(RULES))
POLICIES = [BASE, STRICT]


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that occur twice or more in the text.

    Windows are ranked exactly by doubling: pairs of words, pairs of pairs, pairs of those.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    if len(index) == n:
        return 0
    for step in (1, 2, 4):
        pairs = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        _, ids, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(counts) == len(ids):
            return 0
    starts = np.flatnonzero(counts[ids] > 1)
    edges = np.zeros(n + 1, np.int64)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The MEASURES of one whole text; a null text has none of anything."""
    if text is None:
        return (0,) * len(MEASURES)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    top = max(Counter(words).values(), default=0)
    return (
        len(words),
        len(b"".join(words).decode()),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(text) - len(text.translate(None, UPPER)),
        len(text) - len(text.translate(None, LOWER)),
        top,
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc_id`, MEASURES, and `fail_bits`.

    Null and empty texts measure zero and fail `few_words`. Repeated rows give repeated rows,
    an empty table gives none. Other columns of `docs` are not read, so their names are free.
    """
    fields = [T.StructField(name, T.LongType()) for name in MEASURES]
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([source.schema["doc_id"], *fields])

    def run(batches):
        for batch in batches:
            rows = np.array([measure(t) for t in text_bytes(batch.column(1))], np.int64)
            columns = [pa.array(c) for c in rows.reshape(-1, len(MEASURES)).T]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    bits = sum(
        (F.when(F.expr(test), F.lit(BITS[name])).otherwise(F.lit(0)) for name, test in RULES.items()),
        F.lit(0),
    )
    return source.mapInArrow(run, schema).withColumn("fail_bits", bits.cast("long"))


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with `base_failed` and the policy's verdict `kept`."""
    fails = lambda mask: F.col("fail_bits").bitwiseAND(F.lit(mask)) != 0
    return rows.withColumn("base_failed", fails(BASE.mask)).withColumn(
        "kept", ~fails(policy.mask | BASE.mask)
    )


def ablations(rows: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """For each policy and rule: documents, those failing, failing by it alone, kept without it.

    The ledger is first counted by its bits (at most 2 to the number of rules patterns).
    """
    asked = F.array(
        *[
            F.struct(
                F.lit(p.version).alias("version"), F.lit(p.mask).alias("mask"),
                F.lit(name).alias("rule"), F.lit(BITS[name]).alias("bit"),
            )
            for p in policies
            for name in p.rules
        ]
    )
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    return (
        patterns.select("fail_bits", "n", F.inline(asked))
        .withColumn("failed", failed)
        .groupBy("version", "rule")
        .agg(
            F.sum("n").alias("n_docs"),
            count(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
            count(F.col("failed") == F.col("bit")).alias("n_only_by_it"),
            count(F.col("failed").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"),
        )
    )


#: The measurements by lists and unnested windows; the rules' conditions are the same text in both.
SQL = r"""
with d as (
  select row_number() over () as doc, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), windows as (
  select doc, place, array_to_string(words[place:place + %(last)d], ' ') as phrase
  from (select doc, words, unnest(range(1, len(words) - %(last)d + 1)) as place from d) s
), often as (
  select doc, place from (select *, count(*) over (partition by doc, phrase) as n from windows) s where n > 1
), covered as (
  select doc, count(distinct place + step) as n from often, range(%(window)d) r(step) group by doc
), m as (
  select doc_id, len(words) as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(regexp_replace(text, '[^#*$%%&|<>]', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(covered.n, 0) as n_repeat_words,
    len(lines) as n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper,
    length(regexp_replace(text, '[^a-z]', '', 'g')) as n_lower,
    coalesce(list_max(map_values(list_aggregate(words, 'histogram'))), 0) as n_top_word
  from d left join covered on d.doc = covered.doc
), bits as (
  select *, cast(%(bits)s as bigint) as fail_bits from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed, fail_bits = 0 as kept, fail_bits
from bits
""" % {
    "last": WINDOW - 1,
    "window": WINDOW,
    "bits": " + ".join(f"case when {test} then {BITS[name]} else 0 end" for name, test in RULES.items()),
}


@register(SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")), STRICT)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "fail_bits",
    )
