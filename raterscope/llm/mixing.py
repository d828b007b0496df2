"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a budget of words. A source whose budget holds its whole size e times gives
e complete epochs; the rest is filled by weighted sampling without replacement: every
document gets an exponential key divided by its quality weight, and the documents with the
smallest keys are taken until the prefix sum of their sizes reaches the rest.

No source is sorted as a whole. Sizes are summed by (source, key bucket), two levels of
prefix sums over at most 256 buckets find the one in which the budget ends, and only its
documents are sorted. The result is one cutoff per source, which all rows are compared to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from raterscope.llm.common import WORD, register, table
from raterscope.session import stored

CYCLE = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
LEVEL = 256
LEAST_POWER = 15  # weights down to 2^-15 are spread over the buckets
SLICES = 64


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_quality(text: Column) -> Column:
    """A weight in [0.05, 1]: the fourth power of the share of characters that are no symbols."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>!", ""))
    share = 1 - symbols / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(F.pow(share, 4), F.lit(0.0)), F.lit(0.05))


def sampling_key(identity: Column, weight: Column) -> Column:
    """An exponential number with the weight as its rate; equal identities get equal keys."""
    digits = F.conv(F.substring(F.md5(identity), 1, 12), 16, 10).cast("double")
    return -F.ln((digits + 0.5) / float(1 << 48)) / weight


def bucket_of(key: Column) -> Column:
    """A number under LEVEL^2 that rises with the key and holds few keys, whatever their weights.

    It is the mean of the distribution functions for the weights 1, 1/2, 1/4 and so on to
    2^-LEAST_POWER. A key of any weight between has a density of at most 2 * (LEAST_POWER + 1)
    times that mean's, so a bucket is expected to hold no more than that part of LEVEL^-2.
    """
    falls = [F.exp(-key * 2.0**-i) for i in range(LEAST_POWER + 1)]
    share = 1 - sum(falls[1:], falls[0]) / float(len(falls))
    return F.least(F.floor(share * (LEVEL * LEVEL)).cast("int"), F.lit(LEVEL * LEVEL - 1))


def source_targets(
    sizes: DataFrame,
    cycle: Sequence[int] = CYCLE,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
) -> DataFrame:
    """`target` of each source: `source`, `source_size` with one row per source.

    Weights repeat along the sources in code point order, null last. No target exceeds `most`
    times its source's size; the excess goes to the others by weight. Sources reach their
    bound in the order of bound / weight, so the common level of the rest is the highest of
    what is left divided by the weights that are left. The windows run over one row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(c)) for c in cycle])
    ranked = sizes.withColumn(
        "_weight", F.element_at(weights, F.pmod(F.row_number().over(by_name) - 1, len(cycle)) + 1)
    ).withColumn("_bound", F.col("source_size") * float(most))
    order = W.orderBy(F.col("_bound") / F.col("_weight"), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    later = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * float(share)
    left = budget - F.coalesce(F.sum("_bound").over(earlier), F.lit(0.0))
    levels = ranked.withColumn("_level", left / F.sum("_weight").over(later))
    level = F.max("_level").over(everything)
    return levels.select(
        "source", "source_size", F.least(F.col("_bound"), F.col("_weight") * level).alias("target")
    )


def plan(rows: DataFrame, **targets) -> DataFrame:
    """One row per source: sizes, target, epochs, and the cutoff of the fractional selection.

    `rows` has `doc_id`, `source`, `size`, `key`. Of the sampled part, a document is taken if
    the budget reaches its middle, so the sum lies within half a document of the rest.
    """
    rows = rows.withColumn("_fine", bucket_of(F.col("key")))
    fine = rows.groupBy("source", "_fine").agg(F.sum("size").alias("_size"))
    coarse = fine.groupBy("source", F.floor(F.col("_fine") / LEVEL).alias("_coarse")).agg(
        F.sum("_size").alias("_size")
    )
    totals = coarse.groupBy("source").agg(F.sum("_size").alias("source_size"))
    wanted = source_targets(totals, **targets)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    wanted = wanted.withColumn("epochs", F.coalesce(epochs, F.lit(0)).cast("int")).withColumn(
        "_rest", F.col("target") - F.col("epochs") * F.col("source_size")
    )
    wanted = stored(wanted.withColumn("_source", F.col("source")).drop("source"), "mixing-targets")
    same = F.col("source").eqNullSafe(F.col("_source"))

    def boundary(sums: DataFrame, by: str, start: Column) -> DataFrame:
        """The first bucket of each source that ends beyond the rest, and the sum before it."""
        up_to = F.sum("_size").over(W.partitionBy("source").orderBy(by))
        return (
            sums.withColumn("_end", start + up_to)
            .where(F.col("_end") > F.col("_rest"))
            .groupBy("source")
            .agg(F.min(F.struct(by, (F.col("_end") - F.col("_size")).alias("_start"))).alias("_at"))
            .select(F.col("source").alias("_source"), f"_at.{by}", "_at._start")
        )

    first = boundary(coarse.join(wanted, same).drop("_source"), "_coarse", F.lit(0))
    within = (
        fine.withColumn("_coarse", F.floor(F.col("_fine") / LEVEL))
        .join(first.withColumnRenamed("_coarse", "_only"), same & (F.col("_coarse") == F.col("_only")))
        .drop("_source")
        .join(wanted, same)
        .drop("_source")
    )
    second = boundary(within, "_fine", F.first("_start").over(W.partitionBy("source").orderBy("_fine")))
    last = (
        rows.join(second.withColumnRenamed("_fine", "_only"), same & (F.col("_fine") == F.col("_only")))
        .drop("_source")
        .join(wanted, same)
        .drop("_source")
    )
    ordered = W.partitionBy("source").orderBy("key", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    middle = F.col("_start") + F.sum("size").over(ordered) - F.col("size") / 2
    cutoff = (
        last.withColumn("_taken", middle <= F.col("_rest"))
        .groupBy("source")
        .agg(
            F.max(F.when(F.col("_taken"), F.struct("key", "doc_id"))).alias("_cutoff"),
            F.first("_only").alias("_only"),
        )
        .select(F.col("source").alias("_of"), "_cutoff", "_only")
    )
    return wanted.join(cutoff, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")


def mix(
    docs: DataFrame,
    weight: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **targets,
) -> DataFrame:
    """All columns of `docs` as a struct `doc`, with `size`, `source_size`, `target`, `copies`, `taken`.

    `copies` is how often the mix repeats the document, `taken` its words times that. Reruns
    agree: keys depend on the id (of rows without id: on the text) alone, so rows equal in it
    are taken alike. Null sources are a source of their own, null texts and those without a
    word have size 0 and ride along, an empty table gives an empty result. Columns of `docs`
    may have any name, as they stay inside the struct. Weights must lie in (0, 1].
    """
    identity = F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        sampling_key(identity, weight).alias("key"),
    )
    slim = stored(keyed.drop("doc"), "mixing-rows")
    states = stored(plan(slim, **targets), "mixing-plan")
    # one row per source and slice: broadcast if its written size allows, else joined by slices
    states = states.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    joined = keyed.withColumn("_slice0", F.pmod(F.xxhash64("doc_id", "key"), F.lit(SLICES))).join(
        states,
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("_slice0") == F.col("_slice")),
        "left",
    )
    bucket = bucket_of(F.col("key"))
    chosen = (
        F.col("_only").isNull()
        | (bucket < F.col("_only"))
        | ((bucket == F.col("_only")) & (F.struct("key", "doc_id") <= F.col("_cutoff")))
    )
    copies = F.col("epochs") + F.coalesce(chosen, F.lit(False)).cast("int")
    return joined.withColumn("copies", F.least(copies, F.lit(MOST_EPOCHS))).select(
        "doc", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
    )


def repeat(mixed: DataFrame) -> DataFrame:
    """The documents of a mix with their own columns, each as often as the mix takes it."""
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return mixed.withColumn("_copy", copies).select("doc.*")


SQL = """
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
    -ln((('0x' || substr(md5(coalesce(cast(doc_id as varchar), text, '')), 1, 12))::bigint + 0.5::double)
        / 281474976710656::double)
      / greatest(coalesce(pow(1 - (length(text) - length(translate(text, '#*$%&|<>!', '')))::double
        / greatest(length(text), 1), 4), 0), 0.05::double) as key
  from documents
), s as (
  select source, sum(size)::double as total, 2 * sum(size)::double as bound,
    [3.0, 1.0, 2.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint]::double as weight
  from d group by source
), l as (
  select *, (1.5 * sum(total) over () - coalesce(sum(bound) over (o rows between unbounded preceding
      and 1 preceding), 0)) / sum(weight) over (o rows between current row and unbounded following) as level
  from s window o as (order by bound / weight, source nulls last)
), t as (
  select source, total, least(bound, weight * max(level) over ()) as target from l
), e as (
  select *, case when total > 0 then floor(target / total) else 0 end as epochs from t
), r as (
  select d.doc_id, d.size, e.total, e.target, e.epochs, e.target - e.epochs * e.total as rest,
    sum(d.size) over (partition by d.source order by d.key, d.doc_id rows unbounded preceding)
      - d.size / 2.0::double as middle
  from d join e on d.source is not distinct from e.source
)
select doc_id, size::bigint as size, total::bigint as source_size, target,
  (size * least(epochs + case when middle <= rest then 1 else 0 end, 2))::bigint as taken
from r
"""


@register(SQL)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix(docs, text_quality(F.col("text")))
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken")
