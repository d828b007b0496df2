"""Near duplicates by SimHash: shared blocks of the fingerprint, then Hamming distance.

A fingerprint is cut into BLOCKS blocks. Two fingerprints that differ in at most DISTANCE
bits agree on at least BLOCKS - DISTANCE blocks, so every link is found in a bucket of
fingerprints with the same CHOSEN blocks. Equal fingerprints are merged first. A bucket of
up to BUCKET fingerprints is compared in its task and gives a spanning forest of its links,
never its pairs. The members of larger buckets take a path whose work is linear in their
number: two fingerprints differ in at most four bits if and only if some fingerprint is
within two bits of both, so each member lists all fingerprints within two bits, and those
that list the same one are linked to the smallest of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raterscope.llm.common import free_name, register, table, text_bytes
from raterscope.session import stored

SHINGLE = 4
SEED = 42
BITS = 64
DISTANCE = 4
BLOCKS = 7
CHOSEN = 3
BUCKET = 256
LOT = 1 << 16  # shingles hashed at once, which bounds the memory of a very long text


def fingerprint(text: bytes | None) -> int:
    """The SimHash of a whole text as an unsigned number; zero without any word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends]
    last = ends[SHINGLE - 1 :] or ends[-1:]
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for lot in range(0, len(last), LOT):
        spans = zip(starts[lot : lot + LOT], last[lot : lot + LOT], strict=False)
        hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(last), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """`doc_id`, `fp` (the fingerprint's bits as a signed long) and the columns `more` of each row."""
    source = docs.select(
        F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("doc_id"), *[c.alias(n) for n, c in more.items()]
    )
    fields = [f for f in source.schema.fields if f.name != "text"]
    schema = T.StructType([*fields, T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t) for t in text_bytes(batch.column(0))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(made.view(np.int64))], names=schema.names)

    return source.mapInArrow(run, schema)


def bucket_rows(found: DataFrame, blocks: int = BLOCKS, chosen: int = CHOSEN) -> DataFrame:
    """`bucket` and `fp`: each distinct fingerprint under every choice of blocks."""
    edges = [BITS * b // blocks for b in range(blocks + 1)]
    keys = []
    for number, choice in enumerate(combinations(range(blocks), chosen)):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in choice)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(signed))))
    # equal choices have equal keys; a chance collision of keys only adds a comparison
    return found.select(F.explode(F.array(*keys)).alias("bucket"), "fp")


def _forest(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning edges of the links among a bucket's members, by breadth from each."""
    edges = []
    left = members
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.bitwise_count(front[:, None] ^ left[None, :]) <= distance
            linked = near.any(axis=0)
            edges += zip(front[near[:, linked].argmax(axis=0)], left[linked], strict=True)
            front, left = left[linked], left[~linked]
    return edges


def bucket_links(rows: DataFrame, distance: int = DISTANCE, most: int = BUCKET) -> DataFrame:
    """Edges `a`, `b` of all buckets; `a` with a null `b` marks a member of a larger bucket."""
    schema = "a long, b long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
            left = pa.array(np.asarray(a, np.uint64).view(np.int64))
            right = pa.nulls(len(left), pa.int64()) if b is None else pa.array(np.asarray(b, np.uint64).view(np.int64))
            return pa.RecordBatch.from_arrays([left, right], names=["a", "b"])

        def closed(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Buckets that lie wholly in these sorted rows."""
            if len(keys) < 2:
                return
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts = np.concatenate([[0], cuts])
            sizes = np.diff(np.concatenate([starts, [len(keys)]]))
            two = starts[sizes == 2]
            two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= distance]
            a, b = [fps[two]], [fps[two + 1]]
            large = []
            for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
                members = fps[start : start + size]
                if size > most:
                    large.append(members)
                elif edges := _forest(members, distance):
                    x, y = zip(*edges, strict=True)
                    a.append(np.array(x, np.uint64))
                    b.append(np.array(y, np.uint64))
            yield out(np.concatenate(a), np.concatenate(b))
            if large:
                yield out(np.concatenate(large), None)

        open_keys, open_fps, hot = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            keys = np.concatenate([open_keys, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate(
                [open_fps, batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)]
            )
            if hot is not None:  # rows go on of a bucket already known to be too large
                n = int(np.searchsorted(keys, hot, side="right"))
                if n:
                    yield out(fps[:n], None)
                keys, fps = keys[n:], fps[n:]
                hot = None if len(keys) else hot
            if not len(keys):
                open_keys, open_fps = keys, fps
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            yield from closed(keys[:last], fps[:last])
            open_keys, open_fps = keys[last:], fps[last:]
            if len(open_keys) > most:
                hot = open_keys[0]
                yield out(open_fps, None)
                open_keys, open_fps = open_keys[:0], open_fps[:0]
        yield from closed(open_keys, open_fps)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)
    )


def midpoint_links(members: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges `a`, `b` among the fingerprints `a`, through all points within distance / 2 of each."""
    if distance % 2:
        raise ValueError("the distance must be even")
    flips = [
        sum(1 << bit for bit in chosen) for r in range(distance // 2 + 1) for chosen in combinations(range(BITS), r)
    ]
    signed = [f - (1 << BITS) if f >> (BITS - 1) else f for f in flips]
    points = members.select(
        "a", F.explode(F.transform(F.array(*map(F.lit, signed)), lambda m: F.col("a").bitwiseXOR(m))).alias("point")
    )
    lowest = points.groupBy("point").agg(F.min("a").alias("b"), F.max("a").alias("top")).where("b < top")
    return points.join(lowest, "point").where("a <> b").select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root`: the smallest node that each node of `edges` (`a`, `b`) can reach.

    Each round points every node at its smallest neighbour, follows the pointers twice and
    replaces the nodes of all edges by what they point at, until no edge is left. Rounds are
    written to the shared folder; the driver sees counts only.
    """
    edges = stored(edges.where("a <> b").distinct(), "links")
    names = None
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("a").alias("b"), F.col("b").alias("a")))
        points = both.groupBy("a").agg(F.least("a", F.min("b")).alias("to"))
        points = stored(points.select(F.col("a").alias("node"), "to"), "links-to")
        again = points.select(F.col("node").alias("to"), F.col("to").alias("next"))
        points = stored(
            points.join(again, "to").select("node", F.col("next").alias("to")), "links-next"
        )
        step = points.select(F.col("node").alias("root"), F.col("to").alias("next"))
        names = points.withColumnRenamed("to", "root") if names is None else stored(
            names.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")),
            "links-names",
        )
        left = points.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        right = points.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        moved = edges.join(left, "a").join(right, "b").where("a2 <> b2")
        edges = stored(
            moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(),
            "links",
        )
    if names is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return names


def roots_of(
    found: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, chosen: int = CHOSEN, bucket: int = BUCKET
) -> DataFrame:
    """`fp`, `root`: the same root for all fingerprints that links connect; `found` has each `fp` once."""
    if blocks - distance < chosen:
        raise ValueError("with so many blocks chosen, close fingerprints may share no bucket")
    links = stored(bucket_links(bucket_rows(found, blocks, chosen), distance, bucket), "simhash-links")
    edges = links.where("b is not null")
    large = links.where("b is null").select("a").distinct()
    if large.limit(1).count():
        edges = edges.unionByName(midpoint_links(large, distance))
    joined = found.select("fp").join(components(edges).withColumnRenamed("node", "fp"), "fp", "left")
    return joined.withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`doc_id`, `fp`, `component_id` for each row: the smallest id among all linked documents.

    Texts that are null or have no word have fingerprint zero and link like others. Repeated
    rows give repeated rows. Rows with a null id count as members; a component of such rows
    only has a null `component_id`. An empty table gives an empty result. Other columns of
    `docs` are not read. For `options` see `roots_of`.
    """
    rows = stored(fingerprints(docs, id_col, text_col), "simhash")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("_low")), "simhash-classes")
    roots = stored(roots_of(classes, **options), "simhash-roots")
    lowest = classes.join(roots, "fp").groupBy("root").agg(F.min("_low").alias("component_id"))
    named = roots.join(lowest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of `docs` for each component: the one with the smallest id, nulls last.

    Texts that are null or have no word are linked like others. Rows that share an id are told
    apart by their texts: each belongs to its own text's component, and of those that could
    stand for one component the text with the smaller hash does. Of rows with equal id and text
    the other columns decide, so reruns keep the same rows. Rows without id take part like
    others. An empty table gives an empty result. For `options` see `roots_of`.
    """
    names = []
    for name in ("_k1", "_k2", "_place"):
        names.append(free_name(docs.columns + names, name))
    own_id, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # two hashes of id and text, as ids alone may repeat or be missing
    keys = [F.xxhash64(F.lit(seed), own_id.isNull(), own_id, text) for seed in (1, 2)]
    rows = stored(fingerprints(docs, id_col, text_col, k1=keys[0], k2=keys[1]), "simhash")
    classes = stored(rows.select("fp").distinct(), "simhash-classes")
    best = (
        rows.join(roots_of(classes, **options), "fp").groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("best"))
        .select(F.col("best.k1").alias(names[0]), F.col("best.k2").alias(names[1]))
    )
    simple = [c for c, kind in docs.dtypes if not kind.startswith(("map", "variant")) and c not in (id_col, text_col)]
    order = [F.col(f"`{text_col}`").isNull(), *(F.col(f"`{c}`").asc_nulls_last() for c in simple)]
    kept = docs.withColumns(dict(zip(names, keys))).join(best, names[:2], "left_semi")
    first = F.row_number().over(W.partitionBy(*names[:2]).orderBy(*order))
    return kept.withColumn(names[2], first).where(F.col(names[2]) == 1).select(*[f"`{c}`" for c in docs.columns])


@register()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
