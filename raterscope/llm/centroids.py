"""Centroid clustering: exact k-means on whole numbers, with Ptolemaic lower bounds.

Components are scaled and floored to whole numbers, so distances, sums and means are exact and
every rerun agrees. A few pivots are fixed, and every vector's distances to them are computed
once and stored beside it. For pivots p, s Ptolemy's inequality says

    d(x, c) * d(p, s) >= |d(x, p) * d(c, s) - d(x, s) * d(c, p)|,

which gives a lower bound of a vector's distance to a centroid from stored numbers. Bounds are
rounded down by more than their arithmetic can err. The centroid of the lowest bound is
measured exactly; then every centroid whose bound does not exceed that distance is.

Each round is one pass over the stored vectors. Tasks send one sum per centroid, so a cluster
that holds most vectors moves no more rows than others. Centroids and pivots, n_clusters and
N_PIVOTS rows, are all that the driver holds and sends out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raterscope.llm.common import register, table
from raterscope.session import stored

WIDTH = 64
SCALE = 256
N_CLUSTERS = 40
ROUNDS = 5
SEED = 2
N_PIVOTS = 5
BLOCK = 1024  # vectors whose bounds are held at once
LARGEST = 1 << 27  # beyond it a squared distance may not fit a long

#: More than the relative error of any bound: sqrt, two products and a difference, a division.
SLACK = 64 * np.finfo(np.float64).eps


class Centroids(NamedTuple):
    """Whole-number centroids, and what bounds need: distances to pivots, and among these."""

    rows: np.ndarray  # n_clusters x width, int64
    near: np.ndarray  # n_clusters x pivots, float64
    pairs: list[tuple[int, int, float]]


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """`id`, `point`: floor(scale * x) of each usable vector's components.

    A vector takes part if it has `width` components, none null or non-finite, and none beyond
    LARGEST in size once scaled (its squared distances would not fit a long).
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) >= float(LARGEST)))
    point = F.transform(vector, lambda x: F.floor(x * scale).cast("long"))
    usable = (F.size(vector) == width) & ~bad
    return rows.where(F.coalesce(usable, F.lit(False))).select(F.col(f"`{id_col}`").alias("id"), point.alias("point"))


def first_centroids(points: DataFrame, n_clusters: int, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest sha256 of `<seed>:<id>`, in that order; ties by components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    chosen = points.orderBy(F.sha2(name.cast("binary"), 256), "point").limit(n_clusters).select("point").collect()
    return np.array([r.point for r in chosen], np.int64)


def choose_pivots(centroids: np.ndarray, n_pivots: int = N_PIVOTS) -> np.ndarray:
    """Distinct rows far from one another: the first, then always the farthest from those chosen."""
    if not len(centroids):
        return centroids
    chosen = [0]
    nearest = squares(centroids, centroids[:1])[:, 0]
    while len(chosen) < n_pivots and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squares(centroids, centroids[chosen[-1:]])[:, 0])
    return centroids[chosen]


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of x and of y."""
    return np.array([((x - row) ** 2).sum(axis=1) for row in y], np.int64).reshape(len(y), len(x)).T


def prepared(centroids: np.ndarray, pivots: np.ndarray) -> Centroids:
    among = np.sqrt(squares(pivots, pivots))
    pairs = [(p, s, float(among[p, s])) for p, s in combinations(range(len(pivots)), 2)]
    return Centroids(centroids, np.sqrt(squares(centroids, pivots)), pairs)


def lower_bounds(near: np.ndarray, centroids: Centroids) -> np.ndarray:
    """Squared distances from below: vectors (by their distances to pivots) by centroids."""
    best = np.zeros((len(near), len(centroids.rows)))
    for p, s, among in centroids.pairs:
        one = near[:, p, None] * centroids.near[None, :, s]
        other = near[:, s, None] * centroids.near[None, :, p]
        bound = (np.abs(one - other) - SLACK * (one + other)) / among
        np.maximum(best, bound, out=best)
    return best**2 * (1 - SLACK)


def assign(points: np.ndarray, near: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: smaller number), squared distance, and how many were measured."""
    cluster, distance = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
    measured = 0
    for low in range(0, len(points), BLOCK):
        block, own = slice(low, low + BLOCK), points[low : low + BLOCK]
        every = np.arange(len(own))
        bounds = lower_bounds(near[block], centroids)
        guess = bounds.argmin(axis=1)
        best = ((own - centroids.rows[guess]) ** 2).sum(axis=1)
        open_ = bounds <= best[:, None]
        open_[every, guess] = False
        row, number = np.nonzero(open_)
        exact = np.full(bounds.shape, np.iinfo(np.int64).max)
        exact[every, guess] = best
        for first in range(0, len(row), BLOCK * 8):
            r, c = row[first : first + BLOCK * 8], number[first : first + BLOCK * 8]
            exact[r, c] = ((own[r] - centroids.rows[c]) ** 2).sum(axis=1)
        cluster[block] = exact.argmin(axis=1)  # the first of equal ones
        distance[block] = exact[every, cluster[block]]
        measured += len(own) + len(row)
    return cluster, distance, measured


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), width)


def with_pivots(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """`id`, `point`, `near`: each vector with its distances to the pivots."""
    width = pivots.shape[1] if len(pivots) else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(1), width, np.int64)
            near = np.sqrt(squares(rows, pivots))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(near), pa.list_(pa.float64()))], names=["id", "point", "near"]
            )

    return points.mapInArrow(run, f"id {points.schema['id'].dataType.simpleString()}, point array<long>, near array<double>")


def cluster_sums(points: DataFrame, centroids: Centroids) -> DataFrame:
    """`cluster`, `n`, `sums`: one row for each cluster and task; sums are whole numbers."""
    shared = points.sparkSession.sparkContext.broadcast(centroids)  # n_clusters rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        n = np.zeros(len(own.rows), np.int64)
        sums = np.zeros(own.rows.shape, np.int64)
        for batch in batches:
            rows = _matrix(batch.column(0), own.rows.shape[1], np.int64)
            near = _matrix(batch.column(1), own.near.shape[1], np.float64)
            cluster, _, _ = assign(rows, near, own)
            np.add.at(sums, cluster, rows)
            n += np.bincount(cluster, minlength=len(n))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(n[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    return points.select("point", "near").mapInArrow(run, "cluster long, n long, sums array<long>")


def moved(sums: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floored means of all clusters that have a vector; others keep their centroid."""
    width = centroids.shape[1]
    total = sums.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums")
    )
    out = centroids.copy()
    for r in total.collect():  # a row per cluster
        out[r.cluster] = [s // r.n for s in r.sums]
    return out


def assigned(points: DataFrame, centroids: Centroids) -> DataFrame:
    """`id`, `cluster`, `distance` of every vector, and `measured`, its share of exact distances."""
    shared = points.sparkSession.sparkContext.broadcast(centroids)
    kind = points.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rows = _matrix(batch.column(1), own.rows.shape[1], np.int64)
            near = _matrix(batch.column(2), own.near.shape[1], np.float64)
            cluster, distance, measured = assign(rows, near, own)
            share = np.full(len(rows), measured / max(1, len(rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance), pa.array(share)],
                names=["id", "cluster", "distance", "measured"],
            )

    return points.select("id", "point", "near").mapInArrow(
        run, f"id {kind}, cluster int, distance long, measured double"
    )


def cluster_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    n_clusters: int = N_CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    width: int = WIDTH,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """`id`, `cluster`, `distance` (squared), `measured` of each vector, and the final centroids.

    See `whole_vectors` for the vectors that take part; others give no row. Repeated rows stay
    and count as often as they come; rows without an id take part, with a blank in place of the
    id where hashes choose the first centroids. With fewer vectors than clusters there are as
    many clusters as vectors; without any, the result is empty and there is no centroid. Of
    equally near centroids the one with the smaller number counts. Other columns are not read.
    """
    points = stored(whole_vectors(rows, id_col, vector_col, width, scale), "points")
    centroids = first_centroids(points, n_clusters, seed).reshape(-1, width)
    pivots = choose_pivots(centroids)
    points = stored(with_pivots(points, pivots), "points-near")
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(cluster_sums(points, prepared(centroids, pivots)), centroids)
    return assigned(points, prepared(centroids, pivots)), centroids


def cluster_table(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """`cluster`, `cluster_inertia`, `inertia`, `centroid` (components joined by commas); a row per cluster."""
    sums = {r[0]: r[1] for r in found.groupBy("cluster").agg(F.sum("distance")).collect()}
    rows = [(i, sums.get(i, 0), sum(sums.values()), ",".join(map(str, c))) for i, c in enumerate(centroids.tolist())]
    schema = "cluster int, cluster_inertia long, inertia long, centroid string"
    return found.sparkSession.createDataFrame(rows, schema)


def _round_sql(number: int) -> str:
    """One round: distances of all vectors to all centroids, the nearest, floored means."""
    nearest = f"""a{number} as (select vec_id, k, d from (select v.vec_id, c.k, v.d - 2 * c.d + c.own as d,
    row_number() over (partition by v.vec_id order by v.d - 2 * c.d + c.own, c.k) as place
  from (select vec_id, sum(x * x) as d from x group by 1) v join (
    select x.vec_id, c.k, sum(x.x * c.x) as d, max(o.own) as own from x join c{number} c on x.i = c.i
      join (select k, sum(x * x) as own from c{number} group by 1) o on o.k = c.k group by 1, 2) c on v.vec_id = c.vec_id) t
  where place = 1)"""
    means = f"""m{number} as (select a.k, x.i, sum(x.x) as s, count(*) as n from a{number} a join x on a.vec_id = x.vec_id group by 1, 2),
c{number + 1} as (select c.k, c.i, coalesce(cast((m.s - ((m.s % m.n) + m.n) % m.n) / m.n as bigint), c.x) as x
  from c{number} c left join m{number} m on c.k = m.k and c.i = m.i)"""
    return nearest if number == ROUNDS else f"{nearest},\n{means}"


SQL = f"""
with v as (select vec_id, embedding from embeddings where len(embedding) = {WIDTH}),
e as (select vec_id, i, embedding[i] as x from (select vec_id, embedding, unnest(range(1, {WIDTH + 1})) as i from v) t),
kept as (select vec_id from e group by 1 having count(x) filter (where isfinite(x)) = {WIDTH}),
x as (select e.vec_id, e.i, cast(floor({SCALE} * cast(e.x as double)) as bigint) as x from e join kept k on e.vec_id = k.vec_id),
f as (select vec_id, k from (select vec_id, row_number() over (order by sha256('{SEED}:' || cast(vec_id as varchar))) - 1 as k from kept) t
  where k < {N_CLUSTERS}),
c0 as (select f.k, x.i, x.x from f join x on f.vec_id = x.vec_id),
{",".join(_round_sql(n) for n in range(ROUNDS + 1))},
sizes as (select k, sum(d) as d from a{ROUNDS} group by 1),
digests as (select k, sha256(string_agg(cast(x as varchar), ',' order by i)) as digest from c{ROUNDS} group by 1)
select a.vec_id, cast(a.k as int) as cluster, cast(a.d as bigint) as distance, cast(s.d as bigint) as cluster_inertia,
  cast((select sum(d) from sizes) as bigint) as inertia, g.digest as centroid_sha256
from a{ROUNDS} a join sizes s on a.k = s.k join digests g on a.k = g.k
"""


@register(SQL)
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    found = stored(found.drop("measured"), "clusters")
    sizes = cluster_table(found, centroids)
    return found.join(F.broadcast(sizes), "cluster").select(  # a row per cluster
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.col("centroid").cast("binary"), 256).alias("centroid_sha256"),
    )
