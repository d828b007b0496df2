"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Every word has a sparse random index vector that its hash decides. A word's vector sums the
index vectors of its neighbours over the whole corpus (words share a bounded number of
hashed rows, so the table does not grow with the corpus), plus a part of its own index
vector. A document is the mean and the spread of its words' vectors. A network of two layers
in numpy learns quality from a bounded sample of labelled documents; a temperature, fitted on
labelled documents it did not see, turns its output into calibrated probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raterscope.llm.common import (
    add_from_text,
    crc_fold,
    free_name,
    hash_unit,
    register,
    table,
    text_bytes,
)
from raterscope.session import stored

ROWS = 1 << 15  # hashed word rows
WIDTH = 64
NONZERO = 4
WINDOW = 2
LAGS = (1, 2, 3)
SAMPLE = 20_000  # labelled documents that the network is fitted on
HIDDEN = 32
STEPS = 4000
PART = 256
THRESHOLD = 0.3
CONTEXT_LOT = 1 << 18  # words whose neighbours are added up at once
LOT = 1 << 11  # words pooled at once: their vectors fit a core's cache
PIECE = 1 << 20  # bytes of text read at once, which bounds the memory of very long texts
LONG_WORD = 32  # longer words are hashed one by one

#: What a word is made of: a run of letters, of digits, or of other bytes that are no white space.
KIND = np.full(256, 3, np.uint8)
KIND[[*range(0x09, 0x0E), 0x20]] = 0
KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = 1
KIND[[*range(ord("0"), ord("9") + 1)]] = 2
WORD_END = re.compile(rb"[\x09-\x0d\x20]")
COLUMNS = [f"c{i}" for i in range(WIDTH)]


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each row's index vector."""
    draw = np.random.default_rng(1)
    places = draw.permuted(np.tile(np.arange(WIDTH), (ROWS, 1)), axis=1)[:, :NONZERO]
    return places, draw.choice([-1, 1], (ROWS, NONZERO))


class WordRows:
    """Hashed rows of words: CRC-32 modulo ROWS, taken byte by byte over many words at once."""

    def __init__(self):
        steps = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            steps = (steps >> np.uint32(1)) ^ np.where(steps & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
        self.steps = steps

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The row of each word of `data`, and where the word begins."""
        letters = np.frombuffer(data, np.uint8)
        kinds = KIND[letters]
        borders = np.flatnonzero(np.diff(kinds, prepend=0, append=0))  # white space has kind 0
        starts = borders[kinds[np.minimum(borders, max(0, len(kinds) - 1))] > 0] if len(kinds) else borders
        starts = starts[starts < len(kinds)]
        sizes = borders[np.searchsorted(borders, starts) + 1] - starts
        order = np.argsort(-np.minimum(sizes, LONG_WORD + 1), kind="stable")
        first, longest = starts[order], sizes[order]
        state = np.full(len(order), 0xFFFFFFFF, np.uint32)
        left = np.searchsorted(-longest, -np.arange(LONG_WORD + 1), side="left") if len(order) else []
        for place in range(min(LONG_WORD, int(longest[0]) if len(order) else 0)):
            n = int(left[place])  # words longer than `place` come first
            own = state[:n]
            state[:n] = self.steps[(own ^ letters[first[:n] + place]) & np.uint32(0xFF)] ^ (own >> np.uint32(8))
        state ^= np.uint32(0xFFFFFFFF)
        rows = np.empty(len(order), np.int64)
        rows[order] = state % np.uint32(ROWS)
        for i in np.flatnonzero(sizes > LONG_WORD):
            rows[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]]) % ROWS
        return rows, starts


def pieces(texts: list[bytes | None]) -> Iterator[tuple[bytes, np.ndarray, int]]:
    """Whole texts side by side, about PIECE bytes at a time: bytes, where texts begin, number of the first.

    A longer text is cut in white space, or else where its word ends, and goes on in the next piece.
    """
    held, first, size = [], 0, 0
    for number, text in enumerate(texts):
        text = text or b""
        start = 0
        while len(text) - start > PIECE:
            if held:
                yield b"\n".join(held), np.cumsum([0, *(len(t) + 1 for t in held[:-1])]), first
                held, size = [], 0
            cut = WORD_END.search(text, start + PIECE)
            end = cut.start() if cut else len(text)
            yield text[start:end], np.zeros(1, np.int64), number
            start = end
        if not held:
            first = number
        held.append(text[start:])
        size += len(text) - start
        if size > PIECE:
            yield b"\n".join(held), np.cumsum([0, *(len(t) + 1 for t in held[:-1])]), first
            held, size = [], 0
    if held:
        yield b"\n".join(held), np.cumsum([0, *(len(t) + 1 for t in held[:-1])]), first


def lots(texts: list[bytes | None], rows: WordRows, most: int, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Word rows and the number of their text, at most `most` new words at a time.

    The third value says how many of the first words were in the lot before: the last `reach`
    come again, so that neighbours across the border of two lots are met once.
    """
    kept, owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for data, begin, first in pieces(texts):
        own, starts = rows.of(data)
        number = np.searchsorted(begin, starts, side="right") - 1 + first
        for low in range(0, len(own), most):
            ids = np.concatenate([kept, own[low : low + most]])
            owners = np.concatenate([owner, number[low : low + most]])
            yield ids, owners, len(kept)
            kept, owner = ids[-reach:], owners[-reach:]


def context_sums(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`row`, `n` and WIDTH whole numbers: the index vectors of all neighbours, by hashed row.

    Each task adds up its texts and gives each row once; Spark sums the rest.
    """
    fields = ["row", "n", *COLUMNS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        rows = WordRows()
        sums, seen = np.zeros(ROWS * WIDTH), np.zeros(ROWS, np.int64)
        for batch in batches:
            for ids, owners, old in lots(text_bytes(batch.column(0)), rows, CONTEXT_LOT, WINDOW):
                seen += np.bincount(ids[old:], minlength=ROWS)
                for step in range(1, WINDOW + 1):
                    same = owners[step:] == owners[:-step]
                    same[: max(0, old - step)] = False  # both were in the lot before
                    left, right = ids[:-step][same], ids[step:][same]
                    for word, near in ((left, right), (right, left)):
                        cells = word[:, None] * WIDTH + places[near]
                        sums += np.bincount(cells.ravel(), signs[near].ravel(), ROWS * WIDTH)
        found = np.flatnonzero(seen)
        values = sums.reshape(ROWS, WIDTH)[found].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(seen[found]), *map(pa.array, values.T)], names=fields
        )

    schema = ", ".join(f"{x} long" for x in fields)
    made = docs.select(F.col(text_col).cast("string")).mapInArrow(run, schema)
    return made.groupBy("row").agg(*[F.sum(c).alias(c) for c in fields[1:]])


def word_vectors(sums: DataFrame) -> np.ndarray:
    """The table of ROWS word vectors; its size does not depend on the corpus."""
    found = sums.toPandas().sort_values("row")
    values = found[COLUMNS].to_numpy(np.float64)
    values /= np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-9)
    if len(found):
        values -= np.average(values, axis=0, weights=found["n"])
    places, signs = index_vectors()
    out = np.zeros((ROWS, WIDTH), np.float32)
    np.put_along_axis(out, places, (signs / NONZERO).astype(np.float32), axis=1)
    out[found["row"].to_numpy()] += values.astype(np.float32)
    return out


def pooled(texts: list[bytes | None], vectors: np.ndarray, rows: WordRows) -> np.ndarray:
    """Features of each text: pooled word vectors, and the log of the text's length.

    The pools are the mean and the standard deviation of the vectors, and the mean inner
    product of words one, two and three places apart, which grows where a text repeats itself.
    """
    total = np.zeros((2, len(texts), WIDTH))
    near = np.zeros((len(texts), len(LAGS)))
    count = np.zeros(len(texts), np.int64)
    for ids, owners, old in lots(texts, rows, LOT, max(LAGS)):
        values = vectors[ids]
        for column, lag in enumerate(LAGS):
            right = max(old, lag)  # a pair counts in the lot that its second word is new in
            if right >= len(ids):
                continue
            product = np.einsum("ij,ij->i", values[right:], values[right - lag : len(ids) - lag])
            product *= owners[right:] == owners[right - lag : len(ids) - lag]
            near[:, column] += np.bincount(owners[right:], product, len(texts))
        values, owners = values[old:], owners[old:]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(owners)) + 1])
        own = owners[starts]
        total[0, own] += np.add.reduceat(values, starts, axis=0)
        np.square(values, out=values)
        total[1, own] += np.add.reduceat(values, starts, axis=0)
        count[own] += np.diff(np.concatenate([starts, [len(owners)]]))
    size = np.maximum(count, 1)[:, None]
    mean, square = total / size
    spread = np.sqrt(np.maximum(square - mean**2, 0))
    return np.hstack([mean, spread, near / size, np.log1p(count)[:, None] / 10])


class Network:
    """Features, one hidden layer, one output; trained by Adam, calibrated by a temperature."""

    def fit(self, features: np.ndarray, labels: np.ndarray) -> Network:
        draw = np.random.default_rng(2)
        order = draw.permutation(len(labels))
        held = order[: len(labels) // 6]
        used = order[len(held) :]
        self.centre = features[used].mean(axis=0)
        self.scale = features[used].std(axis=0) + 1e-3
        x, y = (features - self.centre) / self.scale, labels.astype(np.float64)
        n = x.shape[1]
        self.layers = [
            draw.normal(0, n**-0.5, (n, HIDDEN)), np.zeros(HIDDEN),
            draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1),
        ]
        first = [np.zeros_like(p) for p in self.layers]
        second = [np.zeros_like(p) for p in self.layers]
        for step in range(1, STEPS + 1):
            part = draw.choice(used, PART)
            hidden = np.maximum(x[part] @ self.layers[0] + self.layers[1], 0)
            error = (_sigmoid(hidden @ self.layers[2] + self.layers[3]) - y[part]) / len(part)
            back = np.outer(error, self.layers[2]) * (hidden > 0)
            slopes = [
                x[part].T @ back + 1e-4 * self.layers[0], back.sum(axis=0),
                hidden.T @ error + 1e-4 * self.layers[2], error.sum(keepdims=True),
            ]
            for p, g, m, v in zip(self.layers, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.temperature = 1.0
        if len(held):
            outputs = self.outputs(features[held])
            choices = np.geomspace(0.25, 8, 60)
            losses = [np.logaddexp(0, np.where(y[held] > 0, -1, 1) * outputs / t).mean() for t in choices]
            self.temperature = float(choices[int(np.argmin(losses))])
        return self

    def outputs(self, features: np.ndarray) -> np.ndarray:
        hidden = np.maximum((features - self.centre) / self.scale @ self.layers[0] + self.layers[1], 0)
        return hidden @ self.layers[2] + self.layers[3]

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.outputs(features) / self.temperature)


class Constant:
    """What is predicted if the labelled documents are of one kind, or none."""

    def __init__(self, value: float):
        self.value = value

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return np.full(len(features), self.value)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, sample: int = SAMPLE):
    """Fit on `docs` (`doc_id`, `text`) with a label in `labels` (`doc_id`, `quality`).

    At most `sample` labelled documents are used, the first by hash of their id; the driver
    gets their pooled vectors. Null ids and null labels teach nothing; of different labels for
    one id the lowest holds.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(hash_unit(F.col("doc_id"), seed=1), "doc_id").limit(sample)
    )
    known = stored(known, "quality-labels")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # `sample` rows at most

    def compute(found: list[bytes | None]) -> list[pa.Array]:
        return [pa.array(pooled(found, shared.value, WordRows()).tolist(), pa.list_(pa.float64()))]

    made = add_from_text(
        texts, "text", [T.StructField("_features", T.ArrayType(T.DoubleType()))], compute
    )
    rows = made.groupBy("doc_id").agg(F.first("quality").alias("y"), F.first("_features").alias("x"))
    rows = sorted((r.doc_id, r.y, r.x) for r in rows.collect())
    wanted = np.array([y > 0 for _, y, _ in rows])
    if len(set(wanted.tolist())) < 2:
        return Constant(float(wanted.mean()) if len(wanted) else 0.5)
    return Network().fit(np.array([x for _, _, x in rows]), wanted)


def score(docs: DataFrame, vectors: np.ndarray, network, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of `docs` with the probability of good quality of each whole text.

    Null and empty texts are scored like any other, from a zero vector. Repeated rows get equal
    scores; an empty table gives an empty result. `name` must be free in `docs`.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def compute(texts: list[bytes | None]) -> list[pa.Array]:
        table_of, model = shared.value
        return [pa.array(model.probabilities(pooled(texts, table_of, WordRows())))]

    return add_from_text(docs, text_col, [T.StructField(name, T.DoubleType())], compute)


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` (with `doc_id`, `text`) whose score reaches the threshold."""
    name = free_name(docs.columns, "_quality_score")
    vectors = word_vectors(context_sums(docs))
    found = score(docs, vectors, train(docs, labels, vectors), name=name)
    return found.where(F.col(name) >= threshold).drop(name)


@register()
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    vectors = word_vectors(context_sums(docs))
    network = train(docs, labels.where(crc_fold(F.col("doc_id"), 5) != 0), vectors)
    held_out = F.coalesce(crc_fold(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = score(docs, vectors, network)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
