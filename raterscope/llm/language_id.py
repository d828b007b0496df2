"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams of 1 to SPECTRUM characters that
both have (presence, not counts), divided by the geometric mean of how many each has. A
bounded number of labelled texts per language are the landmarks of a Nyström approximation;
kernel ridge regression learns one score per language against the rest on a bounded sample.
Every whole text is scored in batches: presence matrix times landmark matrix times weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
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

SPECTRUM = 3
LANDMARKS = 32  # per language
SAMPLE = 500  # labelled texts per language that the regression is fitted on
RIDGE = 1e-2
BATCH = 128
UNDETERMINED = "und"


def grams(text: bytes | None) -> np.ndarray | None:
    """The distinct n-grams of a whole text in lower case, as sorted numbers; None without a letter."""
    words = (text or b"").decode("utf-8", "replace").lower()
    if not any(map(str.isalpha, words)):
        return None
    points = np.frombuffer(words.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1
    found, code = [], np.zeros(len(points), np.int64)
    for n in range(1, SPECTRUM + 1):
        if len(points) < n:
            break
        code = (code[: len(points) - n + 1] << 21) | points[n - 1 :]
        found.append(np.unique(code))
    return np.concatenate(found)  # longer n-grams are larger numbers, so this is sorted


class Model:
    """Landmarks and, once fitted, the weights of each language."""

    def __init__(self, landmarks: list[np.ndarray], languages: list[str]):
        self.languages = languages
        self.vocabulary = np.unique(np.concatenate(landmarks)) if landmarks else np.zeros(0, np.int64)
        self.presence = np.zeros((len(self.vocabulary), len(landmarks)), np.float32)
        for column, own in enumerate(landmarks):
            self.presence[np.searchsorted(self.vocabulary, own), column] = len(own) ** -0.5
        self.weights = np.zeros((len(landmarks), len(languages)))

    def kernel(self, found: list[np.ndarray]) -> np.ndarray:
        """Kernel values of texts (rows) and landmarks (columns)."""
        rows = np.zeros((len(found), len(self.vocabulary)), np.float32)
        for row, own in enumerate(found):
            place = np.searchsorted(self.vocabulary, own)
            place = np.minimum(place, len(self.vocabulary) - 1)
            rows[row, place[self.vocabulary[place] == own]] = len(own) ** -0.5
        return rows @ self.presence

    def fit(self, landmark_grams: list[np.ndarray], kernels: np.ndarray, labels: list[str]) -> None:
        """Ridge regression in the Nyström features, folded back onto the landmarks."""
        among = self.kernel(landmark_grams).astype(np.float64)
        values, vectors = np.linalg.eigh((among + among.T) / 2)
        root = vectors * np.where(values > 1e-6, np.maximum(values, 1e-6) ** -0.5, 0)
        features = kernels.astype(np.float64) @ root
        share = np.array([labels.count(x) for x in self.languages], np.float64)
        wanted = np.array([[x == y for y in self.languages] for x in labels], np.float64)
        # each language weighs alike, however often it occurs in the sample
        weight = 1 / share[[self.languages.index(x) for x in labels]]
        gram = (features * weight[:, None]).T @ features + RIDGE * np.eye(features.shape[1])
        self.weights = root @ np.linalg.solve(gram, (features * weight[:, None]).T @ wanted)

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        """The best language of each text and its score, limited to 0 to 1."""
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        for start in range(0, len(texts), BATCH):
            found = [grams(t) for t in texts[start : start + BATCH]]
            rows = [i for i, own in enumerate(found) if own is not None]
            if not rows:
                continue
            values = self.kernel([found[i] for i in rows]).astype(np.float64) @ self.weights
            for i, best, value in zip(rows, values.argmax(axis=1), values.max(axis=1), strict=True):
                names[start + i] = self.languages[best]
                scores[start + i] = min(1.0, max(0.0, value))
        return names, scores


def train(
    labelled: DataFrame,
    landmarks: int = LANDMARKS,
    sample: int = SAMPLE,
) -> Model:
    """Fit on `doc_id`, `text`, `lang`: at most `sample` texts per language, the first by hash.

    Rows without id, text or language, and texts without a letter, teach nothing. Only the
    landmarks' n-grams and the sample's kernel values reach the driver.
    """
    known = labelled.where("doc_id is not null and lang is not null and text is not null")
    # ids are counted, not rows, so repeated rows leave the sample as it is
    keyed = known.select("doc_id", "lang").distinct().withColumn("_key", hash_unit(F.col("doc_id"), seed=9))
    # hashes are uniform, so the first ones of a language lie under a small bound; the ranks
    # then run over a few rows per language, not over all of a common one
    keyed = stored(keyed, "language-keys")
    sizes = stored(keyed.groupBy("lang").agg(F.count("*").alias("_n")), "language-sizes")
    near = keyed.join(sizes, "lang").where(F.col("_key") * F.col("_n") <= 3 * sample + 50)
    order = W.partitionBy("lang").orderBy("_key", "doc_id")
    chosen = (
        near.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= sample)
        .groupBy("doc_id")
        .agg(F.min("lang").alias("lang"), F.min("_rank").alias("_rank"))
    )
    chosen = stored(chosen, "language-ids")
    texts = known.select("doc_id", "text").join(chosen, "doc_id")
    texts = texts.groupBy("doc_id").agg(
        F.first("lang").alias("lang"), F.first("_rank").alias("_rank"), F.first("text").alias("text")
    )
    texts = stored(texts, "language-sample")

    def take_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(x, g) for x, g in zip(batch.column(0).to_pylist(), map(grams, text_bytes(batch.column(1))), strict=True) if g is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.string()), pa.array([g.tolist() for _, g in found], pa.list_(pa.int64()))],
                names=["lang", "grams"],
            )

    first = texts.where(F.col("_rank") <= landmarks).select("lang", "text")
    rows = first.mapInArrow(take_grams, "lang string, grams array<long>").collect()
    rows = sorted((r.lang, r.grams) for r in rows)
    own = [np.array(g, np.int64) for _, g in rows]
    model = Model(own, sorted({lang for lang, _ in rows}))
    if not rows:
        return model

    def take_kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(x, g) for x, g in zip(batch.column(0).to_pylist(), map(grams, text_bytes(batch.column(1))), strict=True) if g is not None]
            for start in range(0, len(found), BATCH):
                part = found[start : start + BATCH]
                kernel = model.kernel([g for _, g in part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in part], pa.string()), pa.array(kernel.tolist(), pa.list_(pa.float32()))],
                    names=["lang", "kernel"],
                )

    wanted = texts.where(F.col("lang").isin(model.languages)).select("lang", "text")
    rows = wanted.mapInArrow(take_kernels, "lang string, kernel array<float>").collect()
    rows = sorted((r.lang, r.kernel) for r in rows)
    model.fit(own, np.array([k for _, k in rows], np.float32), [lang for lang, _ in rows])
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text", names=("lang_pred", "score")) -> DataFrame:
    """All columns of `docs` with the predicted language and its score.

    Null texts and texts without a letter are `und` with score 0; so is everything if nothing
    was learned. Repeated rows give repeated rows and an empty table an empty result. `names`
    must be free in `docs`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]

    def compute(texts: list[bytes | None]) -> list[pa.Array]:
        languages, scores = shared.value.predict(texts)
        return [pa.array(languages, pa.string()), pa.array(scores)]

    return add_from_text(docs, text_col, fields, compute)


def identified(docs: DataFrame, least: float = 0.1) -> DataFrame:
    """The rows of `docs` (with `doc_id`, `text`, `lang`) that are in a learned language.

    The model learns from all of `docs`. Texts without a letter, and those whose best score is
    under `least`, are left out.
    """
    names = [free_name(docs.columns, "_lang_pred"), free_name(docs.columns, "_lang_score")]
    model = train(docs.select("doc_id", "text", "lang"))
    found = identify(docs, model, names=names)
    return found.where((F.col(names[0]) != UNDETERMINED) & (F.col(names[1]) >= least)).drop(*names)


@register()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_fold(F.col("doc_id"), 4) == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    model = train(docs.where(~F.col("held_out")))
    return identify(docs.select("doc_id", "text", "held_out"), model).drop("text")
