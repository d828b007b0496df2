"""From documents to token digests: language, quality, near duplicates, mix, encoding.

Each stage gets what its predecessor kept, as a Parquet table, and all but the last return the
columns of documents. The mix repeats a document's row as often as it takes the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raterscope.llm import bpe, language_id, mixing, quality_classifier, simhash
from raterscope.llm.common import table
from raterscope.session import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the documents' own labels teach."""
    return language_id.identified(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality reaches the threshold."""
    return quality_classifier.good_documents(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near duplicates by SimHash."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.repeat(mixing.mix(docs, mixing.text_quality(F.col("text"))))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each remaining row."""
    return bpe.digests(docs, bpe.public_path())


STAGES = [
    ("language_id", known_language),
    ("quality_classifier", good_quality),
    ("simhash", one_of_each),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: The classifiers and the tokenizer cannot be written in SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
