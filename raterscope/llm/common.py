"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The white space that ends a word: code points 0x20 and 0x09 to 0x0D, as bytes.split() has it.
WORD = "[^\\x20\\x09-\\x0D]+"


def register(sql: str | None = None):
    """Register a query under its function's name, with its SQL where SQL can express it."""

    def add(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLE[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(taken: list[str], name: str) -> str:
    """`name`, or with underscores before it until no column has it (case is ignored)."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo `folds`; null ids give null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)).cast("int")


def hash_unit(*cols: Column, seed: int) -> Column:
    """A uniform number in (0, 1) that depends on the values and the seed only."""
    top = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11)
    return (top.cast("double") + 0.5) / float(1 << 53)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 of each text; nulls stay None."""
    return column.cast(pa.large_binary()).to_pylist()


def add_from_text(
    docs: DataFrame,
    text_col: str,
    fields: list[T.StructField],
    compute: Callable[[list[bytes | None]], list[pa.Array]],
) -> DataFrame:
    """All columns of `docs` and those that `compute` makes of each Arrow batch of texts.

    `fields` must not clash with columns of `docs` (see `free_name`).
    """
    position = docs.columns.index(text_col)
    names = docs.columns + [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(text_bytes(batch.column(position)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))
