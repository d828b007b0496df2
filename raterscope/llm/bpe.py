"""BPE encoding and decoding over a table of distinct words.

Texts are split into words at white space, which no token crosses, so a word's ids do not
depend on its neighbours. Documents are packed into blocks of a bounded size; a block keeps
its documents as positions in its own list of distinct words, and hands that list on in
parts by the word's hash. All blocks' words of one part meet in one task, which encodes each
distinct word once and answers each block in the order it asked. Blocks lie in a table that is
bucketed by block, so only words and answers are shuffled; answers join the block by position. Rows that are shuffled grow with the distinct words of blocks, not with the
words. Decoding joins ids to the id-to-piece table, whose size the vocabulary bounds.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raterscope.llm.common import register, table, text_bytes
from raterscope.session import scratch_path

BLOCK_BYTES = 16 << 20  # of text; a longer text is a block of its own
LEAST_PARTS = 64
MAX_VOCABULARY = 1 << 21
DOCUMENTS = -1  # the part that holds a block's documents
PACKED = "block long, part int, payload binary"


def _shrink(*arrays: np.ndarray) -> bytes:
    """Arrays of 32-bit numbers, their bytes grouped by significance, compressed."""
    head = np.array([len(arrays), *map(len, arrays)], "<u4").tobytes()
    body = b"".join(np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + body)


def _grow(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    count = int(np.frombuffer(raw, "<u4", 1)[0])
    sizes = np.frombuffer(raw, "<u4", count, 4)
    out, at = [], 4 + 4 * count
    for n in map(int, sizes):
        planes = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
        at += 4 * n
    return out


def _ids_to_bytes(column: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([column], names=["id"])
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _ids_from_bytes(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_all().column(0).combine_chunks()


class _Packer:
    """Gathers documents until the block is full, then gives its rows."""

    def __init__(self, parts: int):
        self.parts, self.number = parts, 0
        self.clear()

    def clear(self) -> None:
        self.words: dict[bytes, int] = {}
        self.ids: list[pa.Array] = []
        self.counts: list[int] = []
        self.places: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes | None) -> None:
        words, index = (text or b"").split(), self.words
        self.places.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.uint32, len(words)))
        self.counts.append(len(words))
        self.size += len(text or b"")

    def rows(self, ids: pa.Array) -> pa.RecordBatch:
        """One row of documents, one for each part that has words.

        Words are numbered by falling frequency, which keeps the positions small; the list of
        parts in that order tells where the answer to a number is found.
        """
        places = np.concatenate(self.places) if self.places else np.zeros(0, np.uint32)
        words = list(self.words)
        order = np.argsort(-np.bincount(places, minlength=len(words)), kind="stable")
        number = np.empty(len(words), np.uint32)
        number[order] = np.arange(len(words), dtype=np.uint32)
        words = [words[i] for i in order]
        part_of = np.fromiter((zlib.crc32(w) % self.parts for w in words), np.uint32, len(words))
        ids_data = _ids_to_bytes(ids)
        numbers = _shrink(np.array(self.counts, np.uint32), number[places], part_of)
        payloads = [len(ids_data).to_bytes(8, "little") + ids_data + numbers]
        found = [DOCUMENTS]
        by_part = np.argsort(part_of, kind="stable")
        cuts = np.searchsorted(part_of[by_part], np.arange(self.parts + 1))
        press = zstandard.ZstdCompressor(level=3)
        for part in range(self.parts):
            if cuts[part] < cuts[part + 1]:
                own = b" ".join([words[i] for i in by_part[cuts[part] : cuts[part + 1]]])
                payloads.append(press.compress(own))
                found.append(part)
        block = (TaskContext.get().partitionId() << 32) + self.number
        self.number += 1
        self.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * len(found), pa.int64()), pa.array(found, pa.int32()), pa.array(payloads, pa.binary())],
            names=["block", "part", "payload"],
        )


def pack(docs: DataFrame, id_col: str, text_col: str, parts: int, buckets: int) -> DataFrame:
    """Blocks of documents and their distinct words, written once, so that block numbers hold.

    The table is bucketed by block in the shared folder.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, pending = _Packer(parts), []
        for batch in batches:
            start = 0
            for row, text in enumerate(text_bytes(batch.column(1))):
                packer.add(text)
                if packer.size >= BLOCK_BYTES:
                    pending.append(batch.column(0).slice(start, row + 1 - start))
                    yield packer.rows(pa.concat_arrays(pending))
                    pending, start = [], row + 1
            if start < batch.num_rows:
                pending.append(batch.column(0).slice(start))
        if pending:
            yield packer.rows(pa.concat_arrays(pending))

    source = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    name = f"bpe_blocks_{uuid.uuid4().hex}"
    rows = source.mapInArrow(run, PACKED).withColumn("kind", F.least("part", F.lit(0)))
    path = scratch_path(docs.sparkSession, name)
    rows.write.bucketBy(buckets, "block").partitionBy("kind").option("path", path).saveAsTable(name)
    return docs.sparkSession.table(name)


def load(path: str):
    """The tokenizer of a file, checked for words that encode alone as they do in a text."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        definition = file.read()
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    if encode("one  two\n3's") != encode("one") + encode("two") + encode("3's"):
        raise ValueError("a token of this vocabulary may cross white space")
    if tokenizer.get_vocab_size() > MAX_VOCABULARY:
        raise ValueError("the vocabulary is too large for an id-to-piece table in memory")
    return tokenizer


def _answers(packed: DataFrame, definition: str) -> DataFrame:
    """For each block and part, the ids of the words it asked for, in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        opened = zstandard.ZstdDecompressor()
        part, known, ids = None, {}, []
        for batch in batches:
            blocks, parts, payloads = [], [], []
            for block, own, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != part:  # rows come sorted by part
                    part, known, ids = own, {}, []
                words = opened.decompress(payload).split(b" ")
                new = [w for w in words if w not in known]
                encoded = tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
                for word, found in zip(new, encoded, strict=True):
                    known[word] = len(ids)
                    ids.append(found.ids)
                asked = [ids[known[w]] for w in words]
                counts = np.fromiter(map(len, asked), np.uint32, len(asked))
                flat = np.fromiter((i for x in asked for i in x), np.uint32, int(counts.sum()))
                blocks.append(block)
                parts.append(own)
                payloads.append(_shrink(counts, flat))
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(parts, pa.int32()), pa.array(payloads, pa.binary())],
                names=["block", "part", "payload"],
            )

    n = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = packed.where(F.col("kind") != DOCUMENTS).select("block", "part", "payload")
    return asked.repartition(n, "part").sortWithinPartitions("part").mapInArrow(run, PACKED)


def _assemble(documents: bytes, answers: list[bytes], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """`id` and `ids` of one block's documents, from what it packed and the answers by part."""
    head = int.from_bytes(documents[:8], "little")
    keys = _ids_from_bytes(documents[8 : 8 + head])
    counts, places, part_of = _grow(documents[8 + head :])
    pieces = [_grow(data) for data in answers]
    sizes = np.concatenate([p[0] for p in pieces] or [np.zeros(0, "<u4")]).astype(np.int64)
    flat = np.concatenate([p[1] for p in pieces] or [np.zeros(0, "<u4")]).astype(np.int32)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    # answers come part by part, in each part by the words' numbers
    answer_of = np.empty(len(part_of), np.int64)
    answer_of[np.argsort(part_of, kind="stable")] = np.arange(len(part_of))
    sizes, first = sizes[answer_of], first[answer_of]
    ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    step = 256
    for low in range(0, len(keys), step):
        high = min(low + step, len(keys))
        own = places[ends[low] : ends[high]]
        lengths = sizes[own]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        source = np.repeat(first[own] - offsets[:-1], lengths) + np.arange(offsets[-1])
        lists = pa.ListArray.from_arrays(
            pa.array(offsets[ends[low : high + 1] - ends[low]].astype(np.int32)), pa.array(flat[source], pa.int32())
        )
        yield pa.RecordBatch.from_arrays([keys.slice(low, high - low).cast(id_type), lists], names=["id", "ids"])


def encoded_blocks(
    docs: DataFrame, path: str, id_col: str, text_col: str, fields: list[T.StructField], made
) -> DataFrame:
    """The id column and `fields`, which `made` gives for each batch of token lists."""
    spark = docs.sparkSession
    definition = load(path).to_str()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = pack(docs, id_col, text_col, max(LEAST_PARTS, n), n)
    key = docs.select(id_col).schema[0]
    schema = T.StructType([T.StructField(id_col, key.dataType), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        id_type = to_arrow_type(key.dataType)
        for batch in batches:
            for row in range(batch.num_rows):
                answers = batch.column(1)[row].as_py() or []
                for found in _assemble(batch.column(0)[row].as_py(), [a["payload"] for a in answers], id_type):
                    yield pa.RecordBatch.from_arrays([found.column(0), *made(found.column(1))], names=schema.names)

    # a block gets one answer of each part at most
    answers = _answers(packed, definition).groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("part", "payload"))).alias("answers")
    )
    blocks = packed.where(F.col("kind") == DOCUMENTS).select("block", "payload").join(answers, "block", "left")
    return blocks.select("payload", "answers").mapInArrow(run, schema)


IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and `ids`, the tokens of each whole text, as the tokenizers library has them.

    Null and empty texts and those of white space only have no ids. Repeated rows give
    repeated rows; null ids stay null; an empty table gives an empty result. Other columns of
    `docs` are not read. No special tokens are added, those written in a text are recognised.
    """
    return encoded_blocks(docs, path, id_col, text_col, [IDS], lambda lists: [lists])


def _id_to_piece(path: str) -> list[str | None]:
    """The pieces of a vocabulary by id: one row per entry, at most MAX_VOCABULARY."""
    tokenizer = load(path)
    if tokenizer.decoder is not None:
        raise ValueError("this vocabulary has a decoder of its own")
    return [tokenizer.id_to_token(i) for i in range(max(tokenizer.get_vocab(True).values()) + 1)]


def _decoded(lists: pa.Array, id_to_piece: np.ndarray) -> list[str | None]:
    """Join ids to their pieces by position; the last entry stands for unknown ids."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    last = len(id_to_piece) - 1
    flat = np.where((flat < 0) | (flat >= last), last, flat)
    out = []
    for start, end, known in zip(*_bounds(lists), lists.is_valid().to_pylist(), strict=True):
        own = id_to_piece[flat[start:end]].tolist()
        out.append(" ".join([x for x in own if x is not None] if None in own else own) if known else None)
    return out


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of `encoded` and `decoded`: the pieces of its `ids`, joined by one space.

    The id-to-piece table goes to every task, where ids take their pieces by position. Null
    `ids` decode to a null, ids that the vocabulary lacks to nothing.
    """
    pieces = encoded.sparkSession.sparkContext.broadcast(_id_to_piece(path))
    names = [*encoded.columns, "decoded"]
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_to_piece = np.array([*pieces.value, None], object)
        for batch in batches:
            texts = pa.array(_decoded(batch.column(at), id_to_piece), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=names)

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def _bounds(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each list among the flattened values; nulls hold none."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def digests(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, the number of tokens, and the SHA-256 of ids and of the text decoded from them.

    Ids and texts are digested where they are made, so that neither leaves its task.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(_id_to_piece(path))
    fields = [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    tables: list[np.ndarray] = []

    def made(lists: pa.Array) -> list[pa.Array]:
        if not tables:  # once in each task
            tables.append(np.array([*pieces.value, None], object))
            tables.append(np.array([str(i) for i in range(len(pieces.value))], object))
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        texts = [sha(t) for t in _decoded(lists, tables[0])]
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts, ends = _bounds(lists)
        ids = [sha(" ".join(tables[1][flat[a:b]].tolist())) for a, b in zip(starts, ends, strict=True)]
        return [pa.array(ends - starts), pa.array(ids, pa.string()), pa.array(texts, pa.string())]

    return encoded_blocks(docs, path, "doc_id", "text", fields, made)


def public_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register()
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), public_path())
