import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from raterscope.llm import bpe
from tests.llm.cases import documents, empty

PATH = bpe.public_path()


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.mark.parametrize("size", [16 << 20, 500])
def test_equal_to_the_library(spark, sf, library, monkeypatch, size):
    """Small blocks cut every table into many; ids and decoded texts must not change."""
    monkeypatch.setattr(bpe, "BLOCK_BYTES", size)
    odd = spark.createDataFrame([(i, t) for i, t in enumerate([
        "a<|endoftext|>b <|startoftext|>", "I'LL it's 'S", "x\x1cy\x85z w", "ΑΣ ΣΑΣ İ", "é ́a 12三", "\u0000 ퟿", "🙂🙂 #!?",
    ])], "doc_id long, text string")
    for docs in (documents(spark).select("doc_id", "text"), odd, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")):
        keyed = docs.select(F.struct("doc_id", "text").alias("key"), "text").select(F.to_json("key").alias("doc_id"), "text")
        texts = [(r.doc_id, r.text or "") for r in keyed.collect()]
        found = sorted((r.doc_id, r.ids, r.decoded) for r in bpe.decode(bpe.encode(keyed, PATH), PATH).collect())
        ids = [library.encode(t, add_special_tokens=False).ids for _, t in texts]
        wanted = sorted((k, i, library.decode(i, skip_special_tokens=False)) for (k, _), i in zip(texts, ids, strict=True))
        assert found == wanted


def test_null_ids_empty_table_and_unknown_tokens(spark):
    found = bpe.digests(documents(spark), PATH)
    assert found.where("doc_id is null").count() == 2
    assert found.where("n_tokens = 0").select("ids_sha256").distinct().collect()[0][0].startswith("e3b0c44298fc")
    assert bpe.digests(empty(spark), PATH).count() == 0
    odd = spark.createDataFrame([([0, 10**6, -1],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, PATH).collect()] == ["!", None, ""]


def test_tokenizers_that_cross_white_space_are_refused():
    with pytest.raises(ValueError):
        bpe.load(bpe.public_path("byte_bpe_50k.json"))
