import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from raterscope.llm import fill_middle as M
from raterscope.llm.queries import ORACLE, QUERIES
from tests.llm.cases import TEXTS, documents, empty, own_values

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, sentinels=("<P>", "<S>", "<M>"), rate=50, spm_rate=80):
    """n, form, prefix_chars, middle_chars, output by one regular expression."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(s in text for s in sentinels) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = sentinels
    if h[3] % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return n, "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


def random_text(draw, length):
    letters = draw.choice(["ab  \n", "aé漢😀 \t", "   \x0b", "abcdef", "x <P>"])
    return "".join(draw.choice(letters) for _ in range(length))


@pytest.mark.parametrize("seed", range(4))
def test_every_cut_of_chunked_texts(monkeypatch, seed):
    """Chunks of a few bytes, cut inside words, white space and code points."""
    for name, value in (("MEAN_CHUNK", 4), ("LEAST_CHUNK", 1 + seed % 2), ("MOST_CHUNK", 6 + seed), ("PIECE", 16), ("WINDOW", 8)):
        monkeypatch.setattr(M, name, value)
    draw = random.Random(seed)
    gears, summaries = M._gears(), M.Summaries(200)
    for _ in range(300):
        text = random_text(draw, draw.randrange(60))
        units = UNIT.findall(text)
        made = M.Text(text.encode(), gears, summaries)
        assert made.n == len(units)
        for n in range(len(units) + 1):
            assert made.chars_before(n) == len("".join(units[:n])), (text, n)
    assert summaries.hits and summaries.n_bytes <= 200


def test_chunks_depend_on_content_and_cover_the_text():
    draw = random.Random(7)
    shared = "".join(draw.choice("abcdefgh \n") for _ in range(40_000)).encode()
    gears = M._gears()
    chunks = []
    for start in (b"", b"another beginning, of some length. " * 50):
        text = start + shared
        ends = M.chunk_ends(text, gears)
        assert ends[-1] == len(text) and ends == sorted(set(ends))
        sizes = [b - a for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        assert max(sizes) <= M.MOST_CHUNK and min(sizes[:-1]) >= M.LEAST_CHUNK
        chunks.append({text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)})
    assert len(chunks[0] & chunks[1]) > 0.8 * len(chunks[0])
    summaries = M.Summaries()
    M.Text(shared, gears, summaries)
    M.Text(b"another beginning" + shared, gears, summaries)
    assert summaries.hits > 0.8 * summaries.misses


def test_pieces_give_the_same_chunks(monkeypatch):
    draw = random.Random(8)
    text = "".join(draw.choice("abc d") for _ in range(30_000)).encode()
    gears = M._gears()
    whole = M.chunk_ends(text, gears)
    monkeypatch.setattr(M, "PIECE", 777)
    assert M.chunk_ends(text, gears) == whole


def test_odd_documents(spark):
    docs = documents(spark)
    out = M.fill_in_middle(docs, rate=100)
    rows = out.withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    wanted = sorted((repr((i, *brute(i, t, rate=100), t or "")) for i, t, _, _ in TEXTS))
    assert sorted(repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back)) for r in rows) == wanted
    assert own_values(out, ("n", "form", "output"))
    assert M.fill_in_middle(empty(spark)).collect() == []
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<a<", "<S>", "<M>")):
        with pytest.raises(ValueError):
            M.fill_in_middle(docs, sentinels=bad)


def test_other_sentinels_and_texts_that_end_like_one(spark):
    texts = [(i, t) for i, t in enumerate(["a |p b |s| c", "x | |p y", "|m| z", "end |", "p| s| m| a b c d"] * 4)]
    own = ("|p!", "|s!", "|m!")
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = M.fill_in_middle(df, rate=100, sentinels=own).withColumn("back", M.restored(F.col("output"), F.col("form"), own)).collect()
    assert all(r.back == r.text for r in rows)
    assert sorted((r.doc_id, r.output) for r in rows) == sorted((i, brute(i, t, own, 100)[4]) for i, t in texts)


def test_query_equals_plain_version(spark, sf):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    wanted = []
    for r in docs:
        made = brute(r.doc_id, r.text)
        wanted.append((r.doc_id, *made[:4], sha(made[4]), sha(r.text or "")))
    assert sorted(map(tuple, QUERIES["op12_fill_middle"](spark, sf).collect())) == sorted(wanted)
    assert len({w[2] for w in wanted}) == 3


def test_query_equals_sql(spark, sf):
    assert compare(QUERIES["op12_fill_middle"](spark, sf), connect(sf), ORACLE["op12_fill_middle"]) == []
