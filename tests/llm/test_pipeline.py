"""Each stage against a plain version of its rule on what the stage before it kept."""

import hashlib

import corpus_pipeline as P
from raterscope.llm import bpe, language_id, quality_classifier
from raterscope.llm.common import table
from tests.llm.cases import documents, empty
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_stages_one_by_one(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    model = language_id.train(docs)
    expect = {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or "")) and model.predict([r.text.encode()])[1][0] >= 0.1}
    first = P.known_language(spark, docs, sf).cache()
    assert first.columns == columns and {r.doc_id for r in first.collect()} == expect

    second = P.good_quality(spark, first, sf).cache()
    vectors = quality_classifier.word_vectors(quality_classifier.context_sums(first))
    network = quality_classifier.train(first, table(spark, sf, "labels"), vectors)
    rows = quality_classifier.WordRows()
    expect = {r.doc_id for r in first.collect() if network.probabilities(quality_classifier.pooled([(r.text or "").encode()], vectors, rows))[0] >= 0.3}
    assert second.columns == columns and {r.doc_id for r in second.collect()} == expect
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    clean = [r.doc_id for r in first.collect() if labels.get(r.doc_id) == 1]
    assert sum(i in expect for i in clean) >= 0.97 * len(clean)

    third = P.one_of_each(spark, second, sf).cache()
    before = second.collect()
    roots = brute_components([brute_fingerprint(r.text) for r in before], [r.doc_id for r in before])
    assert third.columns == columns and sorted(r.doc_id for r in third.collect()) == sorted(set(roots))

    fourth = P.mixed(spark, third, sf).cache()
    assert fourth.columns == columns
    size = lambda r: len((r.text or "").encode().split())
    words = sum(map(size, third.collect()))
    assert abs(sum(map(size, fourth.collect())) - 1.5 * words) < 0.1 * words
    times = [r["count"] for r in fourth.groupBy("doc_id").count().collect()]
    assert max(times) <= 2

    tokenizer = bpe.load(bpe.public_path())
    expect = []
    for r in fourth.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        expect.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    found = P.encoded(spark, fourth, sf).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in found) == sorted(expect)


def test_odd_documents_pass_through(spark, sf):
    for docs in (documents(spark), empty(spark)):
        for _, stage in P.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert set(docs.columns) >= {"doc_id", "text", "lang", "source", "n_chars"}
        P.encoded(spark, docs, sf).collect()
