"""Payload forms: typed and level-by-level parses, odd values, broken text."""

import json

import pytest
from pyspark.sql import functions as F

from raterscope.functions import payload


def run(spark, function, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, raw string")
    out = df.select("i", function(F.col("raw")).alias("v")).orderBy("i").collect()
    return [r.v for r in out]


def nested(entity) -> str:
    return json.dumps({"is_rejected": False, "response": json.dumps(entity)})


CASES = [
    ('{"decision_string": "x", "labels": ["a::1", "b::2"]}', ["a::1", "b::2"]),
    ("{'decision_string': 'x'; 'labels': ['a::1'; 'b::2']}", ["a::1", "b::2"]),
    ('{"decision_string": "x"}', []),
    ('{"decision_string": "x", "labels": "none"}', []),
    ('{"decision_string": "x", "labels": ["a::1"', None),
    ('{"labels": ["a::1"], "decision_string": "x"}', None),
    ("{bad", None),
    ("", None),
    (None, None),
    ("[1]", None),
    ('{"is_rejected": true, "response": null}', []),
    ('{"is_rejected": true, "response": ""}', []),
    ('{"is_rejected": true, "response": "null"}', []),
    ('{"is_rejected": true, "response": "{bad"}', None),
    (nested({"e": {"payload": [{"values": {"a": "1", "b": "x y"}}]}}), ["a::1", "b::x y"]),
    (nested({"e": {"payload": [{"values": {"a": "1"}}, {"values": {"b": "2"}}]}}), ["a::1", "b::2"]),
    (nested({"e": {"payload": {"values": {"a": "1"}}}}), ["a::1"]),
    (nested({"e": {"payload": [{"values": {"a": "1"}}, {"other": 1}, 7]}}), ["a::1"]),
    (nested({"e": {"payload": []}}), []),
    (nested({"e": {}}), []),
    (nested({"e": {"payload": [{"values": {"a": True, "b": "true", "c": None, "d": 1.0}}]}}),
     ["a::True", "b::true", "c::", "d::1.0"]),
    (nested({"e": {"payload": [{"values": {"a": ["x ", "y"], "b": "[x]"}}]}}), ["a::x,y", "b::[x]"]),
    (nested({"e": {"payload": [{"values": {"a": "  two\n lines "}}]}}), ["a::two lines"]),
]


def test_decision_labels(spark):
    got = run(spark, payload.decision_labels, [c[0] for c in CASES])
    for (text, want), value in zip(CASES, got):
        assert value == want, text


def test_auditor_keyed(spark):
    texts = [
        '{"123": "{\\"labels\\": [\\"a::1\\"]}"}',
        '{"someone": "{\\"labels\\": [\\"a::1\\"]}"}',
        '{"123": "{bad"}',
        '{"123": "{}"}',
        "{bad",
        None,
    ]
    got = run(spark, payload.auditor_keyed_labels, texts)
    assert [v and (v.auditor_id, v.labels) for v in got] == [("123", ["a::1"])] + [None] * 5


def test_first_value_of_a_key_wins(spark):
    df = spark.createDataFrame([(["a::1", " a ::2", "b", "c::x::y", "skip::1"],)], "labels array<string>")
    entries = df.select(payload.label_entries(F.col("labels"), ["skip"]).alias("e")).first().e
    assert [(x.key, x.value) for x in entries] == [("a", "1"), ("c", "x::y")]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("", {}),
        ("{bad", {}),
        (None, {}),
        ('[{"question": "Q", "answer": "[\\"Yes\\",\\"No\\",\\"Yes\\"]"}]', {"Q": 2}),
        ('[{"question": "Q", "answer": "[\'Yes\']"}, {"answer": "x"}]', {"Q": 1}),
        ('[{"question": "Q", "answer": "[]"}, {"question": "Q", "answer": "[\\"Yes\\"]"}]', {"Q": 1}),
        ('[{"question": "Q"}]', {"Q": 0}),
    ],
)
def test_rubric_answers(spark, raw, want):
    assert run(spark, payload.rubric_answers, [raw]) == [want]


USUAL = [
    (payload.decision_labels, "_LIST_FORM", '{"decision_string": "x", "labels": ["a::1", "", "b :: é"]}', ["a::1", "", "b :: é"]),
    (payload.decision_labels, "_LIST_FORM", "{'decision_string':'';'labels':['a::1','b::{}']}", ["a::1", "b::{}"]),
    (payload.listed_labels, "_LIST_FORM", "{'decision_string': 'x'; 'labels': ['a::1'; 'b::2']}", ["a::1", "b::2"]),
    (payload.decision_labels, "_NESTED_FORM", nested({"e": {"payload": [{"values": {"a": "1", "b": "", "c": "x:y z"}}]}}),
     ["a::1", "b::", "c::x:y z"]),
    (payload.decision_labels, "_NESTED_FORM", nested({"e": {"payload": [{"values": {"a": ":"}}, {"values": {"a": "2"}}]}}), ["a:::", "a::2"]),
    (payload.auditor_keyed_labels, "_KEYED_FORM", '{"123": "{\\"labels\\": [\\"a::1\\", \\"\\"]}"}', ("123", ["a::1", ""])),
]


@pytest.mark.parametrize(("function", "form", "text", "want"), USUAL)
def test_usual_spellings_need_no_parse(spark, function, form, text, want):
    df = spark.createDataFrame([(text,), (text[:-1] + ' , "more": 1}',)], "raw string")
    fits = F.regexp_extract("raw", getattr(payload, form), 1) != ""
    # with a further key the same labels are parsed; an object keyed by ids takes the first
    got = [(r.fits, tuple(r.v) if isinstance(want, tuple) else r.v) for r in df.select(fits.alias("fits"), function(F.col("raw")).alias("v")).collect()]
    assert got == [(True, want), (False, want)]


def test_texts_that_only_look_usual_are_parsed(spark):
    texts = [
        '{"decision_string": "x", "labels": ["a::\\u0041", "b::\\"q\\""]}',
        "{'decision_string': 'x'; 'labels': ['a::it;s']}",
        '{"decision_string": "x", "labels": ["a::1" "b"]}',
        '{"decision_string": "x", "labels": ["a::1\n"]}',
        nested({"e": {"payload": [{"values": {"a": "true"}}]}}),
        nested({"e": {"payload": [{"values": {"a": " x"}}]}}),
    ]
    got = run(spark, payload.decision_labels, texts)
    assert got == [["a::A", 'b::"q"'], ["a::it,s"], None, None, ["a::true"], ["a::x"]]
