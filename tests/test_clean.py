"""Cleaning expressions on hand-made values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from raterscope.functions import clean
from raterscope.operators import rubric as rb
from raterscope.plans import layouts
from raterscope.plans import layouts_labels as ll


def values(spark, function, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, raw string")
    return [r.v for r in df.select("i", function(F.col("raw")).alias("v")).orderBy("i").collect()]


def check(spark, function, cases):
    got = values(spark, function, list(cases))
    assert dict(zip(cases, got)) == cases


def test_dates(spark):
    day = date(2025, 3, 4)
    check(spark, clean.lenient_date, {
        "2025-03-04": day, "2025/3/4": day, "2025-03-04T10:00:00Z": day, "3/4/2025": day,
        "20250304": day, "March 4, 2025": day, "4 Mar 2025 10:30": day, "Tue, Mar 4 2025": day,
        "45720": day, "45720.9": day, "31/12/2024": date(2024, 12, 31), "2025-02-30": None,
        "soon": None, "": None, None: None, "12": None,
    })


def test_content_week(spark):
    df = spark.sql("select explode(sequence(date'2025-07-01', date'2025-07-08')) as d")
    got = [r.w for r in df.select(clean.content_week(F.col("d")).alias("w")).collect()]
    assert got == [date(2025, 7, 4)] * 4 + [date(2025, 7, 11)] * 4


def test_ids(spark):
    check(spark, clean.valid_id, {
        "12345678901": "12345678901", " 12345678901 ": "12345678901", "1234567890": None,
        "1.2E+13": None, "'12345678901": None, "": None, None: None,
    })
    assert values(spark, lambda c: clean.valid_id(c, True), ["'12345678901'"]) == ["12345678901"]


def test_targets_and_penalties(spark):
    check(spark, clean.normalize_target, {"85%": 0.85, "0.85": 0.85, "85": 0.85, " 90% ": 0.9, "x": None, None: None})
    check(spark, clean.normalize_penalty, {"25": 0.25, "25%": 0.25, "0,5": 0.5, "-1": -1.0, "-100": -100.0, "": None})


def test_text(spark):
    check(spark, clean.clean_text, {
        " a\r\nb\tc  d ": "a b c d", '"quoted"': "quoted", "'x": "'x", "‎a\u0007": "a", None: "", '""': "",
        "\"": "\"",
    })
    check(spark, clean.sanitize_text, {"a\r\nb\rc\u0000": "a\nb\nc", None: ""})
    check(spark, clean.slug, {"Tone / Style-2": "tone_style_2", " (A) ": "a", "__x": "x"})


def test_boolish(spark):
    check(spark, clean.boolish, {
        "YES": True, " n ": False, "2,5": True, "0": False, "": None, None: None, "maybe": None, "1d": None,
    })


def test_preprocess_order_and_groups(spark):
    df = spark.createDataFrame([("a.1$",)], "old string")
    out = clean.preprocess(df, {
        "replace_regex": [{"pattern": r"(\d)\$", "replace": r"<\1>$", "columns": ["new"]}],
        "replace_strings": [{"find": ".", "replace": "-", "columns": ["new", "absent"]}],
        "rename_columns": [{"from": "old", "to": "new"}],
    })
    assert out.first().new == "a-<1>$"


def test_map_columns_requires_roles(spark):
    df = spark.createDataFrame([("1",)], "actor_id string")
    with pytest.raises(ValueError, match="auditor_id"):
        clean.map_columns(df, ll.LONG_AUDIT_RULES)


def test_registry():
    with pytest.raises(ValueError):
        layouts.find(None)
    with pytest.raises(ValueError):
        layouts.find("OTHER")
    with pytest.raises(ValueError):
        layouts.find("ADHOC", "p9")
    layouts.register("ADHOC", lambda df, config: df, project_id="p9")
    assert layouts.find("ADHOC", "p9")


def test_configured_outcome_and_errors(spark):
    df = spark.createDataFrame(
        [("12345678901", "22345678901", "32345678901", "TRUE"), ("12345678901", "22345678901", "42345678901", "")],
        "r string, a string, j string, ok string",
    )
    config = {
        "quality_methodology": "outcome", "outcome_column": "ok", "positive_outcome": "true",
        "info_columns": {"rater_id_column": "r", "auditor_id_column": "a", "job_id_column": "j"},
        "reporting_week": "2025-07-04",
    }
    out = ll.normalize_by_config(df, config).collect()
    assert [(r.job_id, r.job_correct, r.factor, r.rubric_penalty) for r in out] == [("32345678901", True, 1, -1.0)]
    kept = ll.normalize_by_config(df, {**config, "discard_if_empty": False})
    assert kept.where("not job_correct").count() == 1
    with pytest.raises(ValueError):
        ll.normalize_by_config(df, {"quality_methodology": "multi"})


def test_rubric_inference_needs_two_rounds_and_keeps_seeds(spark):
    records = spark.createDataFrame(
        [
            (1, [("a", 1.0)], 90.0), (2, [("a", 1.0), ("b", 2.0)], 50.0), (3, [("b", 1.0), ("c", 1.0)], 75.0),
            (4, [("x", 1.0), ("y", 1.0)], 10.0), (5, [("z", 0.0)], 90.0), (6, [("a", 1.0)], 80.0), (7, [("b", 1.0)], None),
        ],
        "row_id int, items array<struct<entry:string,factor:double>>, score double",
    )
    got = {r.entry: r.penalty for r in rb.infer_penalties(records).collect()}
    assert got == {"a": 10.0, "b": 20.0, "c": 5.0}  # row 1 wins over row 6; x, y stay open
    seeded = {r.entry: r.penalty for r in rb.infer_penalties(records, provided={"a": 30.0}).collect()}
    assert seeded == {"a": 30.0, "b": 10.0, "c": 15.0}


def test_rejects_add_up(spark):
    df = spark.createDataFrame([("1",), (None,), ("x",)], "v string")
    tagged = clean.tag_rejects(df, [("missing", F.col("v").isNull()), ("text", ~F.col("v").rlike(r"^\d+$"))])
    counts = {r.reject_reason: r.row_count for r in clean.reject_stats(tagged).collect()}
    assert counts == {"missing": 1, "text": 1, "accepted": 1}
    assert sum(counts.values()) == df.count()


def test_dates_of_the_common_spelling(spark):
    texts = ["2024-02-29", " 2024-02-29 ", "2023-02-29", "2024-13-01", "0000-01-01", "9999-12-31", "2024-2-9", "2024-02-29T10:00:00"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(clean.lenient_date(F.col("t")).cast("string"))
    assert [r[0] for r in rows.collect()] == ["2024-02-29", "2024-02-29", None, None, "0000-01-01", "9999-12-31", "2024-02-09", "2024-02-29"]


def test_dates_leave_code_that_is_compiled(spark):
    """The JVM never compiles a method of more than 8000 bytes."""
    days = spark.range(3).select(F.array(F.lit("2024/03/05")).alias("day")).select(F.explode("day").alias("day"))
    made = clean.once(days, {"job_date": clean.lenient_date(F.col("day"))})
    stages = made._jdf.queryExecution().debug().codegenToSeq()
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert all(0 <= size < 8000 for size in sizes)


def test_year_first_dates_with_other_marks(spark):
    texts = ["2024/03/05", "2024.03-05", "2024/02/30", "0000/01/01", " 2024/3/5 10:00", "2024/03/05\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    made = clean.once(df, {"d": clean.lenient_date(F.col("t"))}).orderBy("i")
    got = [r.d for r in made.select(F.col("d").cast("string")).collect()]
    assert got == ["2024-03-05", "2024-03-05", None, "0000-01-01", "2024-03-05", None]
