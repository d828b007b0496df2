"""Cleaning steps on raw text columns."""

from pyspark.sql import functions as F

from checks.registry import check
from checks import fixtures as fx
from raterscope.functions import clean
from raterscope.plans import layouts
from raterscope.plans import layouts_labels as ll

# --- replacements and column roles -----------------------------------------------------

PREPROCESS = {
    "rename_columns": [{"from": "queue_name", "to": "workflow"}, {"from": "absent", "to": "x"}],
    "replace_strings": [{"find": "_", "replace": "-", "columns": ["workflow"]}],
    "replace_regex": [{"pattern": r"^(\d{4})[-/](\d{2}).*$", "replace": r"\2.\1", "columns": ["review_ds"]}],
}


@check("""select actor_id, quality_actor_id, job_id, row_pos,
  regexp_replace(review_ds, '^([0-9]{4})[-/]([0-9]{2}).*$', '\\2.\\1') as review_ds,
  replace(queue_name, '_', '-') as workflow from v_payload""")
def preprocess_config(spark, sf):
    rows = clean.preprocess(fx.view(spark, sf, "v_payload"), PREPROCESS)
    return rows.drop("decision_data", "quality_decision_data")


RENAMED = """select cast(10000000000 + l_suppkey as string) as `Who`, cast(20000000000 + l_partkey as string) as reviewer_id,
  l_returnflag as actor_answer, l_linestatus as reviewer_answer, cast(cast(l_shipdate as date) as string) as job_date,
  cast(30000000000 + l_orderkey as string) as job_id, concat('label_', cast(l_linenumber as string)) as label, l_tax as other
from lineitem"""


@check("""select cast(10000000000 + l_suppkey as varchar) as rater_id, cast(20000000000 + l_partkey as varchar) as auditor_id,
  l_returnflag as rater_response, l_linestatus as auditor_response, cast(cast(l_shipdate as date) as varchar) as job_date,
  cast(30000000000 + l_orderkey as varchar) as job_id, 'default_workflow' as workflow,
  concat('label_', cast(l_linenumber as varchar)) as parent_label from lineitem""")
def map_columns(spark, sf):
    rows = fx.query(spark, sf, RENAMED)
    return clean.map_columns(rows, ll.LONG_AUDIT_RULES, {"actor_id_column": "Who"}).drop("other")


# --- dates and weeks ---------------------------------------------------------------------

DAY = "cast(l_shipdate as date)"
Y, M, D = (f"cast({p}({DAY}) as string)" for p in ("year", "month", "day"))
MONTH = f"""case month({DAY}) when 1 then 'January' when 2 then 'February' when 3 then 'March' when 4 then 'April'
  when 5 then 'May' when 6 then 'June' when 7 then 'July' when 8 then 'August' when 9 then 'September'
  when 10 then 'October' when 11 then 'November' else 'December' end"""
# Ten spellings of the ship date, one of them no date.
SPELLED = f"""select l_orderkey, l_linenumber, l_partkey, {DAY} as day, l_partkey % 10 as kind,
  case l_partkey % 10 when 0 then cast({DAY} as string) when 1 then concat({Y}, '/', {M}, '/', {D})
    when 2 then concat({M}, '/', {D}, '/', {Y}, ' 14:05') when 3 then replace(cast({DAY} as string), '-', '')
    when 4 then concat(substr({MONTH}, 1, 3), ' ', {D}, ', ', {Y}) when 5 then concat({D}, ' ', {MONTH}, ' ', {Y})
    when 6 then concat(' ', cast({DAY} as string), 'T23:59:59.001Z ')
    when 7 then cast(DAYS_FROM_EXCEL as string) when 8 then concat(cast(DAYS_FROM_EXCEL as string), '.75')
    else 'soon' end as raw
from lineitem"""


@check(f"""select l_orderkey, l_linenumber, raw, case when kind <> 9 then day end as job_date
from ({SPELLED.replace("DAYS_FROM_EXCEL", f"datediff('day', date '1899-12-30', {DAY})")}) s""")
def lenient_date(spark, sf):
    text = SPELLED.replace("DAYS_FROM_EXCEL", f"datediff({DAY}, date'1899-12-30')")
    rows = fx.query(spark, sf, text)
    return rows.select(
        "l_orderkey", "l_linenumber", "raw", clean.lenient_date(F.col("raw")).alias("job_date")
    )


@check("""select l_orderkey, l_linenumber, cast(l_shipdate as date) as day, FRI(cast(l_shipdate as date)) as content_week
from lineitem""")
def content_week(spark, sf):
    rows = fx.query(spark, sf, "select l_orderkey, l_linenumber, cast(l_shipdate as date) as day from lineitem")
    return rows.withColumn("content_week", clean.content_week(F.col("day")))


@check("select distinct FRI(cast(l_shipdate as date)) as content_week from lineitem")
def distinct_content_weeks(spark, sf):
    rows = fx.query(spark, sf, "select cast(l_shipdate as date) as day from lineitem")
    return clean.distinct_content_weeks(rows, "day")


# --- ids, outcomes, booleans ---------------------------------------------------------------

IDS = """select o_orderkey, case o_custkey % 7 when 0 then '12E9' when 1 then concat(' ', cast(30000000000 + o_orderkey as string), ' ')
    when 2 then concat('''', cast(30000000000 + o_orderkey as string), '''') when 3 then cast(o_orderkey as string)
    when 4 then null when 5 then '1234567890' else cast(30000000000 + o_orderkey as string) end as raw_id,
  o_custkey % 7 as kind from orders"""


@check(f"""select o_orderkey, raw_id, case when kind in (1, 6) then cast(30000000000 + o_orderkey as varchar) end as plain_id,
  case when kind in (1, 2, 6) then cast(30000000000 + o_orderkey as varchar) end as stripped_id,
  case when kind in (1, 6) then cast(30000000000 + o_orderkey as varchar) else '999999999999' end as auditor_id
from ({IDS}) s""")
def valid_id_filter(spark, sf):
    raw = F.col("raw_id")
    return fx.query(spark, sf, IDS).select(
        "o_orderkey", "raw_id",
        clean.valid_id(raw).alias("plain_id"),
        clean.valid_id(raw, strip_apostrophes=True).alias("stripped_id"),
        clean.auditor_or_placeholder(clean.valid_id(raw)).alias("auditor_id"),
    )


BLANKED = """select job_id, row_pos, queue_name as workflow,
  case when row_pos = 1 then '' when row_pos = 2 then null else decision_data end as decision_data from v_payload"""


@check(f"""select job_id, row_pos, workflow, decision_data from ({BLANKED}) s
where coalesce(decision_data, '') <> '' and workflow not in ('queue_1', 'queue_3')""")
def payload_filters(spark, sf):
    rows = fx.query(spark, sf, BLANKED.replace("v_payload", f"({fx.V_PAYLOAD}) p"))
    kept = rows.where(F.coalesce("decision_data", F.lit("")) != "")
    return clean.exclude_values(kept, "workflow", ["queue_1", "queue_3"])


ORGS = """select o_orderkey, cast(10000000000 + o_custkey % 20 as string) as rater_id,
  cast(10000000000 + o_orderkey % 20 as string) as auditor_id,
  case o_custkey % 4 when 0 then 'North Vendor Ltd' when 1 then 'vendor' when 2 then null else 'Other' end as org from orders"""


@check(f"""select * from ({ORGS}) s where org like '%Vendor%' and auditor_id <> rater_id""")
def org_filter(spark, sf):
    return clean.audited_by(fx.query(spark, sf, ORGS), "org", "Vendor")


STATUSES = """select o_orderkey, case o_custkey % 6 when 0 then 'Approved' when 1 then ' Approved ' when 2 then 'approved'
    when 3 then '' when 4 then null else 'Rejected' end as status, o_custkey % 6 as kind,
  case o_orderkey % 5 when 0 then 'n/a' when 1 then '' else cast(o_custkey % 101 as string) end as score,
  o_orderkey % 5 as score_kind, o_custkey % 101 as score_value from orders"""


@check(f"""select o_orderkey, kind in (0, 1) as job_correct, kind in (0, 1, 2) as job_correct_any_case,
  case when score_kind >= 2 then cast(score_value as double) / 100 end as job_manual_score
from ({STATUSES}) s where kind not in (3, 4)""")
def outcome_flag(spark, sf):
    status = F.col("status")
    return (
        fx.query(spark, sf, STATUSES)
        .select(
            "o_orderkey",
            clean.outcome_flag(status, "Approved").alias("job_correct"),
            clean.outcome_flag(status, "Approved", case_sensitive=False).alias("job_correct_any_case"),
            clean.percent_score(F.col("score")).alias("job_manual_score"),
        )
        .where(F.col("job_correct").isNotNull())
    )


WORDS = """select l_orderkey, l_linenumber, l_partkey % 12 as kind, case l_partkey % 12 when 0 then 'Yes' when 1 then ' no ' when 2 then '0'
    when 3 then '2,5' when 4 then '-1' when 5 then '' when 6 then null when 7 then 'maybe' when 8 then 'Agree'
    when 9 then 'incorrect' when 10 then '0,0' else 'T' end as raw from lineitem"""


@check(f"""select l_orderkey, l_linenumber, raw, case when kind in (0, 3, 4, 8, 11) then true
  when kind in (1, 2, 9, 10) then false end as value from ({WORDS}) s""")
def boolish(spark, sf):
    rows = fx.query(spark, sf, WORDS)
    return rows.select("l_orderkey", "l_linenumber", "raw", clean.boolish(F.col("raw")).alias("value"))


@check(f"""with a as (select l_orderkey, l_linenumber, raw, case when kind in (0, 3, 4, 8, 11) then true
    when kind in (1, 2, 9, 10) then false end as yes from ({WORDS}) s)
select l_orderkey, l_linenumber, case when yes then raw end as agreement_response, yes as agreement_outcome,
  case when not coalesce(yes, false) then raw end as disagreement_response, not yes as disagreement_outcome from a""")
def agreement_outcome(spark, sf):
    rows = fx.query(spark, sf, WORDS)
    none = F.lit(None).cast("string")
    agree = ll.answer_columns(none, F.col("raw"), "agreement")
    disagree = ll.answer_columns(none, F.col("raw"), "disagreement")
    return rows.select(
        "l_orderkey", "l_linenumber",
        agree[0].alias("agreement_response"), agree[1].alias("agreement_outcome"),
        disagree[0].alias("disagreement_response"), disagree[1].alias("disagreement_outcome"),
    )


# --- text ------------------------------------------------------------------------------------


@check("""with a as (select doc_id, regexp_replace(regexp_replace(text, '\\r\\n|[\\r\\n\\x{2028}\\x{2029}]', ' ', 'g'),
    '[\\x{200E}\\x{200F}\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g') as t from documents),
b as (select doc_id, trim(regexp_replace(t, '[ \\t\\x{00A0}]+', ' ', 'g')) as t from a)
select doc_id, case when length(t) >= 2 and left(t, 1) = right(t, 1) and left(t, 1) in ('"', '''')
  then trim(t[2:-2]) else t end as text from b""")
def clean_text(spark, sf):
    rows = fx.table(spark, sf, "documents")
    return rows.select("doc_id", clean.clean_text(F.col("text")).alias("text"))


CODED = """select l_orderkey, l_linenumber, case l_partkey % 6 when 0 then 'rating_v1_0_no' when 1 then 'ad_issue'
    when 2 then 'N/A' when 3 then 'free text' when 4 then null else 'can_not_rate' end as raw, l_partkey % 6 as kind from lineitem"""


@check(f"""select l_orderkey, l_linenumber, case kind when 0 then 'Not Related' when 1 then 'Cannot Decide_Ad Issue'
  when 2 then '' when 3 then 'free text' when 5 then 'Cannot Decide' end as shown from ({CODED}) s""")
def code_map(spark, sf):
    shown = clean.code_map(F.col("raw"), ll.RELEVANCE_CODES)
    return fx.query(spark, sf, CODED).select("l_orderkey", "l_linenumber", shown.alias("shown"))


RELEVANCE = """select cast(10000000000 + l_suppkey as string) as actor_id, cast(20000000000 + l_partkey % 40 as string) as _worker_id,
  cast(30000000000 + l_orderkey as string) as job_id, cast(cast(l_shipdate as date) as string) as review_ds,
  concat('C', cast(l_suppkey % 3 as string)) as _country, l_linenumber, l_partkey,
  case when l_linenumber = 7 then 'No' else 'YES' end as q1_ad_load,
  case l_returnflag when 'A' then 'can_not_rate' when 'N' then 'rating_v1_1_yes' else 'rating_v1_0_no' end as extracted_label,
  case when l_tax < 0.05 then 'Yes' else 'no' end as q2_contributor_correct,
  case when l_tax < 0.03 then '' when l_linestatus = 'O' then 'rating_v1_1_yes' else 'rating_v1_2_yes' end as q3_choice,
  case when l_discount < 0.05 then '' else 'ad_issue' end as q4_cannot_decide,
  case when l_linenumber <= 3 then 'N/A' else 'Other text' end as reason_other
from lineitem"""

SHOWN = """case {0} when 'can_not_rate' then 'Cannot Decide' when 'rating_v1_1_yes' then 'Somewhat Related'
  when 'rating_v1_0_no' then 'Not Related' when 'rating_v1_2_yes' then 'Relevant' when 'ad_issue' then 'Cannot Decide_Ad Issue'
  when 'N/A' then '' else {0} end"""


@check(f"""with a as (select *, case when extracted_label = 'can_not_rate' and reason_other = 'N/A' then 'Other' else reason_other end as rr
    from ({RELEVANCE}) s where q1_ad_load = 'YES'),
b as (select *, case when q2_contributor_correct = 'Yes' then extracted_label else q3_choice end as ar,
    case when q2_contributor_correct = 'Yes' and q3_choice = '' and q4_cannot_decide = '' then rr else q4_cannot_decide end as arr from a),
c as (select *, {SHOWN.format("extracted_label")} as r1, {SHOWN.format("ar")} as a1, {SHOWN.format("rr")} as r2,
    {SHOWN.format("arr")} as a2, cast(review_ds as date) as job_date, _country as workflow, actor_id as rater_id, _worker_id as auditor_id from b)
select workflow, job_date, job_id, rater_id, auditor_id, l_linenumber, 'relevance' as parent_label, r1 as rater_response, a1 as auditor_response,
  r1 = a1 as is_correct, cast(1 as double) as weight from c
union all select workflow, job_date, job_id, rater_id, auditor_id, l_linenumber, 'cannot_decide_reason', r2, a2, true, 0 from c""")
def derived_answers(spark, sf):
    # The line number rides along as the workflow's companion to tell rows of a job apart.
    rows = fx.query(spark, sf, RELEVANCE).withColumn("source_file", F.col("l_linenumber").cast("string"))
    long = ll.normalize_adhoc_relevance(rows)
    return long.select(
        "workflow", "job_date", "job_id", "rater_id", "auditor_id",
        F.col("source_file").cast("int").alias("l_linenumber"), "parent_label", "rater_response",
        "auditor_response", "is_correct", "weight",
    )


# --- configured layouts ------------------------------------------------------------------------

WIDE_SHEET = """select cast(10000000000 + l_suppkey as string) as `Annotator ID`,
  case when l_partkey % 50 = 0 then 'x' else cast(20000000000 + l_partkey % 40 as string) end as `Auditor ID`,
  cast(30000000000 + l_orderkey as string) as `Job`, cast(cast(l_shipdate as date) as string) as `When`, l_linenumber,
  l_returnflag as `Answer`, case when l_tax = 0 then '' else l_linestatus end as `Audit`,
  case l_partkey % 4 when 0 then 'yes' when 1 then 'No' when 2 then '' else '1' end as `Right`,
  case l_partkey % 3 when 0 then 'yes' when 1 then 'no' else null end as `Wrong` from lineitem"""

AUDIT_CONFIG = {
    "quality_methodology": "audit",
    "info_columns": {
        "rater_id_column": "Annotator ID", "auditor_id_column": "Auditor ID",
        "job_id_column": "Job", "job_date_column": "When",
    },
    "labels": [
        {"label_name": "class", "rater_label_column": "Answer", "auditor_label_column": "Audit",
         "auditor_column_type": "answer", "weight": 2},
        {"label_name": "right", "auditor_label_column": "Right", "auditor_column_type": "agreement"},
        {"label_name": "wrong", "auditor_label_column": "Wrong", "auditor_column_type": "disagreement", "weight": 0},
    ],
}

_SHEET = """with s as (select cast(10000000000 + l_suppkey as varchar) as rater_id, cast(20000000000 + l_partkey % 40 as varchar) as auditor_id,
    l_partkey % 50 as bad, cast(30000000000 + l_orderkey as varchar) as job_id, cast(l_shipdate as date) as job_date,
    cast(l_linenumber as varchar) as source_file, 'default_workflow' as workflow, l_returnflag as answer,
    case when l_tax = 0 then '' else l_linestatus end as audit,
    case l_partkey % 4 when 0 then 'yes' when 1 then 'No' when 2 then '' else '1' end as agree, l_partkey % 4 as k4,
    case l_partkey % 3 when 0 then 'yes' when 1 then 'no' end as disagree, l_partkey % 3 as k3 from lineitem)"""


def _sheet(spark, sf):
    return fx.query(spark, sf, WIDE_SHEET).withColumn("source_file", F.col("l_linenumber").cast("string"))


_BASE = "source_file, workflow, job_date, rater_id, auditor_id, job_id"


@check(f"""{_SHEET}
select {_BASE}, 'class' as parent_label, answer as rater_response, audit as auditor_response, answer = audit as is_correct,
  false as is_label_binary, cast(null as varchar) as confusion_type, cast(2 as double) as weight from s where bad <> 0
union all select {_BASE}, 'right', case when k4 in (0, 3) then agree end, agree, k4 in (0, 3), false, null, 1 from s where bad <> 0 and k4 <> 2
union all select {_BASE}, 'wrong', case when k3 <> 0 then disagree end, disagree, k3 <> 0, false, null, 0 from s where bad <> 0 and k3 <> 2""")
def generic_unpivot_audit(spark, sf):
    return ll.normalize_by_config(_sheet(spark, sf), AUDIT_CONFIG)


MULTI_BASE = "source_file, workflow, job_date, rater_id, job_id"


@check(f"""{_SHEET}
select {MULTI_BASE}, 'class' as parent_label, answer as rater_response, cast(0.5 as double) as weight, 'wide' as structure from s
union all select {MULTI_BASE}, 'right', agree, 1, 'wide' from s
union all select {MULTI_BASE}, answer, agree, case answer when 'A' then 0.5 else 1 end, 'long' from s where answer <> 'R'""")
def generic_unpivot_multi(spark, sf):
    info = {k: v for k, v in AUDIT_CONFIG["info_columns"].items() if k != "auditor_id_column"}
    wide = {
        "quality_methodology": "multi", "data_structure": "pivoted", "info_columns": info,
        "labels": [
            {"label_name": "class", "rater_label_column": "Answer", "weight": 0.5},
            {"label_name": "right", "rater_label_column": "Right"},
        ],
    }
    long = {
        "quality_methodology": "multi", "data_structure": "unpivoted", "info_columns": info,
        "label_column": "Answer", "rater_response_column": "Right", "excluded_labels": ["R"],
        "label_weights": {"A": 0.5},
    }
    sheet = _sheet(spark, sf)
    return ll.normalize_by_config(sheet, wide).withColumn("structure", F.lit("wide")).unionByName(
        ll.normalize_by_config(sheet, long).withColumn("structure", F.lit("long"))
    )


@check(f"""{_SHEET}
select {_BASE}, answer = 'A' as job_correct, cast(null as double) as job_manual_score, 'default_rubric' as rubric,
  cast(1 as int) as factor, cast(-1 as double) as rubric_penalty, cast(1 as double) as rubric_score from s where bad <> 0""")
def generic_outcome(spark, sf):
    config = {
        "quality_methodology": "outcome", "info_columns": AUDIT_CONFIG["info_columns"],
        "outcome_column": "Answer", "positive_outcome": "a", "discard_if_empty": True,
    }
    return ll.normalize_by_config(_sheet(spark, sf), config)


@check(f"""{_SHEET}
select {_BASE}, answer = 'A' as job_correct, FRI(job_date) as content_week from (select * replace (FRI(job_date) as job_date) from s) t
where bad <> 0 and answer in ('A', 'N')""")
def generic_without_dates(spark, sf):
    """A configured layout without a date column is dated by the week that its rows were delivered for."""
    info = {k: v for k, v in AUDIT_CONFIG["info_columns"].items() if k != "job_date_column"}
    config = {"quality_methodology": "outcome", "info_columns": info, "outcome_column": "Answer", "positive_outcome": "a"}
    rows = _sheet(spark, sf).where("Answer in ('A', 'N')")
    rows = rows.withColumn("reporting_week", clean.content_week(F.col("When").cast("date")))
    long = layouts.normalize(rows, {"module": "GENERIC", "module_config": config})
    return long.select(*_BASE.split(", "), "job_correct", "content_week")


@check("""select source_file, reject_reason, count(*) as row_count from (select cast(l_linenumber as varchar) as source_file,
  case when l_quantity < 3 then 'invalid_date' when l_partkey % 50 = 0 then 'invalid_id' else 'accepted' end as reject_reason from lineitem) s
group by 1, 2""")
def rejects_configured(spark, sf):
    rows = fx.query(spark, sf, WIDE_SHEET.replace(
        "cast(cast(l_shipdate as date) as string)", "case when l_quantity < 3 then 'some day' else cast(cast(l_shipdate as date) as string) end"
    ))
    rows = rows.withColumn("source_file", F.col("l_linenumber").cast("string"))
    return clean.reject_stats(ll.tag_by_config(rows, AUDIT_CONFIG), ["source_file"])


@check("""select _country as workflow, reject_reason, count(*) as row_count from (select concat('C', cast(l_suppkey % 3 as varchar)) as _country,
  case when l_discount > 0.09 then 'invalid_date' when l_linenumber = 7 then 'not_reviewed'
    when l_partkey % 20 = 0 then 'invalid_id' else 'accepted' end as reject_reason from lineitem) s
group by 1, 2""")
def rejects_relevance(spark, sf):
    rows = fx.query(spark, sf, RELEVANCE.replace(
        "cast(cast(l_shipdate as date) as string)", "case when l_discount > 0.09 then '' else cast(cast(l_shipdate as date) as string) end"
    ).replace("cast(30000000000 + l_orderkey as string)", "case when l_partkey % 20 = 0 then 'job' else cast(30000000000 + l_orderkey as string) end"))
    return clean.reject_stats(ll.tag_adhoc_relevance(rows), ["workflow"])
