"""Layout normalisers from raw text rows to long tables, and reject counts."""

from pyspark.sql import functions as F

from checks.payloads import EXPECTED, KEYED
from checks.registry import check
from checks import fixtures as fx
from raterscope.functions import clean
from raterscope.plans import layouts
from raterscope.plans import layouts_labels as ll
from raterscope.plans import layouts_outcome as lo

LABEL_CONFIG = {
    "quality_methodology": "audit",
    "excluded_labels": [],
    "excluded_queues": ["queue_3"],
    "binary_labels": [{"label_name": "flag", "binary_positive_value": "A"}],
    "label_weights": {"status": 0.5},
}

# The payload fixture with a position that is unique within a rater and job.
POSITION = """cast(l.l_linenumber as bigint) * 1000000000000000 + l.l_partkey * 100000000
  + cast(floor(l.l_extendedprice * 100) as bigint) % 100000000"""
RAW_DECISIONS = fx.V_PAYLOAD.replace("l.l_linenumber as row_pos", f"{POSITION} as row_pos").replace(
    "from lineitem l", ", concat('file_', cast(l.l_suppkey % 3 as string)) as source_file from lineitem l"
)

DECISIONS = f"""d as (select concat('file_', cast(l_suppkey % 3 as varchar)) as source_file, cast(l_shipdate as date) as job_date,
    concat('queue_', cast(l_suppkey % 4 as varchar)) as workflow, cast(30000000000 + l_orderkey as varchar) as job_id,
    cast(10000000000 + l_suppkey as varchar) as rater_id,
    case when l_partkey % 50 <> 0 then cast(20000000000 + l_partkey % 40 as varchar) end as auditor_id,
    l_returnflag as flag, l_linestatus as status, case when l_tax = 0 then 'A' else l_returnflag end as a_flag,
    case when l_linenumber % 4 = 3 and l_quantity = 1 then 'invalid_date' when l_partkey % 50 = 0 and AUDITED then 'invalid_id'
         when l_suppkey % 4 = 3 then 'excluded_queue' when l_orderkey % 97 = 0 then 'invalid_json' end as reason,
    {POSITION.replace("l.", "")} as pos
  from lineitem)"""

LAST = """k as (select * from (select *, row_number() over (partition by source_file, rater_id, job_id order by pos desc) as n
  from d where reason is null) t where n = 1)"""

FLAGS = """case when parent_label <> 'flag' then '' when rater_response = 'A' and auditor_response = 'A' then 'TP'
    when rater_response = 'A' then 'FP' when auditor_response = 'A' then 'FN' else 'TN' end as confusion_type,
  parent_label = 'flag' as is_label_binary, lower(trim(rater_response)) = lower(trim(auditor_response)) as is_correct,
  cast(case parent_label when 'status' then 0.5 else 1 end as double) as weight"""

BASE = "source_file, job_date, workflow, job_id, rater_id"


@check(f"""with {DECISIONS.replace("AUDITED", "true")}, {LAST},
a as (select {BASE}, auditor_id, unnest(['flag', 'status']) as parent_label, unnest([flag, status]) as rater_response,
  unnest([a_flag, '']) as auditor_response from k)
select *, {FLAGS}, 'audit' as methodology from a""")
def normalize_decision_json(spark, sf):
    raw = fx.query(spark, sf, RAW_DECISIONS)
    return ll.normalize_decision_json(raw, LABEL_CONFIG).withColumn("methodology", F.lit("audit"))


@check(f"""with {DECISIONS.replace("AUDITED", "false")}, {LAST}
select {BASE}, unnest(['flag', 'status']) as parent_label, unnest([flag, status]) as rater_response,
  unnest(cast([1, 0.5] as double[])) as weight from k""")
def normalize_decision_json_multi(spark, sf):
    raw = fx.query(spark, sf, RAW_DECISIONS)
    return ll.normalize_decision_json(raw, {**LABEL_CONFIG, "quality_methodology": "multi"})


@check(f"""with {DECISIONS.replace("AUDITED", "true")}
select source_file, coalesce(reason, 'accepted') as reject_reason, count(*) as row_count from d group by all""")
def ingest_reject_stats(spark, sf):
    tagged = ll.tag_decision_json(fx.query(spark, sf, RAW_DECISIONS), LABEL_CONFIG)
    return clean.reject_stats(tagged, ["source_file"])


RAW_KEYED = KEYED.replace("l_orderkey, concat", POSITION.replace("l.", "") + " as row_pos, concat")


@check(f"""with d as (select concat('file_', cast(l_suppkey % 3 as varchar)) as source_file, cast(l_shipdate as date) as job_date,
    concat('cvs_', cast(l_suppkey % 4 as varchar)) as workflow, cast(30000000000 + l_orderkey as varchar) as job_id,
    cast(10000000000 + l_suppkey as varchar) as rater_id, cast(20000000000 + l_partkey % 40 as varchar) as auditor_id,
    l_returnflag as flag, l_linestatus as status, case when l_tax = 0 then 'A' else l_returnflag end as a_flag,
    l_partkey % 17 <> 0 and l_partkey % 13 <> 0 as valid,
    row_number() over (partition by l_suppkey, l_orderkey order by {POSITION.replace("l.", "")} desc) as n
  from lineitem where l_suppkey % 11 <> 0),
a as (select {BASE}, auditor_id, unnest(['extra', 'flag', 'status']) as parent_label, unnest(['', flag, status]) as rater_response,
  unnest(['1', a_flag, '']) as auditor_response from d where n = 1 and valid)
select *, {FLAGS} from a""")
def normalize_auditor_keyed_json(spark, sf):
    return ll.normalize_auditor_keyed_json(fx.query(spark, sf, RAW_KEYED), LABEL_CONFIG)


LONG_SHEET = """select cast(10000000000 + l_suppkey as string) as actor_id,
  concat('''', cast(20000000000 + l_partkey % 40 as string), '''') as reviewer_id,
  case when l_partkey % 50 = 0 then '12' else cast(30000000000 + l_orderkey as string) end as job_id,
  cast(cast(l_shipdate as date) as string) as job_date, concat('queue_', cast(l_suppkey % 4 as string)) as queue,
  case l_linenumber when 1 then 'flag' when 2 then 'status' else 'other' end as label, l_returnflag as actor_answer,
  case when l_tax = 0 then 'A' else lower(l_returnflag) end as ground_truth from lineitem"""


@check(f"""with a as (select cast(10000000000 + l_suppkey as varchar) as rater_id, cast(20000000000 + l_partkey % 40 as varchar) as auditor_id,
    cast(30000000000 + l_orderkey as varchar) as job_id, cast(l_shipdate as date) as job_date,
    concat('queue_', cast(l_suppkey % 4 as varchar)) as workflow, l_returnflag as rater_response,
    case l_linenumber when 1 then 'flag' when 2 then 'status' else 'other' end as parent_label,
    case when l_tax = 0 then 'A' else lower(l_returnflag) end as auditor_response from lineitem where l_partkey % 50 <> 0)
select *, {FLAGS} from a""")
def normalize_long_audit(spark, sf):
    config = {**LABEL_CONFIG, "info_columns": {"reviewer_response_column": "ground_truth"}}
    return ll.normalize_long_audit(fx.query(spark, sf, LONG_SHEET), config)


# Wide rubric rows: three entries with true penalties 12.5, 25 and 50; the score column
# deducts them, so all three can be inferred in every file. One in 29 rows has no score.
WIDE = """select concat('file_', cast(o_custkey % 3 as string)) as source_file, o_orderkey as row_pos,
  concat('''', cast(10000000000 + o_custkey % 50 as string)) as `SRT Annotator ID`,
  case when o_orderkey % 31 = 0 then '' else cast(20000000000 + o_custkey % 7 as string) end as `Vendor Auditor ID`,
  cast(30000000000 + o_orderkey as string) as `SRT Job ID`, cast(cast(o_orderdate as date) as string) as `Time (PT)`,
  case o_orderstatus when 'F' then 'Approved' when 'O' then 'Rejected' else ' ' end as `Vendor Tag`,
  o_orderpriority as `Queue Name`, 'shown' as `Vendor Comment`,
  case when o_orderkey % 29 = 0 then 'n/a' else cast(100 - (12.5 * F1 + 25.0 * F2 + 50.0 * F3) as string) end as `Vendor Manual QA Score`,
  case when F1 = 0 then '' else cast(F1 as string) end as `Clear text`,
  cast(F2 as string) as `Tone / style`, cast(F3 as string) as `Tone-style`
from orders"""
FACTORS = {"F1": "(o_orderkey % 3)", "F2": "(case when o_orderkey % 5 = 1 then 1 else 0 end)",
           "F3": "(case when o_orderkey % 7 = 2 then 1 else 0 end)"}


def with_factors(text: str) -> str:
    for name, value in FACTORS.items():
        text = text.replace(name, value)
    return text


OUTCOMES = with_factors("""o as (select concat('file_', cast(o_custkey % 3 as varchar)) as source_file, o_orderpriority as workflow,
    cast(o_orderdate as date) as job_date, cast(10000000000 + o_custkey % 50 as varchar) as rater_id,
    cast(20000000000 + o_custkey % 7 as varchar) as auditor_id, cast(30000000000 + o_orderkey as varchar) as job_id,
    o_orderstatus = 'F' as job_correct,
    case when o_orderkey % 29 <> 0 then (100 - (12.5 * F1 + 25.0 * F2 + 50.0 * F3)) / 100.0 end as job_manual_score,
    F1 as f1, F2 as f2, F3 as f3
  from orders where o_orderstatus in ('F', 'O') and REJECT)""")

OUTCOME_ROWS = """select source_file, workflow, job_date, rater_id, auditor_id, job_id, job_correct, cast(job_manual_score as double) as job_manual_score,
  unnest(['clear_text', 'tone_style', 'tone_style_2', 'default_rubric']) as rubric,
  unnest(cast([f1, f2, f3, 1] as int[])) as factor, unnest(cast([0.125, 0.25, 0.5, -1] as double[])) as rubric_penalty,
  unnest(cast([round_even(-0.125 * f1, 3), -0.25 * f2, -0.5 * f3, 1] as double[])) as rubric_score from o"""


@check(f"""with {OUTCOMES.replace("REJECT", "o_orderkey % 31 <> 0")} {OUTCOME_ROWS}""")
def normalize_outcome_wide(spark, sf):
    return lo.normalize_outcome_wide_rubric(fx.query(spark, sf, with_factors(WIDE)), {})


# The same rubric as JSON question lists.
YES = """concat('"', replace(case {0} when 0 then '["No"]' when 1 then '["Yes","No"]' else '["Yes","Yes"]' end, '"', concat(chr(92), '"')), '"')"""
JSON = f"""select concat('file_', cast(o_custkey % 3 as string)) as source_file, o_orderkey as row_pos,
  cast(10000000000 + o_custkey % 50 as string) as annotator_id,
  case when o_orderkey % 31 = 0 then cast(10000000000 + o_custkey % 50 as string) else cast(20000000000 + o_custkey % 7 as string) end as auditor_id,
  cast(30000000000 + o_orderkey as string) as task_id, o_orderpriority as task_name,
  cast(cast(o_orderdate as date) as string) as original_submission_time,
  case o_orderstatus when 'F' then 'AUDIT_APPROVED' when 'O' then 'AUDIT_REJECTED' else '' end as audit_status,
  case when o_custkey % 11 = 0 then 'Elsewhere' else 'Main Vendor' end as auditor_organization,
  case when o_orderkey % 29 = 0 then '' else cast(100 - (12.5 * F1 + 25.0 * F2 + 50.0 * F3) as string) end as `QA_score`,
  concat('[', array_join(filter(array(
    case when F1 > 0 then concat('{{"question": "Clear text", "answer": ', {YES.format("F1")}, '}}') end,
    case when F2 > 0 then concat('{{"question": "Tone / style", "answer": ', {YES.format("F2")}, '}}') end,
    case when F3 > 0 then concat('{{"question": "Tone-style", "answer": ', {YES.format("F3")}, '}}') end), x -> x is not null), ','), ']') as rubric_answer
from orders"""


@check(f"""with {OUTCOMES.replace("REJECT", "o_orderkey % 31 <> 0 and o_custkey % 11 <> 0")} {OUTCOME_ROWS}""")
def normalize_outcome_json(spark, sf):
    config = {"organization_token": "Vendor", "drop_self_audits": True}
    return lo.normalize_outcome_json_rubric(fx.query(spark, sf, with_factors(JSON)), config)


ROSTER = """select cast(10000000000 + s_suppkey as string) as rater_id,
  case s_suppkey % 3 when 0 then 'EN-US' when 1 then 'IT-IT' else 'DE-DE' end as market from supplier where s_suppkey % 10 <> 0"""


@check(f"""with {DECISIONS.replace("AUDITED", "true")}, {LAST},
a as (select source_file, job_date, job_id, k.rater_id, auditor_id, r.market as workflow, unnest(['flag', 'status']) as parent_label,
  unnest([flag, status]) as rater_response, unnest([a_flag, '']) as auditor_response
  from k join ({ROSTER}) r on k.rater_id = r.rater_id)
select *, {FLAGS}, FRI(job_date) as content_week from a""")
def normalize_dispatch(spark, sf):
    project = {
        "module": "UQD",
        "module_config": {
            **LABEL_CONFIG,
            "rename_columns": [{"from": "team", "to": "queue_name"}],
            "replace_strings": [{"find": "squad", "replace": "queue", "columns": ["queue_name"]}],
        },
    }
    raw = fx.query(spark, sf, RAW_DECISIONS).withColumnRenamed("queue_name", "team")
    raw = raw.withColumn("team", F.replace("team", F.lit("queue"), F.lit("squad")))
    return layouts.normalize(raw, project, "p0", roster=fx.query(spark, sf, ROSTER))


@check(f"""select coalesce(market, 'UNMAPPED') as market, count(*) as row_count
from v_audit v left join ({ROSTER}) r on v.rater_id = r.rater_id group by 1""")
def roster_remap(spark, sf):
    return layouts.roster_counts(fx.view(spark, sf, "v_audit"), fx.query(spark, sf, ROSTER))


MAILED = """select l_orderkey, l_linenumber, l_partkey, concat(case when l_tax = 0 then ' Rater' else 'rater' end, cast(l_suppkey as string), '@Example.org') as `Email` from lineitem"""
MAILS = """select concat('rater', cast(s_suppkey as string), '@example.org') as email, cast(10000000000 + s_suppkey as string) as rater_id
from supplier where s_suppkey % 10 <> 0"""


@check(f"""select l_orderkey, l_linenumber, l_partkey, m."Email", e.rater_id as srtid
from ({MAILED.replace("`", '"')}) m join ({MAILS}) e on lower(trim(m."Email")) = e.email""")
def email_remap(spark, sf):
    return layouts.map_emails(fx.query(spark, sf, MAILED), fx.query(spark, sf, MAILS))


# --- reject counts of the other layouts ------------------------------------------------------


@check("""select case when l_partkey % 50 = 0 then 'invalid_id' else 'accepted' end as reject_reason, count(*) as row_count from lineitem group by 1""")
def rejects_long_audit(spark, sf):
    config = {**LABEL_CONFIG, "info_columns": {"reviewer_response_column": "ground_truth"}}
    return clean.reject_stats(ll.tag_long_audit(fx.query(spark, sf, LONG_SHEET), config))


@check(f"""with d as (select *, row_number() over (partition by l_suppkey, l_orderkey order by {POSITION.replace("l.", "")} desc) as n
  from lineitem where l_suppkey % 11 <> 0)
select case when l_partkey % 17 <> 0 and l_partkey % 13 <> 0 then 'accepted' else 'invalid_json' end as reject_reason, count(*) as row_count
from d where n = 1 group by 1""")
def rejects_auditor_keyed(spark, sf):
    return clean.reject_stats(ll.tag_auditor_keyed_json(fx.query(spark, sf, RAW_KEYED)))


@check("""select case when o_custkey % 11 = 0 then 'other_organization' when o_orderkey % 31 = 0 then 'self_audit'
    when o_orderstatus not in ('F', 'O') then 'not_audited' else 'accepted' end as reject_reason, count(*) as row_count from orders group by 1""")
def rejects_outcome_json(spark, sf):
    config = {"organization_token": "Vendor", "drop_self_audits": True}
    return clean.reject_stats(lo.outcome_rejects(fx.query(spark, sf, with_factors(JSON)), config, "json"))


@check("""select case when o_orderkey % 31 = 0 then 'invalid_id' when o_orderstatus not in ('F', 'O') then 'not_audited' else 'accepted' end as reject_reason,
  count(*) as row_count from orders group by 1""")
def rejects_outcome_wide(spark, sf):
    return clean.reject_stats(lo.tag_outcome_wide(fx.query(spark, sf, with_factors(WIDE)), {}))
