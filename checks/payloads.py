"""Label extraction from JSON payloads, key/value expansion, alignment."""

from pyspark.sql import functions as F

from checks.registry import check
from checks import fixtures as fx
from raterscope.functions import payload
from raterscope.operators import reshape, rubric as rb
from raterscope.session import stored

KEY = "actor_id, job_id, row_pos"


def joined(column: str):
    """A label array as text; null stays null."""
    return F.when(F.col(column).isNotNull(), F.array_join(column, "|"))


# The SQL never parses JSON: it rebuilds the labels from the columns the payload was made of.
EXPECTED = """select cast(10000000000 + l_suppkey as varchar) as actor_id, cast(30000000000 + l_orderkey as varchar) as job_id,
  l_linenumber as row_pos, l_orderkey, l_partkey, l_returnflag as flag, l_linestatus as status,
  case when l_tax = 0 then 'A' else l_returnflag end as a_flag from lineitem"""


@check(f"""select {KEY}, case when l_orderkey % 97 <> 0 then concat('flag::', flag, '|status::', status) end as labels from ({EXPECTED}) s""")
def extract_labels_payload(spark, sf):
    rows = fx.view(spark, sf, "v_payload")
    return rows.withColumn("labels", payload.decision_labels(F.col("decision_data"))).select(
        "actor_id", "job_id", "row_pos", joined("labels").alias("labels")
    )


@check("""select event_id, concat('k::', cast(regexp_extract(props, '[0-9]+') as varchar)) as labels from events""")
def extract_labels_flat(spark, sf):
    rows = fx.table(spark, sf, "events")
    return rows.withColumn("labels", payload.flat_labels(F.col("props"))).select(
        "event_id", joined("labels").alias("labels")
    )


@check(f"""select {KEY}, concat('flag::', a_flag, '|extra::1') as labels from ({EXPECTED}) s""")
def extract_labels_list(spark, sf):
    rows = fx.view(spark, sf, "v_payload")
    return rows.withColumn("labels", payload.listed_labels(F.col("quality_decision_data"))).select(
        "actor_id", "job_id", "row_pos", joined("labels").alias("labels")
    )


# Auditor-keyed payloads; one in 13 has a key that is no id, one in 17 is broken.
KEYED = """select cast(10000000000 + l_suppkey as string) as rater_id, cast(30000000000 + l_orderkey as string) as entity_id,
  l_linenumber, l_partkey, l_orderkey, concat('file_', cast(l_suppkey % 3 as string)) as source_file,
  cast(cast(l_shipdate as date) as string) as sample_ds,
  case when l_suppkey % 11 = 0 then 'combined_routing' else concat('cvs_', cast(l_suppkey % 4 as string)) end as routing_name,
  concat('{''decision_string'': ''x''; ''labels'': [''flag::', l_returnflag, '''; ''status::', l_linestatus, ''']}') as rater_decision_data,
  case when l_partkey % 17 = 0 then '{"1'
       else concat('{"', case when l_partkey % 13 = 0 then 'someone' else cast(20000000000 + l_partkey % 40 as string) end,
                   '": "', replace(concat('{"labels": ["flag::', case when l_tax = 0 then 'A' else l_returnflag end, '", "extra::1"]}'), '"', concat(chr(92), '"')), '"}')
       end as auditor_decision_data
from lineitem"""


@check("""select cast(30000000000 + l_orderkey as varchar) as entity_id, l_linenumber, l_partkey,
  case when l_partkey % 17 <> 0 and l_partkey % 13 <> 0 then cast(20000000000 + l_partkey % 40 as varchar) end as auditor_id,
  case when l_partkey % 17 <> 0 and l_partkey % 13 <> 0
    then concat('flag::', case when l_tax = 0 then 'A' else l_returnflag end, '|extra::1') end as labels
from lineitem""")
def extract_labels_auditor_keyed(spark, sf):
    rows = fx.query(spark, sf, KEYED)
    parsed = rows.withColumn("keyed", payload.auditor_keyed_labels(F.col("auditor_decision_data")))
    return parsed.select(
        "entity_id", "l_linenumber", "l_partkey", F.col("keyed.auditor_id").alias("auditor_id"),
        joined("keyed.labels").alias("labels"),
    )


# Repeated keys, keys with blanks, items without the separator, values with the separator.
LISTED = """select l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus,
  concat('["flag :: ', l_returnflag, '", "bare", "flag::again", "url::a::', l_linestatus, '", "skip::1"]') as labels from lineitem"""


@check(f"""select l_orderkey, l_linenumber, l_partkey, 'flag' as key, concat(' ', l_returnflag) as value from lineitem
union all select l_orderkey, l_linenumber, l_partkey, 'url', concat('a::', l_linestatus) from lineitem""")
def expand_labels(spark, sf):
    rows = fx.query(spark, sf, LISTED)
    entries = payload.label_entries(F.from_json("labels", "array<string>"), ["skip "])
    long = rows.select("l_orderkey", "l_linenumber", "l_partkey", entries.alias("entries"))
    return reshape.expand_labels(long, "entries")


@check(f"""with p as (select * from ({EXPECTED}) s where l_orderkey % 97 <> 0),
l as (select unnest(['flag', 'status']) as parent_label)
select {KEY}, l_partkey, parent_label, case parent_label when 'flag' then flag else status end as rater_response,
  case parent_label when 'flag' then a_flag else '' end as auditor_response, 'rater' as universe from p cross join l
union all select {KEY}, l_partkey, parent_label, case parent_label when 'flag' then flag when 'status' then status else '' end,
  case parent_label when 'flag' then a_flag when 'extra' then '1' else '' end, 'both'
from p cross join (select unnest(['flag', 'status', 'extra']) as parent_label) m""")
def align_rater_auditor(spark, sf):
    text = fx.V_PAYLOAD.replace("from lineitem l", ", l.l_partkey from lineitem l")
    rows = fx.query(spark, sf, text).select(
        "actor_id", "job_id", "row_pos", "l_partkey",
        F.lit("one file").alias("source_file"),
        payload.label_map(payload.decision_labels(F.col("decision_data"))).alias("rater_map"),
        payload.label_map(payload.decision_labels(F.col("quality_decision_data"))).alias("auditor_map"),
    ).where(F.col("rater_map").isNotNull())
    rows = stored(rows, "aligned")
    spread = ["job_id", "actor_id"]
    rater = reshape.align_labels(rows, ["source_file"], spread, auditor="auditor_map")
    both = reshape.align_labels(
        rows, ["source_file"], spread, auditor="auditor_map", rater_labels_only=False
    )
    return (
        rater.withColumn("universe", F.lit("rater"))
        .unionByName(both.withColumn("universe", F.lit("both")))
        .drop("source_file")
    )


# One question list per order line; some broken, some blank, one answer list in single quotes.
ANSWERS = """select l_orderkey, l_linenumber, l_partkey, l_partkey % 9 as kind, l_suppkey % 3 as y,
  case l_partkey % 9 when 0 then '' when 1 then '[{bad' when 2 then null
    else concat('[{"question": "Clear text", "answer": "', case l_suppkey % 3 when 0 then '[]' when 1 then '[''Yes'']'
        else replace('["Yes","No","Yes"]', '"', concat(chr(92), '"')) end, '"}, {"question": "Tone / style", "answer": "',
        replace('["No"]', '"', concat(chr(92), '"')), '"}, {"answer": "x"}]') end as raw from lineitem"""


@check(f"""select l_orderkey, l_linenumber, l_partkey, 'Clear text' as question, y as yes_count from ({ANSWERS}) s where kind > 2
union all select l_orderkey, l_linenumber, l_partkey, 'Tone / style', 0 from ({ANSWERS}) s where kind > 2""")
def rubric_answer_counts(spark, sf):
    rows = fx.query(spark, sf, ANSWERS.replace("l_suppkey % 3 as y", "cast(l_suppkey % 3 as int) as y"))
    counts = F.explode(payload.rubric_answers(F.col("raw"))).alias("question", "yes_count")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", counts).withColumn(
        "yes_count", F.col("yes_count").cast("bigint")
    )


@check(f"""with r as (select l_orderkey, l_linenumber, l_partkey, case when kind > 2 then cast(y as int) else 0 end as y from ({ANSWERS}) s)
select l_orderkey, l_linenumber, l_partkey, 'clear_text' as rubric, y as factor, cast(0.25 as double) as rubric_penalty,
  cast(-0.25 * y as double) as rubric_score from r
union all select l_orderkey, l_linenumber, l_partkey, 'tone_style', 0, 0.5, 0 from r
union all select l_orderkey, l_linenumber, l_partkey, 'default_rubric', 1, -1, 1 from r""")
def rubric_long(spark, sf):
    rows = fx.query(spark, sf, ANSWERS).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.lit("one file").alias("source_file"),
        payload.rubric_answers(F.col("raw")).alias("factors"),
    )
    rows = stored(rows, "answers")
    # The entries come from the data, their penalties from the configuration.
    entries = rows.select("source_file", F.explode(F.map_keys("factors")).alias("entry")).distinct()
    penalty = F.when(F.col("entry") == "Clear text", 25.0).otherwise(0.5)
    rubric = rb.name_rubric(entries.withColumn("penalty", penalty), ["source_file"])
    spread = ["l_orderkey", "l_linenumber"]
    return rb.rubric_rows(rows, rubric, ["source_file"], spread).drop("source_file")
