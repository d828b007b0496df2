"""Views that give every job an input of its own shape from the benchmark tables.

The text runs in Spark and, with other table names and another Friday expression, in
the SQL used to check results, so both start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from raterscope.session import bound_tasks
from raterscope.sources.lake import spread

V_AUDIT = """
select concat('p', cast(l.l_suppkey % 3 as string), case when l.l_suppkey % 2 = 0 then 'n2' else '' end) as project_id,
       FRI(cast(date_trunc('year', l.l_shipdate) as date)) as reporting_week,
       FRI(cast(l.l_shipdate as date)) as content_week,
       o.o_orderpriority as workflow, cast(l.l_shipdate as date) as job_date,
       cast(10000000000 + l.l_suppkey as string) as rater_id,
       case when l.l_partkey % 50 = 0 then '' else cast(20000000000 + o.o_custkey % 40 as string) end as auditor_id,
       cast(30000000000 + l.l_orderkey as string) as job_id,
       case l.l_linenumber when 7 then 'pipeline_error' when 6 then '' else concat('label_', cast(l.l_linenumber as string)) end as parent_label,
       l.l_returnflag as rater_response,
       case when l.l_tax = 0 then ''
            when cast(l.l_quantity as int) % 5 = 0 then case l.l_returnflag when 'A' then 'N' when 'N' then 'R' else 'A' end
            else l.l_returnflag end as auditor_response,
       l.l_linenumber in (1, 2) as is_label_binary,
       cast(case l.l_linenumber when 3 then 0.5 when 4 then 0 when 5 then 2 else 1 end as double) as weight
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
"""

V_MULTI = """
select concat('m', cast(l.l_orderkey % 3 as string)) as project_id,
       FRI(cast(date_trunc('year', o.o_orderdate) as date)) as reporting_week,
       o.o_orderpriority as workflow, cast(l.l_shipdate as date) as job_date,
       cast(10000000000 + l.l_suppkey as string) as rater_id,
       cast(30000000000 + l.l_orderkey as string) as job_id,
       case when l.l_linenumber = 7 then 'pipeline_error' else concat('label_', l.l_linestatus) end as parent_label,
       case when l.l_tax = 0 then null when l.l_tax = 0.01 then '' else l.l_returnflag end as rater_response,
       cast(case l.l_linestatus when 'O' then 0.5 else 1 end as double) as weight
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
"""

V_OUTCOME = """
select concat('h', cast(o.o_custkey % 3 as string)) as project_id,
       FRI(cast(date_trunc('year', o.o_orderdate) as date)) as reporting_week,
       o.o_orderpriority as workflow, cast(o.o_orderdate as date) as job_date,
       cast(10000000000 + o.o_custkey % 50 as string) as rater_id,
       cast(20000000000 + o.o_custkey % 7 as string) as auditor_id,
       cast(30000000000 + o.o_orderkey as string) as job_id,
       case o.o_orderstatus when 'F' then true when 'O' then false end as job_correct,
       cast(o.o_custkey % 101 as double) / 100 as job_manual_score,
       concat('rubric_', cast(l.l_linenumber as string)) as rubric,
       cast(count(*) as int) as factor,
       cast(-0.125 * l.l_linenumber as double) as rubric_penalty,
       cast(count(*) * 0.125 * l.l_linenumber as double) as rubric_score
from orders o join lineitem l on l.l_orderkey = o.o_orderkey
group by o.o_custkey, o.o_orderdate, o.o_orderpriority, o.o_orderkey, o.o_orderstatus, l.l_linenumber
"""

V_PAYLOAD = """
select cast(10000000000 + l.l_suppkey as string) as actor_id,
       case when l.l_partkey % 50 = 0 then '12E9' else cast(20000000000 + l.l_partkey % 40 as string) end as quality_actor_id,
       cast(30000000000 + l.l_orderkey as string) as job_id, l.l_linenumber as row_pos,
       case l.l_linenumber % 4 when 0 then replace(cast(cast(l.l_shipdate as date) as string), '-', '/')
            when 3 then case when l.l_quantity = 1 then 'not a date' else cast(cast(l.l_shipdate as date) as string) end
            else cast(cast(l.l_shipdate as date) as string) end as review_ds,
       concat('queue_', cast(l.l_suppkey % 4 as string)) as queue_name,
       case when l.l_orderkey % 97 = 0 then '{bad'
            when l.l_orderkey % 2 = 0
              then concat('{''decision_string'': ''x''; ''labels'': [''flag::', l.l_returnflag, '''; ''status::', l.l_linestatus, ''']}')
            else concat('{"is_rejected": false, "response": "',
                        replace(concat('{"entity": {"payload": [{"values": {"flag": "', l.l_returnflag, '", "status": "', l.l_linestatus, '"}}]}}'), '"', concat(chr(92), '"')),
                        '"}') end as decision_data,
       concat('{''decision_string'': ''x''; ''labels'': [''flag::', case when l.l_tax = 0 then 'A' else l.l_returnflag end, '''; ''extra::1'']}') as quality_decision_data
from lineitem l
"""

V_RUBRIC = """
select r.row_id, r.entry, r.factor,
       100 - sum(r.factor * r.pen) over (partition by r.row_id) as manual_score
from (select l_orderkey as row_id, concat('Entry ', cast(l_linenumber as string)) as entry,
             cast(count(*) as double) as factor, cast(2.5 * l_linenumber as double) as pen,
             max(l_linenumber) as ln, count(*) over (partition by l_orderkey) as entries
      from lineitem group by l_orderkey, l_linenumber) r
where r.entries > 1 or r.ln <= 2
"""

V_MARKET_RATERS = """
select cast(date_trunc('year', l_shipdate) as date) as sample_ds, cast(10000000000 + l_suppkey as string) as rater_id,
       concat('cb_exp_l', cast(l_suppkey % 5 as string)) as routing_name, l_linestatus as main_label,
       count(*) as total_count,
       cast(sum(case when l_returnflag = 'A' and l_discount < 0.05 then 1 else 0 end) as bigint) as tp_count,
       cast(sum(case when l_returnflag = 'A' and l_discount >= 0.05 then 1 else 0 end) as bigint) as fp_count,
       cast(sum(case when l_returnflag = 'R' and l_discount < 0.05 then 1 else 0 end) as bigint) as fn_count,
       cast(sum(case when l_returnflag = 'N' or (l_returnflag = 'R' and l_discount >= 0.05) then 1 else 0 end) as bigint) as tn_count
from lineitem group by 1, 2, 3, 4
"""

V_MARKET_OVERVIEW = f"""
select sample_ds, case when grouping_no = 1 then 'combined_routing_all' else routing_name end as routing_name, main_label,
       case when grouping_no = 2 then 'label_negative' when main_label = 'F' then 'label_POSITIVE' else 'label_positive' end as label_category_name,
       cast(sum(tp_count) as bigint) as tp_count, cast(sum(fp_count) as bigint) as fp_count,
       cast(sum(fn_count) as bigint) as fn_count, cast(sum(tn_count) as bigint) as tn_count
from (select r.*, g.grouping_no from ({V_MARKET_RATERS}) r
      lateral_three_groupings) x
group by 1, 2, 3, 4
"""

V_FILES = """
select concat('p', cast(o_custkey % 3 as string)) as project_id,
       FRI(cast(date_trunc('month', o_orderdate) as date)) as data_week,
       concat('file_', cast(o_orderkey as string), '.csv') as filename,
       cast(floor(o_totalprice) as bigint) as size_bytes, o_orderstatus as arrival
from orders
"""

V_PROJECTS = """
select _project_id, _project_name, _project_status, _project_target, _project_metric, note from (values
  ('p0', 'Pine', 'Active', '85%', 'accuracy', 'x'), ('p0n2', 'Pine 2', 'Active', '85%', 'accuracy', 'x'),
  ('p1', 'Plum', 'Active', '0.9', 'agreement', 'x'), ('p1n2', 'Plum 2', 'Inactive', '0.9', 'agreement', 'x'),
  ('p2', 'Pear', 'Hidden', '75', 'accuracy', 'x'), ('p2n2', 'Pear 2', 'Deprecated', '75', 'accuracy', 'x'),
  ('m0', 'Moss', 'Active', '85%', 'agreement', 'x'), ('m1', 'Mint', 'Active', '0.9', 'agreement', 'x'),
  ('m2', 'Mace', 'Inactive', '75', 'agreement', 'x'), ('h0', 'Haze', 'Active', '85%', 'accuracy', 'x'),
  ('h1', 'Holm', 'Active', '0.5', 'accuracy', 'x'), ('h2', 'Hemp', 'Hidden', '75', 'accuracy', 'x')
) as t(_project_id, _project_name, _project_status, _project_target, _project_metric, note)
"""

# project_id -> target as a number, for the reports.
V_TARGETS = """
select project_id, cast(target as double) as target from (values
  ('p0', 0.85), ('p0n2', 0.85), ('p1', 0.9), ('p1n2', 0.9), ('p2', 0.75), ('p2n2', 0.75),
  ('m0', 0.85), ('m1', 0.9), ('m2', 0.75), ('h0', 0.85), ('h1', 0.5), ('h2', 0.75)
) as t(project_id, target)
"""

# Positive value of the binary labels of V_AUDIT.
POSITIVES = {"label_1": "A", "label_2": "A"}

VIEWS = {
    "v_audit": V_AUDIT,
    "v_multi": V_MULTI,
    "v_outcome": V_OUTCOME,
    "v_payload": V_PAYLOAD,
    "v_rubric": V_RUBRIC,
    "v_market_raters": V_MARKET_RATERS,
    "v_market_overview": V_MARKET_OVERVIEW,
    "v_files": V_FILES,
    "v_projects": V_PROJECTS,
    "v_targets": V_TARGETS,
}

TABLES = ("lineitem", "orders", "customer", "supplier", "part", "events", "nation")


def spark_sql(text: str) -> str:
    text = _friday(text, "next_day(date_sub({0}, 1), 'Friday')")
    return text.replace(
        "lateral_three_groupings", "lateral view explode(array(0, 1, 2)) g as grouping_no"
    )


def duck_sql(text: str) -> str:
    text = _friday(text, "({0} + cast((12 - isodow({0})) % 7 as int))")
    return text.replace(
        "lateral_three_groupings",
        "cross join (select unnest([0, 1, 2]) as grouping_no) g",
    )


def _friday(text: str, form: str) -> str:
    """Replace FRI(expr), whose argument has balanced parentheses."""
    while "FRI(" in text:
        start = text.index("FRI(")
        depth, end = 1, start + 4
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        text = text[:start] + form.format(text[start + 4 : end - 1]) + text[end:]
    return text


def table(spark: SparkSession, sf_dir: str, name: str, joined: bool = False) -> DataFrame:
    """A benchmark table; one `joined` to a larger one is not spread, as the join moves its rows itself."""
    bound_tasks(spark)
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows if joined else spread(rows)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of VIEWS over the tables of `sf_dir`."""
    return query(spark, sf_dir, VIEWS[name])


def query(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run SQL in which the benchmark tables are named directly."""
    text = spark_sql(text)
    for name in TABLES:
        if re.search(rf"\b{name}\b", text):
            alias = f"fixture_{name}"
            joined = f"join {name} o on" in text and name == "orders"
            table(spark, sf_dir, name, joined).createOrReplaceTempView(alias)
            text = re.sub(rf"\b{name}\b", alias, text)
    return spark.sql(text)
