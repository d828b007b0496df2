"""Audit reports and the steps they are made of."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import check
from checks import fixtures as fx
from raterscope.functions import metrics as m
from raterscope.operators import dedupe
from raterscope.plans import reports

FLAGGED = """f as (
  select *,
    case when parent_label not in ('label_1', 'label_2') then ''
         when rater_response = 'A' and auditor_response = 'A' then 'TP'
         when rater_response = 'A' then 'FP' when auditor_response = 'A' then 'FN' else 'TN' end as confusion_type,
    lower(trim(coalesce(rater_response, ''))) = lower(trim(coalesce(auditor_response, ''))) as is_correct
  from v_audit)"""

ALLDATA = f"""{FLAGGED},
ranked as (
  select *, row_number() over (partition by project_id, reporting_week, job_id, rater_id, parent_label
    order by content_week nulls last, workflow nulls last, job_date nulls last, auditor_id nulls last,
      rater_response nulls last, auditor_response nulls last, is_label_binary nulls last, weight nulls last,
      confusion_type nulls last, is_correct nulls last) as rn
  from f
  where parent_label is not null and parent_label <> '' and parent_label <> 'pipeline_error' and auditor_id <> ''),
alldata as (select *, reporting_week as week_ending from ranked where rn = 1)"""

CELLS = """count(*) filter (where confusion_type = 'TP') as tp_count, count(*) filter (where confusion_type = 'TN') as tn_count,
  count(*) filter (where confusion_type = 'FP') as fp_count, count(*) filter (where confusion_type = 'FN') as fn_count"""


def quality(prefix: str) -> str:
    return f"""2.0 * tp_count / nullif(2 * tp_count + fp_count + fn_count, 0) as {prefix}_f1score,
  1.0 * tp_count / nullif(tp_count + fp_count, 0) as {prefix}_precision,
  1.0 * tp_count / nullif(tp_count + fn_count, 0) as {prefix}_recall"""


def rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 6) as {n}" for n in names)


def scores(prefix: str) -> list[str]:
    return [f"{prefix}_{s}" for s in ("score", "f1score", "precision", "recall")]


def audit_long(spark, sf) -> DataFrame:
    """The audit fixture with its confusion type and correctness."""
    rater, auditor = F.col("rater_response"), F.col("auditor_response")
    _, cell = m.binary_confusion(F.col("parent_label"), rater, auditor, fx.POSITIVES)
    return fx.view(spark, sf, "v_audit").withColumns(
        {"confusion_type": cell, "is_correct": m.responses_match(rater, auditor)}
    )


def targets(spark, sf) -> DataFrame:
    return fx.view(spark, sf, "v_targets")


@check(f"""with {FLAGGED}
select project_id, job_id, rater_id, parent_label, rater_response, auditor_response, confusion_type,
  parent_label in ('label_1', 'label_2') as is_label_binary from f""")
def confusion_flags(spark, sf):
    rows = fx.view(spark, sf, "v_audit")
    is_binary, cell = m.binary_confusion(
        F.col("parent_label"), F.col("rater_response"), F.col("auditor_response"), fx.POSITIVES
    )
    return rows.select(
        "project_id", "job_id", "rater_id", "parent_label", "rater_response", "auditor_response",
        cell.alias("confusion_type"), is_binary.alias("is_label_binary"),
    )


# Case and blanks differ between the sides on purpose.
SPACED = """select l_orderkey, l_linenumber,
  case when l_linenumber % 3 = 0 then concat(' ', lower(l_returnflag)) else l_returnflag end as rater_response,
  case when l_tax = 0 then null else concat(l_returnflag, ' ') end as auditor_response from lineitem"""


@check(f"""select l_orderkey, l_linenumber, rater_response,
  coalesce(lower(trim(rater_response)) = lower(trim(auditor_response)), false) as is_correct from ({SPACED}) s""")
def response_match(spark, sf):
    rows = fx.query(spark, sf, SPACED)
    match = m.responses_match(F.col("rater_response"), F.col("auditor_response"))
    return rows.select("l_orderkey", "l_linenumber", "rater_response", match.alias("is_correct"))


@check("""select project_id, job_id, rater_id, parent_label,
  cast(case parent_label when 'label_3' then 0.5 when 'label_4' then 0 when 'label_5' then 2 else 1 end as double) as weight
from v_audit""")
def label_weight(spark, sf):
    rows = fx.view(spark, sf, "v_audit").drop("weight")
    weights = {"label_3": 0.5, "label_4": 0, "label_5": 2}
    return rows.select(
        "project_id", "job_id", "rater_id", "parent_label",
        m.label_weight(F.col("parent_label"), weights).alias("weight"),
    )


@check(f"""with {ALLDATA}
select project_id, week_ending, content_week, workflow, job_date, rater_id, auditor_id, job_id, parent_label,
  rater_response, auditor_response, is_correct, weight from alldata""")
def dedupe_labels(spark, sf):
    return reports.audit_rows(audit_long(spark, sf)).select(
        "project_id", "week_ending", "content_week", "workflow", "job_date", "rater_id", "auditor_id",
        "job_id", "parent_label", "rater_response", "auditor_response", "is_correct", "weight",
    )


@check(f"""with {ALLDATA}
select week_ending, project_id, workflow, count(distinct auditor_id) as auditor_count
from alldata group by all""")
def audit_auditor_count(spark, sf):
    return reports.audit_auditor_count(audit_long(spark, sf))


@check(f"""with {ALLDATA},
r as (select week_ending, project_id, workflow, rater_id, count(distinct job_id) as jobs,
    count(distinct case when confusion_type in ('TP', 'FP', 'FN') then job_id end) as jobs_f1,
    sum(weight) as tot, sum(case when is_correct then weight else 0 end) as cor, {CELLS}
  from alldata group by all),
s as (select r.*, target, cor / nullif(tot, 0) as rater_score, {quality("rater")}
  from r left join v_targets t on r.project_id = t.project_id),
w as (select week_ending, project_id, workflow, count(*) as rater_count,
    cast(sum(jobs) as bigint) as job_instances, cast(sum(jobs) as bigint) as audited_instances,
    cast(sum(jobs_f1) as bigint) as audited_instances_f1, max(target) as target_goal,
    count(*) filter (where rater_score >= target) as raters_above_target,
    count(*) filter (where rater_f1score >= target) as raters_above_target_f1,
    sum(cor) / nullif(sum(tot), 0) as workflow_score, avg(rater_f1score) as workflow_f1score,
    avg(rater_precision) as workflow_precision, avg(rater_recall) as workflow_recall
  from s group by all),
a as (select week_ending, project_id, workflow, count(distinct auditor_id) as auditor_count from alldata group by all),
p as (select w.*, auditor_count,
    avg(workflow_score) over q as project_score, avg(workflow_f1score) over q as project_f1score,
    avg(workflow_precision) over q as project_precision, avg(workflow_recall) over q as project_recall
  from w left join a using (week_ending, project_id, workflow)
  window q as (partition by week_ending, project_id))
select week_ending, project_id, workflow, rater_count, auditor_count, job_instances, audited_instances,
  audited_instances_f1, target_goal, raters_above_target, raters_above_target_f1,
  {rounded(*scores("workflow"), *scores("project"))} from p""")
def audit_workflow_summary(spark, sf):
    return reports.audit_workflow_summary(audit_long(spark, sf), targets(spark, sf))


@check(f"""with {ALLDATA},
r as (select week_ending, project_id, workflow, rater_id, parent_label, sum(weight) as tot_labels,
    sum(case when is_correct then weight else 0 end) as correct_labels, {CELLS}
  from alldata group by all),
s as (select *, correct_labels / nullif(tot_labels, 0) as rater_label_score, {quality("rater_label")} from r),
p as (select *, avg(rater_label_score) over q as rater_score, avg(rater_label_f1score) over q as rater_f1score,
    avg(rater_label_precision) over q as rater_precision, avg(rater_label_recall) over q as rater_recall
  from s window q as (partition by week_ending, project_id, workflow, rater_id))
select week_ending, project_id, workflow, rater_id, parent_label, tot_labels, correct_labels,
  tp_count, tn_count, fp_count, fn_count, {rounded(*scores("rater_label"), *scores("rater"))} from p""")
def audit_rater_label_summary(spark, sf):
    return reports.audit_rater_label_summary(audit_long(spark, sf))


@check(f"""with {ALLDATA},
r as (select week_ending, project_id, workflow, job_id, parent_label, count(*) as rater_count,
    sum(case when is_correct then weight else 0 end) as correct_rater_count,
    sum(case when not is_correct then weight else 0 end) as incorrect_rater_count, {CELLS}
  from alldata group by all),
s as (select *, correct_rater_count / rater_count as job_label_score, {quality("job_label")} from r),
p as (select *, avg(job_label_score) over q as job_score, avg(job_label_f1score) over q as job_f1score,
    avg(job_label_precision) over q as job_precision, avg(job_label_recall) over q as job_recall
  from s window q as (partition by week_ending, project_id, workflow, job_id))
select week_ending, project_id, workflow, job_id, parent_label, rater_count, correct_rater_count,
  incorrect_rater_count, tp_count, tn_count, fp_count, fn_count, {rounded(*scores("job"))} from p""")
def audit_job_label_summary(spark, sf):
    return reports.audit_job_label_summary(audit_long(spark, sf))


@check(f"""with {ALLDATA},
c as (select week_ending, project_id, parent_label, rater_response, auditor_response as ground_truth, count(*) as error_count
  from alldata where not is_correct group by all),
p as (select *, sum(error_count) over (partition by week_ending, project_id, parent_label) as total from c)
select week_ending, project_id, parent_label, coalesce(nullif(rater_response, ''), '<empty>') as rater_response,
  coalesce(nullif(ground_truth, ''), '<empty>') as ground_truth, error_count,
  cast(total as bigint) as weekly_label_error_count, round(error_count / total, 6) as weekly_error_contribution from p""")
def audit_error_contribution(spark, sf):
    return reports.audit_error_contribution(audit_long(spark, sf))


SAMPLE_COLUMNS = """week_ending, project_id, workflow, rater_id, job_id, parent_label, rater_response, ground_truth,
  confusion_type, is_correct"""


@check(f"""with {ALLDATA},
d as (select week_ending, project_id, workflow, rater_id, job_id, parent_label,
    coalesce(nullif(rater_response, ''), '<empty>') as rater_response,
    coalesce(nullif(auditor_response, ''), '<empty>') as ground_truth, confusion_type, is_correct
  from alldata where not is_correct)
select {SAMPLE_COLUMNS} from d""")
def audit_incorrect_sample(spark, sf):
    return reports.audit_incorrect_sample(audit_long(spark, sf))


CANONICAL_COLUMNS = """project_id, reporting_week, content_week, workflow, job_date, rater_id, auditor_id, job_id,
  cast(null as boolean) as job_overall_correct, cast(null as double) as job_manual_score, parent_label as label,
  rater_response, auditor_response, is_correct, is_label_binary, confusion_type, weight,
  cast(null as double) as rubric_credit, 'label' as methodology"""
CANONICAL_OUTCOME = """project_id, reporting_week, cast(null as date) as content_week, workflow, job_date, rater_id, auditor_id,
  job_id, job_correct as job_overall_correct, job_manual_score, rubric as label,
  cast(null as varchar) as rater_response, cast(null as varchar) as auditor_response, cast(null as boolean) as is_correct,
  cast(null as boolean) as is_label_binary, cast(null as varchar) as confusion_type, cast(factor as double) as weight,
  rubric_score as rubric_credit, 'rubric' as methodology"""


@check(f"""with {FLAGGED}
select {CANONICAL_COLUMNS} from f
union all select {CANONICAL_OUTCOME} from v_outcome""")
def canonical_schema(spark, sf):
    from raterscope.schema import to_canonical

    labels = to_canonical(audit_long(spark, sf))
    return labels.unionByName(to_canonical(fx.view(spark, sf, "v_outcome")))


@check("""select actor_id, job_id, row_pos, decision_data from (
  select *, row_number() over (partition by actor_id, job_id order by row_pos desc, decision_data desc) as k from v_payload) t where k = 1""")
def dedupe_keep_last(spark, sf):
    rows = fx.view(spark, sf, "v_payload")
    last = dedupe.keep_last(rows, ["actor_id", "job_id"], ["row_pos", "decision_data"])
    return last.select("actor_id", "job_id", "row_pos", "decision_data")
