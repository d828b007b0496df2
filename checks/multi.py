"""Consensus and the multi-review reports."""

from checks.audit import SAMPLE_COLUMNS, rounded, scores, targets
from checks.registry import check
from checks import fixtures as fx
from raterscope.operators import consensus, dedupe
from raterscope.plans import reports

UNIQUE = """u as (select *, reporting_week as week_ending from (
  select *, row_number() over (partition by project_id, reporting_week, job_id, rater_id, parent_label
    order by workflow nulls last, job_date nulls last, rater_response nulls last, weight nulls last) as rn
  from v_multi where parent_label is not null and parent_label <> '' and parent_label <> 'pipeline_error') t where rn = 1),
occ as (select week_ending, project_id, job_id, parent_label, rater_response, count(*) as n from u group by all),
tot as (select *, sum(n) over (partition by week_ending, project_id, job_id, parent_label) as t from occ),
win as (select week_ending, project_id, job_id, parent_label, rater_response as answer from tot where t >= 2 and n * 2 > t),
c as (select u.*, win.answer as consensus_response,
    cast(win.answer is not null as int) as is_determined,
    case when win.answer is not null then cast(coalesce(u.rater_response = win.answer, false) as int) end as is_agreeing
  from u left join win using (week_ending, project_id, job_id, parent_label))"""


def multi_long(spark, sf):
    return fx.view(spark, sf, "v_multi")


@check(f"""with {UNIQUE}
select week_ending as reporting_week, project_id, job_id, parent_label, rater_response, n as response_count,
  cast(t as bigint) as total_responses_count from tot""")
def multi_vote_counts(spark, sf):
    rows = multi_long(spark, sf).where(reports.label_guard())
    return consensus.vote_counts(dedupe.keep_first(rows, dedupe.LABEL_KEY))


@check(f"""with {UNIQUE}
select week_ending, project_id, workflow, rater_id, job_id, parent_label, weight, rater_response,
  consensus_response, is_determined, is_agreeing from c""")
def multi_consensus(spark, sf):
    return reports.multi_rows(multi_long(spark, sf)).select(
        "week_ending", "project_id", "workflow", "rater_id", "job_id", "parent_label", "weight",
        "rater_response", "consensus_response", "is_determined", "is_agreeing",
    )


@check(f"""with {UNIQUE},
j as (select week_ending, project_id, workflow, rater_id, job_id, max(is_determined) as audited,
    sum(weight * is_determined) as tot, sum(weight * is_determined * is_agreeing) as cor from c group by all),
r as (select week_ending, project_id, workflow, rater_id, count(*) as jobs, sum(audited) as audited, sum(tot) as tot, sum(cor) as cor
  from j group by all),
w as (select week_ending, r.project_id, workflow, count(*) as rater_count, cast(sum(jobs) as bigint) as job_instances,
    cast(sum(audited) as bigint) as audited_instances, max(target) as target_goal,
    count(*) filter (where cor / nullif(tot, 0) >= target) as raters_above_target,
    sum(cor) / nullif(sum(tot), 0) as workflow_score
  from r left join v_targets t on r.project_id = t.project_id group by all),
p as (select *, avg(workflow_score) over (partition by week_ending, project_id) as project_score from w)
select week_ending, project_id, workflow, rater_count, cast(0 as bigint) as auditor_count, job_instances,
  audited_instances, cast(0 as bigint) as audited_instances_f1, target_goal, raters_above_target,
  cast(0 as bigint) as raters_above_target_f1, round(workflow_score, 6) as workflow_score,
  cast(0 as double) as workflow_f1score, cast(0 as double) as workflow_precision, cast(0 as double) as workflow_recall,
  round(project_score, 6) as project_score, cast(0 as double) as project_f1score,
  cast(0 as double) as project_precision, cast(0 as double) as project_recall from p""")
def multi_workflow_summary(spark, sf):
    return reports.multi_workflow_summary(multi_long(spark, sf), targets(spark, sf))


@check(f"""with {UNIQUE},
r as (select week_ending, project_id, workflow, rater_id, parent_label, sum(weight * is_determined) as tot_labels,
    sum(weight * is_determined * is_agreeing) as correct_labels from c group by all),
s as (select *, correct_labels / nullif(tot_labels, 0) as rater_label_score from r),
p as (select *, avg(rater_label_score) over (partition by week_ending, project_id, workflow, rater_id) as rater_score from s)
select week_ending, project_id, workflow, rater_id, parent_label, tot_labels, correct_labels,
  cast(0 as bigint) as tp_count, cast(0 as bigint) as tn_count, cast(0 as bigint) as fp_count, cast(0 as bigint) as fn_count,
  {rounded("rater_label_score", "rater_score")},
  {", ".join(f"cast(null as double) as {n}" for n in scores("rater_label")[1:] + scores("rater")[1:])} from p""")
def multi_rater_label_summary(spark, sf):
    return reports.multi_rater_label_summary(multi_long(spark, sf))


@check(f"""with {UNIQUE},
r as (select week_ending, project_id, workflow, job_id, parent_label, cast(sum(is_determined) as bigint) as rater_count,
    sum(case when is_agreeing = 1 then weight else 0 end) as correct_rater_count,
    sum(case when is_agreeing = 0 then weight else 0 end) as incorrect_rater_count from c group by all),
p as (select *, avg(correct_rater_count / nullif(rater_count, 0)) over (partition by week_ending, project_id, workflow, job_id) as job_score from r)
select week_ending, project_id, workflow, job_id, parent_label, rater_count, correct_rater_count, incorrect_rater_count,
  cast(0 as bigint) as tp_count, cast(0 as bigint) as tn_count, cast(0 as bigint) as fp_count, cast(0 as bigint) as fn_count,
  {rounded("job_score")}, {", ".join(f"cast(null as double) as {n}" for n in scores("job")[1:])} from p""")
def multi_job_label_summary(spark, sf):
    return reports.multi_job_label_summary(multi_long(spark, sf))


@check(f"""with {UNIQUE},
e as (select week_ending, project_id, parent_label, rater_response, consensus_response as ground_truth, count(*) as error_count
  from c where is_agreeing = 0 group by all),
p as (select *, sum(error_count) over (partition by week_ending, project_id, parent_label) as total from e)
select week_ending, project_id, parent_label, coalesce(nullif(rater_response, ''), '<empty>') as rater_response,
  coalesce(nullif(ground_truth, ''), '<empty>') as ground_truth, error_count,
  cast(total as bigint) as weekly_label_error_count, round(error_count / total, 6) as weekly_error_contribution from p""")
def multi_error_contribution(spark, sf):
    return reports.multi_error_contribution(multi_long(spark, sf))


@check(f"""with {UNIQUE},
d as (select week_ending, project_id, workflow, rater_id, job_id, parent_label,
    coalesce(nullif(rater_response, ''), '<empty>') as rater_response,
    coalesce(nullif(consensus_response, ''), '<empty>') as ground_truth, '' as confusion_type, false as is_correct
  from c where is_agreeing = 0)
select {SAMPLE_COLUMNS} from d""")
def multi_incorrect_sample(spark, sf):
    return reports.multi_incorrect_sample(multi_long(spark, sf))
