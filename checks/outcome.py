"""Outcome reports and rubric inference."""

from pyspark.sql import functions as F

from checks.audit import SAMPLE_COLUMNS, scores, targets
from checks.registry import check
from checks import fixtures as fx
from raterscope.functions import clean
from raterscope.operators import rubric as rb
from raterscope.plans import reports

UNIQUE = """u as (select *, reporting_week as week_ending from (
  select *, row_number() over (partition by project_id, reporting_week, job_id, rater_id, auditor_id, job_correct
    order by workflow nulls last, job_date nulls last, job_manual_score nulls last, rubric nulls last, factor nulls last,
      rubric_penalty nulls last, rubric_score nulls last) as rn
  from v_outcome where job_correct is not null) t where rn = 1)"""

ZERO_CELLS = ", ".join(f"cast(0 as bigint) as {c}_count" for c in ("tp", "tn", "fp", "fn"))


def zeros(*names: str) -> str:
    return ", ".join(f"cast(0 as double) as {n}" for n in names)


def outcome_long(spark, sf):
    return fx.view(spark, sf, "v_outcome")


@check(f"""with {UNIQUE}
select week_ending, project_id, workflow, rater_id, auditor_id, job_id, job_correct, job_manual_score, rubric from u""")
def dedupe_outcomes(spark, sf):
    return reports.outcome_rows(outcome_long(spark, sf)).select(
        "week_ending", "project_id", "workflow", "rater_id", "auditor_id", "job_id", "job_correct",
        "job_manual_score", "rubric",
    )


@check(f"""with {UNIQUE},
r as (select week_ending, project_id, workflow, rater_id, count(*) as jobs, count(*) filter (where job_correct) as good from u group by all),
w as (select week_ending, r.project_id, workflow, count(*) as rater_count, cast(sum(jobs) as bigint) as job_instances,
    max(target) as target_goal, count(*) filter (where good / jobs >= target) as raters_above_target,
    sum(good) / sum(jobs) as workflow_score
  from r left join v_targets t on r.project_id = t.project_id group by all),
a as (select week_ending, project_id, workflow, count(distinct auditor_id) as auditor_count from u group by all),
p as (select *, avg(workflow_score) over (partition by week_ending, project_id) as project_score
  from w left join a using (week_ending, project_id, workflow))
select week_ending, project_id, workflow, rater_count, auditor_count, job_instances, job_instances as audited_instances,
  cast(0 as bigint) as audited_instances_f1, target_goal, raters_above_target,
  cast(0 as bigint) as raters_above_target_f1, round(workflow_score, 6) as workflow_score,
  round(project_score, 6) as project_score, {zeros(*scores("workflow")[1:], *scores("project")[1:])} from p""")
def outcome_workflow_summary(spark, sf):
    return reports.outcome_workflow_summary(outcome_long(spark, sf), targets(spark, sf))


@check(f"""with {UNIQUE},
r as (select week_ending, project_id, workflow, rater_id, cast(count(*) as double) as tot_labels,
  cast(count(*) filter (where job_correct) as double) as correct_labels from u group by all)
select *, 'default_label' as parent_label, {ZERO_CELLS}, round(correct_labels / tot_labels, 6) as rater_label_score,
  round(correct_labels / tot_labels, 6) as rater_score, {zeros(*scores("rater_label")[1:], *scores("rater")[1:])} from r""")
def outcome_rater_label_summary(spark, sf):
    return reports.outcome_rater_label_summary(outcome_long(spark, sf))


@check(f"""with {UNIQUE},
r as (select week_ending, project_id, workflow, job_id, count(*) as rater_count,
  cast(count(*) filter (where job_correct) as double) as correct_rater_count,
  cast(count(*) filter (where not job_correct) as double) as incorrect_rater_count from u group by all)
select *, 'default_label' as parent_label, {ZERO_CELLS}, round(correct_rater_count / rater_count, 6) as job_score,
  {zeros(*scores("job")[1:])} from r""")
def outcome_job_label_summary(spark, sf):
    return reports.outcome_job_label_summary(outcome_long(spark, sf))


@check(f"""with {UNIQUE}
select week_ending, project_id, 'default_label' as parent_label, 'n/a' as rater_response,
  'Incorrect Annotation' as ground_truth, count(*) as error_count, count(*) as weekly_label_error_count,
  cast(1 as double) as weekly_error_contribution from u where not job_correct group by week_ending, project_id""")
def outcome_error_contribution(spark, sf):
    return reports.outcome_error_contribution(outcome_long(spark, sf))


@check(f"""with {UNIQUE},
d as (select distinct week_ending, project_id, workflow, rater_id, job_id, 'default_label' as parent_label,
    'n/a' as rater_response, 'Incorrect Annotation' as ground_truth, '' as confusion_type, job_correct as is_correct
  from u where not job_correct)
select {SAMPLE_COLUMNS} from d""")
def outcome_incorrect_sample(spark, sf):
    return reports.outcome_incorrect_sample(outcome_long(spark, sf))


@check("""select project_id, reporting_week as week_ending, workflow, rater_id, auditor_id, job_id, job_correct,
  job_manual_score, rubric, factor, rubric_penalty, rubric_score from (
  select *, row_number() over (partition by project_id, reporting_week, job_id, rater_id, auditor_id, job_correct, rubric
    order by workflow nulls last, job_date nulls last, job_manual_score nulls last, factor nulls last,
      rubric_penalty nulls last, rubric_score nulls last) as rn
  from v_outcome where job_correct is not null) t where rn = 1""")
def outcome_rubric_detail(spark, sf):
    return reports.outcome_rubric_detail(outcome_long(spark, sf))


@check("""select distinct entry, cast(2.5 * cast(substr(entry, 7) as int) as double) as penalty from v_rubric""")
def infer_rubric_penalties(spark, sf):
    rows = fx.view(spark, sf, "v_rubric")
    # One record's own entries, at most one per line of an order.
    records = rows.groupBy("row_id").agg(
        F.collect_list(F.struct("entry", "factor")).alias("items"),
        F.max("manual_score").alias("score"),
    )
    return rb.infer_penalties(records)


PENALTIES = """select l_orderkey, l_linenumber, cast(l_quantity as int) as factor,
  case l_linenumber % 4 when 0 then concat(cast(cast(l_quantity as int) as string), '%')
    when 1 then concat('0,', cast(cast(l_quantity as int) as string)) when 2 then cast(cast(l_quantity as int) as string)
    else '-1.0' end as raw_penalty from lineitem"""


@check(f"""with p as (select *, try_cast(replace(rtrim(raw_penalty, '%'), ',', '.') as double) as x from ({PENALTIES}) s),
q as (select *, case when x >= 1 then x / 100 else x end as penalty from p)
select l_orderkey, l_linenumber, round(penalty, 6) as rubric_penalty,
  round_even(-factor * penalty, 3) as rubric_score from q""")
def rubric_score(spark, sf):
    rows = fx.query(spark, sf, PENALTIES)
    penalty = clean.normalize_penalty(F.col("raw_penalty"))
    return rows.select(
        "l_orderkey", "l_linenumber", F.round(penalty, 6).alias("rubric_penalty"),
        rb.rubric_score(F.col("factor"), penalty).alias("rubric_score"),
    )


# Entry names with separators, capitals and near duplicates, per brand.
ENTRIES = """select distinct p_brand as scope, entry from (
  select p_brand, p_type as entry from part union all select p_brand, concat(p_type, '!') as entry from part
  union all select p_brand, concat('  ', replace(p_name, ' ', ' / ')) as entry from part) e"""


@check(f"""with e as ({ENTRIES}),
s as (select *, trim(regexp_replace(regexp_replace(translate(lower(trim(entry)), '/- ', '___'), '[^a-z0-9_]+', '', 'g'), '_+', '_', 'g'), '_') as slug from e),
n as (select *, row_number() over (partition by scope, slug order by entry) as k from s)
select scope, entry, case when k = 1 then slug else concat(slug, '_', cast(k as varchar)) end as rubric from n""")
def rubric_slug(spark, sf):
    return rb.name_rubric(fx.query(spark, sf, ENTRIES), ["scope"])
