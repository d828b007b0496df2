"""Market and contributor roll-ups, catalogues, dimension checks."""

from pyspark.sql import functions as F

from checks.audit import CELLS, ALLDATA, audit_long, quality
from checks.multi import UNIQUE as MULTI_UNIQUE
from checks.registry import check
from checks import fixtures as fx
from raterscope.functions import clean
from raterscope.functions import metrics as m
from raterscope.plans import reports, rollups
from raterscope.sources import dimension, ledger

# --- markets -----------------------------------------------------------------------------

CONFIG = rollups.MarketConfig(
    target=0.64, combined_label="F+O", project_id="cb", week_ending="2025-07-04"
)
SINGLE = rollups.MarketConfig(
    target=0.85, combined_label="eb", language_token=1, upper_language=False
)

RATED = """select *, (tp_count + tn_count) / nullif(tp_count + fp_count + fn_count + tn_count, 0) as unweighted_accuracy,
    2.0 * tp_count / nullif(2 * tp_count + fp_count + fn_count, 0) as unweighted_f1,
    1.0 * tp_count / nullif(tp_count + fp_count, 0) as unweighted_precision,
    1.0 * tp_count / nullif(tp_count + fn_count, 0) as unweighted_recall"""
RATES = "unweighted_accuracy, unweighted_f1, unweighted_precision, unweighted_recall"
AVERAGES = ", ".join(f"avg({r}) as {r}" for r in RATES.split(", "))
ROUNDED = ", ".join(f"round({r}, 6) as {r}" for r in RATES.split(", "))
SUMS = ", ".join(
    f"cast(sum({c}) as bigint) as {c}"
    for c in ("total_count", "audit_count", "tp_count", "fp_count", "tn_count", "fn_count")
)


def market_sql(token: int = 3, upper: bool = True, target: float = 0.64, combined: str = "F+O") -> str:
    lang = f"split_part(routing_name, '_', {token})"
    lang = f"upper({lang})" if upper else lang
    return f"""ov as ({RATED} from v_market_overview),
ra as ({RATED} from v_market_raters),
over_rows as (select sample_ds, routing_name, nullif({lang}, '') as lang, main_label, {RATES} from ov
  where sample_ds = (select max(sample_ds) from ov x where x.main_label = ov.main_label) and label_category_name ilike '%positive%'),
rl as (select sample_ds, rater_id, nullif({lang}, '') as lang, main_label, total_count, tp_count + fp_count + fn_count as audit_count,
    tp_count, fp_count, tn_count, fn_count, {RATES}, (tp_count + fp_count) / total_count as positivity,
    coalesce(unweighted_f1 >= {target}, false) as above_target, tp_count + fp_count + fn_count > 0 as has_valid_score
  from ra where sample_ds = (select max(sample_ds) from ra x where x.main_label = ra.main_label)),
rc0 as (select sample_ds, rater_id, lang, {SUMS}, {AVERAGES}, avg(positivity) as positivity from rl
  where lang is not null group by all),
rc as (select *, '{combined}' as main_label, coalesce(unweighted_f1 >= {target}, false) as above_target,
  audit_count > 0 as has_valid_score from rc0),
mr as (select sample_ds, lang, count(*) as rater_count, count(*) filter (where above_target) as raters_above_target,
    cast(sum(audit_count) as bigint) as audit_count, avg(positivity) as positivity from rc where has_valid_score group by all),
mc0 as (select sample_ds, lang, {AVERAGES} from over_rows where routing_name not ilike '%combined%' and lang is not null group by all),
mc as (select mc0.*, '{combined}' as main_label, rater_count, raters_above_target,
    raters_above_target / rater_count as raters_above_target_perc, audit_count, positivity
  from mc0 left join mr using (sample_ds, lang)),
oc0 as (select sample_ds, routing_name as lang, {AVERAGES} from over_rows where routing_name ilike '%combined%' group by all),
oc as (select oc0.*, '{combined}' as main_label, t.* exclude (sample_ds), t.raters_above_target / t.rater_count as raters_above_target_perc
  from oc0 left join (select sample_ds, cast(sum(audit_count) as bigint) as audit_count, cast(sum(rater_count) as bigint) as rater_count,
    cast(sum(raters_above_target) as bigint) as raters_above_target from mr group by 1) t on oc0.sample_ds = t.sample_ds)"""


def _rated(df):
    tp, fp, fn, tn = (F.col(f"{c}_count") for c in ("tp", "fp", "fn", "tn"))
    return df.withColumns(
        {
            "unweighted_accuracy": m.ratio(tp + tn, tp + fp + fn + tn),
            "unweighted_f1": m.f1(tp, fp, fn),
            "unweighted_precision": m.precision(tp, fp),
            "unweighted_recall": m.recall(tp, fn),
        }
    )


def _tables(spark, sf, config=CONFIG):
    overview = _rated(fx.view(spark, sf, "v_market_overview"))
    raters = _rated(fx.view(spark, sf, "v_market_raters"))
    return rollups.market_rollup(overview, raters, config)


def _round(df):
    doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, 6) for c in doubles})


@check(f"""with {market_sql()}
select sample_ds, routing_name, lang, main_label, {ROUNDED} from over_rows""")
def market_overview(spark, sf):
    return _round(rollups.market_overview(_rated(fx.view(spark, sf, "v_market_overview")), CONFIG))


_RL = "total_count, audit_count, tp_count, fp_count, tn_count, fn_count"


@check(f"""with {market_sql()}
select sample_ds, rater_id, lang, main_label, {_RL}, {ROUNDED}, round(positivity, 6) as positivity, above_target, has_valid_score from rl""")
def rater_label_market(spark, sf):
    return _round(_tables(spark, sf)["rater_label"])


@check(f"""with {market_sql()}
select sample_ds, rater_id, lang, main_label, {_RL}, {ROUNDED}, round(positivity, 6) as positivity, above_target, has_valid_score from rc""")
def rater_combined(spark, sf):
    return _round(_tables(spark, sf)["rater_combined"])


@check(f"""with {market_sql()}
select sample_ds, routing_name as lang, main_label, {ROUNDED} from over_rows where routing_name ilike '%combined%'""")
def market_overall_label(spark, sf):
    return _round(_tables(spark, sf)["overall_label"])


_MC = f"""sample_ds, lang, main_label, {ROUNDED}, rater_count, raters_above_target,
  round(raters_above_target_perc, 6) as raters_above_target_perc, audit_count"""


@check(f"with {market_sql()} select {_MC} from oc")
def market_overall_combined(spark, sf):
    return _round(_tables(spark, sf)["overall_combined"])


@check(f"""with {market_sql()}
select sample_ds, lang, main_label, {ROUNDED} from over_rows where routing_name not ilike '%combined%'""")
def market_label(spark, sf):
    return _round(_tables(spark, sf)["market_label"])


@check(f"with {market_sql()} select {_MC}, round(positivity, 6) as positivity from mc")
def market_combined(spark, sf):
    return _round(_tables(spark, sf)["market_combined"])


@check(f"with {market_sql(2, False, 0.85, 'eb')} select {_MC}, round(positivity, 6) as positivity from mc")
def market_combined_single(spark, sf):
    """The single-family roll-up: other language token, no upper-casing, other target."""
    return _round(_tables(spark, sf, SINGLE)["market_combined"])


SINGLE_DASH = rollups.MarketConfig(
    target=0.85, combined_label="eb", language_token=1, upper_language=False, project_id="eb", week_ending="2025-07-04"
)
# One family: rows as they are, the language is the second token.
SINGLE_SQL = f"""ov as ({RATED} from v_market_overview), ra as ({RATED} from v_market_raters),
o as (select sample_ds, routing_name, nullif(split_part(routing_name, '_', 2), '') as lang, 'eb' as main_label, {RATES} from ov
  where sample_ds = (select max(sample_ds) from ov) and label_category_name ilike '%positive%'),
r as (select sample_ds, rater_id, nullif(split_part(routing_name, '_', 2), '') as lang, 'eb' as main_label, total_count,
    tp_count + fp_count + fn_count as audit_count, tp_count, fp_count, tn_count, fn_count, {RATES},
    (tp_count + fp_count) / total_count as positivity, coalesce(unweighted_f1 >= 0.85, false) as above_target,
    tp_count + fp_count + fn_count > 0 as has_valid_score from ra where sample_ds = (select max(sample_ds) from ra)),
g as (select sample_ds, lang, count(*) as rater_count, count(*) filter (where above_target) as raters_above_target,
    cast(sum(audit_count) as bigint) as audit_count, avg(positivity) as positivity from r where has_valid_score and lang is not null group by all),
mk as (select o.* exclude (routing_name), g.* exclude (sample_ds, lang), raters_above_target / rater_count as raters_above_target_perc
  from o left join g using (sample_ds, lang) where routing_name not ilike '%combined%'),
t as (select sample_ds, cast(sum(audit_count) as bigint) as audit_count, cast(sum(rater_count) as bigint) as rater_count,
    cast(sum(raters_above_target) as bigint) as raters_above_target, avg(positivity) as positivity from g group by 1),
oa as (select o.sample_ds, routing_name as lang, main_label, {RATES}, t.* exclude (sample_ds), raters_above_target / rater_count as raters_above_target_perc
  from o left join t using (sample_ds) where routing_name ilike '%combined%')"""


def _single(spark, sf, name):
    overview, raters = (_rated(fx.view(spark, sf, f"v_market_{v}")) for v in ("overview", "raters"))
    return _round(rollups.single_family_rollup(overview, raters, SINGLE_DASH)[name])


@check(f"with {SINGLE_SQL} select {_MC}, round(positivity, 6) as positivity from oa")
def market_single_overall(spark, sf):
    return _single(spark, sf, "overall")


@check(f"with {SINGLE_SQL} select {_MC}, round(positivity, 6) as positivity from mk")
def market_single_market(spark, sf):
    return _single(spark, sf, "market")


@check(f"""with {SINGLE_SQL}
select date '2025-07-04' as week_ending, 'eb' as project_id, mk.lang as workflow, mk.rater_count,
  cast(null as bigint) as auditor_count, cast(null as bigint) as job_instances, mk.audit_count as audited_instances,
  mk.audit_count as audited_instances_f1, cast(0.85 as double) as target_goal, mk.raters_above_target,
  mk.raters_above_target as raters_above_target_f1,
  round(mk.unweighted_accuracy, 6) as workflow_score, round(mk.unweighted_f1, 6) as workflow_f1score,
  round(mk.unweighted_precision, 6) as workflow_precision, round(mk.unweighted_recall, 6) as workflow_recall,
  round(oa.unweighted_accuracy, 6) as project_score, round(oa.unweighted_f1, 6) as project_f1score,
  round(oa.unweighted_precision, 6) as project_precision, round(oa.unweighted_recall, 6) as project_recall
from mk left join oa using (sample_ds)""")
def market_single_dashboard_workflow(spark, sf):
    return _single(spark, sf, "dashboard_workflow")


@check(f"""with {SINGLE_SQL}
select date '2025-07-04' as week_ending, 'eb' as project_id, r.lang as workflow, r.rater_id, 'eb' as parent_label, r.total_count as tot_labels,
  r.tp_count + r.tn_count as correct_labels, r.audit_count, r.tp_count, r.tn_count, r.fp_count, r.fn_count,
  round(r.unweighted_accuracy, 6) as rater_label_score, round(r.unweighted_f1, 6) as rater_label_f1score,
  round(r.unweighted_precision, 6) as rater_label_precision, round(r.unweighted_recall, 6) as rater_label_recall,
  round(x.unweighted_accuracy, 6) as rater_score, round(x.unweighted_f1, 6) as rater_f1score,
  round(x.unweighted_precision, 6) as rater_precision, round(x.unweighted_recall, 6) as rater_recall
from r left join r x on r.sample_ds = x.sample_ds and r.rater_id = x.rater_id""")
def market_single_dashboard_rater(spark, sf):
    return _single(spark, sf, "dashboard_rater")


_NAMES = (("accuracy", "score"), ("f1", "f1score"), ("precision", "precision"), ("recall", "recall"))


def _as(source: str, prefix: str) -> str:
    return ", ".join(f"round({source}.unweighted_{a}, 6) as {prefix}_{b}" for a, b in _NAMES)


@check(f"""with {market_sql()}
select date '2025-07-04' as week_ending, 'cb' as project_id, mc.lang as workflow, mc.rater_count,
  cast(null as bigint) as auditor_count, cast(null as bigint) as job_instances, mc.audit_count as audited_instances,
  mc.audit_count as audited_instances_f1, cast(0.64 as double) as target_goal, mc.raters_above_target,
  mc.raters_above_target as raters_above_target_f1, {_as("mc", "workflow")}, {_as("oc", "project")}
from mc left join oc on mc.sample_ds = oc.sample_ds and mc.main_label = oc.main_label""")
def market_dashboard_workflow(spark, sf):
    return _round(_tables(spark, sf)["dashboard_workflow"])


@check(f"""with {market_sql()}
select date '2025-07-04' as week_ending, 'cb' as project_id, rl.lang as workflow, rl.rater_id, rl.main_label as parent_label,
  rl.total_count as tot_labels, rl.tp_count + rl.tn_count as correct_labels, rl.audit_count, rl.tp_count, rl.tn_count,
  rl.fp_count, rl.fn_count, {_as("rl", "rater_label")}, {_as("rc", "rater")}
from rl left join rc on rl.sample_ds = rc.sample_ds and rl.rater_id = rc.rater_id""")
def market_dashboard_rater(spark, sf):
    return _round(_tables(spark, sf)["dashboard_rater"])


# --- contributors --------------------------------------------------------------------------

PROJECTS = """select _project_id as project_id, _project_name as project_name, _project_metric as project_metric,
  case when _project_target like '%\\%' escape '\\' then cast(replace(_project_target, '%', '') as double) / 100
       when cast(_project_target as double) > 1 then cast(_project_target as double) / 100 else cast(_project_target as double) end as target
from v_projects where _project_status = 'Active'"""


ROLLUP_SQL = f"""with {ALLDATA},
r as (select week_ending, project_id, workflow, rater_id, parent_label, sum(weight) as tot_labels,
    sum(case when is_correct then weight else 0 end) as correct_labels, {CELLS} from alldata group by all),
s as (select *, round(correct_labels / nullif(tot_labels, 0), 6) as rater_label_score, {quality("rater_label")} from r),
a as (select week_ending, project_id, rater_id, tot_labels, correct_labels, tp_count, fp_count, tn_count, fn_count,
    round(avg(correct_labels / nullif(tot_labels, 0)) over q, 6) as rater_score, round(avg(rater_label_f1score) over q, 6) as rater_f1score,
    round(avg(rater_label_precision) over q, 6) as rater_precision, round(avg(rater_label_recall) over q, 6) as rater_recall
  from s window q as (partition by week_ending, project_id, workflow, rater_id)),
{MULTI_UNIQUE},
mr as (select week_ending, project_id, workflow, rater_id, parent_label, sum(weight * is_determined) as tot_labels,
    sum(weight * is_determined * is_agreeing) as correct_labels from c group by all),
b as (select week_ending, project_id, rater_id, tot_labels, correct_labels, 0 as tp_count, 0 as fp_count, 0 as tn_count, 0 as fn_count,
    round(avg(correct_labels / nullif(tot_labels, 0)) over (partition by week_ending, project_id, workflow, rater_id), 6) as rater_score,
    cast(null as double) as rater_f1score, cast(null as double) as rater_precision, cast(null as double) as rater_recall from mr),
x as (select * from a union all select * from b),
p as ({PROJECTS}),
j as (select week_ending, regexp_replace(x.project_id, 'n[0-9]$', '') as project_id, project_name,
    case when regexp_matches(x.project_id, 'n[0-9]$') then right(x.project_id, 1) else '1' end as segment, rater_id,
    tot_labels, correct_labels, tp_count, fp_count, tn_count, fn_count, rater_score, rater_f1score, rater_precision, rater_recall,
    target, project_metric
  from x join p on x.project_id = p.project_id),
g as (select week_ending, project_id, project_name, segment, rater_id, target, project_metric, sum(tot_labels) as tot_labels,
    sum(correct_labels) as correct_labels, cast(sum(tp_count) as bigint) as tp_count, cast(sum(fp_count) as bigint) as fp_count,
    cast(sum(tn_count) as bigint) as tn_count, cast(sum(fn_count) as bigint) as fn_count, round(avg(rater_score), 12) as score,
    round(avg(rater_f1score), 12) as rater_f1score, round(avg(rater_precision), 12) as rater_precision, round(avg(rater_recall), 12) as rater_recall
  from j group by all)
select week_ending, project_id, project_name, segment, rater_id, tot_labels, correct_labels, tp_count, fp_count, tn_count, fn_count,
  case when project_metric <> 'agreement' then score end as rater_accuracy,
  case when project_metric = 'agreement' then score end as rater_agreement,
  rater_f1score, rater_precision, rater_recall, target as target_goal from g"""


@check(ROLLUP_SQL)
def contributor_rollup(spark, sf):
    audit = reports.audit_rater_label_summary(audit_long(spark, sf))
    multi = reports.multi_rater_label_summary(fx.view(spark, sf, "v_multi"))
    dim = dimension.project_dim(fx.view(spark, sf, "v_projects"), active_only=True)
    projects = dim.join(dimension.targets(dim), "project_id")
    table = rollups.contributor_rollup(audit.unionByName(multi), projects)
    means = ["rater_accuracy", "rater_agreement", *rollups.CONTRIBUTOR_MEANS[1:]]
    return table.withColumns({c: F.round(c, 12) for c in means})


@check(f"""select week_ending as "Week Ending", project_id as "Project ID", project_name as "Project Name", segment as "Segment",
  concat('''', rater_id) as "Contributor ID", tot_labels as "Total Labels", correct_labels as "Correct Labels",
  tp_count as "True Positives", fp_count as "False Positives", tn_count as "True Negatives", fn_count as "False Negatives",
  rater_accuracy as "Accuracy", rater_agreement as "Agreement", rater_f1score as "F1 Score", rater_precision as "Precision",
  rater_recall as "Recall", target_goal as "Target Goal" from ({ROLLUP_SQL}) t""")
def contributor_display(spark, sf):
    """The whole contributor table as it is shown: every row and column."""
    return rollups.contributor_display(contributor_rollup(spark, sf))


# --- catalogues ----------------------------------------------------------------------------

WORKFLOWS = """select project_id, workflow from v_audit union select project_id, workflow from v_multi
union select project_id, workflow from v_outcome"""
LABELS = """select project_id, parent_label as label from v_audit union select project_id, parent_label from v_multi
union select project_id, rubric from v_outcome"""


def _long_tables(spark, sf):
    return [fx.view(spark, sf, v) for v in ("v_audit", "v_multi", "v_outcome")]


@check(WORKFLOWS)
def catalog_workflows(spark, sf):
    return rollups.catalog_workflows(*_long_tables(spark, sf))


@check(LABELS)
def catalog_labels(spark, sf):
    return rollups.catalog_labels(*_long_tables(spark, sf))


NAMED = "(select _project_id as project_id, _project_name as project_name from v_projects where _project_status not in ('Hidden', 'Deprecated')) n"


@check(f"""with c as ({WORKFLOWS}),
known as (select distinct project_id, workflow from v_audit where l_is_known(workflow))
select n.project_name, c.project_id, c.workflow, '' as note from c left join {NAMED} on n.project_id = c.project_id
where not exists (select 1 from known k where k.project_id = c.project_id and k.workflow = c.workflow)""".replace(
    "l_is_known(workflow)", "workflow in ('1-URGENT', '5-LOW')"))
def new_workflow_entries(spark, sf):
    known = fx.view(spark, sf, "v_audit").where("workflow in ('1-URGENT', '5-LOW')")
    known = known.select("project_id", "workflow", F.lit("seen").alias("note"))
    dim = dimension.project_dim(fx.view(spark, sf, "v_projects"))
    return rollups.new_entries(catalog_workflows(spark, sf), known, dim, "workflow")


@check(f"""with c as ({LABELS})
select n.project_name, c.project_id, c.label, '' as note from c left join {NAMED} on n.project_id = c.project_id
where not exists (select 1 from v_multi k where k.project_id = c.project_id and k.parent_label = c.label)
  and not exists (select 1 from v_outcome k where k.project_id = c.project_id and k.rubric = c.label and k.rubric = 'rubric_1')""")
def new_label_entries(spark, sf):
    multi = fx.view(spark, sf, "v_multi").select("project_id", F.col("parent_label").alias("label"))
    first = fx.view(spark, sf, "v_outcome").where("rubric = 'rubric_1'")
    known = multi.unionByName(first.select("project_id", F.col("rubric").alias("label")))
    dim = dimension.project_dim(fx.view(spark, sf, "v_projects"))
    known = known.withColumn("note", F.lit("seen"))
    return rollups.new_entries(catalog_labels(spark, sf), known, dim, "label")


# --- projects, rosters ---------------------------------------------------------------------

# One project per customer.
RAW_PROJECTS = """select concat('c', cast(c_custkey as string)) as _project_id, c_name as _project_name,
  case c_mktsegment when 'BUILDING' then 'Hidden' when 'MACHINERY' then 'Deprecated' when 'HOUSEHOLD' then 'Inactive' else 'Active' end as _project_status,
  case c_custkey % 5 when 0 then concat(cast(c_custkey % 101 as string), '%') when 1 then concat('0.', cast(10 + c_custkey % 90 as string))
    when 2 then cast(2 + c_custkey % 99 as string) when 3 then concat(' ', cast(c_custkey % 101 as string), '% ') else 'tbd' end as _project_target,
  case c_custkey % 4 when 0 then '2025-01-15' when 1 then '2025-09-01' when 2 then 'soon' else null end as _project_start_date,
  case when c_custkey % 3 = 0 then '2026-06-30' else '' end as _project_end_date,
  case c_custkey % 3 when 0 then concat('{"module": "UQD", "module_config": {"quality_methodology": "audit", "label_weights": {"a": ', cast(c_custkey % 7 as string), '}}}')
    when 1 then '{bad' else '' end as _project_config,
  c_acctbal as note, c_custkey as internal_key, c_custkey % 5 as _k5, c_custkey % 4 as _k4, c_custkey % 3 as _k3, c_custkey as _key
from customer"""
TARGET = """case _k5 when 0 then (_key % 101) / 100.0 when 1 then cast(concat('0.', cast(10 + _key % 90 as varchar)) as double)
  when 2 then (2 + _key % 99) / 100.0 when 3 then (_key % 101) / 100.0 end"""


def _raw_projects(spark, sf):
    return fx.query(spark, sf, RAW_PROJECTS)


@check(f"""select _project_id as project_id, _project_name as project_name, _project_status as project_status
from ({RAW_PROJECTS}) p where _project_status not in ('Hidden', 'Deprecated')""")
def project_dim(spark, sf):
    dim = dimension.project_dim(_raw_projects(spark, sf))
    return dim.select("project_id", "project_name", "project_status")


@check(f"""select _project_id as project_id, _project_target as project_target, round(cast({TARGET} as double), 6) as target from ({RAW_PROJECTS}) p""")
def normalize_target(spark, sf):
    raw = _raw_projects(spark, sf)
    target = clean.normalize_target(F.col("_project_target"))
    return raw.select(
        F.col("_project_id").alias("project_id"), F.col("_project_target").alias("project_target"),
        F.round(target, 6).alias("target"),
    )


@check(f"""select _project_id as project_id, case _k4 when 1 then date '2025-09-01' else date '2025-07-01' end as project_start_date,
  case when _k3 = 0 then date '2026-06-30' end as project_end_date, round(cast({TARGET} as double), 6) as project_target,
  case when _k3 = 0 then 'UQD' end as module, case when _k3 = 0 then 'audit' end as methodology,
  case when _k3 = 0 then cast(_key % 7 as double) end as weight_a
from ({RAW_PROJECTS}) p where _project_status not in ('Hidden', 'Deprecated')""")
def project_metadata(spark, sf):
    meta = dimension.metadata(dimension.project_dim(_raw_projects(spark, sf)))
    config = F.col("config.module_config")
    return meta.select(
        "project_id", "project_start_date", "project_end_date",
        F.round("project_target", 6).alias("project_target"), F.col("config.module").alias("module"),
        config["quality_methodology"].alias("methodology"),
        F.try_element_at(config["label_weights"], F.lit("a")).alias("weight_a"),
    )


@check("""with p as (select _project_id as project_id from v_projects where _project_status = 'Active')
select v.project_id, data_week, filename, size_bytes, arrival from v_files v where v.project_id in (select project_id from p)""")
def active_projects_semi(spark, sf):
    projects = dimension.project_dim(fx.view(spark, sf, "v_projects"))
    return ledger.active_only(fx.view(spark, sf, "v_files"), projects)


# A roster with unknown headers: most ids and markets are good, some are not; ids repeat.
ROSTER = """select c_custkey as row_pos, c_name as `Contributor Name`,
  case when c_custkey % 9 = 0 then 'n/a' when c_custkey % 2 = 0 then concat('#', cast(10000000000 + c_custkey % 1000 as string))
    else cast(10000000000 + c_custkey % 1000 as string) end as `SRT ID`,
  case when c_nationkey % 8 = 0 then 'unknown' when c_nationkey % 2 = 0 then 'EN-US' else 'it-it' end as `Market Name`,
  concat('Rater', cast(c_custkey % 700 as string), case when c_custkey % 8 = 0 then '' else '@Example.org ' end) as `Work Mail`
from customer"""


@check(f"""with c as (select count(*) as n, count(*) filter (where regexp_matches("SRT ID", '^[#'']?[0-9]{{10,}}$')) as good_id,
  count(*) filter (where regexp_matches(trim("Market Name"), '(?i)^[a-z]{{2}}-[a-z]{{2}}$')) as good_market,
  count(*) filter (where regexp_matches(trim("Work Mail"), '(?i)^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}$')) as good_mail from ({ROSTER.replace("`", '"')}) r)
select 'rater_id' as role, 'SRT ID' as column_name from c where good_id >= n // 2
union all select 'market', 'Market Name' from c where good_market >= n // 2
union all select 'email', 'Work Mail' from c where good_mail >= n // 2""")
def infer_role_columns(spark, sf):
    roles = {**dimension.ROSTER_ROLES, "email": (dimension.EMAIL_HINTS, dimension.EMAIL_VALUE)}
    return dimension.infer_role_columns(fx.query(spark, sf, ROSTER).drop("row_pos"), roles)


@check(f"""select regexp_replace("SRT ID", '^#', '') as rater_id, arg_max("Market Name", row_pos) as market
from ({ROSTER.replace("`", '"')}) r group by 1""")
def roster_map(spark, sf):
    return dimension.roster_map(fx.query(spark, sf, ROSTER))


@check(f"""select lower(trim("Work Mail")) as email, arg_max(regexp_replace("SRT ID", '^#', ''), row_pos) as rater_id
from ({ROSTER.replace("`", '"')}) r where "Work Mail" like '%@%' group by 1""")
def email_map(spark, sf):
    return dimension.email_map(fx.query(spark, sf, ROSTER))
