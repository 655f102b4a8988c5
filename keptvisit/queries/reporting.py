"""Aggregations and reports."""

from datetime import date

from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates
from keptvisit.operators import folds, profiles, reports
from keptvisit.queries.book import query
from keptvisit.queries.steps import FOLD, age_sql

col = F.col


def in_encounters(obs: str) -> str:
    return (f"{{{obs}}} o join {{ehr_encounter}} e on e.encounter_id = o.encounter_id"
            " and e.voided = 0 and o.voided = 0")


def named(clinic, view, codes, names, named_only=True):
    return reports.named_observations(
        clinic.view("ehr_encounter"), clinic.view(view), names, codes, named_only)


@query("eav_pivot_person", "select o.person_id, " + ", ".join(
    f"max(case when o.concept_id in ({', '.join(map(str, codes))}) then cn.name end) as {name}"
    for name, codes in fixed.PERSON_CONCEPTS.items()) + f"""
from {in_encounters("obs")}
join {{concept_name}} cn on cn.concept_id = o.value_coded and cn.voided = 0 and cn.locale = 'en'
  and cn.locale_preferred = 1
where o.concept_id in (1054, 2051, 1972, 1973, 1605, 1710, 5605, 8365)
group by o.person_id""")
def eav_pivot_person(clinic):
    concepts = fixed.PERSON_CONCEPTS
    names = reports.preferred_names(clinic.view("concept_name"), "en", preferred=True, live=True)
    return reports.pivot_values(
        named(clinic, "obs", reports.codes_of(concepts), names), ["person_id"], concepts)


@query("eav_pivot_visit", f"""
select e.visit_id,
  max(case when o.concept_id = 11124 then cn.name end) as health_status,
  max(case when o.concept_id = 10012 then cn.name end) as social_support,
  max(case when o.concept_id = 6744 then cn.name end) as regimen_line
from {in_encounters("visit_obs")}
join {{concept_name}} cn on cn.concept_id = o.value_coded
where o.concept_id in (11124, 10012, 6744)
group by e.visit_id""")
def eav_pivot_visit(clinic):
    concepts = {name: [code] for name, code in reports.VISIT_CONCEPTS.items()}
    names = reports.preferred_names(clinic.view("concept_name"))
    return reports.pivot_values(
        named(clinic, "visit_obs", reports.codes_of(concepts), names), ["visit_id"], concepts)


def yes_no_sql(codes, name):
    return (f"max(case when o.concept_id in ({codes}) and value_coded = 1065 then 'Yes' "
            f"when o.concept_id in ({codes}) and value_coded = 1066 then 'No' end) as {name}")


@query("eav_yes_no_visit", "select e.visit_id, " + ", ".join([
    yes_no_sql("10591", "tb"), yes_no_sql("6836", "art_toxicity"),
    yes_no_sql("7684, 10280", "mental_health"), yes_no_sql("9771", "adherence_counselling"),
    yes_no_sql("6419", "hospitalization"),
    """max(case when (o.concept_id = 6474 and value_coded = 1065)
      or (o.concept_id = 1685 and value_coded is not null) then 'Yes'
    when o.concept_id = 6474 and value_coded = 1066 then 'No' end) as substance_use""",
    "max(case when o.concept_id = 6903 then 'Yes' end) as oi", "max(cn.name) as alcohol",
]) + f" from {in_encounters('visit_obs')}"
       " left join {concept_name} cn on cn.concept_id = o.value_coded and cn.locale = 'en'"
       " where o.concept_id in (10591, 6836, 7684, 10280, 9771, 6419, 6474, 1685, 6903)"
       " group by e.visit_id")
def eav_yes_no_visit(clinic):
    names = reports.preferred_names(clinic.view("concept_name"), "en")
    rows = named(clinic, "visit_obs", reports.YES_NO_CODES, names, named_only=False)
    return reports.yes_no_per_visit(rows, ["visit_id"])


def cutoff_sql(model, risk, suffix, risk_suffix):
    return f"""
select week, case when age >= 18 then 'adult' else 'minor' end as band, location_id,
  '{model}' as model_type, '{risk}' as risk, round(min(prob_{suffix}), 6) as probability_threshold
from {{aged}} where risk_{risk_suffix} = '{risk}' and age is not null
group by week, case when age >= 18 then 'adult' else 'minor' end, location_id"""


AGED = f"""
select l.*, {age_sql("birthdate", "rtc_date")} as age
from {{ledger}} l join {{person}} p on p.person_id = l.person_id"""


@query("risk_cutoffs",
       "select *, 'own' as rule from (" + " union ".join(
           cutoff_sql(model, risk, suffix, suffix)
           for model, suffix in (("1 day", "1day"), ("7 day", "7day"))
           for risk in ("Medium Risk", "High Risk"))
       + ") union all select *, '1-day risk' as rule from (" + " union ".join(
           cutoff_sql(model, risk, suffix, "1day")
           for model, suffix in (("1 day", "1day"), ("7 day", "7day"))
           for risk in ("Medium Risk", "High Risk")) + ")", aged=AGED)
def risk_cutoffs(clinic):
    def cutoffs(compat, rule):
        table = reports.risk_cutoffs(clinic.ledger, clinic.person, ["week"], compat)
        return table.withColumn("rule", F.lit(rule)).withColumn(
            "probability_threshold", F.round("probability_threshold", 6))

    return cutoffs(False, "own").unionByName(cutoffs(True, "1-day risk"))


PERFORMANCE = """
select model_version, week, l.name as clinic, count(*) as appointments,
  count(*) filter (risk_1day is not null) as predicted,
  count(*) filter (observed_rtc_date is not null) as returned,
  count(*) filter (observed_rtc_date < rtc_date) as early,
  count(*) filter (observed_rtc_date = rtc_date) as on_time,
  count(*) filter (observed_rtc_date > rtc_date) as late,
  count(*) filter (observed_rtc_date is null and rtc_date < as_of) as non_returners,
  count(*) filter (risk_1day is null and observed_rtc_date <= rtc_date) as true_negative,
  count(*) filter (risk_1day is null and coalesce(observed_rtc_date > rtc_date, true))
    as false_negative,
  count(*) filter (risk_1day is not null and observed_rtc_date <= rtc_date) as false_positive,
  count(*) filter (risk_1day is not null and coalesce(observed_rtc_date > rtc_date, true))
    as true_positive
from {ledger} m join {location} l on l.location_id = m.location_id,
  (select cast(max(encounter_datetime) as date) as as_of from {encounter})
where rtc_date <= as_of and start_date >= date '1996-01-01' and l.name <> 'Location Test'
group by rollup (model_version, week, l.name)"""


def as_of(clinic):
    """The latest visit day on record, as a constant of the plan."""
    return clinic.encounter.agg(F.to_date(F.max("encounter_datetime"))).scalar()


def performance(clinic):
    return reports.performance(clinic.ledger, clinic.location, as_of(clinic), date(1996, 1, 1))


@query("model_performance_rollup", PERFORMANCE)
def model_performance_rollup(clinic):
    return performance(clinic)


@query("ppv_npv_sens_spec", """
select model_version, week, clinic,
  round(coalesce(true_positive / nullif(true_positive + false_positive, 0), 0), 4) as ppv,
  round(coalesce(true_negative / nullif(true_negative + false_negative, 0), 0), 4) as npv,
  round(coalesce(true_positive / nullif(true_positive + false_negative, 0), 0), 4) as sensitivity,
  round(coalesce(true_negative / nullif(true_negative + false_positive, 0), 0), 4) as specificity
from {performance}""", performance=PERFORMANCE)
def ppv_npv_sens_spec(clinic):
    return reports.with_ratios(performance(clinic)).select(
        "model_version", "week", "clinic", "ppv", "npv", "sensitivity", "specificity")


CASCADE_STEPS = {
    "high_risk_client": "true",
    "high_risk_client_contacted": "phone_ok is not null or home_visit is not null",
    "phone_follow_up": "phone_ok is not null",
    "home_follow_up": "home_visit is not null",
    "successful_contact_attempts": "phone_ok = 'YES' or home_visit = 'YES'",
    "successful_contact_attempts_kept_appointment":
        "(phone_ok = 'YES' or home_visit = 'YES') and rescheduled is null and kept",
    "successful_contact_attempts_missed_appointment":
        "(phone_ok = 'YES' or home_visit = 'YES') and not kept",
    "unsuccessful_contact_attempts": "phone_ok = 'NO' and home_visit is null and best = 'NO'",
    "no_contact_attempts": "phone_ok is null and home_visit is null",
    "no_contact_attempts_kept_appointment": "phone_ok = 'NO' and home_visit is null and kept",
    "rescheduled_appointment": "rescheduled is not null",
    "unsuccessful_kept_appointment":
        "phone_ok = 'NO' and home_visit is null and best = 'NO' and kept",
}


@query("outreach_cascade", "select week, location_id, name, " + ", ".join(
    f"count(distinct person_id) filter ({test}) as {name}" for name, test in CASCADE_STEPS.items()
) + " from {contacts} group by week, location_id, name", contacts="""
select m.week, m.location_id, l.name, m.person_id, o.phone_ok, o.home_visit, o.rescheduled,
  b.best, cast(f.encounter_datetime as date) between m.prediction_generated_date and m.end_date
    as kept
from {ledger} m join {location} l on l.location_id = m.location_id
left join {outreach} o on o.person_id = m.person_id
left join (select person_id, max(phone_ok) as best from {outreach} group by person_id) b
  on b.person_id = m.person_id
left join {visit} f on f.person_id = m.person_id and f.next_clinical_datetime is null
  and f.is_clinical_encounter = 1
where m.risk_1day is not null""")
def outreach_cascade(clinic):
    return reports.outreach_cascade(
        clinic.ledger, clinic.location, clinic.outreach, clinic.encounter)


@query("latest_contact_outcome", """
select distinct person_id, (select max(i.phone_ok) from {outreach} i
  where i.person_id = o.person_id) as outcome
from {outreach} o""")
def latest_contact_outcome(clinic):
    return reports.best_contact_outcome(clinic.outreach)


LABELLED = """
select e.*, case when d >= 1 then 'Disengaged' when d < 1 then 'Active In Care' end as y_1day,
  case when d >= 7 then 'Disengaged' when d < 7 then 'Active In Care' end as y_7days,
  case when d >= 28 then 'Disengaged' when d < 28 then 'Active In Care' end as y_1month,
  case when d >= 90 then 'Disengaged' when d < 90 then 'Active In Care' end as y_3month
from (select *, cast(coalesce(next_clinical_datetime, (select max(encounter_datetime) from {encounter}))
  as date) - rtc_date as d from {visit}) e"""

OUTCOMES = {"y_1day": 1, "y_7days": 7, "y_1month": 28, "y_3month": 90}


def labelled(clinic):
    """Visits with an outcome per horizon; open visits are measured at the last known day."""
    back = F.coalesce(F.to_date("next_clinical_datetime"), as_of(clinic))
    days = dates.days_between(col("rtc_date"), back)
    return clinic.visit.withColumns({
        name: clinical.label_from_days(days, horizon) for name, horizon in OUTCOMES.items()
    })


@query("outcome_prevalence", """
select variable, value, n, round(n * 100 / sum(n) over (partition by variable), 6) as percentage
from (
""" + " union all ".join(
    f"select '{name}' as variable, {name} as value, count(*) as n from {{labelled}} "
    f"where {name} is not null group by {name}" for name in OUTCOMES) + ")", labelled=LABELLED)
def outcome_prevalence(clinic):
    table = profiles.prevalence(labelled(clinic), list(OUTCOMES))
    return table.withColumn("percentage", F.round("percentage", 6))


@query("distinct_person_share", """
select variable, value, persons, round(persons * 100 / sum(persons) over (partition by variable), 6)
  as percentage
from (
  select 'transfer_in_location_id' as variable, cast(transfer_in_location_id as varchar) as value,
    count(distinct person_id) as persons from {encounter} group by transfer_in_location_id
  union all
  select 'transfer_out_location_id', cast(transfer_out_location_id as varchar),
    count(distinct person_id) from {encounter} group by transfer_out_location_id
  union all
  select 'location_id', cast(location_id as varchar), count(distinct person_id)
  from {encounter} group by location_id)""")
def distinct_person_share(clinic):
    table = profiles.distinct_person_share(
        clinic.encounter, ["transfer_in_location_id", "transfer_out_location_id", "location_id"])
    return table.withColumn("percentage", F.round("percentage", 6))


@query("cohort_size", """
select count(distinct person_id) as persons, count(distinct encounter_id) as visits
from {encounter}""")
def cohort_size(clinic):
    return clinic.encounter.agg(
        F.count_distinct("person_id").alias("persons"),
        F.count_distinct("encounter_id").alias("visits"),
    )


@query("class_weights", """
select encounter_id, round(case y_1day when 'Disengaged' then s1 when 'Active In Care' then 1 - s1 end, 6)
    as w_1day,
  round(case y_1month when 'Disengaged' then s2 when 'Active In Care' then 1 - s2 end, 6) as w_1month
from {labelled}, (select count(*) filter (y_1day = 'Active In Care') / count(*) as s1,
  count(*) filter (y_1month = 'Active In Care') / count(*) as s2 from {labelled})""",
       labelled=LABELLED)
def class_weights(clinic):
    rows = labelled(clinic).select("encounter_id", "y_1day", "y_1month")
    weighted = profiles.class_weights(rows, {"y_1day": "w_1day", "y_1month": "w_1month"})
    return weighted.select(
        "encounter_id", F.round("w_1day", 6).alias("w_1day"), F.round("w_1month", 6).alias("w_1month"))


PROFILED = ["weight", "height", "vl_resulted", "cd4_resulted", "who_stage"]
TEXTS = ["disclosure", "arv_meds", "rtc_date"]


@query("missingness_profile", " union all ".join(
    f"select '{name}' as variable, count(*) - count({name}) as n_missing, "
    f"round(count({name}) / count(*), 6) as complete_rate from {{encounter}}"
    for name in PROFILED + TEXTS))
def missingness_profile(clinic):
    table = profiles.missingness(clinic.encounter, PROFILED + TEXTS)
    return table.withColumn("complete_rate", F.round("complete_rate", 6))


@query("numeric_profile", " union all ".join(
    f"""select '{name}' as variable, round(avg({name}), 6) as mean, round(stddev_samp({name}), 6) as sd,
      round(cast(quantile_cont({name}, 0.0) as double), 6) as p0,
      round(cast(quantile_cont({name}, 0.25) as double), 6) as p25,
      round(cast(quantile_cont({name}, 0.5) as double), 6) as p50,
      round(cast(quantile_cont({name}, 0.75) as double), 6) as p75,
      round(cast(quantile_cont({name}, 1.0) as double), 6) as p100 from {{encounter}}"""
    for name in PROFILED))
def numeric_profile(clinic):
    table = profiles.numeric_profile(clinic.encounter, PROFILED)
    numbers = ["mean", "sd", "p0", "p25", "p50", "p75", "p100"]
    return table.withColumns({name: F.round(name, 6) for name in numbers})


@query("long_ecdf", """
select variable, value, count(*) as n, round(any_value(ecdf), 6) as ecdf from (
  select variable, value, cume_dist() over (partition by variable order by value) as ecdf from (
""" + " union all ".join(
    f"select '{name}' as variable, cast({name} as double) as value from {{encounter}} "
    f"where {name} is not null" for name in PROFILED) + ")) group by variable, value")
def long_ecdf(clinic):
    table = profiles.long_ecdf(clinic.encounter, PROFILED)
    return table.withColumn("ecdf", F.round("ecdf", 6))


ACTUAL = "case when observed_rtc_date <= rtc_date then 'Active In Care' else 'Disengaged' end"


def scored(clinic):
    """Ledger rows with their actual outcome; no return counts as disengaged."""
    kept = col("observed_rtc_date") <= col("rtc_date")
    return clinic.ledger.withColumn(
        "actual", F.when(kept, fixed.ACTIVE).otherwise(fixed.DISENGAGED))


@query("score_density", f"""
select cast(least(floor(prob_1day * 20), 19) as int) as bin, {ACTUAL} as actual, count(*) as n
from {{ledger}} group by 1, 2""")
def score_density(clinic):
    table = profiles.score_density(scored(clinic), "prob_1day", "actual", bins=20)
    return table


@query("top_quantile_outcome", " union all ".join(f"""
select '{name}' as cut, {ACTUAL} as actual, count(*) as n from {{ledger}}
where prob_1day > (select quantile_cont(prob_1day, {share}) from {{ledger}}) group by 2"""
    for name, share in (("p80", 0.80), ("p85", 0.85), ("p90", 0.90))))
def top_quantile_outcome(clinic):
    return profiles.top_outcomes(
        scored(clinic), "prob_1day", "actual", {"p80": 0.80, "p85": 0.85, "p90": 0.90})


@query("fold_sizes", "select fold_id, count(*) as persons from {fold} group by fold_id", fold=FOLD)
def fold_sizes(clinic):
    return folds.fold_sizes(folds.person_folds(clinic.encounter))


@query("confusion_matrix", f"""
select {ACTUAL} as actual,
  case when prob_1day >= 0.5 then 'Disengaged' else 'Active In Care' end as predicted,
  count(*) as n
from {{ledger}} group by 1, 2""")
def confusion_matrix(clinic):
    return profiles.confusion_matrix(scored(clinic), "prob_1day", "actual")
