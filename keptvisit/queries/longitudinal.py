"""Window features, labels and timeliness."""

from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates
from keptvisit.operators import history, joins, longitudinal, ranks, reports, timeline
from keptvisit.queries.book import query
from keptvisit.queries.reporting import as_of
from keptvisit.queries.steps import HISTORY, age_sql

col = F.col

# One visit per person and day, with the columns of the next recorded visit.
DAILY = """
select * from (
  select *, cast(encounter_datetime as date) as visit_date,
    row_number() over (partition by person_id, cast(encounter_datetime as date)
      order by encounter_id) as day_row
  from {visit}) where day_row = 1"""

LAST_DAY = "(select cast(max(encounter_datetime) as date) from {encounter})"


def label_sql(test: str, name: str, guard: str = "true") -> str:
    return (f"case when not ({guard}) then null when {test} then 'Disengaged' "
            f"when not ({test}) then 'Active In Care' end as y_{name}")


LABELS = {
    "daily": DAILY,
    "spans": f"""
select *, lead(encounter_type) over (partition by person_id order by encounter_id) as next_type,
  cast(coalesce(cast(next_clinical_datetime as date), {LAST_DAY}) - rtc_date as int) as days_defaulted
from {{daily}}""",
    "labels": "select *, " + ", ".join(
        label_sql(f"days_defaulted >= {days}", name, "coalesce(next_type not in (153, 158, 186), true)")
        for name, days in fixed.HORIZONS.items()) + " from {spans}",
    "old_labels": "select *, " + ", ".join(
        label_sql(f"days_defaulted >= {days}", name) for name, days in fixed.HORIZONS.items())
    + " from {spans}",
}


def daily(clinic):
    return timeline.first_of_day(clinic.visit, clinic.hot_persons, laid_out=True)


def labels(clinic, pickup_aware=True):
    rows = daily(clinic).withColumn("next_type", F.lead("encounter_type").over(longitudinal.by_id()))
    back = F.coalesce(F.to_date("next_clinical_datetime"), as_of(clinic))
    return longitudinal.outcome_labels(
        rows, back, next_type=col("next_type") if pickup_aware else None)


@query("visit_number", """
select person_id, encounter_id, cast(visit_number as bigint) as visit_number from {kept}""", **HISTORY)
def visit_number(clinic):
    kept = history.care_visits(clinic.visit, history.SINCE)
    return history.visit_numbers(kept, clinic.hot_persons).select(
        "person_id", "encounter_id", "visit_number")


BMI = "round(weight / ((height / 100) * (height / 100)), 2)"


@query("baseline_visit", f"""
select k.person_id, {age_sql("birthdate", "encounter_datetime")} as age_baseline,
  gender as gender_baseline,
  case when weight >= 1 and height >= 1 and {BMI} between 5 and 60 then {BMI} end as bmi_baseline,
  who_stage as who_staging_baseline,
  case when vl_resulted < 1000 then 1 else 0 end as vl_suppression_baseline,
  round(log10(vl_resulted + 1), 6) as viral_load_log10_baseline,
  disclosure as hiv_disclosure_baseline, arv_line as regimen_line_baseline,
  coalesce(is_pregnant, 0) as pregnancy_baseline,
  case when k.location_id in ({", ".join(map(str, fixed.URBAN_SITES))}) then 'Urban'
    when k.location_id in ({", ".join(map(str, fixed.RURAL_SITES))}) then 'Rural' end
    as clinic_location_baseline,
  cd4_resulted as cd4_baseline, l.name as clinic_name_baseline,
  replace(replace(replace(replace(replace(replace(replace(arv_meds, '##', ' + '),
    '1400', 'DTG'), '628', '3TC'), '630', 'AZT'), '631', 'NVP'), '632', 'TDF'), '633', 'EFV')
    as art_regimen_baseline
from {{kept}} k left join {{person}} p on p.person_id = k.person_id
left join {{location}} l on l.location_id = k.location_id and l.retired = 0
where visit_number = 1""", **HISTORY)
def baseline_visit(clinic):
    table = history.baseline_visit(clinic.visit, clinic.person, clinic.location, history.SINCE)
    return table.withColumn("viral_load_log10_baseline", F.round("viral_load_log10_baseline", 6))


@query("days_defaulted_history", "select * from {history}", **HISTORY)
def days_defaulted_history(clinic):
    return history.days_defaulted_history(clinic.visit, clinic.hot_persons, history.SINCE)


@query("strict_three_visit_defaults", """
select a.person_id, a.encounter_id, a.visit_number,
  case when a.days_defaulted_last_encounter is null or b.days_defaulted_last_encounter is null
    or c.days_defaulted_last_encounter is null then null
  else (a.days_defaulted_last_encounter >= 1)::int + (b.days_defaulted_last_encounter >= 1)::int
    + (c.days_defaulted_last_encounter >= 1)::int end as num_1day_defaults_last_3_visits
from {history} a
left join {history} b on b.person_id = a.person_id and b.visit_number = a.visit_number - 1
left join {history} c on c.person_id = b.person_id and c.visit_number = b.visit_number - 1""",
       **HISTORY)
def strict_three_visit_defaults(clinic):
    table = history.days_defaulted_history(clinic.visit, clinic.hot_persons, history.SINCE)
    return history.strict_three_visit_defaults(table, clinic.hot_persons)


@query("first_row_per_day", """
select person_id, visit_date, encounter_id, encounter_type, rtc_date from {daily}""", daily=DAILY)
def first_row_per_day(clinic):
    rows = timeline.first_of_day(clinic.encounter, clinic.hot_persons)
    return rows.select("person_id", "visit_date", "encounter_id", "encounter_type", "rtc_date")


@query("next_visit", f"""
select person_id, encounter_id, coalesce(lead(visit_date) over w, {LAST_DAY}) as next_date,
  lead(encounter_type) over w as next_type, lead(rtc_date) over w as next_appointment,
  coalesce(lead(visit_date, 2) over w, {LAST_DAY}) as second_next_date
from {{daily}} window w as (partition by person_id order by encounter_id)""", daily=DAILY)
def next_visit(clinic):
    rows = timeline.first_of_day(clinic.encounter, clinic.hot_persons)
    return longitudinal.next_visits(rows, as_of(clinic)).select(
        "person_id", "encounter_id", "next_date", "next_type", "next_appointment",
        "second_next_date")


ORDERS = {
    "daily": DAILY,
    "guesses": """
select *, case when vl_resulted is not null and vl_order_date is null
    then lag(visit_date) over w else vl_order_date end as vl_guess,
  case when cd4_resulted is not null and cd4_order_date is null
    then lag(visit_date) over w else cd4_order_date end as cd4_guess
from {daily} window w as (partition by person_id order by encounter_id)""",
    "orders_known": """
select *, last_value(vl_guess ignore nulls) over w as vl_order_estimated,
  last_value(cd4_guess ignore nulls) over w as cd4_order_estimated
from {guesses} window w as (partition by person_id order by visit_date
  rows between unbounded preceding and current row)""",
}

LABS = {
    "vl_order_estimated": ("vl_resulted", "vl_order_date"),
    "cd4_order_estimated": ("cd4_resulted", "cd4_order_date"),
}


def ordered_labs(clinic):
    return longitudinal.estimated_order_dates(
        timeline.first_of_day(clinic.encounter, clinic.hot_persons), LABS)


@query("estimated_order_date", """
select person_id, encounter_id, vl_order_estimated, cd4_order_estimated from {orders_known}""",
       **ORDERS)
def estimated_order_date(clinic):
    return ordered_labs(clinic).select("person_id", "encounter_id", *LABS)


@query("days_since_order", """
select person_id, encounter_id, cast(visit_date - vl_order_estimated as int) as days_since_vl,
  cast(visit_date - cd4_order_estimated as int) as days_since_cd4 from {orders_known}""", **ORDERS)
def days_since_order(clinic):
    spans = {"days_since_vl": "vl_order_estimated", "days_since_cd4": "cd4_order_estimated"}
    return longitudinal.days_since(ordered_labs(clinic), spans).select(
        "person_id", "encounter_id", *spans)


CARRIED = ["weight", "who_stage", "vl_resulted", "cd4_resulted", "arv_line", "is_pregnant",
           "arv_meds", "disclosure", "tb_test_result"]


@query("locf_impute", "select person_id, encounter_id, " + ", ".join(
    f"{name} as {name}_orig, last_value({name} ignore nulls) over w as {name}" for name in CARRIED)
    + """ from {daily} window w as (partition by person_id order by visit_date
  rows between unbounded preceding and current row)""", daily=DAILY)
def locf_impute(clinic):
    rows = timeline.first_of_day(clinic.encounter, clinic.hot_persons)
    filled = longitudinal.carry_forward(rows, CARRIED, baseline=False)
    return filled.select("person_id", "encounter_id", *CARRIED, *[f"{n}_orig" for n in CARRIED])


@query("baseline_broadcast", "select d.person_id, d.encounter_id, " + ", ".join(
    f"b.{name} as {name}_baseline" for name in CARRIED) + """
from {daily} d join (
  select * from (select *, row_number() over (partition by person_id order by visit_date) as visit_row
    from {daily}) where visit_row = 1) b on b.person_id = d.person_id""", daily=DAILY)
def baseline_broadcast(clinic):
    rows = timeline.first_of_day(clinic.encounter, clinic.hot_persons)
    return longitudinal.baselines(rows, CARRIED).select(
        "person_id", "encounter_id", *[f"{name}_baseline" for name in CARRIED])


ROLLED = ["1day", "7days", "2wks", "1month"]


@query("rolling_defaults", "select person_id, encounter_id, " + ", ".join(
    f"coalesce(cast(lag(r_{name}) over (partition by person_id order by encounter_id) as bigint), 0) "
    f"as num_{name}_defaults_last_3visits" for name in ROLLED) + " from {sums}",
       **LABELS, sums="select person_id, encounter_id, " + ", ".join(
           f"case when count(y_{name}) over w = count(*) over w then "
           f"sum(case when y_{name} = 'Disengaged' then 1 else 0 end) over w end as r_{name}"
           for name in ROLLED) + """ from {old_labels}
window w as (partition by person_id order by visit_date rows between 2 preceding and current row)""")
def rolling_defaults(clinic):
    rows = longitudinal.rolling_defaults(labels(clinic, pickup_aware=False), ROLLED)
    return rows.select(
        "person_id", "encounter_id", *[f"num_{name}_defaults_last_3visits" for name in ROLLED])


PICKUPS = {
    **LABELS,
    "placed": """
select *, row_number() over (partition by person_id order by visit_date) as spot,
  sum(case when y_1day is null then 1 else 0 end) over (partition by person_id order by visit_date
    rows between 2 preceding and current row) as unlabelled
from {labels}""",
    "widths": """
select *, coalesce(lag(unlabelled) over (partition by person_id order by encounter_id), 0) as pickups
from {placed}""",
    "reached": "select a.person_id, a.encounter_id, any_value(a.pickups) as pickups, " + ", ".join(
        f"count(*) filter (b.y_{name} = 'Disengaged') as s_{name}" for name in ROLLED) + """
from {widths} a join {widths} b on b.person_id = a.person_id
  and b.spot between a.spot - 2 - a.pickups and a.spot
group by a.person_id, a.encounter_id""",
}


@query("pickup_aware_rolling", """
select person_id, encounter_id, cast(pickups as bigint) as med_pickups_last_3visits, """ + ", ".join(
    f"cast(coalesce(lag(s_{name}) over (partition by person_id order by encounter_id), 0) as int) "
    f"as num_{name}_defaults_last_3visits" for name in ROLLED) + " from {reached}", **PICKUPS)
def pickup_aware_rolling(clinic):
    rows = longitudinal.pickup_aware_rolling(labels(clinic), ROLLED)
    return rows.select(
        "person_id", "encounter_id", "med_pickups_last_3visits",
        *[f"num_{name}_defaults_last_3visits" for name in ROLLED])


@query("last_clinical_default", """
select a.person_id, a.encounter_id, b.days_defaulted as days_defaulted_prev
from (
  select person_id, encounter_id, lag(last_spot) over (partition by person_id order by encounter_id)
    as wanted
  from (select *, max(case when encounter_type in (153, 158, 186) then null else spot end)
      over (partition by person_id order by visit_date
        rows between unbounded preceding and current row) as last_spot from {numbered})) a
left join {numbered} b on b.person_id = a.person_id and b.spot = a.wanted""",
       **LABELS, numbered="""
select *, row_number() over (partition by person_id order by visit_date) as spot from {labels}""")
def last_clinical_default(clinic):
    return longitudinal.last_clinical_default(labels(clinic)).select(
        "person_id", "encounter_id", "days_defaulted_prev")


def ever_sql(span: int, bound: str, name: str) -> str:
    return f"""
case when count(*) filter (b.y_1month = 'Disengaged'
    and b.visit_date {bound} a.visit_date - interval {span} year) > 0 then 1
  when count(*) filter (b.encounter_id is not null and b.y_1month is null
    and b.visit_date {bound} a.visit_date - interval {span} year) > 0 then null
  else 0 end as {name}"""


@query("ever_defaulted_within", f"""
select a.person_id, a.encounter_id, {ever_sql(1, ">", "ever_1year")}, {ever_sql(2, ">", "ever_2year")},
  {ever_sql(1, ">=", "ever_1year_inclusive")}
from {{labels}} a left join {{labels}} b on b.person_id = a.person_id and b.visit_date < a.visit_date
group by a.person_id, a.encounter_id""", **LABELS)
def ever_defaulted_within(clinic):
    rows = longitudinal.ever_defaulted(labels(clinic), {"ever_1year": 1, "ever_2year": 2})
    rows = longitudinal.ever_defaulted(rows, {"ever_1year_inclusive": 1}, inclusive=True)
    return rows.select(
        "person_id", "encounter_id", "ever_1year", "ever_2year", "ever_1year_inclusive")


@query("cohort_from_first_age", f"""
select person_id, encounter_id, first_age, case when first_age >= 18 then 'adult'
  when first_age < 18 then 'minor' end as cohort
from (select person_id, encounter_id, first_value({age_sql("birthdate", "visit_date")}) over (
    partition by person_id order by visit_date) as first_age
  from {{daily}} join {{person}} using (person_id))""", daily=DAILY)
def cohort_from_first_age(clinic):
    rows = timeline.first_of_day(clinic.encounter, clinic.hot_persons).join(
        clinic.person, "person_id")
    age = dates.years_between(col("birthdate"), col("visit_date"))
    return longitudinal.cohort_from_first_age(rows.withColumn("age", age)).select(
        "person_id", "encounter_id", "first_age", "cohort")


@query("percent_rank_global", """
select encounter_id, round(percent_rank() over (order by prob_1day), 6) as rank_1day,
  round(percent_rank() over (order by vl_resulted), 6) as rank_load
from {ledger} join {encounter} using (encounter_id) where vl_resulted is not null""")
def percent_rank_global(clinic):
    loads = clinic.encounter.select("encounter_id", "vl_resulted").filter("vl_resulted is not null")
    rows = clinic.ledger.select("encounter_id", "prob_1day").join(loads, "encounter_id")
    ranked = ranks.with_percent_rank(rows, [], "prob_1day", "rank_1day")
    ranked = ranks.with_percent_rank(ranked, [], "vl_resulted", "rank_load")
    return ranked.select(
        "encounter_id", F.round("rank_1day", 6).alias("rank_1day"),
        F.round("rank_load", 6).alias("rank_load"))


@query("percent_rank_by_site", """
select encounter_id, location_id,
  round(percent_rank() over (partition by location_id order by prob_1day), 6) as site_rank
from {ledger}""")
def percent_rank_by_site(clinic):
    rows = clinic.ledger.select("encounter_id", "location_id", "prob_1day")
    ranked = ranks.with_percent_rank(rows, ["location_id"], "prob_1day", "site_rank")
    return ranked.select("encounter_id", "location_id", F.round("site_rank", 6).alias("site_rank"))


@query("disengagement_labels", """
select person_id, encounter_id, days_defaulted, y_1day, y_7days, y_2wks, y_1month, y_3month,
  case when days_defaulted > 30 then 'Disengaged' when days_defaulted <= 30 then 'Active In Care' end
    as y_1month_old
from {old_labels}""", **LABELS)
def disengagement_labels(clinic):
    old = clinical.label_from_days(
        col("days_defaulted"), fixed.HORIZONS_OLD["1month"], strict=True)
    return labels(clinic, pickup_aware=False).select(
        "person_id", "encounter_id", "days_defaulted", *[f"y_{name}" for name in fixed.HORIZONS],
        old.alias("y_1month_old"))


@query("label_null_on_pickup", """
select person_id, encounter_id, next_type, y_1day, y_7days, y_1month,
  case y_1day when 'Disengaged' then 1 when 'Active In Care' then 0 end as y_1day_bin
from {labels}""", **LABELS)
def label_null_on_pickup(clinic):
    return labels(clinic).select(
        "person_id", "encounter_id", "next_type", "y_1day", "y_7days", "y_1month",
        longitudinal.missed("1day").alias("y_1day_bin"))


@query("two_step_outcome", f"""
select person_id, encounter_id, cast(rtc_date - seen as int) as days_until_scheduled,
  cast(next_1 - seen as int) as days_until_actual, cast(next_1 - rtc_date as int) as gap_1,
  cast(next_2 - rtc_2 as int) as gap_2,
  case when next_1 - rtc_date > 30 then 'Disengaged' when next_1 - rtc_date <= 30
    then 'Active In Care' end as outcome_1,
  case when next_2 - rtc_2 > 30 then 'Disengaged' when next_2 - rtc_2 <= 30
    then 'Active In Care' end as outcome_2
from (
  select *, cast(encounter_datetime as date) as seen,
    cast(coalesce(lead(encounter_datetime) over w, {LAST_DAY}) as date) as next_1,
    cast(coalesce(lead(encounter_datetime, 2) over w, {LAST_DAY}) as date) as next_2,
    lead(rtc_date) over w as rtc_2,
    row_number() over (partition by person_id order by encounter_datetime, encounter_id) as rn
  from {{encounter}} window w as (partition by person_id order by encounter_id)) where rn = 1""")
def two_step_outcome(clinic):
    return history.two_step_outcome(clinic.encounter, clinic.hot_persons, as_of(clinic))


def timeliness_sql(beyond: str, early: bool) -> str:
    def steps(word, days, last):
        return " ".join(
            f"when {days} <= {limit} then '{word}: UP TO {limit} DAYS'" for limit in (7, 14, 28, 90)
        ) + f" else '{last}' end"

    seen, due = "v.encounter_datetime", "cast(v.prev_rtc_date as timestamp)"
    early_sql = ("case " + steps("EARLY", f"date_sub('day', {seen}, {due})", "EARLY: MORE THAN 90 DAYS")
                 if early else "'EARLY'")
    return f"""
when v.prev_rtc_date = cast({seen} as date) then 'ON-TIME'
when v.prev_rtc_date > cast({seen} as date) then {early_sql}
when v.prev_rtc_date < cast({seen} as date) then case {steps("LATE", f"date_sub('day', {due}, {seen})", beyond)}
else '????' end as timeliness"""


@query("return_timeliness", f"""
select e.person_id, e.encounter_id, case when v.rtc_date is null then 'NON-RETURNER'
{timeliness_sql("LATE: OVER 90 DAYS", early=True)}
from {{encounter}} e join {{ledger}} l on l.encounter_id = e.encounter_id
left join {{visit}} v on v.person_id = e.person_id and v.prev_rtc_date = e.rtc_date
  and v.is_clinical_encounter = 1 and v.encounter_type not in (186, 99999)
where e.is_clinical_encounter = 1 and e.encounter_type not in (186, 99999)""")
def return_timeliness(clinic):
    appointments = clinic.encounter.filter(
        (col("is_clinical_encounter") == 1) & ~col("encounter_type").isin(fixed.NON_VISIT_TYPES)
    ).select("person_id", "encounter_id", "rtc_date")
    scored = appointments.join(clinic.ledger.select("encounter_id"), "encounter_id")
    matched = joins.next_visit_matches(scored, clinic.visit)
    return matched.select(
        "person_id", "encounter_id",
        reports.return_timeliness(
            col("answer_datetime"), col("rtc_date"), col("answer_rtc_date")
        ).alias("timeliness"))


@query("predicted_vs_observed", f"""
select v.person_id, v.encounter_type, v.rtc_date, v.encounter_datetime, v.prev_rtc_date,
  cast(weekofyear(v.prev_rtc_date) - 17 as int) as week_number, round(l.prob_1day, 6) as prob_1day,
  case when v.rtc_date is null or (v.rtc_date > cast(v.encounter_datetime as date)
    and v.rtc_date <= v.prev_rtc_date) then 'NON-RETURNER'
{timeliness_sql("LATE OVER 90 DAYS", early=False)}
from {{ledger}} l join {{visit}} v on v.person_id = l.person_id and v.prev_rtc_date = l.rtc_date
  and v.is_clinical_encounter = 1 and v.encounter_type not in (186, 99999)""")
def predicted_vs_observed(clinic):
    table = reports.predicted_vs_observed(clinic.ledger, clinic.visit)
    return table.withColumn("prob_1day", F.round("prob_1day", 6)).orderBy(col("prob_1day").desc())
