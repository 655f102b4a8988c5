"""Joins."""

from pyspark.sql import functions as F

from keptvisit.operators import filters, history, joins
from keptvisit.queries.book import query
from keptvisit.queries.steps import HISTORY, age_sql

BMI = "round(weight / ((height / 100) * (height / 100)), 2)"

STAR = f"""
select v.person_id, v.encounter_id, coalesce(transfer_out_location_id, v.location_id) as location_id,
  rtc_date, {age_sql("birthdate", "encounter_datetime")} as age,
  case when birthdate is null then 1 else 0 end as age_na, gender,
  case when weight >= 1 and height >= 1 and {BMI} between 5 and 60 then {BMI} end as bmi,
  case when weight >= 1 and height >= 1 and {BMI} between 5 and 60 then 0 else 1 end as bmi_na,
  round(log10(vl_resulted + 1), 6) as viral_load_log10,
  case when vl_resulted is null then 1 else 0 end as viral_load_log10_na,
  cd4_resulted as cd4, case when cd4_resulted is null then 1 else 0 end as cd4_na, visit_number,
  round(case when days_defaulted_last_encounter > 0 then ln(days_defaulted_last_encounter) end, 6)
    as log_days_defaulted,
  case when days_defaulted_last_encounter is null then 1 else 0 end as log_days_defaulted_na,
  coalesce(disclosure, 'Not Done') as disclosure, cast(month(rtc_date) as varchar) as month,
  clinic_county, size_enrollments_log10, volume_visits_log10, care_programme, facility_type
from {{visit}} v join {{person}} p on p.person_id = v.person_id
left join {{history}} h on h.person_id = v.person_id and h.encounter_id = v.encounter_id
left join {{facility}} f on f.location_id = v.location_id"""

PROGRAMS = """
select v.encounter_id, p.program_id, p.name as program_name
from {encounter} v
left join {program_map} m on m.visit_type = v.visit_type and m.voided is null
  and (m.program_id <> 42 or m.visit_type not in (51, 54))
  and (m.program_id <> 52 or m.visit_type not in (1, 2))
left join {program} p on p.program_id = m.program_id and p.retired = 0"""


def star(clinic):
    visits = clinic.visit
    past = history.days_defaulted_history(visits, clinic.hot_persons, history.SINCE)
    return joins.feature_star(visits, clinic.person, past, clinic.view("facility"))


def rounded(frame, *names):
    return frame.withColumns({name: F.round(name, 6) for name in names})


@query("feature_star_join", STAR, **HISTORY)
def feature_star_join(clinic):
    return rounded(joins.serving_features(star(clinic)), "viral_load_log10", "log_days_defaulted")


def programs(clinic):
    return joins.programs_of_visits(
        clinic.encounter.select("encounter_id", "visit_type"),
        clinic.view("program_map"), clinic.view("program"),
    )


@query("conditional_left_join", PROGRAMS)
def conditional_left_join(clinic):
    return programs(clinic).select("encounter_id", "program_id", "program_name")


@query("one_row_per_encounter", """
select encounter_id, program_id, program_name from (
  select *, row_number() over (partition by encounter_id order by program_id nulls last) as rn
  from {programs}) where rn = 1""", programs=PROGRAMS)
def one_row_per_encounter(clinic):
    return joins.one_row_per_encounter(
        programs(clinic), ["program_id", "program_name"], "program_id"
    )


@query("unscored_anti_join", """
select person_id, encounter_id, rtc_date from {encounter}
where encounter_id not in (select encounter_id from {ledger})""")
def unscored_anti_join(clinic):
    rows = clinic.encounter.select("person_id", "encounter_id", "rtc_date")
    return filters.unscored(rows, clinic.ledger)


@query("next_visit_match", """
select l.person_id, l.encounter_id, l.rtc_date, v.encounter_id as answer_id,
  v.encounter_datetime as answer_datetime, v.encounter_type as answer_type,
  v.rtc_date as answer_rtc_date
from {ledger} l left join {visit} v on v.person_id = l.person_id and v.prev_rtc_date = l.rtc_date
  and v.is_clinical_encounter = 1 and v.encounter_type not in (186, 99999)""")
def next_visit_match(clinic):
    appointments = clinic.ledger.select("person_id", "encounter_id", "rtc_date")
    return joins.next_visit_matches(appointments, clinic.visit)


@query("facility_metadata_join", """
select encounter_id, location_id, clinic_county, size_enrollments_log10, volume_visits_log10,
  care_programme, facility_type
from {encounter} left join {facility} using (location_id)""")
def facility_metadata_join(clinic):
    facility = clinic.view("facility").drop("prediction_endpoint")
    return clinic.encounter.select("encounter_id", "location_id").join(
        facility, "location_id", "left"
    )


@query("address_identifier_join", """
select e.encounter_id, e.person_id, county, sub_county, identifier, site_name, site_code
from {encounter} e left join {person_address} a on a.person_id = e.person_id
left join {address} s on s.location_id = e.location_id""")
def address_identifier_join(clinic):
    visits = clinic.encounter.select("encounter_id", "person_id", "location_id")
    return joins.with_addresses(visits, clinic.view("person_address")).join(
        clinic.view("address"), "location_id", "left"
    ).drop("location_id")
