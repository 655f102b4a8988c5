"""Filters and predicates."""

from datetime import date

from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates
from keptvisit.operators import filters
from keptvisit.queries.book import query
from keptvisit.queries.scalars import sql_list
from keptvisit.queries.steps import age_sql

ACTIVE = """
select person_id, encounter_id, rtc_date from {visit}
where encounter_type <> 111 and encounter_type <> 99999
  and case when encounter_type = 116 then coalesce(transfer_in_location_id = 9998, false) else true end
  and transfer_out_date is null and coalesce(transfer_in_location_id, 0) not in (9998, 9999)
  and coalesce(transfer_out_location_id, 0) not in (9998, 9999) and is_clinical_encounter = 1
  and out_of_care is null and death_date is null
  and rtc_date >= date '%s' and rtc_date <= date '%s'
  and encounter_datetime < date_created
  and (next_clinical_datetime is null or (%s and next_clinical_datetime >= rtc_date))"""


def active_sql(start: str, end: str, retrospective: bool) -> str:
    return ACTIVE % (start, end, str(retrospective).lower())


@query("site_list_filter", f"""
select person_id, encounter_id, location_id from {{encounter}}
where coalesce(transfer_out_location_id, location_id) in ({sql_list(fixed.TARGET_SITES)})""")
def site_list_filter(clinic):
    return filters.site_list(clinic.encounter).select("person_id", "encounter_id", "location_id")


@query("active_appointment_filter",
       "select *, 'weekly' as run from (" + active_sql("1995-01-02", "2003-12-28", False)
       + ") union all select *, 'retrospective' as run from ("
       + active_sql("1995-01-02", "2003-12-28", True) + ")")
def active_appointment_filter(clinic):
    start, end = F.lit(date(1995, 1, 2)), F.lit(date(2003, 12, 28))
    keep = ["person_id", "encounter_id", "rtc_date"]
    weekly = filters.active_appointments(clinic.visit, start, end).select(
        *keep, F.lit("weekly").alias("run"))
    past = filters.active_appointments(clinic.visit, start, end, retrospective=True).select(
        *keep, F.lit("retrospective").alias("run"))
    return weekly.unionByName(past)


@query("drop_repeat_visit_rows", """
select person_id, encounter_id from {visit}
where case when rtc_date <> prev_rtc_date or encounter_type <> prev_encounter_type
    or encounter_datetime <> prev_encounter_datetime then true else false end""")
def drop_repeat_visit_rows(clinic):
    return filters.without_repeats(clinic.visit).select("person_id", "encounter_id")


@query("care_start_filter", """
select person_id, encounter_id, since from {encounter}, (values (1996), (1999)) t(since)
where arv_start_date is not null and is_clinical_encounter = 1 and year(encounter_datetime) >= since""")
def care_start_filter(clinic):
    def since(year):
        return filters.in_care_since(clinic.encounter, date(year, 1, 1)).select(
            "person_id", "encounter_id", F.lit(year).alias("since"))

    return since(1996).unionByName(since(1999))


@query("study_window_filter", """
select person_id, encounter_id from {encounter}
where rtc_date <= date '2000-06-30' and encounter_datetime >= date '1996-07-01'""")
def study_window_filter(clinic):
    window = filters.study_window(clinic.encounter, date(1996, 7, 1), date(2000, 6, 30))
    return window.select("person_id", "encounter_id")


@query("drop_med_pickups", """
select person_id, encounter_id, encounter_type from {encounter}
where encounter_type <> 186 and encounter_type <> 158""")
def drop_med_pickups(clinic):
    return filters.without_pickups(clinic.encounter).select(
        "person_id", "encounter_id", "encounter_type")


@query("age_band_split", f"""
select encounter_id, case when age >= 18 then 'adult' else 'minor' end as band
from (select encounter_id, {age_sql("birthdate", "encounter_datetime")} as age
  from {{encounter}} join {{person}} using (person_id)) where age is not null""")
def age_band_split(clinic):
    age = dates.years_between(F.col("birthdate"), F.col("encounter_datetime"))
    rows = clinic.encounter.join(clinic.person, "person_id")
    return rows.select("encounter_id", clinical.age_band(age).alias("band")).filter(
        "band is not null")
