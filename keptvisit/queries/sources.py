"""Sources, sinks and ledger maintenance."""

from pyspark.sql import functions as F

from keptvisit.operators import filters, folds, history, timeline
from keptvisit.queries.book import query
from keptvisit.session import by_key, scratch_path, write_out
from keptvisit.sources import ledger as ledgers
from keptvisit.sources import tables
from keptvisit.queries.steps import DAILY, FOLD, HISTORY

ENCOUNTER_COLUMNS = [
    "person_id", "encounter_id", "encounter_datetime", "location_id", "encounter_type", "rtc_date",
]


@query("scan_encounters", """
select person_id, encounter_id, encounter_datetime, location_id, encounter_type, rtc_date
from {encounter}""")
def scan_encounters(clinic):
    return clinic.encounter.select(*ENCOUNTER_COLUMNS)


@query("csv_null_token", """
select person_id, encounter_id, rtc_date, weight, disclosure, who_stage from {encounter}""")
def csv_null_token(clinic):
    path = scratch_path(clinic.spark, "extract")
    extract = clinic.encounter.select(
        "person_id", "encounter_id", "rtc_date", "weight", "disclosure", "who_stage"
    )
    tables.write_extract(extract, path)
    return tables.read_extract(clinic.spark, path, extract.schema)


@query("multi_site_union", """
select s.person_id, encounter_id, travel_time, c_mktsegment as occupation, c_name as education
from (
  select person_id, encounter_id, travel_time from {survey_answer} join {encounter} e
    using (person_id, encounter_id) where e.location_id < 8
  union all
  select person_id, encounter_id, travel_time from {survey_answer} join {encounter} e
    using (person_id, encounter_id) where e.location_id < 8
  union all
  select person_id, encounter_id, travel_time from {survey_answer} join {encounter} e
    using (person_id, encounter_id) where e.location_id between 8 and 15
  union all
  select person_id, encounter_id, travel_time from {survey_answer} join {encounter} e
    using (person_id, encounter_id) where e.location_id > 15
) s left join {customer} on c_custkey = s.person_id""")
def multi_site_union(clinic):
    keys, rows = ["person_id", "encounter_id"], clinic.table("orders").count()
    places = by_key(clinic.encounter.select(*keys, "location_id"), rows, *keys)
    answers = by_key(clinic.view("survey_answer").select(
        *keys, "travel_time", "occupation", "education"), rows, *keys).join(places, keys)
    # Joined once for all extracts; a union of joins would sort them all in one task.
    answers = write_out(answers, "answers")
    first = answers.filter("location_id < 8")
    second = answers.filter("location_id between 8 and 15")
    third = answers.filter("location_id > 15")
    supplement = clinic.table("customer").selectExpr(
        "c_custkey as person_id", "c_mktsegment as occupation", "c_name as education"
    )
    return tables.stack_sites(
        [first, first, second, third], supplement, "person_id", ["occupation", "education"]
    ).drop("location_id")


@query("snapshot_roundtrip", """
select person_id, visit_date, encounter_id, rtc_date, weight from {daily}""", daily=DAILY)
def snapshot_roundtrip(clinic):
    daily = timeline.first_of_day(clinic.encounter, clinic.hot_persons).select(
        "person_id", "visit_date", "encounter_id", "rtc_date", "weight"
    )
    return tables.save_snapshot(daily, scratch_path(clinic.spark, "daily"))


@query("append_predictions", """
select person_id, encounter_id, location_id, rtc_date, prob_1day, risk_1day, model_version, week
from {ledger}""")
def append_predictions(clinic):
    """Append, refresh, append, and a repeated and a test run that add nothing, on one folder."""
    kept = ["person_id", "encounter_id", "location_id", "rtc_date", "prob_1day", "risk_1day",
            "model_version", "week"]
    rows = clinic.ledger.select(*kept, "observed_rtc_date")
    path = scratch_path(clinic.spark, "ledger")
    ledgers.append_predictions(rows.filter("model_version = 'V10'"), path)
    ledgers.refresh_ledger(
        clinic.spark, path, rows.schema, ledgers.backfill_observed_return, clinic.visit)
    for _ in range(2):
        ledgers.append_predictions(rows.filter("model_version = 'V11'"), path, run="second")
    ledgers.append_predictions(rows, path, test_run=True)
    return ledgers.read_ledger(clinic.spark, path, rows.schema).select(*kept)


@query("rebuild_table", """
select person_id, encounter_id, encounter_date, visit_number, days_defaulted_last_encounter
from {history}""", **HISTORY)
def rebuild_table(clinic):
    frame = history.days_defaulted_history(clinic.visit, clinic.hot_persons, history.SINCE)
    path = scratch_path(clinic.spark, "days-defaulted")
    ledgers.rebuild_table(frame, path)
    return ledgers.rebuild_table(frame, path)


@query("backfill_observed_return", """
select l.person_id, l.encounter_id, l.rtc_date,
  coalesce(l.observed_rtc_date, (
    select min(cast(v.encounter_datetime as date)) from {visit} v
    where v.person_id = l.person_id and v.prev_rtc_date = l.rtc_date
      and v.encounter_type not in (186, 99999) and v.is_clinical_encounter = 1
      and v.rtc_date is not null
      and (v.rtc_date <= cast(v.encounter_datetime as date) or v.rtc_date > v.prev_rtc_date)
  )) as observed_rtc_date
from {ledger} l""")
def backfill_observed_return(clinic):
    ledger = clinic.ledger.select("person_id", "encounter_id", "rtc_date", "observed_rtc_date")
    return ledgers.backfill_observed_return(ledger, clinic.visit)


@query("backfill_rtc_date", """
select l.person_id, l.encounter_id, e.rtc_date
from {ledger} l join {encounter} e on e.encounter_id = l.encounter_id""")
def backfill_rtc_date(clinic):
    gaps = clinic.ledger.selectExpr(
        "person_id", "encounter_id", "case when model_version = 'V11' then rtc_date end as rtc_date"
    )
    return ledgers.backfill_rtc_date(gaps, clinic.encounter)


@query("ledger_add_columns", """
select person_id, encounter_id, prob_1day, risk_1day,
  case when model_version = 'V11' then prob_7day end as prob_7day,
  case when model_version = 'V11' then risk_7day end as risk_7day
from {ledger}""")
def ledger_add_columns(clinic):
    kept = ["person_id", "encounter_id", "prob_1day", "risk_1day"]
    old = clinic.ledger.filter("model_version = 'V10'").select(*kept)
    new = clinic.ledger.filter("model_version = 'V11'").select(*kept, "prob_7day", "risk_7day")
    return ledgers.add_seven_day_columns(old, new)


@query("deid_sample_export", """
select e.person_id + 14563 as person_id, e.encounter_id, e.rtc_date, f.fold_id
from {encounter} e join {fold} f using (person_id) where f.fold_id = 2""", fold=FOLD)
def deid_sample_export(clinic):
    rows = folds.assign_folds(clinic.encounter.select("person_id", "encounter_id", "rtc_date"))
    sample = tables.shift_ids(rows, fold=2, offset=14563)
    path = scratch_path(clinic.spark, "sample")
    tables.write_extract(sample, path)
    return tables.read_extract(clinic.spark, path, sample.schema)
