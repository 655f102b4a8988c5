"""Named SQL steps that several oracles share."""

AGE = """cast(year({visit}) - year({birth})
  - case when month({visit}) * 100 + day({visit}) < month({birth}) * 100 + day({birth})
    then 1 else 0 end as int)"""


def age_sql(birth: str, visit: str) -> str:
    return AGE.format(birth=birth, visit=visit)


def years_sql(start: str, end: str) -> str:
    """Complete years from start to end, negative when the end comes first."""
    return (f"case when {start} <= cast({end} as date) then {age_sql(start, end)} "
            f"else -{age_sql(end, start)} end")


FOLD = """
select person_id, cast((row_number() over (
    order by md5(concat(cast(person_id as varchar), '-123')) || ':' || cast(person_id as varchar))
  - 1) % 11 + 1 as int) as fold_id
from (select distinct person_id from {encounter})"""

DAILY = """
select * from (
  select *, cast(encounter_datetime as date) as visit_date,
    row_number() over (partition by person_id, cast(encounter_datetime as date)
      order by encounter_id) as day_row
  from {encounter}) where day_row = 1"""

HISTORY = {
    "kept": """
select *, row_number() over (partition by person_id order by encounter_datetime, encounter_id)
    as visit_number,
  case when datediff('day', prev_clinical_rtc_date, cast(encounter_datetime as date)) < -31 then -31
    when datediff('day', prev_clinical_rtc_date, cast(encounter_datetime as date)) > 365 then 365
    else datediff('day', prev_clinical_rtc_date, cast(encounter_datetime as date)) end as own_days
from {visit}
where arv_start_date is not null and is_clinical_encounter = 1
  and encounter_datetime >= date '1996-01-01'
  and not (rtc_date = prev_rtc_date and encounter_type = prev_encounter_type
    and encounter_datetime = prev_encounter_datetime)""",
    "history": """
select person_id, encounter_id, cast(encounter_datetime as date) as encounter_date, visit_number,
  cast(coalesce(own_days, lag(own_days) over (partition by person_id
    order by encounter_datetime, encounter_id)) as int) as days_defaulted_last_encounter
from {kept}""",
}
