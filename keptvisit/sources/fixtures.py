"""Views shaped like clinic records, derived from the given tables.

Each view is one SQL text that Spark and DuckDB both run: table names stand in
braces. `Clinic` gives the views as DataFrames; `with_views` puts them before
an oracle query.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from keptvisit.operators import timeline
from keptvisit.sources.tables import read_table

VIEWS = {
    "person": """
select c_custkey as person_id,
  case when c_custkey % 41 = 0 then null
    else date '1940-01-01' + cast((c_custkey * 37) % 20000 as int) end as birthdate,
  case when c_custkey % 2 = 0 then 'F' else 'M' end as gender
from {customer}""",
    "location": """
select n_nationkey as location_id, n_name as name, r_name as county, 0 as retired,
  case when n_nationkey % 2 = 0 then 7 else 1 end as prediction_endpoint
from {nation} join {region} on n_regionkey = r_regionkey""",
    "encounter": """
select o_custkey as person_id, o_orderkey as encounter_id, o_orderdate as encounter_datetime,
  c_nationkey as location_id,
  case o_orderpriority when '5-LOW' then 186 when '4-NOT SPECIFIED' then 2
    when '1-URGENT' then 110 else 1 end as encounter_type,
  case when o_orderkey % 97 = 0 then null
    else cast(o_orderdate as date) + cast(28 + (o_orderkey % 12) * 28 as int) end as rtc_date,
  case when o_orderkey % 29 = 0 then null
    else cast(40 + cast(floor(o_totalprice) as bigint) % 90 as double) end as weight,
  case when o_orderkey % 31 = 0 then 0.0e0
    else cast(140 + o_orderkey % 50 as double) end as height,
  case when o_orderkey % 3 = 0 then null
    else cast(floor(o_totalprice) as bigint) % 5000 end as vl_resulted,
  case when o_orderkey % 3 = 0 or o_orderkey % 5 = 0 then null
    else cast(o_orderdate as date) + cast(-((o_orderkey * 13) % 400) as int) end as vl_order_date,
  case when o_orderkey % 3 = 0 then null when o_orderkey % 2 = 0
    then o_orderdate - interval '30' hour
    else o_orderdate - interval '2900' hour end as vl_resulted_date,
  case when o_orderkey % 4 = 0 then null
    else cast(floor(o_totalprice) as bigint) % 1600 end as cd4_resulted,
  case when o_orderkey % 4 = 0 or o_orderkey % 7 = 0 then null
    else cast(o_orderdate as date) + cast(-((o_orderkey * 17) % 900) as int) end as cd4_order_date,
  case when o_orderkey % 4 = 0 then null
    else o_orderdate - interval '4001' hour end as cd4_resulted_date,
  case when o_orderkey % 6 = 0 then null else 1 + o_orderkey % 4 end as who_stage,
  case when o_orderkey % 9 = 0 then null when o_orderkey % 2 = 0 then 'Disclosed'
    else 'Partial' end as disclosure,
  case when o_orderkey % 8 = 0 then null
    else concat('628##', cast(630 + o_orderkey % 5 as varchar(9)), '##1400') end as arv_meds,
  case when o_orderkey % 53 = 0 then 9999
    when o_orderkey % 59 = 0 then c_nationkey + 1 end as transfer_out_location_id,
  case when o_orderkey % 211 = 0 then cast(o_orderdate as date) end as death_date,
  case when o_orderkey % 17 = 0 then 0 else 1 end as is_clinical_encounter,
  cast(1 + o_orderkey % 60 as int) as visit_type,
  case when o_orderkey % 47 = 0 then 9998 when o_orderkey % 43 = 0 then c_nationkey end
    as transfer_in_location_id,
  case when o_orderkey % 61 = 0 then cast(o_orderdate as date) end as transfer_out_date,
  case when o_orderkey % 103 = 0 then 1 end as out_of_care,
  case when o_orderkey % 107 = 0 then o_orderdate - interval '1' day
    else o_orderdate + interval '6' hour end as date_created,
  case when o_custkey % 23 = 0 then null when o_custkey % 19 = 0 then date '1900-01-01'
    else date '1990-01-01' + cast((o_custkey * 11) % 3000 as int) end as arv_start_date,
  case when o_custkey % 17 = 0 then date '1900-01-01'
    else date '1988-01-01' + cast((o_custkey * 7) % 2500 as int) end as hiv_start_date,
  case when o_orderkey % 11 = 0 then null else cast(1 + o_orderkey % 3 as int) end as arv_line,
  case when o_orderkey % 5 = 0 then null else cast(o_orderkey % 2 as int) end as is_pregnant,
  case when o_orderkey % 13 = 0 then 'Positive' when o_orderkey % 2 = 0 then 'Negative' end
    as tb_test_result,
  case when o_orderkey % 4 = 1
    then cast(o_orderdate as date) + cast(20 + o_orderkey % 90 as int) end as med_pickup_rtc_date,
  case o_orderkey % 10 when 0 then 6101 when 1 then 6102 when 2 then 6103 when 3 then 1267
    when 4 then 1187 when 5 then 5488 when 6 then 7272 when 7 then 7278 when 8 then 99 end
    as care_status
from {orders} join {customer} on c_custkey = o_custkey""",
    "ledger": """
select person_id, encounter_id, location_id, rtc_date,
  cast((encounter_id * 7919) % 10007 as double) / 10007 as prob_1day,
  cast((encounter_id * 6007) % 10009 as double) / 10009 as prob_7day,
  case when (encounter_id * 7919) % 10007 >= 9006 then 'High Risk'
    when (encounter_id * 7919) % 10007 >= 8005 then 'Medium Risk' end as risk_1day,
  case when (encounter_id * 6007) % 10009 >= 9008 then 'High Risk'
    when (encounter_id * 6007) % 10009 >= 8007 then 'Medium Risk' end as risk_7day,
  case when encounter_id % 2 = 0 then 'V10' else 'V11' end as model_version,
  cast(date_trunc('week', rtc_date) as date) as start_date,
  cast(date_trunc('week', rtc_date) as date) + 6 as end_date,
  cast(date_trunc('week', rtc_date) as date) + (-60) as prediction_generated_date,
  concat(cast(year(cast(date_trunc('week', rtc_date) as date) + (-4)) as varchar(4)), '-W',
    lpad(cast(cast(floor((dayofyear(cast(date_trunc('week', rtc_date) as date) + (-4)) - 1) / 7e0)
      as int) + 1 as varchar(2)), 2, '0')) as week,
  case when encounter_id % 3 = 0 then null
    else rtc_date + cast((encounter_id * 31) % 40 - 10 as int) end as observed_rtc_date
from {encounter}
where rtc_date is not null and is_clinical_encounter = 1 and encounter_type not in (2, 111, 99999)""",
    "outreach": """
select user_id as person_id, cast(ts as date) as contact_date,
  case event_type when 'purchase' then 'YES' when 'error' then 'NO' end as phone_ok,
  case event_type when 'click' then 'YES' end as home_visit,
  case event_type when 'signup' then cast(ts as date) end as rescheduled
from {events}""",
    "ehr_encounter": """
select o_custkey as person_id, o_orderkey as encounter_id, o_orderkey - o_orderkey % 3 as visit_id,
  c_nationkey as location_id, o_orderdate as encounter_datetime,
  case when o_orderkey % 37 = 0 then 1 else 0 end as voided
from {orders} join {customer} on c_custkey = o_custkey""",
    "obs": """
select o_custkey as person_id, l_orderkey as encounter_id, cast(o_custkey % 25 as int) as location_id,
  case when l_partkey % 11 = 0 then 5089 else case l_linenumber when 1 then 1054 when 2 then 2051
    when 3 then 1972 when 4 then 1605 when 5 then 1710 when 6 then 5605 else 8365 end end
    as concept_id,
  cast(1060 + l_partkey % 40 as int) as value_coded,
  case when l_partkey % 10 = 0 then 1 else 0 end as voided
from {lineitem} join {orders} on o_orderkey = l_orderkey""",
    "visit_obs": """
select o_custkey as person_id, l_orderkey as encounter_id, cast(o_custkey % 25 as int) as location_id,
  case when l_partkey % 11 = 0 then 5089
    when l_partkey % 11 < 5 then case l_suppkey % 4 when 0 then 11124 when 1 then 10012
      when 2 then 6744 else 6419 end
    else case l_linenumber when 1 then 10591 when 2 then 6836 when 3 then 6474 when 4 then 1685
      when 5 then 7684 when 6 then 6903 else 9771 end end as concept_id,
  case l_returnflag when 'A' then 1065 when 'R' then 1066
    else case when l_partkey % 9 <> 0 then cast(1060 + l_partkey % 40 as int) end end as value_coded,
  case when l_partkey % 10 = 0 then 1 else 0 end as voided
from {lineitem} join {orders} on o_orderkey = l_orderkey""",
    "concept_name": """
select cast(1060 + p_partkey % 40 as int) as concept_id,
  concat(p_name, ' ', cast(p_partkey as varchar(20))) as name,
  case when p_partkey % 5 = 0 then 'fr' else 'en' end as locale,
  case when p_partkey % 3 = 0 then 0 else 1 end as locale_preferred,
  case when p_partkey % 7 = 0 then 1 else 0 end as voided
from {part}""",
    "survey_answer": """
select person_id, encounter_id,
  case encounter_id % 8 when 0 then 'LESS THAN ONE HOUR' when 1 then '30 TO 60 MINUTES'
    when 2 then 'ONE TO TWO HOURS' when 3 then 'MORE THAN TWO HOURS' when 4 then 'UNKNOWN PLACE'
    when 5 then 'LESS THAN 30 MINUTES' end as travel_time,
  case encounter_id % 9 when 0 then 'FORM 1 TO 2' when 1 then 'PRE UNIT' when 2 then 'COLLEGE'
    when 3 then 'UNIVERSITY' when 4 then 'STANDARD 4 TO 8' when 5 then 'NONE' end as education,
  case encounter_id % 11 when 0 then 'TEACHER' when 1 then 'FARMER' when 2 then 'STUDENT'
    when 3 then 'MINER' when 4 then 'BODA-BODA' when 5 then 'HOUSEWIFE' when 6 then 'PILOT' end
    as occupation,
  case encounter_id % 7 when 0 then 'OUTPATIENT SERVICES' when 1 then 'SELF TEST'
    when 2 then 'MATERNAL CHILD HEALTH PROGRAM' when 3 then 'HOME BASED TESTING PROGRAM'
    when 4 then 'HIV TESTING SERVICES STRATEGY' when 5 then 'ELSEWHERE' end as entry_point,
  case encounter_id % 8 when 0 then 'ADULTINITIAL' when 1 then 'PEDSRETURN'
    when 2 then 'YOUTHRETURN' when 3 then 'PEDSINITIAL' when 4 then 'DRUGPICKUP' end
    as encounter_type_name,
  case encounter_id % 6 when 0 then 'Strongly Agree' when 1 then 'Agree' when 2 then 'Neutral'
    when 3 then 'Disagree' when 4 then 'Strongly Disagree' end as agreement,
  case encounter_id % 3 when 0 then 'Checked' when 1 then 'Unchecked' end as box,
  case encounter_id % 5 when 0 then 1 when 1 then 0 end as flag,
  case encounter_id % 4 when 0 then 'FIRST LINE HIV ANTIRETROVIRAL DRUG TREATMENT'
    when 1 then 'SECOND LINE HIV ANTIRETROVIRAL DRUG TREATMENT' when 2 then 'OTHER' end
    as line_label,
  case encounter_id % 7 when 0 then '3TC + EFV + TDF' when 1 then '3TC + ABC + DTG'
    when 2 then '3TC + RTV + TDF + LOP + DTG' when 3 then 'd4T + 3TC + NVP' when 4 then 'DTG' end
    as regimen
from {encounter}""",
    "program_map": """
select distinct cast(1 + o_orderkey % 60 as int) as visit_type,
  cast(41 + o_orderkey % 13 as int) as program_id,
  case when o_orderkey % 5 = 0 then 1 end as voided
from {orders}""",
    "program": """
select cast(p_partkey as int) as program_id, p_name as name,
  case when p_partkey % 6 = 0 then 1 else 0 end as retired
from {part} where p_partkey between 41 and 53""",
    "facility": """
select c_nationkey as location_id, r_name as clinic_county,
  round(log10(count(*)), 6) as size_enrollments_log10,
  round(log10(sum(case when c_acctbal > 0 then 2 else 1 end)), 6) as volume_visits_log10,
  case when c_nationkey % 3 = 0 then 'Town' else 'County' end as care_programme,
  case when c_nationkey % 4 = 0 then 'Hospital' else 'Dispensary' end as facility_type,
  case when c_nationkey % 2 = 0 then 7 else 1 end as prediction_endpoint
from {customer} join {nation} on n_nationkey = c_nationkey join {region} on r_regionkey = n_regionkey
where n_name <> 'NATION_3'
group by c_nationkey, r_name""",
    "address": """
select s_nationkey as location_id, min(s_name) as site_name, cast(min(s_suppkey) as bigint)
  as site_code
from {supplier} group by s_nationkey""",
    "person_address": """
select c_custkey as person_id, r_name as county, n_name as sub_county,
  concat('ID-', cast(c_custkey as varchar(20))) as identifier
from {customer} join {nation} on n_nationkey = c_nationkey join {region} on r_regionkey = n_regionkey
where c_acctbal > 0""",
}

# The previous and next columns of a visit; Spark builds them with timeline.along.
VISIT_SQL = """
select *,
  lag(rtc_date) over w as prev_rtc_date, lag(encounter_type) over w as prev_encounter_type,
  lag(encounter_datetime) over w as prev_encounter_datetime,
  lead(encounter_datetime) over w as next_datetime,
  lead(encounter_type) over w as next_encounter_type, lead(rtc_date) over w as next_rtc_date,
  (last_value(case when is_clinical_encounter = 1 then struct_pack(r := rtc_date) end ignore nulls)
    over (partition by person_id order by encounter_datetime, encounter_id
      rows between unbounded preceding and 1 preceding)).r as prev_clinical_rtc_date,
  first_value(case when is_clinical_encounter = 1 then encounter_datetime end ignore nulls)
    over (partition by person_id order by encounter_datetime, encounter_id
      rows between 1 following and unbounded following) as next_clinical_datetime
from {encounter}
window w as (partition by person_id order by encounter_datetime, encounter_id)"""

ORACLE_VIEWS = {**VIEWS, "visit": VISIT_SQL}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _needs(text: str) -> list[str]:
    return [name for name in [*TABLES, *ORACLE_VIEWS] if "{" + name + "}" in text]


def with_views(text: str, **extra: str) -> str:
    """`text` with braced view names, as one query with the views it needs in front.

    `extra` holds further named steps, in the order in which they build on each other.
    """
    steps = {**ORACLE_VIEWS, **extra}
    found: dict[str, str] = {}

    def visit(sql: str) -> None:
        for name, body in steps.items():
            if "{" + name + "}" in sql and name not in found:
                visit(body)
                found[name] = body

    visit(text)
    plain = {name: name for name in [*TABLES, *steps]}
    ctes = ",\n".join(f"{name} as ({body.format(**plain)})" for name, body in found.items())
    return (f"with {ctes}\n" if found else "") + text.format(**plain)


class Clinic:
    """The views over one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        # Model matrices written for this object, by the day they were known.
        self.written: dict[date | None, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        inputs = {
            need: getattr(self, need) if need in VIEWS else self.table(need)
            for need in _needs(text)
        }
        return self.spark.sql(text, **inputs)

    @cached_property
    def person(self) -> DataFrame:
        return self.view("person")

    @cached_property
    def location(self) -> DataFrame:
        return self.view("location")

    @cached_property
    def encounter(self) -> DataFrame:
        return self.view("encounter")

    @cached_property
    def ledger(self) -> DataFrame:
        return self.view("ledger")

    @cached_property
    def outreach(self) -> DataFrame:
        return self.view("outreach")

    @cached_property
    def hot_persons(self) -> timeline.HotKeys:
        """Persons with too many visits for one task, measured on the key column alone."""
        visits = self.table("orders").selectExpr("o_custkey as person_id")
        return timeline.find_hot_keys(visits, "person_id")

    @cached_property
    def visit(self) -> DataFrame:
        """Encounters with the previous and next visit's columns."""
        return timeline.with_neighbours(self.encounter, self.hot_persons)
