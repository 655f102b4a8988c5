"""Projections, scalar features and recodes."""

from datetime import date

from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates, recodes
from keptvisit.operators import profiles
from keptvisit.queries.book import query
from keptvisit.queries.steps import age_sql, years_sql

col = F.col
AGE_AT_VISIT = age_sql("birthdate", "encounter_datetime")
BMI = "round(weight / ((height / 100) * (height / 100)), 2)"
USABLE = "weight is not null and height is not null and weight >= 1 and height >= 1"


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def sql_case(column: str, groups: dict, otherwise: str = "null") -> str:
    whens = " ".join(
        f"when {column} in ({sql_list(raws)}) then " + (f"'{name}'" if isinstance(name, str) else str(name))
        for name, raws in groups.items()
    )
    return f"case {whens} else {otherwise} end"


@query("bind_parameters", """
select person_id, encounter_id, rtc_date from {encounter}
where rtc_date between date '1996-01-01' and date '2000-12-31' and weight >= 50""")
def bind_parameters(clinic):
    return clinic.spark.sql(
        "select person_id, encounter_id, rtc_date from {visits} "
        "where rtc_date between :start and :finish and weight >= :least",
        args={"start": date(1996, 1, 1), "finish": date(2000, 12, 31), "least": 50},
        visits=clinic.encounter,
    )


@query("effective_location", """
select encounter_id, coalesce(transfer_out_location_id, location_id) as effective_location
from {encounter}""")
def effective_location(clinic):
    place = clinical.effective_location(col("transfer_out_location_id"), col("location_id"))
    return clinic.encounter.select("encounter_id", place.alias("effective_location"))


@query("age_in_years", f"""
select encounter_id, {AGE_AT_VISIT} as age,
  case when birthdate is null then 1 else 0 end as age_na
from {{encounter}} join {{person}} using (person_id)""")
def age_in_years(clinic):
    return clinic.encounter.join(clinic.person, "person_id").select(
        "encounter_id",
        dates.years_between(col("birthdate"), col("encounter_datetime")).alias("age"),
        clinical.is_missing(col("birthdate")).alias("age_na"),
    )


@query("bmi_bounded", f"""
select encounter_id, bmi, case when bmi is null then 1 else 0 end as bmi_na from (
  select encounter_id, case when {USABLE} and {BMI} between 5 and 60 then {BMI} end as bmi
  from {{encounter}})""")
def bmi_bounded(clinic):
    value = clinical.bmi(col("weight"), col("height"))
    return clinic.encounter.select(
        "encounter_id", value.alias("bmi"), clinical.is_missing(value).alias("bmi_na")
    )


@query("bmi_unbounded", f"""
select encounter_id, case when height <> 0 then {BMI} end as bmi,
  case when {USABLE} then 0 else 1 end as bmi_na
from {{encounter}}""")
def bmi_unbounded(clinic):
    weight, height = col("weight"), col("height")
    return clinic.encounter.select(
        "encounter_id",
        clinical.bmi(weight, height, low=None, high=None, least_input=None).alias("bmi"),
        clinical.inputs_missing(weight, height).alias("bmi_na"),
    )


@query("viral_load_log10", """
select encounter_id, round(log10(vl_resulted + 1), 6) as viral_load_log10,
  case when vl_resulted is null then 1 else 0 end as viral_load_log10_na,
  round(log10(case when vl_resulted = 0 then 1e-17 else vl_resulted + 1e-17 end), 6)
    as viral_load_log10_old,
  round(coalesce(log10(case when vl_resulted = 0 then 1e-17 else vl_resulted + 1e-17 end),
    -17), 6) as viral_load_log10_old_filled
from {encounter}""")
def viral_load_log10(clinic):
    load = col("vl_resulted")
    old = clinical.viral_load_log10(load, 1e-17)
    return clinic.encounter.select(
        "encounter_id",
        F.round(clinical.viral_load_log10(load), 6).alias("viral_load_log10"),
        clinical.is_missing(load).alias("viral_load_log10_na"),
        F.round(old, 6).alias("viral_load_log10_old"),
        F.round(F.coalesce(old, F.log10(F.lit(1e-17))), 6).alias("viral_load_log10_old_filled"),
    )


@query("vl_suppressed", """
select encounter_id, case when vl_resulted < 1000 then 1 else 0 end as vl_suppressed
from {encounter}""")
def vl_suppressed(clinic):
    return clinic.encounter.select(
        "encounter_id", clinical.vl_suppressed(col("vl_resulted")).alias("vl_suppressed")
    )


@query("days_since_lab", """
select encounter_id,
  cast(date_sub('day', encounter_datetime, vl_resulted_date) as int) as days_since_vl,
  case when vl_resulted_date is null then 1 else 0 end as days_since_vl_na,
  cast(cast(encounter_datetime as date) - cast(cd4_resulted_date as date) as int)
    as days_since_cd4,
  case when cd4_resulted_date is null then 1 else 0 end as days_since_cd4_na
from {encounter}""")
def days_since_lab(clinic):
    visit, load, cd4 = col("encounter_datetime"), col("vl_resulted_date"), col("cd4_resulted_date")
    return clinic.encounter.select(
        "encounter_id",
        dates.full_days_between(visit, load).alias("days_since_vl"),
        clinical.is_missing(load).alias("days_since_vl_na"),
        dates.days_between(cd4, visit).alias("days_since_cd4"),
        clinical.is_missing(cd4).alias("days_since_cd4_na"),
    )


@query("log_days_defaulted", """
select encounter_id, round(case when d > 0 then ln(d) end, 6) as log_days_serving,
  round(ln(case when d < -31 then -31 when d > 365 then 365 else d end + 32), 6)
    as log_days_training
from (select encounter_id, cast(encounter_datetime as date) - prev_rtc_date as d from {visit})""")
def log_days_defaulted(clinic):
    late = dates.days_between(col("prev_rtc_date"), col("encounter_datetime"))
    return clinic.visit.select(
        "encounter_id",
        F.round(clinical.log_days_defaulted(late, "serving"), 6).alias("log_days_serving"),
        F.round(clinical.log_days_defaulted(late, "training"), 6).alias("log_days_training"),
    )


@query("appointment_month", """
select encounter_id, cast(month(rtc_date) as varchar) as appointment_month,
  cast(month(encounter_datetime) as varchar) as visit_month
from {encounter}""")
def appointment_month(clinic):
    return clinic.encounter.select(
        "encounter_id",
        dates.appointment_month(col("rtc_date")).alias("appointment_month"),
        dates.appointment_month(col("encounter_datetime")).alias("visit_month"),
    )


@query("missing_indicators", """
select encounter_id, case when weight is null then 1 else 0 end as "weight_NA",
  case when who_stage is null then 1 else 0 end as "who_stage_NA",
  case when cd4_resulted is null then 1 else 0 end as "cd4_resulted_NA",
  case when vl_resulted is null then 1 else 0 end as "vl_resulted_NA",
  case when disclosure is null then 1 else 0 end as "disclosure_NA"
from {encounter}""")
def missing_indicators(clinic):
    names = ["weight", "who_stage", "cd4_resulted", "vl_resulted", "disclosure"]
    flags = clinical.missing_indicators(names)
    return clinic.encounter.withColumns(flags).select("encounter_id", *flags)


@query("fill_fixed_values", """
select encounter_id, coalesce(weight, 0) as weight, coalesce(who_stage, 0) as who_stage,
  coalesce(cd4_resulted, 0) as cd4_resulted,
  round(coalesce(log10(vl_resulted + 1), log10(1)), 6) as viral_load_log10
from {encounter}""")
def fill_fixed_values(clinic):
    fills = clinical.fixed_fills(["weight", "who_stage", "cd4_resulted"], ["viral_load_log10"], {})
    load = F.round(clinical.viral_load_log10(col("vl_resulted")), 6)
    return clinic.encounter.withColumn("viral_load_log10", load).select(
        "encounter_id", *fills
    ).fillna(fills)


@query("fill_category_defaults", """
select encounter_id, coalesce(arv_meds, 'Other') as arv_meds,
  coalesce(tb_test_result, 'Unknown') as tb_test_result,
  coalesce(disclosure, 'Not Done') as disclosure, coalesce(care_status, 1118) as care_status,
  coalesce(is_pregnant, 0) as is_pregnant
from {encounter}""")
def fill_category_defaults(clinic):
    fills = {"arv_meds": "Other", "tb_test_result": "Unknown", "disclosure": "Not Done",
             "care_status": 1118, "is_pregnant": 0}
    return clinic.encounter.select("encounter_id", *fills).fillna(fills)


@query("null_out_of_range", f"""
select encounter_id, case when bmi between 10 and 35 then bmi end as bmi,
  case when bmi between 5 and 35 then bmi end as bmi_old,
  case when cd4_resulted between 0 and 1500 then cd4_resulted end as cd4,
  case when years between 0 and 100 then years end as duration_in_care,
  case when load between -10 and 10 then load end as viral_load_log10
from (select *, case when height <> 0 then {BMI} end as bmi, round(log10(vl_resulted + 1), 6) as load,
  {years_sql("arv_start_date", "encounter_datetime")} as years
  from {{encounter}})""")
def null_out_of_range(clinic):
    ranges = fixed.PLAUSIBLE_RANGES
    value = clinical.bmi(col("weight"), col("height"), None, None, None)
    load = F.round(clinical.viral_load_log10(col("vl_resulted")), 6)
    years = dates.years_between(col("arv_start_date"), col("encounter_datetime"))
    return clinic.encounter.select(
        "encounter_id",
        clinical.within(value, *ranges["bmi"]).alias("bmi"),
        clinical.within(value, 5, 35).alias("bmi_old"),
        clinical.within(col("cd4_resulted"), *ranges["cd4"]).alias("cd4"),
        clinical.within(years, *ranges["duration_in_care"]).alias("duration_in_care"),
        clinical.within(load, *ranges["viral_load_log10"]).alias("viral_load_log10"),
    )


@query("clamp_range", """
select encounter_id,
  cast(case when d < -31 then -31 when d > 365 then 365 else d end as int) as days_defaulted,
  cast(case when a < 0 then 0 when a > 1000 then 1000 else a end as int) as lab_age
from (select encounter_id, cast(encounter_datetime as date) - prev_rtc_date as d,
  cast(encounter_datetime as date) - cd4_order_date as a from {visit})""")
def clamp_range(clinic):
    late = dates.days_between(col("prev_rtc_date"), col("encounter_datetime"))
    lab_age = dates.days_between(col("cd4_order_date"), col("encounter_datetime"))
    return clinic.visit.select(
        "encounter_id",
        clinical.clamp(late, *fixed.DEFAULT_DAYS_RANGE).alias("days_defaulted"),
        clinical.clamp(lab_age, *fixed.LAB_AGE_RANGE).alias("lab_age"),
    )


@query("quantile_outliers_to_null", """
select encounter_id,
  case when weight between (select quantile_cont(weight, 0.01) from {encounter})
    and (select quantile_cont(weight, 0.99) from {encounter}) then weight end as weight,
  case when cd4_resulted between (select quantile_cont(cd4_resulted, 0.01) from {encounter})
    and (select quantile_cont(cd4_resulted, 0.99) from {encounter}) then cd4_resulted end
    as cd4_resulted
from {encounter}""")
def quantile_outliers_to_null(clinic):
    rows = clinic.encounter.select("encounter_id", "weight", "cd4_resulted")
    return profiles.quantile_outliers_to_null(rows, ["weight", "cd4_resulted"])


@query("recode_encounter_class", f"""
select encounter_id, {sql_case("encounter_type_name", fixed.ENCOUNTER_CLASSES, "'Other'")}
    as encounter_class,
  case when encounter_type_name is not null then
    {sql_case("encounter_type_name", fixed.ENCOUNTER_CLASSES, "'Other'")} end
    as encounter_class_known
from {{survey_answer}}""")
def recode_encounter_class(clinic):
    name = col("encounter_type_name")
    return clinic.view("survey_answer").select(
        "encounter_id",
        recodes.encounter_class(name).alias("encounter_class"),
        recodes.encounter_class(name, null_is_other=False).alias("encounter_class_known"),
    )


GROUPS = {
    "travel_time": fixed.TRAVEL_TIME_GROUPS, "education": fixed.EDUCATION_GROUPS,
    "occupation": fixed.OCCUPATION_GROUPS, "entry_point": fixed.ENTRY_POINT_GROUPS,
}


@query("recode_groups", "select encounter_id, " + ", ".join(
    f"{sql_case(name, groups)} as {name}, {sql_case(name, groups, name)} as {name}_kept"
    for name, groups in GROUPS.items()) + " from {survey_answer}")
def recode_groups(clinic):
    columns = []
    for name, groups in GROUPS.items():
        columns.append(recodes.grouped(col(name), groups).alias(name))
        columns.append(recodes.grouped(col(name), groups, keep_unmapped=True).alias(f"{name}_kept"))
    return clinic.view("survey_answer").select("encounter_id", *columns)


@query("infer_regimen_line", f"""
select encounter_id, coalesce({sql_case("line_label", fixed.LINE_LABELS)},
  {sql_case("regimen", fixed.REGIMENS_BY_LINE)}, 5) as regimen_line
from {{survey_answer}}""")
def infer_regimen_line(clinic):
    return clinic.view("survey_answer").select(
        "encounter_id", recodes.regimen_line(col("line_label"), col("regimen")).alias("regimen_line")
    )


KNOWN_REGIMENS = [name for names in fixed.REGIMENS_BY_LINE.values() for name in names]


@query("valid_regimen_or_other", f"""
select encounter_id, case when regimen in ({sql_list(KNOWN_REGIMENS)}) then regimen
  else 'Invalid Regimen' end as regimen
from {{survey_answer}}""")
def valid_regimen_or_other(clinic):
    return clinic.view("survey_answer").select(
        "encounter_id", recodes.valid_regimen(col("regimen")).alias("regimen")
    )


@query("regimen_names", """
select encounter_id, arv_meds, case when arv_meds is not null then (
  select string_agg(coalesce(name, code), ' + ' order by spot)
  from (select unnest(string_split(arv_meds, '##')) as code,
      generate_subscripts(string_split(arv_meds, '##'), 1) as spot) parts
  left join {drug} using (code)) end as regimen
from {encounter}""", drug="select * from (values " + ", ".join(
    f"('{code}', '{name}')" for code, name in fixed.DRUG_NAMES.items()) + ") t(code, name)")
def regimen_names(clinic):
    return clinic.encounter.select(
        "encounter_id", "arv_meds",
        recodes.regimen_names(col("arv_meds"), fixed.DRUG_NAMES).alias("regimen"),
    )


@query("urban_rural", f"""
select encounter_id, location_id,
  {sql_case("location_id", {"Urban": fixed.URBAN_SITES, "Rural": fixed.RURAL_SITES})} as clinic_location
from {{encounter}}""")
def urban_rural(clinic):
    return clinic.encounter.select(
        "encounter_id", "location_id", recodes.urban_rural(col("location_id")).alias("clinic_location")
    )


@query("decode_care_status", f"""
select encounter_id, case care_status {" ".join(
    f"when {code} then '{name}'" for code, name in fixed.CARE_STATUS.items())} end as care_status,
  {sql_case("care_status", {"Yes": fixed.DISENGAGED_STATUS, "No": fixed.ENGAGED_STATUS})}
    as ever_disengaged,
  case is_pregnant when 1 then 'Pregnant' when 0 then 'Not Pregnant' end as pregnancy,
  case when death_date is not null then 1 else 0 end as death
from {{encounter}}""")
def decode_care_status(clinic):
    return clinic.encounter.select(
        "encounter_id",
        recodes.care_status(col("care_status")).alias("care_status"),
        recodes.ever_disengaged(col("care_status")).alias("ever_disengaged"),
        recodes.pregnancy(col("is_pregnant")).alias("pregnancy"),
        col("death_date").isNotNull().cast("int").alias("death"),
    )


@query("sentinel_date_to_null", f"""
select encounter_id, start as arv_start_date,
  {years_sql("start", "encounter_datetime")} as duration_in_care,
  case when start is null then 1 else 0 end as duration_in_care_na,
  cast(start - hiv_start as int) as days_to_start
from (select *, case when year(arv_start_date) <> 1900 then arv_start_date end as start,
  case when year(hiv_start_date) <> 1900 then hiv_start_date end as hiv_start from {{encounter}})""")
def sentinel_date_to_null(clinic):
    start = dates.unless_sentinel(col("arv_start_date"))
    known = dates.unless_sentinel(col("hiv_start_date"))
    return clinic.encounter.select(
        "encounter_id",
        start.alias("arv_start_date"),
        dates.years_between(start, col("encounter_datetime")).alias("duration_in_care"),
        clinical.is_missing(start).alias("duration_in_care_na"),
        dates.days_between(known, start).alias("days_to_start"),
    )


@query("lab_date_if_resulted", """
select encounter_id, case when vl_resulted is not null then vl_order_date end as vl_order_date,
  case when cd4_resulted is not null then cd4_order_date end as cd4_order_date
from {encounter}""")
def lab_date_if_resulted(clinic):
    return clinic.encounter.select(
        "encounter_id",
        clinical.lab_date_if_resulted(col("vl_order_date"), col("vl_resulted")).alias("vl_order_date"),
        clinical.lab_date_if_resulted(col("cd4_order_date"), col("cd4_resulted")).alias("cd4_order_date"),
    )


@query("earliest_due_date", """
select encounter_id, case when rtc_date is null then med_pickup_rtc_date
  when med_pickup_rtc_date is null or rtc_date < med_pickup_rtc_date then rtc_date
  else med_pickup_rtc_date end as due_date
from {encounter}""")
def earliest_due_date(clinic):
    due = clinical.earliest_due_date(col("rtc_date"), col("med_pickup_rtc_date"))
    return clinic.encounter.select("encounter_id", due.alias("due_date"))


@query("after_closure_flag", """
select encounter_id, case when rtc_date is null then null
  when rtc_date >= date '1999-06-30' then 'Yes' else 'No' end as after_closure
from {encounter}""")
def after_closure_flag(clinic):
    flag = clinical.after_closure(col("rtc_date"), F.lit(date(1999, 6, 30)))
    return clinic.encounter.select("encounter_id", flag.alias("after_closure"))


@query("scale_recodes", """
select encounter_id, case agreement when 'Strongly Agree' then 5 when 'Agree' then 4
    when 'Neutral' then 3 when 'Disagree' then 2 when 'Strongly Disagree' then 1 end as agreement,
  case box when 'Checked' then 'Yes' when 'Unchecked' then 'No' end as box,
  case flag when 1 then 'Yes' when 0 then 'No' end as flag
from {survey_answer}""")
def scale_recodes(clinic):
    return clinic.view("survey_answer").select(
        "encounter_id", recodes.likert(col("agreement")).alias("agreement"),
        recodes.checked(col("box")).alias("box"), recodes.yes_no(col("flag")).alias("flag"),
    )


@query("week_bounds", """
select encounter_id, rtc_date + cast(1 - isodow(rtc_date) as int) as week_start,
  rtc_date + cast(7 - isodow(rtc_date) as int) as week_end,
  rtc_date + cast(28 - isodow(rtc_date) as int) as four_weeks_end
from {encounter}""")
def week_bounds(clinic):
    day = col("rtc_date")
    return clinic.encounter.select(
        "encounter_id", dates.week_start(day).alias("week_start"),
        dates.week_end(day).alias("week_end"), dates.week_end(day, 4).alias("four_weeks_end"),
    )


@query("cohort_week_label", """
select encounter_id, strftime(rtc_date - 7, '%G-W%V') as week from {encounter}""")
def cohort_week_label(clinic):
    return clinic.encounter.select(
        "encounter_id", dates.cohort_week_label(col("rtc_date")).alias("week")
    )


@query("sunday_week_label", """
select encounter_id, strftime(cast(date_trunc('week', rtc_date) as date), '%Y-W%U') as week
from {encounter}""")
def sunday_week_label(clinic):
    return clinic.encounter.select(
        "encounter_id", dates.sunday_week_label(col("rtc_date")).alias("week")
    )


@query("endpoint_selector", """
select encounter_id, round(case when prediction_endpoint = 7 then prob_7day else prob_1day end, 6)
  as probability
from {ledger} left join {location} using (location_id)""")
def endpoint_selector(clinic):
    chosen = clinical.endpoint_probability(
        col("prediction_endpoint"), col("prob_1day"), col("prob_7day")
    )
    return clinic.ledger.join(clinic.location, "location_id", "left").select(
        "encounter_id", F.round(chosen, 6).alias("probability")
    )
