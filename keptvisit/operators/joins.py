"""Joins of the extracts.

Dimension sides carry no broadcast hint: Spark broadcasts them when their
measured size is below its threshold and shuffles them otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates


def feature_star(
    visits: DataFrame, person: DataFrame, history: DataFrame, facility: DataFrame
) -> DataFrame:
    """Visits with their person (required), missed-day history and facility (optional)."""
    own = history.select(
        "person_id", "encounter_id", "visit_number", "days_defaulted_last_encounter"
    )
    return (
        visits.join(person, "person_id")
        .join(own, ["person_id", "encounter_id"], "left")
        .join(facility, "location_id", "left")
    )


def serving_features(star: DataFrame) -> DataFrame:
    """Predictors of the weekly run, from the star join."""
    col = F.col
    age = dates.years_between(col("birthdate"), col("encounter_datetime"))
    mass = clinical.bmi(col("weight"), col("height"))
    days = col("days_defaulted_last_encounter")
    return star.select(
        "person_id", "encounter_id",
        clinical.effective_location(col("transfer_out_location_id"), col("location_id"))
        .alias("location_id"),
        "rtc_date",
        age.alias("age"), clinical.is_missing(col("birthdate")).alias("age_na"), "gender",
        mass.alias("bmi"), clinical.is_missing(mass).alias("bmi_na"),
        clinical.viral_load_log10(col("vl_resulted")).alias("viral_load_log10"),
        clinical.is_missing(col("vl_resulted")).alias("viral_load_log10_na"),
        col("cd4_resulted").alias("cd4"), clinical.is_missing(col("cd4_resulted")).alias("cd4_na"),
        "visit_number",
        clinical.log_days_defaulted(days, "serving").alias("log_days_defaulted"),
        clinical.is_missing(days).alias("log_days_defaulted_na"),
        F.coalesce("disclosure", F.lit("Not Done")).alias("disclosure"),
        dates.appointment_month(col("rtc_date")).alias("month"),
        "clinic_county", "size_enrollments_log10", "volume_visits_log10", "care_programme",
        "facility_type",
    )


def programs_of_visits(visits: DataFrame, program_map: DataFrame, program: DataFrame) -> DataFrame:
    """Visits with the programs of their visit type; every visit stays.

    Enrolments that another program implies are skipped inside the join
    condition, so that they do not remove the visit.
    """
    usable = program_map.select(
        F.col("visit_type").alias("map_type"), F.col("program_id").alias("map_program"), "voided"
    )
    implied: Column = (
        (F.col("map_program") != 42) | ~F.col("map_type").isin(51, 54)
    ) & ((F.col("map_program") != 52) | ~F.col("map_type").isin(1, 2))
    matched = visits.join(
        usable,
        (F.col("map_type") == F.col("visit_type")) & F.col("voided").isNull() & implied,
        "left",
    )
    named = program.select("program_id", F.col("name").alias("program_name"), "retired")
    return matched.join(
        named, (F.col("map_program") == F.col("program_id")) & (F.col("retired") == 0), "left"
    ).drop("map_type", "voided", "retired", "map_program")


def first_programs(program_map: DataFrame, program: DataFrame) -> DataFrame:
    """One program name per visit type, the lowest id among the usable ones.

    Equal to joining all programs and keeping one row per encounter, without
    multiplying the visits first.
    """
    types = program_map.select("visit_type").distinct()
    matched = programs_of_visits(types, program_map, program).filter("program_id is not null")
    return matched.groupBy("visit_type").agg(
        F.min_by("program_name", "program_id").alias("program_name")
    )


def one_row_per_encounter(rows: DataFrame, columns: list[str], order: str) -> DataFrame:
    """The row with the lowest `order` of each encounter; unknown order comes last."""
    rank = F.struct(F.col(order).isNull().alias("unknown"), F.col(order).alias("value"))
    return (
        rows.groupBy("encounter_id")
        .agg(F.min_by(F.struct(*columns), rank).alias("row"))
        .select("encounter_id", "row.*")
    )


def next_visit_matches(appointments: DataFrame, visits: DataFrame) -> DataFrame:
    """Each appointment with every clinical visit that answers it, or none."""
    answers = visits.filter(
        (F.col("is_clinical_encounter") == 1)
        & ~F.col("encounter_type").isin(fixed.NON_VISIT_TYPES)
    ).select(
        "person_id",
        F.col("prev_rtc_date").alias("rtc_date"),
        F.col("encounter_id").alias("answer_id"),
        F.col("encounter_datetime").alias("answer_datetime"),
        F.col("encounter_type").alias("answer_type"),
        F.col("rtc_date").alias("answer_rtc_date"),
    )
    return appointments.join(answers, ["person_id", "rtc_date"], "left")


def with_addresses(person: DataFrame, address: DataFrame) -> DataFrame:
    """Persons with county, sub-county and identifier where known."""
    return person.join(address, "person_id", "left")
