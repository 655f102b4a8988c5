"""Visit history per person: numbering, missed days, baseline visit."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates, recodes
from keptvisit.operators import filters, timeline
from keptvisit.operators.timeline import VISIT_ORDER, HotKeys

SINCE = date(1996, 1, 1)


def care_visits(visits: DataFrame, since: date) -> DataFrame:
    """Visits that count for the history: in care, since a date, no repeats."""
    return filters.without_repeats(filters.in_care_since(visits, since))


def visit_numbers(visits: DataFrame, hot: HotKeys) -> DataFrame:
    """Visits numbered per person by time; the encounter id breaks ties."""
    return timeline.along(visits, hot, VISIT_ORDER, lambda window: {}, number="visit_number")


def days_defaulted_history(visits: DataFrame, hot: HotKeys, since: date) -> DataFrame:
    """Per visit, the days between the appointment of the clinical visit before and the visit, clamped.

    Where that is unknown the previous visit's own value is taken.
    """
    late = dates.days_between(F.col("prev_clinical_rtc_date"), F.to_date("encounter_datetime"))
    rows = care_visits(visits, since).select(
        "person_id", "encounter_id", "encounter_datetime",
        clinical.clamp(late, *fixed.DEFAULT_DAYS_RANGE).alias("_days"),
    )
    filled = timeline.along(
        rows, hot, VISIT_ORDER,
        lambda window: {
            "days_defaulted_last_encounter": F.coalesce("_days", F.lag("_days").over(window))
        },
        back=1, number="visit_number",
    )
    return filled.select(
        "person_id", "encounter_id", F.to_date("encounter_datetime").alias("encounter_date"),
        "visit_number", "days_defaulted_last_encounter",
    )


def strict_three_visit_defaults(
    history: DataFrame, hot: HotKeys, horizons: dict[str, int] | None = None
) -> DataFrame:
    """Visits missed by at least a horizon among this and the two before; null if any is unknown.

    `horizons` maps result columns to days.
    """
    horizons = horizons or {"num_1day_defaults_last_3_visits": 1}
    late = F.col("days_defaulted_last_encounter")
    flags = {
        f"_{name}": F.when(late >= days, 1).when(late < days, 0) for name, days in horizons.items()
    }
    return timeline.along(
        history.withColumns(flags), hot, ["visit_number"],
        lambda window: {
            name: F.col(f"_{name}") + F.lag(f"_{name}", 1).over(window)
            + F.lag(f"_{name}", 2).over(window)
            for name in horizons
        },
        back=2,
    ).select("person_id", "encounter_id", "visit_number", *horizons)


def first_visits(visits: DataFrame, columns: list[str]) -> DataFrame:
    """The first visit of each person, combined before the shuffle; no window."""
    order = F.struct(*VISIT_ORDER)
    return (
        visits.groupBy("person_id")
        .agg(F.min_by(F.struct(*columns), order).alias("row"))
        .select("person_id", "row.*")
    )


def baseline_visit(
    visits: DataFrame, person: DataFrame, location: DataFrame, since: date,
    drug_names: dict[str, str] = fixed.DRUG_NAMES,
) -> DataFrame:
    """One row per person with the attributes of the first visit in care."""
    columns = [
        "encounter_id", "encounter_datetime", "location_id", "weight", "height", "who_stage",
        "vl_resulted", "disclosure", "arv_line", "is_pregnant", "cd4_resulted", "arv_meds",
    ]
    first = first_visits(care_visits(visits, since), columns)
    names = location.filter("retired = 0").select("location_id", "name")
    col = F.col
    return first.join(person, "person_id", "left").join(names, "location_id", "left").select(
        "person_id",
        dates.years_between(col("birthdate"), col("encounter_datetime")).alias("age_baseline"),
        col("gender").alias("gender_baseline"),
        clinical.bmi(col("weight"), col("height")).alias("bmi_baseline"),
        col("who_stage").alias("who_staging_baseline"),
        clinical.vl_suppressed(col("vl_resulted")).alias("vl_suppression_baseline"),
        clinical.viral_load_log10(col("vl_resulted")).alias("viral_load_log10_baseline"),
        col("disclosure").alias("hiv_disclosure_baseline"),
        col("arv_line").alias("regimen_line_baseline"),
        F.coalesce("is_pregnant", F.lit(0)).alias("pregnancy_baseline"),
        recodes.urban_rural(col("location_id")).alias("clinic_location_baseline"),
        col("cd4_resulted").alias("cd4_baseline"),
        col("name").alias("clinic_name_baseline"),
        recodes.regimen_names(col("arv_meds"), drug_names).alias("art_regimen_baseline"),
    )


def two_step_outcome(
    encounters: DataFrame, hot: HotKeys, as_of: Column, horizon: int = 30
) -> DataFrame:
    """First visit per person with the gaps and outcomes of its first two appointments.

    The two next visits follow by encounter id; open ones last until `as_of`.
    """
    rows = encounters.select(
        "person_id", "encounter_id", "encounter_datetime", "rtc_date",
        F.to_date("encounter_datetime").alias("seen"),
    )
    led = timeline.along(
        rows, hot, ["encounter_id"],
        lambda window: {
            "next_1": F.lead("seen", 1).over(window),
            "next_2": F.lead("seen", 2).over(window),
            "rtc_2": F.lead("rtc_date", 1).over(window),
        },
        ahead=2,
    )
    first = first_visits(led, ["encounter_id", "seen", "rtc_date", "next_1", "next_2", "rtc_2"])
    next_1 = F.coalesce("next_1", as_of)
    next_2 = F.coalesce("next_2", as_of)
    gap_1 = dates.days_between(F.col("rtc_date"), next_1)
    gap_2 = dates.days_between(F.col("rtc_2"), next_2)
    return first.select(
        "person_id", "encounter_id",
        dates.days_between(F.col("seen"), F.col("rtc_date")).alias("days_until_scheduled"),
        dates.days_between(F.col("seen"), next_1).alias("days_until_actual"),
        gap_1.alias("gap_1"),
        gap_2.alias("gap_2"),
        clinical.label_from_days(gap_1, horizon, strict=True).alias("outcome_1"),
        clinical.label_from_days(gap_2, horizon, strict=True).alias("outcome_2"),
    )
