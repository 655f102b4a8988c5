"""From visits to the model matrix: labels, history features, folds, weights, fills."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates
from keptvisit.operators import filters, folds, longitudinal, profiles, timeline
from keptvisit.operators.timeline import HotKeys
from keptvisit.session import write_out

col = F.col

LABS = {"vl_ordered": ("vl_resulted", "vl_order_date"),
        "cd4_ordered": ("cd4_resulted", "cd4_order_date")}
ROLLED = ["1day", "7days"]


def clean_longitudinal(
    visits: DataFrame, person: DataFrame, hot: HotKeys, as_of: Column
) -> DataFrame:
    """One row per person and day with labels, history features and carried values.

    All windows share the layout by person.
    """
    daily = timeline.first_of_day(visits, hot, laid_out=True)
    daily = daily.withColumns({
        "next_type": F.lead("encounter_type").over(longitudinal.by_id()),
        "visit_number": F.row_number().over(longitudinal.by_date()),
        "bmi": clinical.bmi(col("weight"), col("height"), None, None, None),
        "viral_load_log10": clinical.viral_load_log10(col("vl_resulted")),
        "cd4": col("cd4_resulted"),
        "disclosure": F.coalesce("disclosure", F.lit("Not Done")),
        "month": dates.appointment_month(col("rtc_date")),
    })
    rows = longitudinal.estimated_order_dates(daily, LABS)
    rows = longitudinal.days_since(
        rows, {"days_since_vl": "vl_ordered", "days_since_cd4": "cd4_ordered"}
    )
    back = F.coalesce(F.to_date("next_clinical_datetime"), as_of)
    rows = longitudinal.outcome_labels(rows, back, next_type=col("next_type"))
    rows = longitudinal.pickup_aware_rolling(rows, ROLLED)
    rows = longitudinal.last_clinical_default(rows)
    rows = longitudinal.carry_forward(
        rows, ["bmi", "viral_load_log10", "cd4", "disclosure", "tb_test_result"], baseline=False
    )
    rows = rows.join(person, "person_id")
    return rows.withColumn("age", dates.years_between(col("birthdate"), col("visit_date")))


def plausible(rows: DataFrame) -> DataFrame:
    """Implausible values set to null, missed days and lab ages clamped."""
    ranges = fixed.PLAUSIBLE_RANGES
    kept = {name: clinical.within(col(name), *ranges[name])
            for name in ("bmi", "cd4", "viral_load_log10")}
    ages = {name: clinical.clamp(col(name), *fixed.LAB_AGE_RANGE)
            for name in ("days_since_vl", "days_since_cd4")}
    logs = {"log_days_defaulted": clinical.log_days_defaulted(col("days_defaulted_prev"))}
    return rows.withColumns(kept | ages | logs)


def filled(rows: DataFrame) -> DataFrame:
    """Missing indicators, then fixed values for the missing predictors."""
    return rows.withColumns(clinical.missing_indicators(fixed.MEASURED)).fillna(fixed.FILLS)


def model_matrix(
    visits: DataFrame, person: DataFrame, facility: DataFrame, programs: DataFrame,
    hot: HotKeys, as_of: Column, opening: date | None, closure: date | Column,
    k: int = fixed.FOLDS,
) -> DataFrame:
    """Rows with all predictors, `y_*` labels, `w_*` weights, cohort and fold.

    The longitudinal stage is written once: folds and class weights read it
    again.
    """
    rows = filters.study_window(clean_longitudinal(visits, person, hot, as_of), opening, closure)
    rows = plausible(longitudinal.cohort_from_first_age(rows))
    labels = {f"y_{name}": f"w_{name}" for name in fixed.HORIZONS}
    rows = (
        rows.join(facility, "location_id", "left")
        .join(programs, "visit_type", "left")
        .select("person_id", "encounter_id", "location_id", "visit_date", "rtc_date", "cohort",
                *labels, *[name for name in fixed.PREDICTORS if not name.endswith("_NA")])
    )
    rows = write_out(rows, "longitudinal")
    return filled(profiles.class_weights(folds.assign_folds(rows, k), labels))
