"""Row filters of the extracts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions.clinical import effective_location


def site_list(encounters: DataFrame, sites: list[int] | None = None) -> DataFrame:
    """Encounters whose patient is expected at one of the sites."""
    place = effective_location(F.col("transfer_out_location_id"), F.col("location_id"))
    return encounters.filter(place.isin(sites or fixed.TARGET_SITES))


def none_of(value: Column, codes: list[int]) -> Column:
    """Not one of the codes; an unknown value passes."""
    return value.isNull() | ~value.isin(codes)


def active_appointments(
    visits: DataFrame, start: Column, end: Column, retrospective: bool = False
) -> DataFrame:
    """Appointments from start to end of living patients in care who have not come back yet.

    Coming back means a clinical visit. In retrospective runs a later visit is allowed when it is on or after the
    appointment.
    """
    transfers = [fixed.TRANSFER_INTERNAL, fixed.TRANSFER_EXTERNAL]
    kind = F.col("encounter_type")
    came_back = F.col("next_clinical_datetime")
    not_back = came_back.isNull()
    if retrospective:
        not_back = not_back | (came_back >= F.col("rtc_date"))
    return visits.filter(
        ~kind.isin(fixed.LAB_ENTRY_TYPES)
        & ((kind != fixed.TRANSFER_TYPE)
           | (F.col("transfer_in_location_id") == fixed.TRANSFER_INTERNAL))
        & F.col("transfer_out_date").isNull()
        & none_of(F.col("transfer_in_location_id"), transfers)
        & none_of(F.col("transfer_out_location_id"), transfers)
        & (F.col("is_clinical_encounter") == 1)
        & F.col("out_of_care").isNull()
        & F.col("death_date").isNull()
        & F.col("rtc_date").between(start, end)
        & not_back
        & (F.col("encounter_datetime") < F.col("date_created"))
    )


def without_repeats(visits: DataFrame) -> DataFrame:
    """Drop visits that repeat the previous one.

    The test is three-valued: where the comparison is unknown the row is dropped
    as well, which removes first visits.
    """
    same = (
        (F.col("rtc_date") == F.col("prev_rtc_date"))
        & (F.col("encounter_type") == F.col("prev_encounter_type"))
        & (F.col("encounter_datetime") == F.col("prev_encounter_datetime"))
    )
    return visits.filter(~same)


def in_care_since(visits: DataFrame, since: date) -> DataFrame:
    """Clinical visits of treated patients from a date on."""
    return visits.filter(
        F.col("arv_start_date").isNotNull()
        & (F.col("is_clinical_encounter") == 1)
        & (F.col("encounter_datetime") >= F.lit(since))
    )


def study_window(
    visits: DataFrame, opening: date | None, closure: date | Column
) -> DataFrame:
    """Visits from the opening on, if there is one, with appointments up to the closure."""
    due = visits.filter(F.col("rtc_date") <= F.lit(closure))
    return due if opening is None else due.filter(F.col("encounter_datetime") >= F.lit(opening))


def without_pickups(visits: DataFrame, kinds: list[int] | None = None) -> DataFrame:
    return visits.filter(~F.col("encounter_type").isin(kinds or fixed.MED_PICKUP_TYPES_OLD))


def unscored(visits: DataFrame, ledger: DataFrame) -> DataFrame:
    """Visits whose encounter is not in the ledger yet."""
    return visits.join(ledger.select("encounter_id"), "encounter_id", "left_anti")


def holdout_split(rows: DataFrame, fold: int = fixed.FOLDS) -> tuple[DataFrame, DataFrame]:
    """Training rows and the rows of the fold kept for the test."""
    return rows.filter(F.col("fold_id") != fold), rows.filter(F.col("fold_id") == fold)
