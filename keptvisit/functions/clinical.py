"""Clinical values: BMI, viral load, missed days, plausible ranges, missing-value rules."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed


def is_missing(value: Column) -> Column:
    return value.isNull().cast("int")


def bmi(weight: Column, height_cm: Column, low: float | None = 5.0, high: float | None = 60.0,
        least_input: float | None = 1.0) -> Column:
    """Body mass index to 2 decimals; null for implausible inputs or results.

    Bounds of None are not checked: the training extracts keep every result.
    """
    metres = height_cm / 100
    value = F.round(F.when(metres != 0, weight / (metres * metres)), 2)
    if least_input is not None:
        value = F.when((weight >= least_input) & (height_cm >= least_input), value)
    if low is not None:
        value = F.when(value >= low, value)
    if high is not None:
        value = F.when(value <= high, value)
    return value


def inputs_missing(weight: Column, height_cm: Column, least_input: float = 1.0) -> Column:
    """1 where weight or height is absent or too small to be a measurement."""
    usable = (weight >= least_input) & (height_cm >= least_input)
    return F.when(usable, 0).otherwise(1)


def viral_load_log10(copies: Column, offset: float = 1.0) -> Column:
    return F.log10(copies + F.lit(offset))


def vl_suppressed(copies: Column, below: int = 1000) -> Column:
    """1 below the limit; 0 otherwise, also when not measured."""
    return F.when(copies < below, 1).otherwise(0)


def clamp(value: Column, low: float, high: float) -> Column:
    """Value moved into [low, high]; null stays null, unlike greatest and least."""
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def within(value: Column, low: float, high: float) -> Column:
    """Value inside [low, high], else null."""
    return F.when(value.between(low, high), value)


def log_days_defaulted(days: Column, profile: str = "training") -> Column:
    """Log of the missed days.

    Serving takes the log of positive days only. Training clamps first and moves
    the range above zero.
    """
    if profile == "serving":
        return F.ln(F.when(days > 0, days))
    return F.ln(clamp(days, *fixed.DEFAULT_DAYS_RANGE) + 32)


def missing_indicators(names: list[str]) -> dict[str, Column]:
    return {f"{name}_NA": is_missing(F.col(name)) for name in names}


def fixed_fills(numbers: list[str], logs: list[str], categories: dict[str, object]) -> dict:
    """Fill values for DataFrame.fillna: 0, log(1) and category defaults."""
    return {**{n: 0 for n in numbers}, **{n: math.log(1) for n in logs}, **categories}


def lab_date_if_resulted(ordered: Column, result: Column) -> Column:
    return F.when(result.isNotNull(), ordered)


def earliest_due_date(*days: Column) -> Column:
    """Earliest of the dates that are known."""
    return F.least(*days)


def after_closure(day: Column, closure: Column) -> Column:
    return F.when(day >= closure, "Yes").when(day < closure, "No")


def label_from_days(days: Column, at_least: int, strict: bool = False) -> Column:
    """Outcome label of a missed-day count; null days give no label."""
    late = days > at_least if strict else days >= at_least
    return F.when(late, fixed.DISENGAGED).when(~late, fixed.ACTIVE)


def unless_pickup(label: Column, next_type: Column) -> Column:
    """No label when the next visit only picks up drugs; an unknown next type keeps it."""
    pickup = F.coalesce(next_type.isin(fixed.MED_PICKUP_TYPES), F.lit(False))
    return F.when(~pickup, label)


def effective_location(transfer_out: Column, location: Column) -> Column:
    """Where the patient is expected next."""
    return F.coalesce(transfer_out, location)


def endpoint_probability(endpoint: Column, prob_1day: Column, prob_7day: Column) -> Column:
    """The probability of the horizon that the site uses; 1 day unless it chose 7."""
    return F.when(endpoint == 7, prob_7day).otherwise(prob_1day)


def age_band(age: Column) -> Column:
    """adult, minor, or null when the age is unknown."""
    return F.when(age >= fixed.ADULT_AGE, "adult").when(age < fixed.ADULT_AGE, "minor")
