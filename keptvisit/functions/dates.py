"""Weeks, ages and day distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def years_between(start: Column, end: Column) -> Column:
    """Complete years; a birthday on 29 February is reached on 1 March of a common year."""
    return F.timestamp_diff("YEAR", start, end).cast("int")


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from start to end."""
    return F.datediff(end, start)


def full_days_between(start: Column, end: Column) -> Column:
    """Whole periods of 24 hours from start to end, negative when end comes first."""
    return F.timestamp_diff("DAY", start, end).cast("int")


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", day))


def week_end(day: Column, weeks: int = 1) -> Column:
    """Sunday that ends a run of `weeks` weeks from the day's week on."""
    return F.date_add(week_start(day), 6 + 7 * (max(weeks, 1) - 1))


def cohort_week_label(day: Column) -> Column:
    """ISO label, like 2023-W05, of the week before the day's week."""
    before = F.date_sub(week_start(day), 7)
    week = F.lpad(F.weekofyear(before).cast("string"), 2, "0")
    return F.concat(F.extract(F.lit("YEAROFWEEK"), before).cast("string"), F.lit("-W"), week)


def sunday_week_label(day: Column) -> Column:
    """Label of the day's Monday with weeks counted from the year's first Sunday."""
    monday = week_start(day)
    week = F.floor((F.dayofyear(monday) + 7 - F.dayofweek(monday)) / 7)
    return F.concat(
        F.year(monday).cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0")
    )


def appointment_month(day: Column) -> Column:
    return F.month(day).cast("string")


def unless_sentinel(day: Column, year: int = 1900) -> Column:
    """The date, or null where it carries the `unknown` year."""
    return F.when(F.year(day) != year, day)
