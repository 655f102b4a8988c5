"""Longitudinal features over one visit per person and day.

All functions take the output of `timeline.first_of_day`: a person has at most
one row per calendar day, so a window per person is bounded by the days of the
study, whatever the number of raw records. Two orders are in use: visits by
date, and by encounter id for "previous" and "next".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.functions import clinical, dates

col = F.col


def by_date() -> WindowSpec:
    return Window.partitionBy("person_id").orderBy("visit_date")


def by_id() -> WindowSpec:
    return Window.partitionBy("person_id").orderBy("encounter_id")


def so_far() -> WindowSpec:
    return by_date().rowsBetween(Window.unboundedPreceding, 0)


def next_visits(daily: DataFrame, as_of: Column) -> DataFrame:
    """Next and second next visit; an open visit is taken to last until `as_of`."""
    return daily.withColumns({
        "next_date": F.coalesce(F.lead("visit_date").over(by_id()), as_of),
        "next_type": F.lead("encounter_type").over(by_id()),
        "next_appointment": F.lead("rtc_date").over(by_id()),
        "second_next_date": F.coalesce(F.lead("visit_date", 2).over(by_id()), as_of),
    })


def estimated_order_dates(daily: DataFrame, labs: dict[str, tuple[str, str]]) -> DataFrame:
    """Order dates per lab, `name -> (result, order date)`.

    A result without an order date is taken to be ordered at the visit before;
    the date is then carried forward.
    """
    guesses = {
        f"_{name}": F.when(
            col(result).isNotNull() & col(ordered).isNull(), F.lag("visit_date").over(by_id())
        ).otherwise(col(ordered))
        for name, (result, ordered) in labs.items()
    }
    carried = {name: F.last(f"_{name}", ignorenulls=True).over(so_far()) for name in labs}
    return daily.withColumns(guesses).withColumns(carried).drop(*guesses)


def days_since(daily: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Days from a date column to the visit, per `name -> date column`."""
    return daily.withColumns({
        name: dates.days_between(col(start), col("visit_date")) for name, start in columns.items()
    })


def carry_forward(daily: DataFrame, names: list[str], baseline: bool = True) -> DataFrame:
    """Missing values filled from the person's earlier visits.

    The measured values stay as `<name>_orig`. `<name>_baseline` is the value of
    the first visit, missing for all visits if it was missing there.
    """
    columns: dict[str, Column] = {f"{name}_orig": col(name) for name in names}
    if baseline:
        columns |= {f"{name}_baseline": F.first(name).over(so_far()) for name in names}
    columns |= {name: F.last(name, ignorenulls=True).over(so_far()) for name in names}
    return daily.withColumns(columns)


def baselines(daily: DataFrame, names: list[str]) -> DataFrame:
    return daily.withColumns({f"{name}_baseline": F.first(name).over(so_far()) for name in names})


def outcome_labels(
    daily: DataFrame,
    next_date: Column,
    horizons: dict[str, int] = fixed.HORIZONS,
    strict: bool = False,
    next_type: Column | None = None,
) -> DataFrame:
    """Days from the appointment to the next visit, and a label per horizon.

    With `next_type`, a visit that is followed by a drug pick-up gets no label.
    """
    rows = daily.withColumn("days_defaulted", dates.days_between(col("rtc_date"), next_date))
    labels = {}
    for name, days in horizons.items():
        label = clinical.label_from_days(col("days_defaulted"), days, strict)
        labels[f"y_{name}"] = label if next_type is None else clinical.unless_pickup(label, next_type)
    return rows.withColumns(labels)


def missed(name: str) -> Column:
    """1 for a missed appointment, 0 for a kept one, null without a label."""
    return (col(f"y_{name}") == fixed.DISENGAGED).cast("int")


def rolling_defaults(labelled: DataFrame, horizons: list[str]) -> DataFrame:
    """Missed appointments among the three visits before; any unlabelled one makes it 0."""
    last_three = by_date().rowsBetween(-2, 0)
    sums, lagged = {}, {}
    for name in horizons:
        known = F.count(missed(name)).over(last_three) == F.count(F.lit(1)).over(last_three)
        sums[f"_{name}"] = F.when(known, F.sum(missed(name)).over(last_three))
        lagged[f"num_{name}_defaults_last_3visits"] = F.coalesce(
            F.lag(f"_{name}").over(by_id()), F.lit(0)
        )
    return labelled.withColumns(sums).withColumns(lagged).drop(*sums)


def pickup_aware_rolling(labelled: DataFrame, horizons: list[str]) -> DataFrame:
    """Missed appointments among the three clinical visits before.

    The window of three visits grows by the unlabelled visits among the last
    three, so drug pick-ups do not push clinical visits out. It never exceeds six
    rows, so it is a sum over six fixed lags.
    """
    last_three = by_date().rowsBetween(-2, 0)
    unlabelled = F.sum(col("y_1day").isNull().cast("int")).over(last_three)
    rows = labelled.withColumn("_unlabelled", unlabelled).withColumn(
        "med_pickups_last_3visits", F.coalesce(F.lag("_unlabelled").over(by_id()), F.lit(0))
    )
    width = 3 + col("med_pickups_last_3visits")
    sums, lagged = {}, {}
    for name in horizons:
        terms = [missed(name)] + [F.lag(missed(name), back).over(by_date()) for back in range(1, 6)]
        sums[f"_{name}"] = sum(
            (F.when(F.lit(back) < width, F.coalesce(term, F.lit(0))).otherwise(0)
             for back, term in enumerate(terms)),
            F.lit(0),
        )
        lagged[f"num_{name}_defaults_last_3visits"] = F.coalesce(
            F.lag(f"_{name}").over(by_id()), F.lit(0)
        )
    return rows.withColumns(sums).withColumns(lagged).drop("_unlabelled", *sums)


def last_clinical_default(labelled: DataFrame) -> DataFrame:
    """Missed days of the last visit before this one that was no drug pick-up.

    The value travels inside a struct, so an unknown number of days at that
    visit stays unknown instead of falling back to an earlier visit.
    """
    clinical_visit = F.coalesce(~col("encounter_type").isin(fixed.MED_PICKUP_TYPES), F.lit(True))
    carried = F.last(
        F.when(clinical_visit, F.struct(col("days_defaulted").alias("days"))), ignorenulls=True
    ).over(so_far())
    return (
        labelled.withColumn("_last", carried)
        .withColumn("days_defaulted_prev", F.lag("_last").over(by_id())["days"])
        .drop("_last")
    )


def ever_defaulted(
    labelled: DataFrame, years: dict[str, int], horizon: str = "1month", inclusive: bool = False
) -> DataFrame:
    """Whether any earlier visit of the last years was missed: 1, 0, or null if unknown.

    The visit on the same day `years` ago is outside unless `inclusive`. Days are
    unique per person, so the calendar frame minus its edges is exact.
    """
    rows = labelled.withColumn("_missed", missed(horizon)).withColumn(
        "_open", col("_missed").isNull().cast("int")
    )
    columns = {}
    for name, span in years.items():
        frame = (
            f"over (partition by person_id order by visit_date "
            f"range between interval {span} year preceding and current row)"
        )
        first = F.expr(f"first(struct(visit_date, _missed, _open)) {frame}")
        edge = (first["visit_date"] == F.add_months("visit_date", -12 * span)) & F.lit(not inclusive)

        def inside(value: str, first=first, edge=edge, frame=frame) -> Column:
            own = F.coalesce(col(value), F.lit(0))
            outside = F.when(edge, F.coalesce(first[value], F.lit(0))).otherwise(0)
            return F.coalesce(F.expr(f"sum({value}) {frame}"), F.lit(0)) - own - outside

        columns[name] = F.when(inside("_missed") > 0, 1).when(inside("_open") > 0, None).otherwise(0)
    return rows.withColumns(columns).drop("_missed", "_open")


def cohort_from_first_age(daily: DataFrame) -> DataFrame:
    """adult or minor by the age at the first visit."""
    first = F.first("age").over(so_far())
    return daily.withColumns({"first_age": first, "cohort": clinical.age_band(first)})
