"""Scalar rules on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from keptvisit.functions import clinical, dates, recodes
from keptvisit.plans.weekly import week_of


def values(spark, rows, schema, column):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [r["v"] for r in frame.select("i", column.alias("v")).orderBy("i").collect()]


WEEKS = [
    (date(2023, 6, 26), date(2023, 6, 26)), (date(2023, 6, 28), date(2023, 6, 26)),
    (date(2023, 6, 25), date(2023, 6, 19)), (date(2023, 1, 1), date(2022, 12, 26)),
    (date(2016, 1, 1), date(2015, 12, 28)),
]


def test_week_start(spark):
    got = values(spark, [(d,) for d, _ in WEEKS], "d date", dates.week_start(F.col("d")))
    assert got == [monday for _, monday in WEEKS]
    assert [week_of(d)[0] for d, _ in WEEKS] == got


def test_week_end_and_labels(spark):
    days = [(date(2023, 6, 25),), (date(2023, 6, 26),), (None,)]
    assert values(spark, days, "d date", dates.week_end(F.col("d"))) == [
        date(2023, 6, 25), date(2023, 7, 2), None]
    assert values(spark, days, "d date", dates.week_end(F.col("d"), 2))[1] == date(2023, 7, 9)
    assert week_of(date(2023, 6, 28), 2) == (date(2023, 6, 26), date(2023, 7, 9))
    year_end = [(date(2024, 1, 1),), (date(2021, 1, 5),), (date(2021, 1, 12),)]
    assert values(spark, year_end, "d date", dates.cohort_week_label(F.col("d"))) == [
        "2023-W52", "2020-W53", "2021-W01"]
    got = values(spark, year_end, "d date", dates.sunday_week_label(F.col("d")))
    assert got == [d.strftime("%Y-W%U") for d in (date(2024, 1, 1), date(2021, 1, 4), date(2021, 1, 11))]


def test_leap_day_age(spark):
    rows = [(date(2004, 2, 29), date(2022, 2, 28)), (date(2004, 2, 29), date(2022, 3, 1)), (None, date(2022, 3, 1))]
    got = values(spark, rows, "b date, v date", dates.years_between(F.col("b"), F.col("v")))
    assert got == [17, 18, None]


def test_day_spans_differ(spark):
    rows = [(datetime(2020, 1, 2, 1), datetime(2020, 1, 1, 23)), (datetime(2020, 1, 3), datetime(2020, 1, 1))]
    schema = "visit timestamp, lab timestamp"
    visit, lab = F.col("visit"), F.col("lab")
    assert values(spark, rows, schema, dates.full_days_between(visit, lab)) == [0, -2]
    assert values(spark, rows, schema, dates.days_between(lab, visit)) == [1, 2]


def test_clamp_keeps_null(spark):
    rows = [(None,), (-50,), (-31,), (0,), (365,), (900,)]
    assert values(spark, rows, "d int", clinical.clamp(F.col("d"), -31, 365)) == [
        None, -31, -31, 0, 365, 365]


def test_log_of_days(spark):
    rows = [(None,), (-50,), (0,), (1,), (900,)]
    serving = values(spark, rows, "d int", clinical.log_days_defaulted(F.col("d"), "serving"))
    assert serving[:4] == [None, None, None, 0.0]
    training = values(spark, rows, "d int", clinical.log_days_defaulted(F.col("d")))
    assert training[0] is None and training[1] == 0.0 and training[4] == pytest.approx(5.98393, abs=1e-4)


def test_bmi(spark):
    rows = [(70.0, 175.0), (None, 175.0), (70.0, 0.0), (0.5, 175.0), (300.0, 150.0), (5.0, 180.0)]
    got = values(spark, rows, "w double, h double", clinical.bmi(F.col("w"), F.col("h")))
    assert got == [22.86, None, None, None, None, None]
    free = clinical.bmi(F.col("w"), F.col("h"), None, None, None)
    assert values(spark, rows, "w double, h double", free) == [22.86, None, None, 0.16, 133.33, 1.54]


def test_suppression_and_labels(spark):
    assert values(spark, [(None,), (999,), (1000,)], "x int", clinical.vl_suppressed(F.col("x"))) == [0, 1, 0]
    days = [(None,), (27,), (28,)]
    assert values(spark, days, "d int", clinical.label_from_days(F.col("d"), 28)) == [
        None, "Active In Care", "Disengaged"]
    assert values(spark, days, "d int", clinical.label_from_days(F.col("d"), 28, strict=True))[2] == "Active In Care"
    kinds = [("Disengaged", 186), ("Disengaged", None), ("Active In Care", 2)]
    got = values(spark, kinds, "y string, t int", clinical.unless_pickup(F.col("y"), F.col("t")))
    assert got == [None, "Disengaged", "Active In Care"]


def test_band_and_endpoint(spark):
    assert values(spark, [(18,), (17,), (None,)], "a int", clinical.age_band(F.col("a"))) == [
        "adult", "minor", None]
    rows = [(7,), (1,), (None,)]
    chosen = clinical.endpoint_probability(F.col("e"), F.lit(0.1), F.lit(0.7))
    assert values(spark, rows, "e int", chosen) == [0.7, 0.1, 0.1]


def test_regimens(spark):
    rows = [("628##630",), ("628",), ("9##628",), (None,)]
    got = values(spark, rows, "m string", recodes.regimen_names(F.col("m"), {"628": "3TC", "630": "AZT"}))
    assert got == ["3TC + AZT", "3TC", "9 + 3TC", None]
    lines = [("THIRD LINE HIV ANTIRETROVIRAL DRUG TREATMENT", "DTG"), (None, "3TC + ABC + DTG"), ("X", "Y"), (None, None)]
    got = values(spark, lines, "l string, r string", recodes.regimen_line(F.col("l"), F.col("r")))
    assert got == [3, 2, 5, 5]
    assert values(spark, [(None,), ("Y",), ("3TC + TDF + DTG",)], "r string", recodes.valid_regimen(F.col("r"))) == [
        "Invalid Regimen", "Invalid Regimen", "3TC + TDF + DTG"]
