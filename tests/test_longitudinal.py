"""Longitudinal features against plain loops on random and hand-made histories."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from keptvisit.operators import longitudinal

PICKUPS = (153, 158, 186)
SCHEMA = ("person_id long, encounter_id long, visit_date date, encounter_type int, rtc_date date, "
          "next_datetime date, vl int, vl_order date, weight double")


def history(seed, persons=25):
    rng = random.Random(seed)
    rows, ids = [], iter(rng.sample(range(10000), 10000))
    for person in range(persons):
        days = sorted(rng.sample(range(1500), rng.randint(1, 20)))
        dates = [date(2019, 2, 27) + timedelta(d) for d in days]
        for place, day in enumerate(dates):
            nxt = dates[place + 1] if place + 1 < len(dates) else None
            rtc = None if rng.random() < 0.1 else day + timedelta(rng.choice([5, 20, 60, 400]))
            rows.append((
                person, next(ids), day, rng.choice([1, 1, 2, 153, 158, 186, None]), rtc, nxt,
                rng.choice([None, 5, 2000]), rng.choice([None, day - timedelta(9)]),
                rng.choice([None, 60.0, 71.5]),
            ))
    return rows


END = date(2024, 1, 1)


@pytest.fixture(scope="module", params=[1, 2])
def data(request, spark):
    rows = history(request.param)
    names = [part.strip().split()[0] for part in SCHEMA.split(",")]
    people = {}
    for row in rows:
        people.setdefault(row[0], []).append(dict(zip(names, row)))
    for visits in people.values():
        visits.sort(key=lambda v: v["visit_date"])
        by_id = sorted(visits, key=lambda v: v["encounter_id"])
        for place, visit in enumerate(by_id):
            visit["before"] = by_id[place - 1] if place else None
            visit["after"] = by_id[place + 1] if place + 1 < len(by_id) else None
        for visit in visits:
            back = visit["next_datetime"] or END
            visit["days"] = (back - visit["rtc_date"]).days if visit["rtc_date"] else None
            kind = visit["after"]["encounter_type"] if visit["after"] else None
            for name, horizon in (("1day", 1), ("1month", 28)):
                known = visit["days"] is not None and kind not in PICKUPS
                visit[name] = (visit["days"] >= horizon) if known else None
                visit[name + "_old"] = None if visit["days"] is None else visit["days"] >= horizon
    frame = spark.createDataFrame(rows, SCHEMA)
    frame = frame.withColumn("next_type", F.lead("encounter_type").over(longitudinal.by_id()))
    return people, frame


def labelled(frame, aware=True):
    back = F.coalesce("next_datetime", F.lit(END))
    return longitudinal.outcome_labels(frame, back, next_type=F.col("next_type") if aware else None)


def check(frame, people, column, want):
    got = {(r["person_id"], r["encounter_id"]): r[column] for r in frame.collect()}
    seen = 0
    for visits in people.values():
        for place, visit in enumerate(visits):
            assert got[visit["person_id"], visit["encounter_id"]] == want(visits, place, visit), (column, visit)
            seen += 1
    assert seen == len(got)


def test_pickup_aware_rolling(data):
    people, frame = data
    rows = longitudinal.pickup_aware_rolling(labelled(frame), ["1day", "1month"])

    def pickups(visits, visit):
        if visit["before"] is None:
            return 0
        spot = visits.index(visit["before"])
        return sum(v["1day"] is None for v in visits[max(spot - 2, 0):spot + 1])

    def count(name):
        def want(visits, place, visit):
            if visit["before"] is None:
                return 0
            spot = visits.index(visit["before"])
            width = 3 + pickups(visits, visit["before"])
            return sum(bool(v[name]) for v in visits[max(spot - width + 1, 0):spot + 1])
        return want

    check(rows, people, "med_pickups_last_3visits", lambda vs, _, v: pickups(vs, v))
    for name in ("1day", "1month"):
        check(rows, people, f"num_{name}_defaults_last_3visits", count(name))


def test_rolling_is_poisoned_by_null(data):
    people, frame = data
    rows = longitudinal.rolling_defaults(labelled(frame, aware=False), ["1day"])

    def want(visits, place, visit):
        if visit["before"] is None:
            return 0
        spot = visits.index(visit["before"])
        last = [v["1day_old"] for v in visits[max(spot - 2, 0):spot + 1]]
        return 0 if None in last else sum(last)

    check(rows, people, "num_1day_defaults_last_3visits", want)


def test_last_clinical_default(data):
    people, frame = data
    rows = longitudinal.last_clinical_default(labelled(frame))

    def want(visits, place, visit):
        if visit["before"] is None:
            return None
        spot = visits.index(visit["before"])
        clinical = [v for v in visits[:spot + 1] if v["encounter_type"] not in PICKUPS]
        return clinical[-1]["days"] if clinical else None

    check(rows, people, "days_defaulted_prev", want)


def earlier(day, years):
    try:
        return day.replace(year=day.year - years)
    except ValueError:
        return day.replace(year=day.year - years, day=28)


@pytest.mark.parametrize("inclusive", [False, True])
def test_ever_defaulted(data, inclusive):
    people, frame = data
    rows = longitudinal.ever_defaulted(labelled(frame), {"one": 1, "two": 2}, inclusive=inclusive)
    for name, years in (("one", 1), ("two", 2)):
        def want(visits, place, visit):
            start = earlier(visit["visit_date"], years)
            span = [
                v["1month"] for v in visits[:place]
                if v["visit_date"] > start or (inclusive and v["visit_date"] == start)
            ]
            return 1 if True in span else None if None in span else 0

        check(rows, people, name, want)


def test_same_day_last_year_is_the_edge(spark):
    day = date(2021, 5, 4)
    rows = spark.createDataFrame(
        [(1, 1, date(2020, 5, 4), "Disengaged"), (1, 2, day, "Active In Care"),
         (2, 3, date(2020, 2, 29), "Disengaged"), (2, 4, date(2021, 2, 28), None)],
        "person_id long, encounter_id long, visit_date date, y_1month string")
    out = longitudinal.ever_defaulted(rows, {"open": 1})
    out = longitudinal.ever_defaulted(out, {"closed": 1}, inclusive=True)
    got = {r["encounter_id"]: (r["open"], r["closed"]) for r in out.collect()}
    assert got == {1: (0, 0), 2: (0, 1), 3: (0, 0), 4: (1, 1)}


def test_order_dates_and_carry_forward(data):
    people, frame = data
    rows = longitudinal.estimated_order_dates(frame, {"guess": ("vl", "vl_order")})
    rows = longitudinal.carry_forward(rows, ["weight"])

    def order_date(visits, place, visit):
        for v in reversed(visits[:place + 1]):
            guess = v["vl_order"]
            if v["vl"] is not None and guess is None:
                guess = v["before"]["visit_date"] if v["before"] else None
            if guess is not None:
                return guess
        return None

    check(rows, people, "guess", order_date)
    check(rows, people, "weight", lambda vs, i, v: next(
        (x["weight"] for x in reversed(vs[:i + 1]) if x["weight"] is not None), None))
    check(rows, people, "weight_orig", lambda vs, i, v: v["weight"])
    check(rows, people, "weight_baseline", lambda vs, i, v: vs[0]["weight"])


def test_next_visits(data):
    people, frame = data
    rows = longitudinal.next_visits(frame.drop("next_type"), F.lit(END))

    def second(vs, i, v):
        two = v["after"]["after"] if v["after"] else None
        return two["visit_date"] if two else END

    check(rows, people, "next_date", lambda vs, i, v: v["after"]["visit_date"] if v["after"] else END)
    check(rows, people, "next_type", lambda vs, i, v: v["after"]["encounter_type"] if v["after"] else None)
    check(rows, people, "second_next_date", second)
