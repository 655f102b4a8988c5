"""Windows per person give the same rows when persons are split into blocks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMALL
from keptvisit.operators import history, timeline
from keptvisit.sources.fixtures import Clinic

LIMIT = 4


@pytest.fixture(scope="module")
def clinic(spark):
    return Clinic(spark, SMALL)


@pytest.fixture(scope="module")
def split(clinic):
    hot = timeline.find_hot_keys(clinic.encounter.select("person_id"), "person_id", LIMIT)
    assert hot.keys is not None and hot.keys.count() > 50
    return hot


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).isEmpty()


def test_no_hot_keys_by_default(clinic):
    assert clinic.hot_persons.keys is None


def test_neighbours(clinic, split):
    same(timeline.with_neighbours(clinic.encounter, split), clinic.visit)


def test_numbers_and_history(clinic, split):
    kept = history.care_visits(clinic.visit, history.SINCE)
    same(history.visit_numbers(kept, split), history.visit_numbers(kept, clinic.hot_persons))
    plain = history.days_defaulted_history(clinic.visit, clinic.hot_persons, history.SINCE)
    blocks = history.days_defaulted_history(clinic.visit, split, history.SINCE)
    same(blocks, plain)
    same(history.strict_three_visit_defaults(blocks, split),
         history.strict_three_visit_defaults(plain, clinic.hot_persons))


def test_two_step_outcome_and_first_of_day(clinic, split):
    end = F.lit("2001-12-31").cast("date")
    same(history.two_step_outcome(clinic.encounter, split, end),
         history.two_step_outcome(clinic.encounter, clinic.hot_persons, end))
    same(timeline.first_of_day(clinic.encounter, split),
         timeline.first_of_day(clinic.encounter, clinic.hot_persons))


def scrambled(spark):
    """Repeated ids, days met twice, missing dates, a null person, and few clinical visits."""
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.randint(1, 40),
             None if rng.random() < 0.1 else rng.randint(0, 30), rng.random() < 0.3) for _ in range(160)]
    return spark.createDataFrame(rows, "person_id int, encounter_id int, d int, c boolean").select(
        "person_id", "encounter_id", F.monotonically_increasing_id().alias("row"),
        F.col("c").cast("int").alias("is_clinical_encounter"), F.lit(1).alias("encounter_type"),
        F.date_add(F.lit("2020-01-01"), F.col("d")).cast("timestamp").alias("encounter_datetime"),
        F.when(F.col("encounter_id") % 5 > 0, F.date_add(F.lit("2020-02-01"), F.col("encounter_id")))
        .alias("rtc_date"))


@pytest.mark.parametrize("limit", [1, 3, 10, 10**6])
def test_first_of_day_is_one_rule(spark, limit):
    rows = scrambled(spark)
    hot = timeline.find_hot_keys(rows, "person_id", limit)
    got = timeline.first_of_day(rows, hot).collect()
    want = {}
    for r in rows.collect():
        day = (r["person_id"], r["encounter_datetime"])
        want[day] = min(want.get(day, 10**9), r["encounter_id"])
    assert {(r["person_id"], r["encounter_datetime"]): r["encounter_id"] for r in got} == want
    assert len(got) == len(want)


@pytest.mark.parametrize("limit", [1, 3, 10, 10**6])
def test_clinical_neighbours_pass_over_other_visits(spark, limit):
    rows = scrambled(spark).withColumn("encounter_id", F.col("row") + 1)
    hot = timeline.find_hot_keys(rows, "person_id", limit)
    assert (hot.keys is None) == (limit == 10**6)
    got = {r["row"]: r for r in timeline.with_neighbours(rows, hot).collect()}
    people = {}
    for r in rows.collect():
        people.setdefault(r["person_id"], []).append(r)
    assert len(got) == 160 and None in people
    for visits in people.values():
        visits.sort(key=lambda r: (r["encounter_datetime"] is not None, r["encounter_datetime"],
                                   r["encounter_id"]) if r["encounter_datetime"] else (False, None, r["encounter_id"]))
        for at, r in enumerate(visits):
            before = [v for v in visits[:at] if v["is_clinical_encounter"]]
            after = [v for v in visits[at + 1:] if v["is_clinical_encounter"]]
            row = got[r["row"]]
            assert row["prev_clinical_rtc_date"] == (before[-1]["rtc_date"] if before else None)
            seen = next((v["encounter_datetime"] for v in after if v["encounter_datetime"]), None)
            assert row["next_clinical_datetime"] == seen


@pytest.mark.parametrize("limit", [1, 2, 3, 7])
def test_one_person_holds_everything(spark, limit):
    rows = spark.range(0, 200, 1, 5).select(
        F.lit(1).alias("person_id"), (F.col("id") * 37 % 200).alias("spot"), F.col("id").alias("x"))
    hot = timeline.find_hot_keys(rows, "person_id", limit)

    def build(window):
        return {
            "back2": F.lag("x", 2).over(window),
            "ahead1": F.lead("x", 1).over(window),
            "near": F.sum("x").over(window.rowsBetween(-2, 1)),
        }

    got = timeline.along(rows, hot, ["spot"], build, back=2, ahead=1, number="n")
    window = Window.partitionBy("person_id").orderBy("spot")
    want = rows.withColumns(build(window)).withColumn(
        "n", F.row_number().over(window).cast("bigint"))
    same(got, want)


def test_first_of_day_takes_the_lowest_encounter(spark):
    rows = spark.createDataFrame(
        [(1, 9, "2020-01-01 08:00:00"), (1, 3, "2020-01-01 17:00:00"), (1, 4, "2020-01-02 01:00:00")],
        "person_id long, encounter_id long, t string",
    ).withColumn("encounter_datetime", F.col("t").cast("timestamp")).drop("t")
    hot = timeline.find_hot_keys(rows, "person_id")
    kept = timeline.first_of_day(rows, hot).orderBy("visit_date").collect()
    assert [r["encounter_id"] for r in kept] == [3, 4]


def test_tasks_of_a_timeline_hold_few_rows(spark, monkeypatch):
    """More rows are more tasks, not larger ones, and the rows are the same."""
    clinic = Clinic(spark, SMALL)
    visits = clinic.encounter
    total = visits.count()
    hot = timeline.find_hot_keys(visits.select("person_id"), "person_id")
    assert (hot.keys, hot.others) == (None, total)
    few = timeline.with_neighbours(visits, hot)
    monkeypatch.setattr(timeline, "LAID_ROWS", 100)
    many = timeline.with_neighbours(visits, hot)
    assert many.rdd.getNumPartitions() == -(-total // 100)
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()
    crowded = timeline.find_hot_keys(visits.select("person_id"), "person_id", limit=15)
    assert crowded.rows > 0 and crowded.rows + crowded.others == total
    split = timeline.with_neighbours(visits, crowded)
    assert split.exceptAll(few).isEmpty() and few.exceptAll(split).isEmpty()
