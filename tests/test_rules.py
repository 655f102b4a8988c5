"""Filters, ledger, bands and metrics on hand-made rows."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from keptvisit import fixed_values as fixed
from keptvisit.operators import filters, folds, metrics, profiles, reports, risk
from keptvisit.sources import ledger as ledgers
from keptvisit.sources import tables


def test_repeats_are_three_valued(spark):
    day, other = datetime(2020, 1, 1), datetime(2020, 2, 1)
    rows = spark.createDataFrame([
        (1, date(2020, 3, 1), date(2020, 3, 1), 2, 2, day, day),      # a repeat
        (2, date(2020, 3, 1), None, 2, None, day, None),              # all unknown: dropped
        (3, date(2020, 3, 1), date(2020, 3, 1), 2, 2, other, day),    # another time
        (4, date(2020, 3, 1), None, 2, 1, day, day),                  # known to differ
    ], "id int, rtc_date date, prev_rtc_date date, encounter_type int, prev_encounter_type int, "
       "encounter_datetime timestamp, prev_encounter_datetime timestamp")
    assert {r["id"] for r in filters.without_repeats(rows).collect()} == {3, 4}


def test_active_appointments(spark):
    base = dict(
        encounter_type=1, transfer_in_location_id=None, transfer_out_location_id=None,
        transfer_out_date=None, is_clinical_encounter=1, out_of_care=None, death_date=None,
        rtc_date=date(2020, 3, 4), next_clinical_datetime=None, encounter_datetime=datetime(2020, 1, 1),
        date_created=datetime(2020, 1, 2))
    changes = [
        {}, {"encounter_type": 111}, {"encounter_type": 116}, {"transfer_in_location_id": 7},
        {"transfer_in_location_id": 9999}, {"transfer_out_location_id": 9998},
        {"death_date": date(2020, 2, 1)}, {"rtc_date": date(2020, 3, 9)},
        {"next_clinical_datetime": datetime(2020, 3, 5)}, {"next_clinical_datetime": datetime(2020, 3, 1)},
        {"date_created": datetime(2020, 1, 1)}, {"out_of_care": 1},
    ]
    schema = ("encounter_type int, transfer_in_location_id int, transfer_out_location_id int, "
              "transfer_out_date date, is_clinical_encounter int, out_of_care int, death_date date, "
              "rtc_date date, next_clinical_datetime timestamp, encounter_datetime timestamp, "
              "date_created timestamp, id int")
    names = [part.strip().split()[0] for part in schema.split(",")]
    rows = spark.createDataFrame(
        [tuple({**base, **change, "id": i}[name] for name in names) for i, change in enumerate(changes)], schema)
    start, end = F.lit(date(2020, 3, 2)), F.lit(date(2020, 3, 8))
    ids = lambda retro: {r["id"] for r in filters.active_appointments(rows, start, end, retro).collect()}
    assert ids(False) == {0, 3}
    assert ids(True) == {0, 3, 8}


def test_csv_null_token_keeps_other_text(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, "NULLS"), (2, 1.5, None)], "a int, b double, c string")
    tables.write_extract(rows, str(tmp_path / "x"))
    text = "".join(p.read_text() for p in (tmp_path / "x").glob("*.csv"))
    assert "1,NULL,NULLS" in text
    back = tables.read_extract(spark, str(tmp_path / "x"), rows.schema)
    assert sorted(map(tuple, back.collect())) == [(1, None, "NULLS"), (2, 1.5, None)]


def test_stack_sites_can_drop_doubles(spark):
    a = spark.createDataFrame([(1, "x", "old")], "person_id int, v string, job string")
    b = spark.createDataFrame([(2, "y", "old")], "person_id int, v string, job string")
    more = spark.createDataFrame([(1, "miner")], "person_id int, job string")
    doubled = tables.stack_sites([a, a, b], more, "person_id", ["job"])
    assert sorted((r["person_id"], r["job"]) for r in doubled.collect()) == [
        (1, "miner"), (1, "miner"), (2, None)] or doubled.count() == 3
    once = tables.stack_sites([a, a, b], more, "person_id", ["job"], distinct=True)
    assert once.count() == 2


def test_backfill_takes_the_first_return_once(spark):
    ledger = spark.createDataFrame(
        [(1, 10, date(2020, 2, 1), None), (1, 11, date(2020, 5, 1), date(2020, 5, 2)), (2, 12, date(2020, 2, 1), None)],
        "person_id int, encounter_id int, rtc_date date, observed_rtc_date date")
    visits = spark.createDataFrame([
        (1, 1, 1, datetime(2020, 2, 5), date(2020, 3, 1), date(2020, 2, 1)),
        (1, 1, 1, datetime(2020, 2, 3), date(2020, 3, 1), date(2020, 2, 1)),
        (1, 186, 1, datetime(2020, 2, 1), date(2020, 3, 1), date(2020, 2, 1)),
        (1, 1, 1, datetime(2020, 5, 9), date(2020, 6, 1), date(2020, 5, 1)),
        (2, 1, 1, datetime(2020, 1, 20), date(2020, 2, 1), date(2020, 2, 1)),  # not moved
    ], "person_id int, encounter_type int, is_clinical_encounter int, encounter_datetime timestamp, "
       "rtc_date date, prev_rtc_date date")
    got = {r["encounter_id"]: r["observed_rtc_date"]
           for r in ledgers.backfill_observed_return(ledger, visits).collect()}
    assert got == {10: date(2020, 2, 3), 11: date(2020, 5, 2), 12: None}


def test_append_skips_test_runs(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2020-W01"), (2, "2020-W02")], "encounter_id int, week string")
    path = str(tmp_path / "ledger")
    ledgers.append_predictions(rows, path)
    ledgers.append_predictions(rows, path, test_run=True)
    assert ledgers.read_ledger(spark, path, rows.schema).count() == 2
    ledgers.append_predictions(rows.limit(1), path)
    assert ledgers.read_ledger(spark, path, rows.schema).count() == 3


def brute_bands(rows):
    def pr(values, v):
        return sum(x < v for x in values) / (len(values) - 1) if len(values) > 1 else 0.0

    out = {}
    for i, site, p1, _ in rows:
        whole = pr([r[2] for r in rows], p1)
        own = pr([r[2] for r in rows if r[1] == site], p1)
        band = "High Risk" if whole >= .9 else "Medium Risk" if whole >= .8 else None
        if own >= .9:
            band = "High Risk"
        elif own >= .8 and band != "High Risk":
            band = "Medium Risk"
        out[i] = band
    return out


def test_percentile_bands(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([1, 1, 2]), round(rng.random(), 2), rng.random()) for i in range(300)]
    rows += [(300, 8, 0.99, 0.5)]                       # a site with one row
    rows += [(301 + i, 9, 0.3, 0.5) for i in range(5)]  # a site with equal scores
    frame = spark.createDataFrame(rows, "id int, location_id int, prob_1day double, prob_7day double")
    frame = frame.withColumn("band", F.lit("adult"))
    got = {r["id"]: r["risk_1day"] for r in risk.percentile_bands(frame, ["band"]).collect()}
    assert got == brute_bands(rows)
    assert got[300] == "High Risk" and got[301] is None


def test_cutoffs_and_switch(spark):
    rows = spark.createDataFrame(
        [(1, 1, 0.9, 0.1, "adult"), (2, 1, 0.6, 0.1, "adult"), (3, 1, 0.2, 0.1, "adult"), (4, 5, 0.9, 0.9, "adult"),
         (5, 1, 0.9, 0.2, "minor"), (6, 1, 0.1, 0.1, "minor")],
        "id int, location_id int, prob_1day double, prob_7day double, band string")
    cutoffs = spark.createDataFrame(
        [("adult", 1, "1 day", "High Risk", 0.8), ("adult", 1, "1 day", "Medium Risk", 0.5)],
        "band string, location_id int, model_type string, risk string, probability_threshold double")
    got = {r["id"]: r["risk_1day"] for r in risk.cutoff_bands(rows, cutoffs, ["band"]).collect()}
    assert got == {1: "High Risk", 2: "Medium Risk", 3: None, 4: None, 5: None, 6: None}
    # Adults are a small batch with cut-offs; minors have none on record and use ranks.
    got = {r["id"]: r["risk_1day"] for r in risk.banded_by_batch_size(rows, cutoffs, ["band"]).collect()}
    assert got == {1: "High Risk", 2: "Medium Risk", 3: None, 4: None, 5: "High Risk", 6: None}
    ranked = {r["id"]: r["risk_1day"] for r in risk.banded_by_batch_size(rows, cutoffs, ["band"], small=1).collect()}
    assert ranked == {r["id"]: r["risk_1day"] for r in risk.percentile_bands(rows, ["band"]).collect()}


def test_cutoff_compat(spark):
    ledger = spark.createDataFrame(
        [(1, 1, date(2020, 1, 1), 0.9, 0.2, "High Risk", None), (2, 1, date(2020, 1, 1), 0.1, 0.7, None, "High Risk")],
        "person_id int, location_id int, rtc_date date, prob_1day double, prob_7day double, risk_1day string, risk_7day string")
    person = spark.createDataFrame([(1, date(1980, 1, 1)), (2, date(1980, 1, 1))], "person_id int, birthdate date")
    pick = lambda compat: {
        (r["model_type"], r["risk"]): r["probability_threshold"]
        for r in reports.risk_cutoffs(ledger, person, [], compat).collect()}
    assert pick(False) == {("1 day", "High Risk"): 0.9, ("7 day", "High Risk"): 0.7}
    assert pick(True) == {("1 day", "High Risk"): 0.9, ("7 day", "High Risk"): 0.2}


def test_auc_equals_pair_counting(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["m", "n"]), rng.randint(0, 20) / 20, rng.random() < 0.4) for i in range(400)]
    frame = spark.createDataFrame(rows, "id int, model string, p double, late boolean")
    got = {r["model"]: r for r in metrics.auc_interval(frame, ["model"], "p", F.col("late")).collect()}
    for model in ("m", "n"):
        pos = [p for _, m, p, y in rows if m == model and y]
        neg = [p for _, m, p, y in rows if m == model and not y]
        pairs = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
        assert got[model]["auc"] == pytest.approx(pairs)
        assert 0 <= got[model]["lower"] < pairs < got[model]["upper"] <= 1
    whole = metrics.auc(frame, [], "p", F.col("late")).first()["auc"]
    assert 0 < whole < 1


def test_metrics_of_one_class_are_null(spark):
    frame = spark.createDataFrame([(0.7, True), (0.2, True)], "p double, late boolean")
    row = metrics.binary_metrics(frame, [], "p", F.col("late")).first()
    assert row["auc"] is None and row["specificity"] is None and row["recall"] == 0.5


def test_folds_are_disjoint_and_even(spark):
    rows = spark.range(1000).selectExpr("id % 97 as person_id", "id as encounter_id")
    table = folds.assign_folds(rows, 11)
    per_person = table.groupBy("person_id").agg(F.count_distinct("fold_id").alias("n"))
    assert per_person.filter("n > 1").isEmpty() and table.count() == 1000
    sizes = [r["persons"] for r in folds.fold_sizes(table).collect()]
    assert len(sizes) == 11 and max(sizes) - min(sizes) <= 1


def test_class_weights(spark):
    labels = [fixed.ACTIVE, fixed.ACTIVE, fixed.DISENGAGED, None]
    rows = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "id int, y string")
    got = {r["id"]: r["w"] for r in profiles.class_weights(rows, {"y": "w"}).collect()}
    assert got == {0: 0.5, 1: 0.5, 2: 0.5, 3: None}


def test_observations_follow_their_encounter_site_span_and_names(spark):
    encounters = spark.createDataFrame(
        [(1, 10, 5, datetime(2020, 1, 1), 0), (2, 10, 6, datetime(2020, 2, 1), 0),
         (3, 11, 5, datetime(2020, 3, 1), 1)],
        "encounter_id int, visit_id int, location_id int, encounter_datetime timestamp, voided int")
    obs = spark.createDataFrame(
        [(7, 1, 5, 6744, 1, 0), (7, 2, 6, 6744, 2, 0), (7, 2, 6, 6744, 3, 0), (7, 3, 5, 6744, 1, 0),
         (7, 1, 5, 5089, 1, 0), (7, 1, 5, 6744, 2, 1), (7, 1, 5, 6744, None, 0), (7, None, 5, 6744, 1, 0)],
        "person_id int, encounter_id int, location_id int, concept_id int, value_coded int, voided int")
    names = spark.createDataFrame(
        [(1, "one", "en", 1, 0), (1, "uno", "es", 1, 0), (2, "two", "en", 0, 0), (2, "void", "en", 1, 1)],
        "concept_id int, name string, locale string, locale_preferred int, voided int")

    def values(preferred, **options):
        rows = reports.named_observations(encounters, obs, preferred, [6744], **options)
        return sorted((r["encounter_id"], r["value_name"] or "") for r in rows.collect())

    assert values(reports.preferred_names(names)) == [(1, "uno"), (2, "void")]
    assert values(reports.preferred_names(names, "en", preferred=True, live=True)) == [(1, "one")]
    english = reports.preferred_names(names, "en", live=True)
    assert values(english, named_only=False) == [(1, ""), (1, "one"), (2, ""), (2, "two")]
    assert values(english, encounter_site=6) == values(english, obs_site=6) == [(2, "two")]
    assert values(english, span=(date(2020, 1, 1), date(2020, 1, 31))) == [(1, "one")]
    wide = reports.pivot_values(
        reports.named_observations(encounters, obs, english, [6744]), ["visit_id"], {"line": [6744]})
    assert [tuple(r) for r in wide.collect()] == [(10, "two")]
