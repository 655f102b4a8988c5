"""The ledger in its folder through append, refresh, append, refresh."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from keptvisit.operators import timeline
from keptvisit.sources import ledger
from keptvisit.sources.fixtures import Clinic


def parquet_files(folder):
    """Files with their time of change, so that a file written again is a different one."""
    return {(str(p), p.stat().st_mtime_ns) for p in folder.rglob("*.parquet")}


@pytest.mark.parametrize("threshold", ["-1", "100m"])
def test_no_row_is_lost_and_only_open_weeks_are_written(spark, tmp_path, threshold):
    clinic = Clinic(spark, SMALL)
    path = str(tmp_path / "ledger")
    rows = clinic.ledger
    full = rows.withColumn("observed_rtc_date", F.coalesce("observed_rtc_date", "rtc_date"))
    weeks = sorted(r["week"] for r in rows.select("week").distinct().collect())
    closed, open_ = weeks[0], weeks[1]
    old = full.filter(F.col("week") == closed).unionByName(rows.filter(F.col("week") == open_))
    new = rows.filter(~F.col("week").isin(closed, open_))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        fill = ledger.backfill_observed_return
        refresh = lambda: ledger.refresh_ledger(spark, path, rows.schema, fill, clinic.visit)
        ledger.append_predictions(old, path)
        before = parquet_files(tmp_path / "ledger" / f"week={closed}")
        assert before
        assert refresh().count() == old.count()
        ledger.append_predictions(new, path)
        done = refresh()
        assert parquet_files(tmp_path / "ledger" / f"week={closed}") == before
        after = parquet_files(tmp_path / "ledger")
        assert refresh().count() == rows.count()
        assert parquet_files(tmp_path / "ledger") == after
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = fill(old.unionByName(new), clinic.visit)
    assert done.count() == rows.count()
    assert done.select(*want.columns).exceptAll(want).isEmpty()


def test_a_failed_fill_leaves_the_ledger(spark, tmp_path):
    clinic = Clinic(spark, SMALL)
    path = str(tmp_path / "ledger")
    ledger.append_predictions(clinic.ledger, path)
    bad = lambda r, v: r.withColumn("observed_rtc_date", F.raise_error(F.lit("no")).cast("date"))
    with pytest.raises(Exception):
        ledger.refresh_ledger(spark, path, clinic.ledger.schema, bad, clinic.visit)
    assert ledger.read_ledger(spark, path, clinic.ledger.schema).count() == clinic.ledger.count()


def test_a_derived_table_may_be_rebuilt_from_itself(spark, tmp_path):
    path = str(tmp_path / "derived")
    spark.range(10).write.parquet(path)
    again = ledger.rebuild_table(spark.read.parquet(path).filter("id > 3"), path)
    assert again.count() == 6


@pytest.fixture(scope="module")
def parts(spark):
    """The fixture's visits, of which a part becomes known later, and ledger rows with gaps."""
    clinic = Clinic(spark, SMALL)
    rows = clinic.ledger.withColumn("observed_rtc_date", F.lit(None).cast("date")).withColumn(
        "rtc_date", F.when(F.col("encounter_id") % 7 != 0, F.col("rtc_date"))).cache()
    middle = clinic.encounter.selectExpr("percentile_approx(date_created, 0.6) as m").first()["m"]
    return clinic, rows, middle


def both(rows, known):
    return ledger.backfill_observed_return(ledger.backfill_rtc_date(rows, known), known)


def known_until(clinic, moment):
    """Visits entered before the moment, beside the neighbours that were known then."""
    early = clinic.encounter.filter(F.col("date_created") < F.lit(moment))
    return timeline.with_neighbours(early, clinic.hot_persons)


def test_a_refresh_follows_new_visits(spark, tmp_path, parts):
    clinic, rows, middle = parts
    path = str(tmp_path / "ledger")
    ledger.append_predictions(rows, path)
    first = ledger.refresh_ledger(spark, path, rows.schema, both, known_until(clinic, middle))
    n_open = first.filter("observed_rtc_date is null").count()
    before = parquet_files(tmp_path / "ledger")
    ledger.refresh_ledger(spark, path, rows.schema, both, known_until(clinic, middle))
    assert parquet_files(tmp_path / "ledger") == before
    done = ledger.refresh_ledger(spark, path, rows.schema, both, clinic.visit)
    assert done.filter("observed_rtc_date is null").count() < n_open
    # An early return keeps its date; all else is as if every visit had been known at once.
    want = both(both(rows, known_until(clinic, middle)), clinic.visit)
    assert done.count() == rows.count()
    assert done.select(*want.columns).exceptAll(want).isEmpty()
    assert not (tmp_path / "ledger" / "_filled").exists()


def test_rows_appended_after_their_return_are_filled(spark, tmp_path, parts):
    """The second append is answered by visits that the first refresh has already seen."""
    clinic, rows, _ = parts
    path = str(tmp_path / "ledger")
    one, two = rows.filter("person_id % 2 = 0"), rows.filter("person_id % 2 = 1")
    for part in (one, two):
        ledger.append_predictions(part, path)
        done = ledger.refresh_ledger(spark, path, rows.schema, both, clinic.visit)
    want = both(rows, clinic.visit)
    assert done.count() == rows.count() and done.select(*want.columns).exceptAll(want).isEmpty()


def test_a_replacement_that_stopped_is_finished(spark, tmp_path, parts, monkeypatch):
    clinic, rows, _ = parts
    path = str(tmp_path / "ledger")
    ledger.append_predictions(rows, path)
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "_finish_replacement", stop_if(lambda *_: (tmp_path / "ledger/_filled").exists()))
        with pytest.raises(InterruptedError):
            ledger.refresh_ledger(spark, path, rows.schema, both, clinic.visit)
    # The stop came in the middle: one of the old weeks has already gone.
    gone = sorted((tmp_path / "ledger").glob("week=*"))[0]
    gone.rename(tmp_path / "gone")
    done = ledger.refresh_ledger(spark, path, rows.schema, both, clinic.visit)
    want = both(rows, clinic.visit)
    lost = F.col("week") == gone.name.removeprefix("week=")
    changed = not want.filter(lost & F.col("observed_rtc_date").isNotNull()).isEmpty()
    assert changed and done.count() == rows.count()
    assert done.select(*want.columns).exceptAll(want).isEmpty()


def stop_if(test):
    def stop(*_):
        if test():
            raise InterruptedError
    return stop


def test_a_run_that_stopped_half_way_counts_once(spark, tmp_path, parts, monkeypatch):
    _, rows, _ = parts
    path = str(tmp_path / "ledger")
    old, new = rows.filter("model_version = 'V10'"), rows.filter("model_version = 'V11'")
    ledger.append_predictions(old, path, run="old")
    before = parquet_files(tmp_path / "ledger")
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "_move_mark", stop_if(lambda: True))
        with pytest.raises(InterruptedError):
            ledger.append_predictions(new, path, run="new")
    half = parquet_files(tmp_path / "ledger") - before
    assert half and ledger.read_ledger(spark, path, rows.schema).count() == old.count()
    # The second attempt has other weeks than the first: what that left must go.
    weeks = sorted(r["week"] for r in new.select("week").distinct().collect())
    again = new.filter(F.col("week") != weeks[0])
    ledger.append_predictions(again, path, run="new")
    ledger.append_predictions(again, path, run="new")
    now = parquet_files(tmp_path / "ledger")
    assert before <= now and not half & now
    done = ledger.read_ledger(spark, path, rows.schema)
    want = old.unionByName(again).select(*done.columns)
    assert done.count() == want.count() and done.exceptAll(want).isEmpty()


def test_a_name_that_is_no_folder_is_refused(spark, tmp_path, parts):
    with pytest.raises(ValueError):
        ledger.append_predictions(parts[1], str(tmp_path / "ledger"), run="a/b")
