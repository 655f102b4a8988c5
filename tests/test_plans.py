"""Physical plans: what is pushed down, shuffled and kept off a single task."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from keptvisit import session
from keptvisit.queries import load
from keptvisit.sources.fixtures import Clinic


def plan_of(spark, name):
    frame = entry.queries()[name](spark, SMALL)
    return frame._jdf.queryExecution().executedPlan().toString()


def person_exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(person_id#\d+L, \d+\)", plan)


@pytest.mark.parametrize("name", [
    "visit_number", "days_defaulted_history", "strict_three_visit_defaults", "first_row_per_day",
    "estimated_order_date", "locf_impute", "baseline_broadcast", "pickup_aware_rolling",
    "last_clinical_default", "ever_defaulted_within", "rolling_defaults",
])
def test_one_shuffle_by_person(spark, name):
    assert len(person_exchanges(plan_of(spark, name))) == 1


@pytest.mark.parametrize("name", [
    name for name in entry.oracle_sql() if name not in (
        "append_predictions", "csv_null_token", "deid_sample_export", "rebuild_table",
        "snapshot_roundtrip")
])
def test_no_cross_join_and_no_window_over_everything(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # A window without partition columns would follow a single-partition exchange.
    assert not re.search(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(spark, "vl_suppressed")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} <= {
        "o_orderkey", "o_custkey", "o_totalprice", "c_custkey"}


def test_longitudinal_scan_reads_only_needed_columns(spark):
    plan = plan_of(spark, "first_row_per_day")
    schema = re.search(r"ReadSchema: struct<([^>]*o_orderkey[^>]*)>", plan).group(1)
    assert "o_totalprice" not in schema and "o_orderstatus" not in schema


def test_filter_reaches_the_scan(spark):
    plan = plan_of(spark, "care_start_filter")
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_explicit_filters_on_dates_are_bound(spark):
    plan = plan_of(spark, "bind_parameters")
    assert ":start" not in plan


def test_site_answers_are_joined_once(spark, monkeypatch):
    """The extracts are filters of one table; tasks grow in number, not in rows."""
    clinic = Clinic(spark, SMALL)
    plain = load().QUERIES["multi_site_union"](clinic)
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    dealt = load().QUERIES["multi_site_union"](clinic)
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
    rows = clinic.encounter
    assert session.by_key(rows, 1000, "person_id").rdd.getNumPartitions() == 10
    assert session.by_key(rows, 800, "person_id") is rows
