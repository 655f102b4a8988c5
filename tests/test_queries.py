"""Every registered query beside its oracle, and the driver contract."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from conftest import SMALL
from keptvisit.queries import load

BOOK = load()
ORACLES = BOOK.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows_as_oracle(spark, con, name):
    frame = BOOK.runners()[name](spark, SMALL)
    assert compare(con, frame, ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(BOOK.runners()) == 123
    assert set(BOOK.runners()) <= set(entry.queries())


def test_entry_has_rows_and_a_stable_schema(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert {"person_id", "prob_1day", "risk_1day", "week"} <= set(frame.columns)
