"""Distributed ranks against brute force."""

import random

import numpy as np
import pytest

from keptvisit.operators import ranks


@pytest.fixture(scope="module")
def tied(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        group = rng.choice(["a", "a", "a", "b", "c"])
        # One value holds a third of the rows.
        value = 0.5 if rng.random() < 0.34 else rng.choice([None] + [x / 20 for x in range(40)])
        rows.append((i, group, value))
    rows.append((3000, "single", 0.1))
    return rows, spark.createDataFrame(rows, "id long, site string, score double")


def brute(rows, by_site):
    want = {}
    for i, group, value in rows:
        others = [v for _, g, v in rows if v is not None and (not by_site or g == group)]
        if value is None:
            want[i] = None
        elif len(others) == 1:
            want[i] = 0.0
        else:
            want[i] = sum(v < value for v in others) / (len(others) - 1)
    return want


@pytest.mark.parametrize("hot_rows", [50, 10**6])
@pytest.mark.parametrize("by_site", [True, False])
def test_percent_rank(tied, by_site, hot_rows):
    rows, frame = tied
    groups = ["site"] if by_site else []
    ranked = ranks.with_percent_rank(frame, groups, "score", "pr", hot_rows)
    got = {r["id"]: r["pr"] for r in ranked.collect()}
    want = brute(rows, by_site)
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == pytest.approx(value) if value is not None else got[key] is None


def test_more_crowded_values_than_may_be_broadcast(tied):
    rows, frame = tied
    lookup = ranks.percent_ranks(frame, ["site"], "score", "pr")
    ranked = ranks.attach(frame, lookup, ["site", "score"], "n", hot_rows=10, many=2)
    want = brute(rows, True)
    got = {r["id"]: r["pr"] for r in ranked.collect()}
    assert got == {i: None if v is None else pytest.approx(v) for i, v in want.items()}


def test_quantiles_are_linear(tied):
    rows, frame = tied
    shares = {"low": 0.01, "mid": 0.5, "high": 0.87, "top": 1.0}
    got = {r["site"]: r for r in ranks.quantiles(frame, ["site"], "score", shares).collect()}
    for site in ("a", "b", "c", "single"):
        values = [v for _, g, v in rows if g == site and v is not None]
        for name, share in shares.items():
            assert got[site][name] == pytest.approx(np.quantile(values, share))


def test_row_numbers_are_dense(spark):
    keys = spark.createDataFrame([(f"k{i:04d}",) for i in random.Random(1).sample(range(9999), 500)], "k string")
    got = [(r["k"], r["n"]) for r in ranks.row_numbers(keys, "k", "n").collect()]
    assert [n for _, n in sorted(got)] == list(range(1, 501))


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_a_null_group_is_a_group(spark, hot_rows):
    rows = [(None, 1.0), (None, 2.0), (None, 2.0), ("a", 5.0), ("a", 5.0), ("a", 6.0),
            (None, None), ("b", 1.0), ("a", None), (None, 4.0)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, site string, score double")
    got = {r["id"]: r["pr"] for r in ranks.with_percent_rank(frame, ["site"], "score", "pr", hot_rows).collect()}
    want = [0, 1 / 3, 1 / 3, 0, 0, 1, None, 0, None, 1]
    assert [got[i] for i in range(10)] == [None if w is None else pytest.approx(w) for w in want]
