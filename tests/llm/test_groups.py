"""Groups in blocks and connected components beside plain versions."""

import random

import numpy as np
from pyspark.sql import functions as F

from keptvisit.llm import groups


def plain_components(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {frozenset(x for x in root if find(x) == r) for r in {find(x) for x in root}}


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    pairs += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2060)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    found = {}
    for row in groups.components(edges, "a", "b").collect():
        found.setdefault(row["component"], set()).add(row["id"])
    linked = [(a, b) for a, b in pairs if a != b]
    assert {frozenset(v) for v in found.values()} == plain_components(linked)
    assert groups.components(edges.limit(0), "a", "b").collect() == []


def test_every_pair_meets_once_in_any_chunking(spark):
    rows = spark.range(40).select(F.col("id").alias("item"), (F.col("id") % 3).alias("team"))

    def work(columns):
        left, right = groups.crossing(columns)
        ids = columns["item"]
        pairs = [(ids[i], ids[j]) for a, i in enumerate(left) for j in left[a + 1:]] if right is None \
            else [(ids[i], ids[j]) for i in left for j in right]
        if not pairs:
            return None
        return {"a": np.array([min(p) for p in pairs]), "b": np.array([max(p) for p in pairs])}

    wanted = sorted((a, b) for a in range(40) for b in range(a + 1, 40) if a % 3 == b % 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        for pieces in (1, 2, 5):
            met = groups.paired_chunks(rows, "item", F.lit(pieces))
            got = groups.run_groups(
                met, ["team", "low", "high"], "a long, b long",
                lambda t: groups.numbers(t, "item", "home", "low", "high"), work)
            assert sorted(map(tuple, got.collect())) == wanted
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
