"""Hard negatives beside brute force in Python integers."""

import math

import numpy as np
import pytest
from odd import odd_vectors  # noqa: F401
from pyspark.sql import functions as F

from keptvisit.llm import negatives


def brute(rows, every=100):
    """rows: (id, label, vector), one per id."""
    rows = [(i, (y + 1) % 10 if i % 7 == 0 else y, [math.floor(256 * x) for x in v]) for i, y, v in rows]
    out = []
    for anchor, label, v in rows:
        if anchor % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i, y) for i, y, w in rows
                        if i != anchor and len(w) == len(v))
        for p, positive, _ in [r for r in scored if r[2] == label][:5]:
            far = [r for r in scored if r[2] != label and 80 * -p <= 100 * -r[0] <= 100 * -p][:5]
            out += [(anchor, positive, n, i, -p, -s) for n, (s, i, _) in enumerate(far, start=1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_equals_brute_force(spark, block):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(6, 5))
    rows = [(i, int(rng.integers(4)), [float(x) for x in np.float32(middle[i % 6] + 0.3 * rng.normal(size=5))])
            for i in range(900)]
    # Ties and copies of an anchor, with the same label and with others.
    rows += [(1000 + i, i % 3, rows[200][2]) for i in range(40)]
    found = sorted(map(tuple, negatives.mine(frame(spark, rows), block=block).collect()))
    assert found == brute(rows) and len(found) > 100


def test_only_blocks_that_matter_are_read(spark):
    rng = np.random.default_rng(6)
    # Clusters far apart; each has its own labels.
    rows = [(i, int(rng.integers(2)), [float(x) for x in np.float32(
        10 * np.eye(8)[i % 8] + 0.05 * rng.normal(size=8))]) for i in range(1600)]
    usable = negatives.usable(frame(spark, rows), (F.col("label") + 1) % 10, "vec_id", "embedding", "label")
    blocks = negatives.in_blocks(usable, 20)
    anchors = negatives.anchors_of(blocks, 100, 5)
    low, high = (np.stack([np.frombuffer(r[c], "<i4") for r in blocks.orderBy("run").collect()]).astype(float)
                 for c in ("low", "high"))
    asked = anchors.collect()
    points = np.stack([np.frombuffer(r["vector"], "<i4") for r in asked]).astype(float)
    least, most = negatives.bounds(points, low, high)
    need = negatives.wanted(least, most, np.array([r["floor"] for r in asked]), [None] * len(asked))
    assert need.mean() < 0.4
    # The bounds hold for every row of every block.
    for at, block in enumerate(blocks.orderBy("run").collect()):
        inside = points @ np.frombuffer(block["vector"], "<i4").reshape(-1, 8).T.astype(float)
        assert (inside >= least[:, [at]]).all() and (inside <= most[:, [at]]).all()
    assert sorted(map(tuple, negatives.mine(frame(spark, rows), block=20).collect())) == brute(rows)


def test_curve_visits_every_cell_and_moves_one_step():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    keys = [k.tobytes() for k in negatives.hilbert(cells, 3)]
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_odd_rows(spark, odd_vectors):
    odd = odd_vectors.withColumn("label", F.when(F.col("vec_id") != 4, 1).otherwise(2)).withColumn(
        "run", F.lit("clash")).withColumn("batch", F.lit(None))
    rows = odd.unionByName(odd.filter("vec_id = 3").withColumn("label", F.lit(None).cast("int")))
    found = negatives.mine(rows, every=10).collect()
    usable = {}
    for r in rows.collect():
        v = r["embedding"]
        if None in (r["vec_id"], r["label"], v) or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable[r["vec_id"]] = r["label"], list(v)
    assert sorted(map(tuple, found)) == brute([(i, y, v) for i, (y, v) in usable.items()], every=10)
    assert negatives.mine(rows.limit(0)).collect() == []
    # Large components are scored exactly, those beyond a long are left out.
    big = [(0, 1, [2.0**20, 1.0]), (1, 1, [2.0**20, 0.0]), (2, 2, [2.0**20 - 64.0, 3.0]), (3, 2, [2.0**40, 0.0])]
    assert sorted(map(tuple, negatives.mine(frame(spark, big)).collect())) == brute(big[:3])
