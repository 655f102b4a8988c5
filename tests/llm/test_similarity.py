"""Near duplicates of texts and vectors, and nearest neighbours, beside brute force."""

import numpy as np
import pytest
from conftest import SMALL
from odd import odd_documents, odd_vectors  # noqa: F401
from pyspark.sql import functions as F

from keptvisit.llm import ann, groups, jaccard, neardup


def plain_sets(texts):
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        n = max(len(words) - 4, min(len(words), 1))
        out.append({tuple(words[i:i + 5]) for i in range(n)})
    return out


def plain_groups(ids, linked):
    n = len(ids)
    i, j = np.nonzero(np.triu(linked, 1))
    root = groups.forest(n, i, j)
    ids = np.asarray(ids)
    least = {r: ids[root == r].min() for r in set(root.tolist())}
    return [least[r] for r in root.tolist()]


@pytest.mark.parametrize("chunk", [jaccard.CHUNK, 3])
def test_jaccard_join(spark, monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    base = [f"w{i}" for i in range(200)]
    rng = np.random.default_rng(3)
    planted = []
    for k in range(30):
        words = list(base)
        for at in rng.integers(0, 200, rng.integers(0, 9)):
            words[at] = f"z{rng.integers(50)}"
        planted.append((10_000 + k, " ".join(words)))
    docs = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame(planted, "doc_id long, text string"))
    rows = sorted(docs.collect())
    sets = plain_sets([r["text"] for r in rows])
    linked = np.array([[bool(a and b) and len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets])
    got = {r["doc_id"]: r for r in jaccard.join(docs).collect()}
    ids = [r["doc_id"] for r in rows]
    for at, group in enumerate(plain_groups(ids, linked)):
        row = got[ids[at]]
        assert row["n_links"] == linked[at].sum() - linked[at][at]
        assert row["group_id"] == group and row["kept"] == (group == ids[at])


@pytest.mark.parametrize("hot", [1, 10**6])
def test_crowded_classes_keep_all_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(groups, "HOT_COPIES", hot)
    same = [(i, "one two three four five six") for i in range(5)]
    rows = [*same, (4, same[0][1]), (9, "quite another text with enough words"), (10, None), (None, same[0][1])]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([(r["doc_id"] is None, *r) for r in got], key=str) == sorted(
        [(False, i, 0, 4, i == 0) for i in (0, 1, 2, 3, 4, 4)]
        + [(False, 9, 9, 0, True), (False, 10, 10, 0, True), (True, None, None, 0, True)], key=str)


def test_jaccard_odd_rows(odd_documents):
    rows = jaccard.join(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_links"] == 2 and by[2]["group_id"] == by[3]["group_id"] == 1
    assert sum(r["doc_id"] == 3 for r in rows) == 2
    assert by[None]["group_id"] is None and by[None]["n_links"] == 0 and by[None]["kept"]
    assert by[5]["n_links"] == by[6]["n_links"] == by[7]["n_links"] == 0
    assert by[9]["group_id"] == 8 and by[11]["group_id"] == 10
    assert jaccard.join(odd_documents.limit(0)).collect() == []


def test_posterior_rule():
    for n in jaccard.STEPS:
        least = jaccard.least_matches(n, 0.8, 1e-6)
        assert 0 < least < n
    rng = np.random.default_rng(0)
    kept = rng.binomial(128, 0.8, 20_000) >= jaccard.least_matches(128, 0.8, 1e-6)
    assert kept.all()


@pytest.mark.parametrize("chunk", [neardup.CHUNK, 4])
def test_near_vectors(spark, monkeypatch, chunk):
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(20, 24))
    vectors = np.concatenate([
        rng.normal(size=(60, 24)), np.repeat(centre, 6, axis=0) + 0.16 * rng.normal(size=(120, 24))])
    frame = spark.createDataFrame(
        [(int(i), [float(x) for x in np.float32(v)]) for i, v in enumerate(vectors)],
        "vec_id long, embedding array<float>")
    unit = neardup.unit(np.float32(vectors).astype(float))
    linked = unit @ unit.T >= 0.95
    assert linked.sum() > 300
    rows = sorted(neardup.find(frame).collect())
    assert [r["n_links"] for r in rows] == (linked.sum(axis=1) - 1).tolist()
    assert [r["component_id"] for r in rows] == plain_groups(range(180), linked)


def test_near_vectors_odd_rows(odd_vectors):
    rows = neardup.find(odd_vectors).collect()
    assert len(rows) == odd_vectors.count()
    by = {r["vec_id"]: r for r in rows}
    assert by[1]["n_links"] == by[2]["n_links"] == 3 and by[20]["n_links"] == 3
    assert by[3]["component_id"] == 1 and not by[20]["kept"]
    for alone in (4, 6, 7, 8, 9, 10, 11, 12, 40):
        assert by[alone]["n_links"] == 0 and by[alone]["component_id"] == alone
    assert by[None]["component_id"] is None and by[None]["n_links"] == 0
    assert neardup.find(odd_vectors.limit(0)).collect() == []


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(7, 24))
    turned = neardup.rotated(x, 3)
    assert turned.shape == (7, 32)
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(x, axis=1), rtol=1e-4)


def test_neighbours_recall_and_scores(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = ann.search(frame, F.col("id") % 20 == 0).collect()
    table = sorted(frame.select("vec_id", "embedding").collect())
    ids = np.array([r[0] for r in table])
    vectors = np.array([r[1] for r in table], dtype=np.float64)
    place = {v: at for at, v in enumerate(ids)}
    found = {}
    for r in rows:
        assert r["score"] == pytest.approx(vectors[place[r["query_id"]]] @ vectors[place[r["vec_id"]]], abs=1e-12)
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    hits = 0
    for query in ids[ids % 20 == 0]:
        score = vectors @ vectors[place[query]]
        score[place[query]] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        assert sorted(found[query]) == list(range(1, 21))
        hits += len(set(best.tolist()) & set(found[query].values()))
    assert hits >= 0.9 * 20 * len(found)


def test_neighbours_odd_rows(odd_vectors):
    rows = sorted(ann.search(odd_vectors, F.col("id") % 20 == 0).collect())
    by = {}
    for r in rows:
        by.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 6)))
    # All candidates when there are fewer than k; ties to the smaller id.
    assert by == {20: [(1, 3.0), (2, 3.0), (3, 2.97), (4, 0.0), (40, -3.0)],
                  40: [(4, 0.0), (3, -0.99), (1, -1.0), (2, -1.0), (20, -3.0)]}
    assert ann.search(odd_vectors.limit(0), F.col("id") % 20 == 0).collect() == []


def test_neighbours_of_every_length_and_of_copies(spark):
    rng = np.random.default_rng(8)
    rows = [(n, rng.normal(size=6).tolist()) for n in range(1500)]
    rows += [(10_000 + n, rng.normal(size=3).tolist()) for n in range(130)]
    rows += [(20_000 + n, [3.0] * 6) for n in range(700)]
    found = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0).collect():
        found.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    hits = 0
    for query, vector in rows:
        if query % 20:
            continue
        best = sorted((-float(np.dot(vector, w)), i) for i, w in rows if len(w) == len(vector) and i != query)[:20]
        own = [i for _, i in sorted(found[query])]
        hits += len({i for _, i in best} & set(own))
        if len(vector) == 3:
            # Few vectors of a length are searched whole.
            assert own == [i for _, i in best]
    assert hits >= 0.95 * 20 * len(found) and len(found) == sum(i % 20 == 0 for i, _ in rows)


def test_copies_beyond_the_first_take_no_part():
    vectors = np.array([[1.0, 2.0], [1.0, 2.0], [0.0, 1.0], [1.0, 2.0]])
    kept, ids = ann.first_copies(vectors, np.array([9, 4, 5, 7]), 2)
    assert sorted(zip(ids.tolist(), kept.tolist())) == [(4, [1.0, 2.0]), (5, [0.0, 1.0]), (7, [1.0, 2.0])]


def test_parts_grow_with_the_vectors():
    assert [ann.part_count(n, 6000) for n in (1000, 60_000, 100_000, 10**6, 10**9)] == [16, 16, 32, 128, 128]


def test_parts_are_balanced():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(640, 8))
    near = ann.nearest_in(x, x, 10)
    assert set(np.bincount(ann.balanced_parts(near, 8, rng)).tolist()) == {80}
