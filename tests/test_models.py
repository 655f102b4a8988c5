"""Properties of training, scoring and the weekly run."""

import math
from datetime import date

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import MEDIUM
from keptvisit import fixed_values as fixed
from keptvisit.models import assemble, explain, features, many, registry, score, train
from keptvisit.operators import metrics
from keptvisit.plans import maintenance, weekly
from keptvisit.queries import modelling
from keptvisit.sources import ledger
from keptvisit.sources.fixtures import Clinic


@pytest.fixture(scope="module")
def clinic(spark):
    return Clinic(spark, MEDIUM)


@pytest.fixture(scope="module")
def matrix(clinic):
    return modelling.matrix(clinic)


LINEAR, BOOSTED, TREES = [(0.001, 0.0), (0.01, 0.5)], [(3, 0.3)], 5


@pytest.fixture(scope="module")
def cell(matrix):
    """One cell with few settings and trees, to test properties with."""
    made = train.train_cells(matrix, [("adult", "7day", "7days")], fixed.FOLDS, LINEAR, BOOSTED, TREES)[0]
    yield made
    made.split.release()


def test_matrix_is_complete(matrix):
    rows = matrix.select(*fixed.PREDICTORS)
    assert rows.dropna().count() == rows.count() > 10_000
    keys = matrix.groupBy("person_id", "visit_date").count()
    assert keys.filter("count > 1").isEmpty()
    folds = matrix.groupBy("person_id").agg(F.count_distinct("fold_id").alias("n"))
    assert folds.filter("n > 1").isEmpty()
    flags = matrix.agg(F.max("age_NA"), F.max("bmi_NA"), F.min("bmi_NA")).first()
    assert tuple(flags) == (1, 1, 0)


def test_holdout_is_never_trained_on(cell):
    split = cell.split
    assert split.train.join(split.test, "person_id", "left_semi").isEmpty()
    assert [r[0] for r in split.train.select("cv_fold").distinct().orderBy("cv_fold").collect()] == list(range(fixed.FOLDS - 1))


def test_many_linear_models_equal_separate_fits(cell):
    packed = many.pack([cell.split.train], fixed.FOLDS - 1)
    fit = many.fit_linear(packed, LINEAR, 200, 1e-9)[0]
    rows = cell.split.train.withColumn("p", F.lit(None))
    for setting, fold in ((0, many.ALL), (1, many.ALL), (1, 3)):
        own = rows if fold == many.ALL else rows.filter(F.col("cv_fold") != fold)
        penalty, share = LINEAR[setting]
        plain = LogisticRegression(weightCol="weight", maxIter=500, tol=1e-12, regParam=penalty,
                                   elasticNetParam=share).fit(own)
        weights = fit.weights[fit.models.index((setting, fold))]
        ours = assemble.linear_model(own.sparkSession, weights)
        both = train.probability(plain.transform(cell.split.test), "a").join(
            train.probability(ours.transform(cell.split.test), "b").select(*train.KEYS, "b"), train.KEYS)
        assert both.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-5
        assert np.abs(plain.coefficients.toArray() - weights[:-1]).max() < 1e-3
    packed.blocks.unpersist()


def test_boosted_models_beside_plain_trees(spark):
    """Many trees from one histogram pass equal a plain greedy tree for each model."""
    rng = np.random.default_rng(2)
    n, width, folds = 600, 4, 3
    x = np.round(rng.normal(size=(n, width)), 1)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) > 0).astype(float)
    w, fold = rng.uniform(0.5, 2, n), rng.integers(0, folds, n)
    train_rows = spark.createDataFrame(
        [(i, i, float(y[i]), float(w[i]), int(fold[i]), Vectors.dense(x[i])) for i in range(n)],
        ["person_id", "encounter_id", "label", "weight", "cv_fold", "features"])
    packed = many.pack([train_rows], folds)
    forest = many.fit_boosted(packed, [(2, 0.3)], most_trees=8, write_every=3)[0]
    edges = packed.edges[0]
    bins = np.stack([np.searchsorted(e, x[:, k]) for k, e in enumerate(edges)], axis=1)
    for m, (_, out) in enumerate(forest.models):
        mine = fold != out
        margin = np.zeros(n)
        for tree in range(8):
            p = many.sigmoid(margin)
            g, h = w * (p - y), w * p * (1 - p)

            def grow(rows, depth):
                total_g, total_h = g[rows & mine].sum(), h[rows & mine].sum()
                best = (1e-9, None)
                for k in range(width if depth else 0):
                    for b in range(len(edges[k])):
                        left = rows & mine & (bins[:, k] <= b)
                        lg, lh = g[left].sum(), h[left].sum()
                        if min(lh, total_h - lh) < 1:
                            continue
                        gain = lg**2 / (lh + 1) + (total_g - lg)**2 / (total_h - lh + 1) - total_g**2 / (total_h + 1)
                        if gain > best[0] + 1e-9:
                            best = gain, (k, b)
                if best[1] is None:
                    margin[rows] += -0.3 * total_g / (total_h + 1)
                    return
                k, b = best[1]
                right = bins[:, k] > b
                grow(rows & ~right, depth - 1)
                grow(rows & right, depth - 1)

            grow(np.ones(n, bool), 2)
        assert np.abs(forest.margins(bins, 0, 8, 2)[:, m] - margin).max() < 1e-4
    packed.blocks.unpersist()


def test_bundled_histograms_are_the_plain_sums():
    """Predictors counted in bundles give the sums of every predictor, bin, node and model."""
    rng = np.random.default_rng(5)
    n, models, level = 700, 3, 2
    kind = rng.integers(0, 9, n)
    bins = np.hstack([rng.integers(0, 32, (n, 3)), kind[:, None] == np.arange(9), rng.integers(0, 2, (n, 4))]).astype(np.uint8)
    width = bins.shape[1]
    sizes = bins.max(axis=0).astype(int) + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    codes, members = many._bundles(bins)
    assert len(codes) <= width // 3
    assert all((members[k, 1 + codes[members[k, 0]].astype(int)] == bins[:, k]).all() for k in range(width))
    # One tree with both branches open, one whose left branch has ended, one that is a leaf.
    feature = np.full((models, 7), -1)
    feature[0, :3], feature[1, [0, 2]] = (0, 1, 2), (3, 1)
    split = np.full((models, 7), 12)
    split[:, 0] = (9, 0, 0)
    slope, curve = rng.normal(size=(models, n)), rng.uniform(size=(models, n))
    rows = many.Rows(0, None, np.ascontiguousarray(bins.T), codes, members, np.zeros(n), np.ones(n), np.zeros(n), None, None)
    got = many._histograms(rows, {"feature": feature, "split": split}, level, slope, curve, offsets).reshape(models, 2, 4, -1)
    for m in range(models):
        plain = np.zeros((2, 4, offsets[-1]))
        for row in range(n):
            at = 0
            for _ in range(level):
                if at >= 0:
                    f = feature[m, at]
                    at = -1 if f < 0 else 2 * at + 1 + int(bins[row, f] > split[m, at])
            if at >= 0:
                for k, values in enumerate((slope, curve)):
                    plain[k, at - 3, offsets[:-1] + bins[row]] += values[m, row]
        assert np.abs(got[m] - plain).max() < 1e-9


def test_blocks_are_filled_across_batches(monkeypatch):
    monkeypatch.setattr(many, "BLOCK", 100)
    names = ["person_id", "encounter_id", "label", "weight", "cv_fold", "x"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.list_(pa.float64())]
    columns = lambda ids: [ids, ids, [1.0] * len(ids), [1.0] * len(ids), [0] * len(ids), [[float(i)] for i in ids]]
    ends = [0, 30, 30, 100, 240, 400, 430]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns(list(range(a, b))), kinds)], names)
               for a, b in zip(ends, ends[1:])]
    blocks = [block.to_pylist()[0] for block in many._packer(0, 1, [np.array([200.0])])(iter(batches))]
    assert [len(block["label"]) // 8 for block in blocks] == [100, 100, 100, 100, 30]
    assert np.concatenate([np.frombuffer(block["x"]) for block in blocks]).tolist() == list(range(430))
    assert sum(np.frombuffer(block["bins"], np.uint8).sum() for block in blocks) == 229


def test_one_node_of_two_is_counted_and_the_other_is_the_rest():
    """Counting one child of each node and taking the other from the parent gives the sums of all nodes."""
    rng = np.random.default_rng(11)
    n, models = 900, 3
    bins = np.hstack([rng.integers(0, 32, (n, 3)), rng.integers(0, 2, (n, 3))]).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(bins.max(axis=0).astype(int) + 1)])
    codes, members = many._bundles(bins)
    rows = many.Rows(0, None, np.ascontiguousarray(bins.T), codes, members, np.zeros(n), np.ones(n), np.zeros(n), None, None)
    # All branches open, one that has ended at the first level, and a split that sends all rows to the left.
    feature, split = np.full((models, 15), -1), np.full((models, 15), 12)
    feature[:, :7] = (0, 1, 2, 0, 1, 2, 1)
    feature[1, [1, 3, 4]], split[2, 0] = -1, 31
    slope, curve = rng.normal(size=(models, n)), rng.uniform(size=(models, n))
    count = lambda level, few=None: many._histograms(
        rows, {"feature": feature, "split": split} if level else None, level, slope, curve, offsets, few)
    for level in (1, 2, 3):
        few = rng.integers(0, 2, (models, 2 ** (level - 1)))
        above, part, whole = count(level - 1), count(level, few), count(level)
        for m in range(models):
            got = many._both(part[m].reshape(2, -1, offsets[-1]), above[m].reshape(2, -1, offsets[-1]), few[m])
            split_ = feature[m, 2 ** (level - 1) - 1:2**level - 1] >= 0
            plain = whole[m].reshape(2, 2**level, -1)
            assert np.abs(got - plain)[:, np.repeat(split_, 2)].max() < 1e-9


def test_strips_leave_out_each_models_own_fold(monkeypatch):
    monkeypatch.setattr(many, "STRIP", 100)
    rng = np.random.default_rng(3)
    n, of_fold = 130, np.array([0, 1, 2, many.ALL])
    fold = np.sort(rng.integers(0, 3, n)).astype(np.int32)
    label, weight, margin = rng.integers(0, 2, n).astype(float), rng.uniform(0.5, 2, n), 30 * rng.normal(size=(4, n))
    margin[:, :2] = (800, -800)
    rows = many.Rows(0, None, None, None, None, label, weight, fold, None, None)
    lost, p, weights = np.zeros((4, 4)), np.empty((4, n)), np.empty((4, n))
    for strip, some, own in many._strips(rows, of_fold, lambda strip: margin[:, strip], lost):
        p[:, strip], weights[:, strip] = some, own
    out = fold == of_fold[:, None]
    assert np.allclose(p, many.sigmoid(margin), rtol=1e-12, atol=1e-300) and (weights == weight * ~out).all()
    loss = np.logaddexp(0, margin) - label * margin
    plain = [(loss * weight * ~out).sum(axis=1), (weight * ~out).sum(axis=1), (loss * weight * out).sum(axis=1), (weight * out).sum(axis=1)]
    assert np.allclose(lost, plain, rtol=1e-10, atol=1e-9)


def test_cells_trained_together_equal_cells_trained_alone(spark):
    """Rows of a block are in the order of their folds, and cells share nothing but the time."""
    rng = np.random.default_rng(8)
    n, folds, trains = 500, 3, []
    for cell in range(2):
        x = np.round(rng.normal(size=(n, 4)), 1)
        y = (x[:, cell] + rng.normal(size=n) > 0).astype(float)
        trains.append(spark.createDataFrame(
            [(i, i, float(y[i]), 1.0, int(i % folds), Vectors.dense(x[i])) for i in range(n)],
            ["person_id", "encounter_id", "label", "weight", "cv_fold", "features"]).coalesce(1))
    packed = many.pack(trains, folds)
    for row in packed.blocks.select("fold", "encounters").collect():
        fold, encounters = np.frombuffer(row["fold"], np.int32), np.frombuffer(row["encounters"], np.int64)
        assert (np.diff(fold) >= 0).all() and (encounters % folds == fold).all()
    both = many.fit_boosted(packed, [(2, 0.3), (3, 0.1)], most_trees=5, write_every=2)
    for train_rows, forest in zip(trains, both):
        alone = many.pack([train_rows], folds)
        own = many.fit_boosted(alone, [(2, 0.3), (3, 0.1)], most_trees=5, write_every=2)[0]
        assert len(forest.value) == len(own.value) == 5 and forest.rounds == own.rounds
        assert all((a == b).all() for a, b in zip(forest.feature, own.feature))
        assert all(np.allclose(a, b) for a, b in zip(forest.value, own.value))
        alone.release()
    packed.release()


def test_leaderboard_and_stack(cell):
    board = train.leaderboard(cell).orderBy("rank").collect()
    assert [r["rank"] for r in board] == [1, 2] and {r["model"] for r in board} == {"GLM", "GBM"}
    assert board[0]["holdout_auc"] >= board[1]["holdout_auc"] > 0.5
    assert cell.out_of_fold.count() == cell.split.train.count()
    meta, holdout = train.stack(cell)
    assert min(meta.coefficients) >= 0
    assert holdout.count() == cell.split.test.count()
    area = metrics.auc(holdout, [], "stacked", F.col("label") == 1).first()["auc"]
    assert area > 0.5
    assert holdout.filter("stacked < 0 or stacked > 1").isEmpty()


def test_saved_models_load_and_score(cell, matrix, tmp_path):
    meta, holdout = train.stack(cell)
    paths = train.save_ranked(train.ranked(cell, meta, holdout), str(tmp_path))
    names = [path.rsplit("/", 1)[1] for path in paths]
    assert names[0].startswith("1_") and "_auc_0." in names[0] and len(names) == 3
    for path in paths:
        scored = train.probability(PipelineModel.load(path).transform(matrix.limit(50)), "p")
        assert scored.filter("p between 0 and 1").count() == 50
    # Loaded models and stack give the scores that they gave on the hold-out rows.
    for name in ("GLM", "GBM", "stacked"):
        loaded = PipelineModel.load(next(path for path in paths if f"_{name}_" in path))
        again = train.probability(loaded.transform(matrix.join(holdout.select(*train.KEYS), train.KEYS)), "p")
        both = again.select(*train.KEYS, "p").join(holdout.select(*train.KEYS, name), train.KEYS)
        assert both.count() == holdout.count() and both.filter(f"abs(p - {name}) > 1e-9").isEmpty()


def test_importance_names_predictors(cell):
    for t in cell.trained:
        table = explain.importance(t.model, cell.split.train).collect()
        assert {r["variable"] for r in table} == set(features.predictors("7days"))
        assert max(r["relative_importance"] for r in table) == pytest.approx(1)
    assert "num_7days_defaults_last_3visits" not in features.predictors("1day")


def test_learning_curve_ends_at_the_loss_of_the_scores(cell):
    curve = train.learning_curve(cell)
    for t in cell.trained:
        rows = curve.filter(F.col("model") == t.name).orderBy("iteration").collect()
        assert rows[0]["logloss"] == pytest.approx(math.log(2)) and rows[-1]["logloss"] < rows[0]["logloss"]
        loss = lambda p: F.sum(-F.col("weight") * (
            F.col("label") * F.log(p) + (1 - F.col("label")) * F.log(1 - p))) / F.sum("weight")
        own = train.probability(t.model.transform(cell.split.train), "p").agg(loss(F.col("p"))).first()[0]
        held = cell.out_of_fold.agg(loss(F.col(t.name))).first()[0]
        assert rows[-1]["logloss"] == pytest.approx(own, rel=1e-5)
        assert rows[-1]["cv_logloss"] == pytest.approx(held, rel=1e-5)


def test_a_run_is_trained_once_and_counts_when_it_is_finished(spark, tmp_path):
    folder, calls = str(tmp_path), []

    def half(where):
        spark.range(3).write.parquet(f"{where}/leaderboard")
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        registry.train_once(spark, folder, "abc", half)
    assert registry.find(spark, folder, "abc") is None

    def whole(where):
        calls.append(where)
        spark.range(5).write.parquet(f"{where}/leaderboard")
        return [{"cohort": "adult", "horizon": "1day", "rank": 1, "name": "x", "auc": 0.5}]

    runs = [registry.train_once(spark, folder, "abc", whole) for _ in range(2)]
    assert len(calls) == 1 and runs[0] == runs[1] and runs[1].table("leaderboard").count() == 5
    assert registry.find(spark, folder, "other") is None
    one = spark.range(4).withColumn("x", F.lit("a"))
    assert registry.fingerprint(one, [1]) == registry.fingerprint(one.orderBy(F.desc("id")), [1])
    assert registry.fingerprint(one, [1]) != registry.fingerprint(one, [2])
    assert registry.fingerprint(one, [1]) != registry.fingerprint(one.filter("id < 3"), [1])


def test_training_queries_cover_all_cells(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(modelling, "FOLDS", 3)
    monkeypatch.setattr(registry, "home", lambda _: str(tmp_path))
    assert len(train.LINEAR) == 12 and len(train.BOOSTED) == 4 and train.MOST_TREES >= 60
    for name, value in (("LINEAR", LINEAR), ("BOOSTED", BOOSTED), ("MOST_TREES", 3)):
        monkeypatch.setattr(train, name, value)
    clinic = Clinic(spark, MEDIUM)
    matrix = modelling.matrix(clinic)
    four = {(band, horizon) for band in ("adult", "minor") for horizon in ("1day", "7day")}
    board = modelling.train_leaderboard(clinic).collect()
    assert {(r["cohort"], r["horizon"]) for r in board} == four and len(board) == 8
    # All other queries read the run; a second fit would fail.
    monkeypatch.setattr(train, "train_cells", None)
    names = modelling.save_ranked_models(clinic).collect()
    assert {(r["cohort"], r["horizon"]) for r in names} == four and len(names) == 12
    scores = modelling.batch_score(clinic)
    assert scores.filter("prob_1day is null or prob_7day is null").isEmpty()
    for (band, horizon), model in modelling.training_run(clinic).best().items():
        rows = matrix.filter(F.col("cohort") == band).orderBy("encounter_id").limit(20)
        direct = train.probability(model.transform(rows), "p").select(*train.KEYS, "p")
        both = scores.join(direct, train.KEYS)
        assert both.count() == 20 and both.filter(f"abs(prob_{horizon} - p) > 1e-9").isEmpty()
    assert modelling.score_snapshot(clinic).count() == 2 * matrix.filter("cohort is not null").count()
    for table in (modelling.learning_curve(clinic), modelling.variable_importance(clinic),
                  modelling.stacked_ensemble(clinic), modelling.partial_dependence(clinic)):
        assert {tuple(r) for r in table.select("cohort", "horizon").distinct().collect()} == four


def test_scores_stay_on_their_rows(matrix):
    models = modelling.linear_models(matrix)
    rows = matrix.withColumn("band", F.col("cohort")).filter("band is not null")
    scored = score.score(rows, models)
    assert scored.count() == rows.count()
    assert scored.filter("prob_1day between 0 and 1 and prob_7day between 0 and 1").count() == rows.count()
    one = rows.filter("band = 'minor'").orderBy("encounter_id").limit(20)
    direct = train.probability(models["minor", "1day"].transform(one), "p").select("encounter_id", "p")
    joined = scored.join(direct, "encounter_id")
    assert joined.count() == 20 and joined.filter("abs(prob_1day - p) > 1e-9").isEmpty()
    gaps = score.score(rows, {key: m for key, m in models.items() if key[0] == "adult"})
    assert gaps.filter("band = 'minor' and prob_1day is null").count() == rows.filter("band = 'minor'").count()


def test_weekly_run(clinic, matrix):
    models = modelling.linear_models(matrix)
    inputs = modelling.weekly_inputs(clinic)
    start = date(1998, 3, 4)
    test = weekly.weekly_risk_run(inputs, models, start, 4, retrospective=True, version="t").cache()
    live = weekly.weekly_risk_run(inputs, models, start, 4, retrospective=True, test_run=False, version="t")
    assert test.count() > live.count()
    assert live.join(clinic.ledger, "encounter_id", "left_semi").isEmpty()
    span = test.agg(F.min("rtc_date"), F.max("rtc_date"), F.min("start_date"), F.max("end_date")).first()
    assert date(1998, 3, 2) == span[2] <= span[0] and span[1] <= span[3] == date(1998, 3, 29)
    assert test.groupBy("encounter_id").count().filter("count > 1").isEmpty()
    assert {r[0] for r in test.select("risk_1day").distinct().collect()} <= {None, "High Risk", "Medium Risk"}
    test.unpersist()


def test_daily_refresh(clinic, tmp_path):
    gaps = clinic.ledger.withColumn("rtc_date", F.when(F.col("model_version") == "V11", F.col("rtc_date")))
    since = date(1996, 1, 1)
    path = str(tmp_path / "ledger")
    ledger.append_predictions(gaps, path)
    done = maintenance.daily_refresh(
        path, gaps.schema, clinic.visit, clinic.person, clinic.location, clinic.hot_persons,
        str(tmp_path), since, since)
    assert done["ledger"].filter("rtc_date is null").isEmpty()
    assert done["ledger"].count() == clinic.ledger.count()
    before = clinic.ledger.filter("observed_rtc_date is null").count()
    assert done["ledger"].filter("observed_rtc_date is null").count() < before
    baseline = done["baseline_visit"]
    assert baseline.count() == baseline.select("person_id").distinct().count()
