"""The pipeline's stages, each on what the one before kept."""

import os

import corpus_pipeline
import pytest
from conftest import SMALL
from odd import odd_documents  # noqa: F401
from pyspark.sql import functions as F

from keptvisit.llm import jaccard, mixing, quality, secrets
from keptvisit.session import use_checkpoints


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_all_but_the_last_return_documents(stages):
    for frame in stages[1:-1]:
        assert frame.dtypes == stages[0].dtypes


def test_decisions_take_effect(spark, stages):
    docs, good, single, masked, mixed, encoded = stages
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = {r["doc_id"] for r in quality.classify(docs, labels).filter("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept
    assert jaccard.join(single).filter("n_links > 0").count() == 0
    joined = jaccard.join(good)
    assert single.count() == joined.filter("kept").count()
    assert masked.count() == single.count()
    assert masked.filter(F.length("text") != F.col("n_chars")).count() == 0
    words = mixing.mix(masked).agg(F.sum("taken")).first()[0]
    assert mixed.agg(F.sum(mixing.size_of("text"))).first()[0] == words
    assert encoded.count() == mixed.count()


def test_texts_of_one_id_are_judged_each_for_itself(spark):
    first = " ".join(f"a{n}" for n in range(60))
    other = " ".join(f"b{n}" for n in range(60))
    rows = [(1, first), (7, first), (7, other), (7, other), (8, "one"), (8, "two"), (8, None), (8, ""), (9, other)]
    docs = spark.createDataFrame(
        [(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r["doc_id"], r["text"] or "") for r in corpus_pipeline.keep_one_of_each(spark, docs, SMALL).collect()]
    assert sorted(kept) == [(1, first), (7, other), (8, ""), (8, "one"), (8, "two")]


def test_live_secrets_are_gone(spark, odd_documents):
    masked = corpus_pipeline.mask_secrets(spark, odd_documents, SMALL)
    before, after = (secrets.report(secrets.scan(d)).agg(F.sum("n_live")).first()[0]
                     for d in (odd_documents, masked))
    assert before > 0 and after == 0


@pytest.mark.parametrize("at", range(5))
def test_odd_and_empty_rows(spark, odd_documents, at):
    stage = corpus_pipeline.STAGES[at][1]
    columns = odd_documents.columns
    for frame in (odd_documents, odd_documents.limit(0)):
        out = stage(spark, frame, SMALL)
        rows = out.collect()
        if at < 4:
            assert out.columns == columns
        if frame is not odd_documents:
            assert rows == []
        elif at == 1:
            assert sorted((r["doc_id"] or 0) for r in rows) == [0, 1, 5, 6, 7, 8, 10, 12, 13, 14, 15]
        elif at in (2, 4):
            assert len(rows) == odd_documents.count()


def test_run_is_the_stages(spark, stages):
    key = ["doc_id", "n_tokens", "ids_sha256"]
    use_checkpoints(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    got = corpus_pipeline.run(spark, SMALL).select(*key)
    assert sorted(got.collect()) == sorted(stages[-1].select(*key).collect())
    # Only the stages' results are left.
    left = sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before)
    assert left == sorted(f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES)
