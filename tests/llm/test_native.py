"""Secret scan and mixing beside their SQL, also on odd rows, and their rules."""

import duckdb
import pytest
from compare import compare
from conftest import SMALL
from odd import odd_documents  # noqa: F401
from pyspark.sql import functions as F

from keptvisit.llm import mixing, queries, secrets

OPERATORS = {
    "op1_secret_scan": lambda d: secrets.report(secrets.scan(d)),
    "op4_source_mixing": lambda d: mixing.mix(d).select(
        "doc_id", "size", "source_size", "target", "taken"),
}


def beside(frame, name, folder):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}')")
    return compare(con, frame, queries.ORACLES[name])


@pytest.mark.parametrize("name", list(OPERATORS))
def test_whole_table(spark, name):
    assert beside(queries.QUERIES[name](spark, SMALL), name, f"{SMALL}/documents.parquet") == []


@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_rows(spark, odd_documents, tmp_path, name):
    path = str(tmp_path / "documents.parquet")
    odd_documents.write.parquet(path)
    assert beside(OPERATORS[name](spark.read.parquet(path)), name, f"{path}/*.parquet") == []


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(odd_documents, name):
    assert OPERATORS[name](odd_documents.limit(0)).collect() == []


def test_copied_examples_are_told_from_live_secrets(odd_documents):
    rows = {r["doc_id"]: r for r in OPERATORS["op1_secret_scan"](odd_documents).collect()}
    assert rows[15]["n_copied"] == 1 and rows[15]["n_live"] == 0
    assert rows[12]["n_assign"] == 1 and rows[12]["n_access"] == 1 and rows[12]["n_live"] == 2
    assert rows[13]["n_hex"] == 1 and rows[13]["n_assign"] == 2
    assert "opaque" in rows[14]["spans"]


def test_both_counts_decide(spark):
    rows = [(n, "token=Zx81kLq0PpY7", "one") for n in range(secrets.COPIED_REPOSITORIES)]
    rows += [(100 + n, "token=Qw45rTy8UuI2", "two") for n in range(secrets.COPIED_REPOSITORIES - 1)]
    rows += [(200 + n, "token=Mn39bVc6XxS5", f"s{n}") for n in range(secrets.COPIED_OWNERS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in secrets.report(secrets.scan(docs)).collect()}
    assert {r["n_live"] for i, r in found.items() if i < 100} == {0}
    assert {r["n_live"] for i, r in found.items() if 100 <= i < 200} == {1}
    assert {r["n_live"] for i, r in found.items() if i >= 200} == {0}
    assert (found[0]["most_repositories"], found[0]["most_owners"]) == (secrets.COPIED_REPOSITORIES, 1)
    assert (found[200]["most_repositories"], found[200]["most_owners"]) == (secrets.COPIED_OWNERS, secrets.COPIED_OWNERS)


def test_only_live_secrets_are_masked(odd_documents):
    out = secrets.redact(odd_documents, secrets.scan(odd_documents), chars="n_chars")
    assert out.columns == odd_documents.columns and out.count() == odd_documents.count()
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[12]["text"] == "[SECRET]\" and é😀 [SECRET] secret=short token:xyz"
    assert rows[12]["n_chars"] == len(rows[12]["text"])
    assert rows[15]["text"] == "apikey=EXAMPLE99" and rows[15]["n_chars"] == 1
    assert rows[5]["text"] is None


def test_water_filling_holds_and_reshares(spark):
    sizes = spark.createDataFrame([("a", 10, 5), ("b", 500, 2), (None, 90, 1)],
                                  "source string, source_size long, weight long")
    got = {r["source"]: r["target"] for r in mixing.water_fill(sizes, 3).collect()}
    assert got["a"] == 30 and got[None] == pytest.approx(570 / 3) and got["b"] == pytest.approx(1140 / 3)
    assert sum(got.values()) == pytest.approx(600)


def test_sample_takes_the_target_of_each_source(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("cut_key", F.lit(1))
    taken = {r["source"]: r["n"] for r in mixing.sample(docs, chars="n_chars").withColumn(
        "n", mixing.size_of("text")).groupBy("source").agg(F.sum("n").alias("n")).collect()}
    for row in mixing.mix(docs).select("source", "target").distinct().collect():
        assert abs(taken.get(row["source"], 0) - row["target"]) <= 1
    most = mixing.mix(docs).filter("taken > 3 * size").count()
    assert most == 0


def test_rows_of_one_place_are_taken_in_turn(spark, tmp_path):
    words = lambda n: " ".join(["word"] * n)
    rows = [(1, "a", words(10))] * 40 + [(None, "b", words(7))] * 300 + [(2, "c", words(5))] * 20
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5).write.parquet(path)
    docs = spark.read.parquet(path)
    assert beside(OPERATORS["op4_source_mixing"](docs), "op4_source_mixing", f"{path}/*.parquet") == []
    taken = mixing.sample(docs).groupBy("source").agg(F.sum(mixing.size_of("text")).alias("n"))
    # "a" and "c" are held at three times their 400 and 100 words; "b" has the rest, 157 rows and a word.
    assert {r["source"]: r["n"] for r in taken.collect()} == {"a": 1200, "b": 1100, "c": 300}
