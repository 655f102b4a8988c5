"""Toxicity: automata beside plain edit distances, contexts, and held-out labels."""

import random
import zlib

import pyarrow as pa
import pytest
from odd import odd_documents, odd_labels  # noqa: F401
from pyspark.sql import functions as F

from keptvisit.llm import queries, toxicity
from keptvisit.llm.toxicity import Automaton, Model, Term

TENTH = "/root/testdata/sf0.1"


def distances(term, word):
    """Edits from the term to every beginning of the word."""
    row = list(range(len(term) + 1))
    last = [row[-1]]
    for letter in word:
        new = [row[0] + 1]
        for k, own in enumerate(term, start=1):
            new.append(min(new[-1] + 1, row[k] + 1, row[k - 1] + (own != letter)))
        row = new
        last.append(row[-1])
    return last


def plain(terms, word):
    found = []
    for n, t in enumerate(terms):
        to = distances(t.text, word)
        edits = min(to[:-1], default=99) if t.stem else to[-1]
        if edits <= t.edits:
            found.append((edits, -t.trust[edits], n))
    return (min(found)[2], min(found)[0]) if found else None


def test_automaton_equals_edit_distances():
    rng = random.Random(3)
    word = lambda low, high: "".join(rng.choice("abc") for _ in range(rng.randint(low, high)))
    for _ in range(12):
        texts = sorted({word(3, 9) for _ in range(6)})
        terms = [Term(t, rng.random() < 0.4) for t in texts]
        automaton = Automaton(terms)
        for _ in range(400):
            read = word(0, 11)
            assert automaton.match(read) == plain(terms, read), (terms, read)


def test_quotation_counts_less_than_abuse():
    model = Model([Term("moron", False), Term("worthless", False)], None, 0.1)
    texts = ["you are a moron, a worthless mor0n", 'he wrote "moron" as an example of the word', "a fine day"]
    hits = model.hits(pa.array(texts))
    assert [len(h) for h in hits] == [3, 1, 0]
    assert [texts[0][h.start:h.end] for h in hits[0]] == ["moron", "worthless", "mor0n"]
    assert [h.edits for h in hits[0]] == [0, 0, 1]
    assert max(h.quotation for h in hits[0]) < 0.1 < 0.8 < hits[1][0].quotation
    x = model.features(pa.array(texts), hits)
    assert (x[0] > x[1]).all() and (x[1] > 0).all() and (x[2] == 0).all()


def test_copies_of_one_document_make_no_terms(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abdegiklmnorstu") for _ in range(7)) for _ in range(400)]
    clean = [(" ".join(rng.choices(words, k=60)), False) for _ in range(400)]
    toxic = [(" ".join(rng.choices(words, k=30) + ["wretch"] + rng.choices(words, k=30)), True) for _ in range(40)]
    copied = [("only here stand quixotic zephyrs " + " ".join(words[:9]), True)] * 40
    sample = spark.createDataFrame(clean + toxic + copied, "text string, toxic boolean")
    assert [t.text for t in toxicity.learn_terms(sample)] == ["wretch"]


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{TENTH}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.classify(docs, labels)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == docs.count()
    told = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    for doc, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    out = [(told[d], r["predicted"]) for d, r in rows.items() if r["held_out"] and told.get(d) is not None]
    toxic, clean = ([p for y, p in out if y == k] for k in (1, 0))
    assert sum(toxic) / len(toxic) > 0.9 and sum(clean) / len(clean) < 0.005
    # Held-out labels are not read.
    turned = labels.withColumn("toxic", F.when(
        toxicity.remainder("doc_id") == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, turned).collect()}
    assert all(again[d] == pytest.approx(r["score"], abs=1e-9) for d, r in rows.items())


def test_misspelled_and_plain_rows(spark):
    docs, labels = (spark.read.parquet(f"{TENTH}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, learns=toxicity.remainder("doc_id") != 1)
    rows = spark.createDataFrame([
        (1, "you idiott, you patheticc worthles l0ser"), (2, "a quiet day in the old town"), (3, None), (4, ""),
        (5, "fine words " * 40_000), (6, "you idiott, you patheticc worthles l0ser"),
    ], "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("_text", F.lit(1))
    found = {r["id"]: r for r in toxicity.detect(rows, model, [F.col("doc_id").alias("id")]).collect()}
    assert found[1]["score"] >= 0.7 and found[1]["score"] == found[6]["score"]
    assert [h["term"] for h in found[1]["hits"]] == ["idiot", "pathetic", "worthless", "loser"]
    assert max(found[k]["score"] for k in (2, 3, 4, 5)) < 0.1 and not found[2]["hits"]


def test_odd_rows(spark, odd_documents, odd_labels):
    rows = toxicity.classify(odd_documents, odd_labels).collect()
    assert len(rows) == odd_documents.count() and {r["held_out"] for r in rows} <= {True, False}
    # With enough labels the odd rows go through the fitted model.
    many = spark.createDataFrame(
        [(1000 + n, "vile dunces " * (n % 3 + 1) + f"word{n} here" if n % 4 == 0 else f"mild word{n} here", "en", "z", 1)
         for n in range(400)], "doc_id long, text string, lang string, source string, n_chars long")
    told = spark.createDataFrame([(1000 + n, 1, int(n % 4 == 0)) for n in range(400)] + [(1, 1, None), (77, 0, 1)],
                                 "doc_id long, quality int, toxic int")
    both = odd_documents.unionByName(many, allowMissingColumns=True)
    found = toxicity.classify(both, told).collect()
    assert len(found) == both.count()
    assert all(r["predicted"] == 0 for r in found if (r["doc_id"] or 0) < 1000)
    none = toxicity.classify(odd_documents, odd_labels.filter("toxic is null"))
    assert {r["score"] for r in none.collect()} == {0.0}
    assert toxicity.classify(odd_documents.limit(0), odd_labels).collect() == []
    assert "op11_toxicity" in queries.QUERIES
