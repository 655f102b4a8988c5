"""Encoding, language model, passages, pages and quality beside brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import SMALL
from odd import odd_documents, odd_labels  # noqa: F401
from pyspark.sql import functions as F

from keptvisit.llm import interpolation, pages, passages, pieces, quality, queries

FILE = public_tokenizers.path(queries.PIECES_FILE)


def words_of(text):
    return (text or "").encode().lower().split()


def test_encoding_equals_the_library(spark, odd_documents):
    library = sentencepiece.SentencePieceProcessor(model_file=FILE)
    rng = random.Random(1)
    letters = "ab ▁\n\té😀<>0x日;\r}) the in"
    odd = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(800)]
    odd += ["", " ", "  a", "a ", "\n", "x" * 300, " " * 70, "a\x00b", "<s>", "<0x0A>", "﻿", "ﬁ①"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").unionByName(
        odd_documents.select((F.col("doc_id") + 10_000).alias("doc_id"), "text")).unionByName(
        spark.read.parquet(f"{SMALL}/documents.parquet").select((F.col("doc_id") + 20_000).alias("doc_id"), "text"))
    texts = {}
    for row in docs.collect():
        texts.setdefault(row["doc_id"], row["text"] or "")
    rows = pieces.encode(docs, FILE).collect()
    assert len(rows) == docs.count()
    for row in rows:
        text = texts[row["doc_id"]] if row["doc_id"] is not None else next(
            r["text"] for r in odd_documents.collect() if r["doc_id"] is None)
        ids = library.encode(text)
        assert row["ids"] == ids and row["decoded"] == library.decode(ids)
        assert sum(row["lengths"]) == len(text.encode())
    assert pieces.encode(docs.limit(0), FILE).collect() == []


def test_spans_are_the_bytes_of_their_pieces():
    model = pieces.Model(open(FILE, "rb").read())
    text = "Hello  wörld\n日本 x"
    ids, ends = model.encode(text)
    data, start = text.encode(), 0
    for number, end in zip(ids, ends):
        if number not in model.id_bytes:
            assert data[start:end].decode().replace(" ", pieces.MARK) in model.pieces[number]
        start = end
    assert start == len(data)


def test_character_map_takes_the_longest_prefix():
    # A double array for "a" -> "1" and "ab" -> "22", built by hand.
    units = [0] * 1024

    def offset(unit_at, to):
        return (unit_at ^ to) << 10

    units[0] = offset(0, 256)
    a = 256 ^ ord("a")
    units[a] = offset(a, 512) | 1 << 8 | ord("a")
    units[512] = 0 | 1 << 31
    b = 512 ^ ord("b")
    units[b] = offset(b, 768) | 1 << 8 | ord("b")
    units[768] = 2 | 1 << 31
    data = pa.array(units, pa.uint32()).buffers()[1].to_pybytes()[:4096]
    found = pieces.CharacterMap(len(data).to_bytes(4, "little") + data + b"1\x0022\x00")
    assert found.longest(b"abc", 0) == (2, b"22")
    assert found.longest(b"ac", 0) == (1, b"1")
    assert found.longest(b"ca", 0) is None


@pytest.mark.parametrize("size", [1 << 22, 3000])
def test_language_model_beside_plain_counts(spark, monkeypatch, size):
    monkeypatch.setattr(interpolation.exchange.units, "__defaults__", (size,))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model, counted = interpolation.train(docs)
    got = {r["doc_id"]: r for r in interpolation.score(model, counted).collect()}
    texts = {r["doc_id"]: [*words_of(r["text"]), b" end"] for r in docs.collect()}
    ones, twos, contexts = Counter(), Counter(), Counter()
    for key, words in texts.items():
        if zlib.crc32(str(key).encode()) % 10:
            ones.update(words)
            twos.update(zip([b" begin", *words], words))
            contexts.update([b" begin", *words[:-1]])
    n, v = sum(ones.values()), len(ones)
    assert (model.tokens, model.distinct) == (n, v)
    assert np.allclose(model.weights.sum(axis=1), 1) and (model.weights[:, 2] > 0).all()
    for key, words in texts.items():
        row = got[key]
        base = sum(math.log10((ones[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        score = 0.0
        for h, w in zip([b" begin", *words], words):
            c = contexts[h]
            a, b, e = model.weights[min(c.bit_length(), len(model.weights) - 1)]
            score += math.log10((a * twos[h, w] / c if c else 0) + b * ones[w] / n + e / (v + 1))
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 10 == 0)
        assert row["n_tokens"] == len(words) and row["train_tokens"] == n
        assert row["n_known"] == sum(ones[w] > 0 for w in words)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["score"] == pytest.approx(score, rel=1e-9)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_odd_rows(odd_documents):
    rows = interpolation.score(*interpolation.train(odd_documents)).collect()
    assert len(rows) == odd_documents.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[5]["n_tokens"] == by[6]["n_tokens"] == by[7]["n_tokens"] == 1
    assert by[None]["held_out"] is True and all(math.isfinite(r["score"]) for r in rows)
    assert interpolation.score(*interpolation.train(odd_documents.limit(0))).collect() == []
    (only,) = interpolation.score(*interpolation.train(odd_documents.filter("doc_id is null"))).collect()
    assert only["train_tokens"] == 0 and only["base_score"] == pytest.approx(0) and only["score"] == pytest.approx(0)


@pytest.mark.parametrize("size", [1 << 22, 3000])
def test_passages_beside_plain_windows(spark, monkeypatch, size):
    monkeypatch.setattr(passages.exchange.units, "__defaults__", (size,))
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9)))
    shared = [word() for _ in range(60)]
    rows = [(i, " ".join([word() for _ in range(rng.randint(0, 90))] + (shared if i % 3 == 0 else [])
                         + [word() for _ in range(rng.randint(0, 90))])) for i in range(40)]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(
        (F.col("doc_id") + 1000).alias("doc_id"), "text").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string"))
    texts = {r["doc_id"]: words_of(r["text"]) for r in docs.collect()}
    holders = {}
    for key, words in texts.items():
        for i in range(len(words) - 49):
            holders.setdefault(tuple(words[i:i + 50]), set()).add(key)
    wanted = {}
    for key, words in texts.items():
        starts = [i for i in range(len(words) - 49) if len(holders[tuple(words[i:i + 50])]) > 1]
        if starts:
            kept = [i for i in starts if min(holders[tuple(words[i:i + 50])]) != key]
            wanted[key] = tuple(passages.covered(np.array(s), 50) for s in (starts, kept))
    got = {r["doc_id"]: tuple([(s["start"], s["stop"]) for s in r[c]] for c in ("spans", "removed"))
           for r in passages.repeats(docs).collect()}
    assert got == wanted and len([k for k in got if k < 1000]) == 14


def plain_passages(texts):
    """Spans and removed spans of every text with a window of 50 words that another text has."""
    holders, wanted = {}, {}
    for key, words in texts.items():
        for i in range(len(words) - 49):
            holders.setdefault(tuple(words[i:i + 50]), set()).add(key)
    for key, words in texts.items():
        starts = [i for i in range(len(words) - 49) if len(holders[tuple(words[i:i + 50])]) > 1]
        if starts:
            kept = [i for i in starts if min(holders[tuple(words[i:i + 50])]) != key]
            wanted[key] = tuple(passages.covered(np.array(s), 50) for s in (starts, kept))
    return wanted


@pytest.mark.parametrize("size", [1 << 22, 3000])
def test_passages_of_one_word_or_line(spark, monkeypatch, size):
    # Text of a short period may have no cut of the gear hash, or one in a passage, so no shared chunk.
    monkeypatch.setattr(passages.exchange.units, "__defaults__", (size,))
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9)))
    lines = ["the ", "na ", "read more ", "all rights reserved ", "please accept cookies ", "a b c "]
    lines += ["".join(rng.choice("hijklm") for _ in range(n - 1)) + " " for n in (4, 8, 12, 20, 30) for _ in range(6)]
    rows = []
    for line in lines:
        for _ in range(2):
            run = (line * 90).split()[:rng.randint(50, 90)]
            rows.append((len(rows), " ".join(
                [word() for _ in range(rng.randint(0, 30))] + run + [word() for _ in range(rng.randint(0, 30))])))
    # Two texts that are the run alone, an empty one, and a run one word too short.
    rows += [(len(rows), "the " * 70), (len(rows) + 1, "the " * 65), (len(rows) + 2, ""), (len(rows) + 3, "zz " * 49)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = plain_passages({key: words_of(text) for key, text in rows})
    got = {r["doc_id"]: tuple([(s["start"], s["stop"]) for s in r[c]] for c in ("spans", "removed"))
           for r in passages.repeats(docs).collect()}
    assert got == wanted and len(got) == 2 * len(lines) + 2


def test_passages_odd_rows(odd_documents):
    rows = passages.report(passages.repeats(odd_documents, words=30)).collect()
    by = {r["doc_id"]: r for r in rows}
    assert set(by) == {1, 2, 3, None, 10, 11}
    assert by[1]["removed_words"] == 0 and by[2]["removed_words"] == 40 and by[2]["first_ids"] == [1]
    assert by[10]["spans"] == "0:60000" and by[11]["removed_words"] == 60000
    assert passages.repeats(odd_documents.limit(0)).collect() == []


def test_an_insertion_shifts_no_later_cut():
    data = np.random.default_rng(4).integers(97, 123, 4000).astype(np.uint8)
    longer = np.concatenate([data[:1000], np.frombuffer(b"inserted", np.uint8), data[1000:]])
    ends = lambda d: passages.cuts(d, np.array([0, len(d)]))
    before, after = ends(data), ends(longer)
    assert set(before[before > 1016] + 8) <= set(after)
    assert set(before[before <= 1000]) <= set(after)


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="page">
<div id="cookie-notice"><p>%s</p></div><header><h1>Site</h1></header><nav><a href="/">Home</a></nav>
<article><header><h1>Head &amp; shoulders</h1></header><p>Short.</p><p>First&nbsp;line<br>second  &eacute;&#233;
<b>bold</b>,  end.<p>%s<script>var t="</p>";</script><ul><li>One</li><li>Two</li></ul>
<div class="ad">%s</div><aside>%s</aside><form><input value="x"><label>Name</label></form>
<section class="comments"><p>%s</p></section></article><div class="sidebar">%s</div>
<footer>&copy; Site</footer>""" % tuple(
    [" ".join(["the story of the town is in the news"] * n) for n in (9, 8, 7, 6, 5, 4)])


def test_page_blocks():
    assert pages.main_text(PAGE).split("\n") == [
        "Head & shoulders", "Short.", "First line second éé bold, end.",
        " ".join(["the story of the town is in the news"] * 8), "One", "Two"]


def test_pages_without_an_article():
    good, other = "the story of the town is in the news " * 6, "zzz qqq kkk " * 30
    html = f"<div><p>{good}</p><p>Short one</p></div><div><p>{other}</p><p>Buy</p></div>"
    assert pages.main_text(html) == good.strip() + "\nShort one"
    linked = f"<div><p><a href=x>{good}</a></p></div>"
    assert pages.main_text(linked) == ""


def test_pages_of_the_table(spark):
    import re
    from html import unescape

    rows = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.op10_html_extraction(spark, SMALL).collect()}
    for row in rows:
        body = re.search(r"<article>(.*)</article>", row["html"], re.S)[1]
        lines = re.sub(r"</?(?:p|h1)>", "\n", re.sub(r"</?b>", "", body.replace("<br>", " "))).split("\n")
        lines = [" ".join(unescape(line).split()) for line in lines]
        text = "\n".join(line for line in lines if line)
        assert got[row["page_id"]]["text"] == text and got[row["page_id"]]["n_chars"] == len(text)


def test_odd_pages(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>"), (2, "u", "<p>"), (3, "u", "a < b & c"),
            (4, "u", "<article>" + "<p>word word the</p>" * 20_000), (5, "u", "<a href='x"), (6, "u", "<div <p>>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = pages.extract(frame).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == by[2]["text"] == by[None]["text"] == "" and by[1]["url"] is None
    assert by[4]["text"].count("\n") == 19_999
    assert pages.extract(frame.limit(0)).collect() == []


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    even = labels.filter("doc_id % 2 = 0")
    model = quality.fit(docs, even)
    told = docs.join(labels.filter("doc_id % 2 = 1"), "doc_id")
    rows = quality.score(told, model, [F.col("doc_id"), F.col("quality"), F.col("toxic")]).collect()
    keep = lambda r: r["probability"] >= quality.ACCEPT
    clean = [r for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    toxic, low = [r for r in rows if r["toxic"] == 1], [r for r in rows if r["quality"] == 0]
    assert sum(map(keep, clean)) >= 0.99 * len(clean)
    assert sum(map(keep, toxic)) <= 0.15 * len(toxic)
    assert sum(map(keep, low)) <= 0.03 * len(low)


def views_of(n, seed):
    """A text view that tells the classes well apart and a page view of many weak columns."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n).astype(float)
    text = np.stack([6 * y - 3 + rng.normal(size=n), rng.normal(size=n)], axis=1)
    page = 0.2 * (2 * y - 1)[:, None] + rng.normal(size=(n, 30))
    return y, text.astype(np.float32), page.astype(np.float32)


def test_co_training_helps_the_weak_view():
    y, text, page = views_of(9000, 0)
    told, rest = slice(0, 100), slice(100, 6000)
    calibrate = np.arange(100) % 3 == 0
    fitted = [quality.co_train(text[told], page[told], y[told], calibrate,
                               quality.array_pool(text[rest], page[rest], 0.9), rounds) for rounds in (0, 3)]
    wrong = [((f[1].raw(page[6000:]) > 0) != y[6000:]).mean() for f in fitted]
    assert wrong[1] < 0.85 * wrong[0]


def test_pool_in_blocks_equals_the_pool_in_one(spark):
    y, text, page = views_of(1500, 1)
    told, rest = slice(0, 300), slice(300, 1500)
    calibrate = np.arange(300) % 3 == 0
    blocks = spark.createDataFrame(
        [(text[at:at + 70].tobytes(), page[at:at + 70].tobytes()) for at in range(300, 1500, 70)],
        "a binary, b binary").repartition(5)
    one, many = (quality.co_train(text[told], page[told], y[told], calibrate, pool) for pool in (
        quality.array_pool(text[rest], page[rest]), quality.frame_pool(blocks, (2, 30))))
    for a, b in zip(one[:2], many[:2]):
        assert np.allclose(a.beta, b.beta, atol=1e-9)
    assert np.allclose(one[2], many[2], atol=1e-9)


@pytest.mark.parametrize("bits", [0, 3, 8, 11])
def test_packed_rows_come_back(bits):
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(7, 11)).astype(np.float32)
    rows[:, :bits] = rng.integers(0, 2, (7, bits))
    again = quality.unpack_rows(pa.py_buffer(quality.pack_rows(rows, bits)), 11, bits)
    assert np.array_equal(rows, again)


def test_quality_model_on_odd_rows(spark, odd_documents):
    """Enough labels that the fitted model, not the fallback, meets the odd rows."""
    good, bad = "the report was clear and the results are plain", "buy buy cheap pills now now click"
    many = spark.createDataFrame(
        [(1000 + n, f"{good if n % 3 else bad} {n % 17}", "en", f"s{n % 4}", 50) for n in range(600)],
        "doc_id long, text string, lang string, source string, n_chars long")
    told = spark.createDataFrame(
        [(1000 + n, int(n % 3 > 0), 0) for n in range(300)] + [(1, None, 0), (None, 1, 0), (99, 0, None)],
        "doc_id long, quality int, toxic int")
    both = odd_documents.unionByName(many, allowMissingColumns=True)
    rows = quality.classify(both, told).collect()
    assert len(rows) == both.count() and all(0 <= r["probability"] <= 1 for r in rows)
    fresh = [r for r in rows if (r["doc_id"] or 0) >= 1300]
    assert len(fresh) == 300
    assert sum(r["kept"] != ((r["doc_id"] - 1000) % 3 > 0) for r in fresh) == 0
    assert quality.accepted(both, told).columns == both.columns


def test_quality_odd_rows(odd_documents, odd_labels):
    rows = quality.classify(odd_documents, odd_labels).collect()
    assert len(rows) == odd_documents.count() and all(r["kept"] for r in rows)
    assert quality.classify(odd_documents.limit(0), odd_labels).collect() == []
    assert quality.accepted(odd_documents, odd_labels.limit(0)).columns == odd_documents.columns
