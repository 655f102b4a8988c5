"""Language-model scoring by deleted interpolation.

Maximum-likelihood estimates of bigrams and unigrams and an even share are mixed
with weights that depend on how often the context was seen, in buckets that
double. The weights are learned by expectation-maximisation on held-out counts:
every training token is held out in turn, its own occurrence deleted from the
counts. For this the tokens are counted by bucket and by their two estimates on
a logarithmic grid of a quarter octave, which is all that is collected.

Tokens are runs of characters other than ASCII white space, ASCII letters in
lower case, then one end per text. Texts are packed into units, in which the
tokens stay; only distinct tokens and bigrams are exchanged for their counts.

Training texts are those with crc32(id as text) mod 10 other than 0. All counts
are over all of them.

Defined cases: a null text is empty and has one token, its end; a null id counts
as an empty text for the fold; without training texts every probability is 1;
every input row gives a row and counts; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keptvisit.llm import exchange
from keptvisit.session import write_out

FOLDS = 10
GRID = 4  # steps per octave
ROUNDS = 60
LEAST_WEIGHT = 1e-6
# No token has a space, so these stand for nothing else.
END, BEGIN = (np.uint64(xxhash.xxh3_64_intdigest(mark)) for mark in (b" end", b" begin"))


def _token_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens, the tokens as places in them with ends, and tokens per text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten().dictionary_encode()
    words = flat.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    owner = np.repeat(np.arange(len(texts)), np.asarray(lists.value_lengths()))
    codes = np.asarray(flat.indices).astype(np.int64)
    if "" in words:
        real = codes != words.index("")
        owner, codes = owner[real], codes[real]
    counts = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(counts)
    tokens = np.insert(codes, ends, len(words))
    return np.append(hashes, END), tokens, counts + 1


def _pack_unit(batch: pa.RecordBatch) -> bytes:
    hashes, tokens, counts = _token_ids(batch.column("text"))
    ids = batch.column("id")
    return exchange.pack(
        np.asarray(pc.fill_null(ids, 0)), np.asarray(ids.is_valid()).astype(np.int64),
        np.asarray(batch.column("held_out")).astype(np.int64),
        counts, tokens, hashes.view(np.int64))


@dataclass
class Unit:
    """An unpacked unit."""

    ids: np.ndarray
    valid: np.ndarray
    held_out: np.ndarray
    counts: np.ndarray
    tokens: np.ndarray
    hashes: np.ndarray

    @staticmethod
    def read(payload: bytes) -> Unit:
        return Unit(*exchange.unpack(payload))

    def first(self) -> np.ndarray:
        """Where each text begins."""
        return np.cumsum(self.counts) - self.counts

    def learned(self) -> np.ndarray:
        """Per token whether it is a training token."""
        return np.repeat(self.held_out == 0, self.counts)

    def unigrams(self) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(self.hashes.view(np.uint64), return_inverse=True)
        return keys, place[self.tokens]

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        words = self.hashes.view(np.uint64)[self.tokens]
        before = np.roll(words, 1)
        before[self.first()] = BEGIN
        mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (words + np.uint64(0xD1B54A32D192ED03))
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return np.unique(mixed ^ (mixed >> np.uint64(32)), return_inverse=True)


def _counted(keys: np.ndarray, place: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    return keys, [np.bincount(place, learned, len(keys)).astype(np.int64)]


def _ask_unigrams(payload: bytes):
    unit = Unit.read(payload)
    return _counted(*unit.unigrams(), unit.learned())


def _ask_bigrams(payload: bytes):
    unit = Unit.read(payload)
    return _counted(*unit.bigrams(), unit.learned())


def _annotate(left: pa.Table, right: pa.Table) -> pa.Table:
    """A unit's texts with the counts of each token and each bigram."""
    unit = Unit.read(left.column("payload")[0].as_py())
    counts = []
    for kind, (_, place) in ((1, unit.unigrams()), (2, unit.bigrams())):
        own = right.filter(pc.equal(right.column("kind"), kind))
        counts.append(exchange.answered(own)[0][place])
    return pa.table({
        "unit": left.column("unit"),
        "payload": pa.array([exchange.pack(
            unit.ids, unit.valid, unit.held_out, unit.counts, *counts)], pa.binary())})


@dataclass(frozen=True)
class Model:
    """Training tokens, distinct ones, training texts, and weights by context bucket.

    A row of `weights` has those of the bigram, the unigram and the even share.
    """

    tokens: int
    distinct: int
    texts: int
    weights: np.ndarray

    def contexts(self, counts: np.ndarray, unigrams: np.ndarray) -> np.ndarray:
        """How often each token's context was followed by a training token."""
        out = np.roll(unigrams, 1)
        out[np.cumsum(counts) - counts] = self.texts
        return out

    def scores(self, counts, unigrams, bigrams) -> np.ndarray:
        """log10 of the probability of each token."""
        context = self.contexts(counts, unigrams)
        weight = self.weights[np.minimum(buckets(context), len(self.weights) - 1)]
        mixed = (weight[:, 0] * bigrams / np.maximum(context, 1)
                 + weight[:, 1] * unigrams / max(self.tokens, 1)
                 + weight[:, 2] / (self.distinct + 1))
        return np.log10(mixed)


def buckets(counts: np.ndarray) -> np.ndarray:
    """0 for 0, 1 for 1, 2 for 2 and 3, 3 for 4 to 7, and so on."""
    return np.frexp(counts.astype(np.float64))[1]


def _grid(p: np.ndarray) -> np.ndarray:
    """The step of a probability on the grid; -1 for 0."""
    return np.where(p > 0, np.rint(-np.log2(np.maximum(p, 1e-300)) * GRID), -1).astype(np.int64)


def _off_grid(step: np.ndarray) -> np.ndarray:
    return np.where(step >= 0, 2.0 ** (-step / GRID), 0.0)


def _held_out_counts(payload: bytes, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens of a unit by bucket and estimates, each deleted from its own counts."""
    _, _, held_out, counts, unigrams, bigrams = exchange.unpack(payload)
    learned = np.repeat(held_out == 0, counts)
    context = model.contexts(counts, unigrams)[learned] - 1
    high = np.where(context > 0, (bigrams[learned] - 1) / np.maximum(context, 1), 0.0)
    low = (unigrams[learned] - 1) / max(model.tokens - 1, 1)
    cells = np.stack([buckets(context), _grid(high), _grid(low)], axis=1)
    return np.unique(cells, axis=0, return_counts=True)


def learn(cells: np.ndarray, times: np.ndarray, distinct: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights per bucket by expectation-maximisation; a bucket without tokens takes the one below."""
    last = np.array([0.0, 0.0, 1.0])
    out = []
    for bucket in range(int(cells[:, 0].max()) + 1 if len(cells) else 1):
        own = cells[:, 0] == bucket if len(cells) else np.zeros(0, bool)
        if own.any():
            parts = np.stack([_off_grid(cells[own, 1]), _off_grid(cells[own, 2]),
                              np.full(own.sum(), 1 / (distinct + 1))], axis=1)
            weight = np.array([1.0, 1.0, 1.0]) / 3
            for _ in range(rounds):
                share = parts * weight
                share /= share.sum(axis=1, keepdims=True)
                weight = (share * times[own, None]).sum(axis=0) / times[own].sum()
                weight = np.maximum(weight, LEAST_WEIGHT)
                weight /= weight.sum()
            if bucket == 0:
                # Without a context the bigram says nothing; its weight goes to the others.
                weight[0] = 0.0
                weight /= weight.sum()
            last = weight
        out.append(last)
    return np.array(out)


def train(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the written units of texts with the counts of their tokens."""
    fold = F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
        (fold % FOLDS == 0).alias("held_out"))
    packed = exchange.units(rows, "text", _pack_unit, "texts")
    ones = exchange.totals(packed, _ask_unigrams, [exchange.SUM], "unigrams", 1 << 18)
    twos = exchange.totals(packed, _ask_bigrams, [exchange.SUM], "bigrams")
    answers = ones.withColumn("kind", F.lit(1)).unionByName(twos.withColumn("kind", F.lit(2)))
    counted = write_out(exchange.with_answers(
        packed, answers, _annotate, "unit long, payload binary"), "counted")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                _, _, held_out, counts, _, _ = exchange.unpack(payload)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(counts[held_out == 0].sum())], pa.int64()),
                     pa.array([int((held_out == 0).sum())], pa.int64())], ["tokens", "texts"])

    size = counted.mapInArrow(sizes, "tokens long, texts long").agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum("texts"), F.lit(0)).alias("texts")).first()
    distinct = ones.agg(F.coalesce(F.sum("fresh"), F.lit(0))).first()[0]
    model = Model(size["tokens"], distinct, size["texts"], np.empty((0, 3)))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                found, times = _held_out_counts(payload, model)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[:, k]) for k in range(3)] + [pa.array(times)],
                    ["bucket", "high", "low", "times"])

    # As many rows as the grid has cells at most, whatever the corpus.
    found = counted.mapInArrow(cells, "bucket long, high long, low long, times long").groupBy(
        "bucket", "high", "low").agg(F.sum("times").alias("times")).toArrow()
    grid = np.stack([np.asarray(found.column(c)) for c in ("bucket", "high", "low")], axis=1)
    order = np.lexsort(grid.T)
    weights = learn(grid[order], np.asarray(found.column("times"))[order], distinct)
    return Model(size["tokens"], distinct, size["texts"], weights), counted


def score(model: Model, counted: DataFrame, id: str = "doc_id") -> DataFrame:
    """One row per text: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    even = np.log10(model.tokens + 0.1 * (model.distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                ids, valid, held_out, counts, unigrams, bigrams = exchange.unpack(payload)
                first = np.cumsum(counts) - counts
                add = lambda v: np.add.reduceat(v, first)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64(), mask=valid == 0), pa.array(held_out == 1),
                    pa.array(counts), pa.array(add((unigrams > 0).astype(np.int64))),
                    pa.array(np.full(len(ids), model.tokens, np.int64)),
                    pa.array(add(np.log10(unigrams + 0.1)) - counts * even),
                    pa.array(add(model.scores(counts, unigrams, bigrams))),
                ], ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return counted.mapInArrow(
        run, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double").withColumnRenamed("id", id)
