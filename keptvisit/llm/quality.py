"""Quality classifier by co-training of a text view and a page-metadata view.

The text view sees the words that separate good from bad labelled documents and
the shape of the text. The metadata view sees language, source and size. Each is
a logistic regression; over some rounds each labels all unlabelled documents it
is sure of for the other one. Their features are written once, in packed blocks;
a round takes sums of slopes and curvatures over all blocks, so that no document
leaves its task. At the end both are calibrated on labelled
documents that neither was fitted on, and a regression on the calibrated
log-odds combines them.

A document is good when its quality label is 1 and its toxicity label is not 1.

Bounds, all parameters: of labelled documents at most `labelled`, those with the
smallest hashes of their ids, are learned from; all other documents count as
unlabelled. The models use at most `words` words. Pseudo-labels together weigh no
more than the labels. Every document is scored, on its whole text.

Defined cases: a null text is empty; null metadata are a value of their own; a
label row without quality, and labels of ids that no document has, are left
out; several labels of one id count as bad if one is; without labels of both
kinds every document gets the share of good labels (1 without labels) and is
kept; every input row gives a row; an empty table gives no rows.
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

from keptvisit.session import shuffle_partitions, write_out

LABELLED, WORDS = 12000, 300
LEAST_DOCUMENTS = 5
ROUNDS, SURE, STEPS = 3, 0.98, 6
# What a pseudo-label weighs at most.
PSEUDO_WEIGHT = 0.5
POOL_ROWS = 200
META_BUCKETS = 64
ACCEPT = 0.5

_SHAPE = np.full(256, 7, np.int8)
for _chars, _kind in ((b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 0), (bytes(range(128, 256)), 0),
                      (b"0123456789", 1), (b" \t", 2), (b"\r\n", 3), (b"|", 4), (b".", 5), (b",", 6)):
    _SHAPE[list(_chars)] = _kind


def word_lists(texts: pa.Array) -> pa.ListArray:
    """The runs of letters and digits of each text, in lower case, with some empty ones."""
    return pc.split_pattern_regex(pc.utf8_lower(texts), r"[^\p{L}\p{N}]+")


def text_features(texts: pa.Array, vocabulary: pa.Array) -> np.ndarray:
    """Per text which words of the vocabulary it has, and numbers for its shape."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    lists = word_lists(texts)
    flat = lists.flatten().dictionary_encode()
    owner = np.repeat(np.arange(n), np.asarray(lists.value_lengths()))
    codes = np.asarray(flat.indices).astype(np.int64)
    size = max(1, len(flat.dictionary))
    pairs, times = np.unique(owner * size + codes, return_counts=True)
    doc, code = pairs // size, pairs % size
    known = np.asarray(pc.fill_null(pc.index_in(flat.dictionary, vocabulary), -1)) if len(flat.dictionary) else np.empty(0, int)
    out = np.zeros((n, len(vocabulary) + 14), np.float32)
    hit = known[code] >= 0
    out[doc[hit], known[code[hit]]] = 1
    total = np.maximum(np.bincount(owner, minlength=n), 1)
    distinct = np.bincount(doc, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, doc, times)
    data = np.frombuffer(b"".join([t.as_py().encode() for t in texts]), np.uint8)
    shape = _SHAPE[data]
    bounds = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(texts)))])
    length = np.maximum(np.diff(bounds), 1)
    at = len(vocabulary)
    shares = []
    for kind in range(8):
        running = np.concatenate([[0], np.cumsum(shape == kind)])
        shares.append(np.diff(running[bounds]) / length)
    lines = shares[3] * length + 1
    out[:, at:] = np.stack([
        *shares, np.log1p(length), distinct / total, most / total, length / total,
        np.log(total / lines), np.log(total / (shares[5] * length + 1)),
    ], axis=1)
    return out


def meta_features(columns: list[pa.Array], size: pa.Array) -> np.ndarray:
    """Per row one hashed bucket per column, and bins of the size."""
    n = len(size)
    out = np.zeros((n, len(columns) * META_BUCKETS + 24), np.float32)
    for number, column in enumerate(columns):
        coded = column.dictionary_encode()
        buckets = np.array([xxhash.xxh3_64_intdigest(str(v)) % META_BUCKETS
                            for v in [*coded.dictionary.to_pylist(), None]])
        which = np.asarray(pc.fill_null(coded.indices, len(coded.dictionary)))
        out[np.arange(n), number * META_BUCKETS + buckets[which]] = 1
    scale = np.log2(np.maximum(np.nan_to_num(np.asarray(pc.fill_null(size.cast(pa.float64()), 0.0))), 0) + 1)
    out[np.arange(n), len(columns) * META_BUCKETS + np.minimum(scale.astype(int), 23)] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Weights of a ridge logistic regression, the intercept last, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ beta)
        slope = x.T @ (weight * (y - p)) - penalty * beta
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        beta += step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-5:
            break
    return beta


@dataclass(frozen=True)
class View:
    """A view's regression with the scaling of its inputs, and its calibration."""

    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> View:
        mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        view = View(mean, scale, np.zeros(x.shape[1] + 1))
        return View(mean, scale, fit_logistic(view.scaled(x), y, weight, ridge))

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x) @ self.beta[:-1] + self.beta[-1]

    def calibrated(self, x: np.ndarray, y: np.ndarray) -> View:
        beta = fit_logistic(self.raw(x)[:, None], y, np.ones(len(y)), 1e-3)
        return View(self.mean, self.scale, self.beta, float(beta[0]), float(beta[1]))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.raw(x) + self.shift, -20, 20)


@dataclass(frozen=True)
class Model:
    """The vocabulary, both views and the weights that combine their log-odds."""

    vocabulary: list[str]
    text: View | None
    page: View | None
    mix: np.ndarray | None
    share: float

    def odds(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of the text view, the metadata view and both."""
        if self.text is None:
            same = np.full(len(text), self.share)
            return same, same, same
        a, b = self.text.log_odds(text), self.page.log_odds(page)
        both = np.stack([a, b], axis=1) @ self.mix[:-1] + self.mix[-1]
        return _sigmoid(a), _sigmoid(b), _sigmoid(both)


Rounds = list[tuple[View, View]]


def pool_sums(
    inputs: tuple[np.ndarray, np.ndarray], past: Rounds, now: tuple[View, View], sure: float, curved: bool,
) -> list[np.ndarray]:
    """For each view the number of rows the other one was sure of, their slope and their curvature.

    A row keeps the last label that the other view was sure of in the past rounds.
    """
    out = []
    for k in (0, 1):
        told = np.full(len(inputs[0]), np.nan)
        for views in past:
            p = _sigmoid(views[1 - k].log_odds(inputs[1 - k]))
            told = np.where((p >= sure) | (p <= 1 - sure), (p >= 0.5).astype(float), told)
        has = ~np.isnan(told)
        x = np.hstack([now[k].scaled(inputs[k][has]), np.ones((has.sum(), 1))])
        p = _sigmoid(x @ now[k].beta)
        out += [np.array([float(has.sum())]), x.T @ (told[has] - p)]
        if curved:
            out.append((x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x)
    return out


def array_pool(text: np.ndarray, page: np.ndarray, sure: float = SURE):
    """The sums over two arrays."""
    return lambda past, now, curved: pool_sums((text, page), past, now, sure, curved)


def pack_rows(rows: np.ndarray, bits: int) -> bytes:
    """The first `bits` columns, which hold 0 or 1, as bits, then the others as they are."""
    return np.packbits(rows[:, :bits].astype(bool), axis=1).tobytes() + rows[:, bits:].tobytes()


def unpack_rows(packed: pa.Buffer, width: int, bits: int) -> np.ndarray:
    low = -(-bits // 8)
    data = np.frombuffer(packed, np.uint8)
    n = len(data) // (low + 4 * (width - bits))
    out = np.empty((n, width), np.float32)
    out[:, :bits] = np.unpackbits(data[:n * low].reshape(n, low), axis=1, count=bits) if bits else 0
    out[:, bits:] = np.frombuffer(data[n * low:].tobytes(), np.float32).reshape(n, width - bits)
    return out


def frame_pool(
    blocks: DataFrame, widths: tuple[int, int], bits: tuple[int, int] = (0, 0), sure: float = SURE,
):
    """The sums over packed blocks (a, b), added up in two steps; a few numbers per task come back."""
    def sums(past: Rounds, now: tuple[View, View], curved: bool) -> list[np.ndarray]:
        shapes = [shape for w in widths for shape in [(1,), (w + 1,), *([(w + 1, w + 1)] if curved else [])]]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for row in zip(batch.column("a"), batch.column("b")):
                    inputs = tuple(unpack_rows(v.as_buffer(), *shape) for v, shape in zip(row, zip(widths, bits)))
                    found = np.concatenate([v.ravel() for v in pool_sums(inputs, past, now, sure, curved)])
                    total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for value in batch.column("sums"):
                    found = np.frombuffer(value.as_buffer())
                    total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        some = int(shuffle_partitions(blocks.sparkSession) ** 0.5) + 1
        rows = blocks.mapInArrow(run, "sums binary").repartition(some).mapInArrow(add, "sums binary").collect()
        total = sum((np.frombuffer(r["sums"]) for r in rows), np.zeros(sum(int(np.prod(s)) for s in shapes)))
        return [v.reshape(s) for v, s in zip(
            np.split(total, np.cumsum([int(np.prod(s)) for s in shapes])[:-1]), shapes)]

    return sums


def co_train(
    text: np.ndarray, page: np.ndarray, y: np.ndarray, calibrate: np.ndarray, pool, rounds: int = ROUNDS,
) -> tuple[View, View, np.ndarray]:
    """Both calibrated views and the combining weights.

    `calibrate` marks the labelled rows kept for calibration; `pool` gives sums over
    the unlabelled documents. A pseudo-label goes from the view that is sure to the
    other one only. A round starts from the views of the last one, takes the
    curvature once and then a few steps.
    """
    train = ~calibrate
    inputs, ridges = (text, page), (5.0, 10.0)
    adjust = lambda view, k: view.calibrated(inputs[k][calibrate], y[calibrate])
    views = tuple(adjust(View.fit(inputs[k][train], y[train], np.ones(train.sum()), ridges[k]), k) for k in (0, 1))
    known = [np.hstack([views[k].scaled(inputs[k][train]), np.ones((train.sum(), 1))]) for k in (0, 1)]
    penalties = []
    for k in (0, 1):
        penalties.append(np.full(known[k].shape[1], ridges[k]))
        penalties[k][-1] = 1e-6
    past: Rounds = []
    for _ in range(rounds):
        past.append(views)
        curves: list[np.ndarray] = []
        for step in range(STEPS):
            found = pool(past, views, step == 0)
            size = len(found) // 2
            moved = 0.0
            new = []
            for k in (0, 1):
                count, slope, *curve = found[k * size:(k + 1) * size]
                weight = min(PSEUDO_WEIGHT, train.sum() / max(count[0], 1))
                p = _sigmoid(known[k] @ views[k].beta)
                if step == 0:
                    own = (known[k] * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ known[k]
                    curves.append(own + weight * curve[0] + np.diag(penalties[k]))
                pull = known[k].T @ (y[train] - p) + weight * slope - penalties[k] * views[k].beta
                change = np.linalg.solve(curves[k], pull)
                change /= max(1.0, np.abs(change).max())
                moved = max(moved, float(np.abs(change).max()))
                new.append(View(views[k].mean, views[k].scale, views[k].beta + change))
            views = tuple(new)
            if moved < 1e-3:
                break
        views = tuple(adjust(views[k], k) for k in (0, 1))
    odds = np.stack([v.log_odds(x[calibrate]) for v, x in zip(views, inputs)], axis=1)
    return views[0], views[1], fit_logistic(odds, y[calibrate], np.ones(calibrate.sum()), 0.1)


def _inputs(docs: DataFrame, text: str, metadata: tuple[str, ...], size: str):
    return [F.col(text).cast("string").alias("text"),
            *[F.col(c).cast("string").alias(f"meta{n}") for n, c in enumerate(metadata)],
            F.col(size).cast("double").alias("size")]


def fit(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text",
    metadata: tuple[str, ...] = ("lang", "source"), size: str = "n_chars",
    labelled: int = LABELLED, words: int = WORDS, rounds: int = ROUNDS,
) -> Model:
    """A model from a bounded sample of the labelled documents and all others."""
    truth = labels.filter("quality is not null").select(
        F.col(id).cast("long").alias("_id"),
        ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1)).cast("double").alias("good"),
    ).groupBy("_id").agg(F.min("good").alias("good"))
    ids = docs.select(F.col(id).cast("long").alias("_id")).filter("_id is not null").join(truth, "_id")
    order = F.xxhash64(F.lit("sample"), "_id")
    chosen = write_out(ids.distinct().orderBy(order, "_id").limit(labelled), "chosen")
    names = [f"meta{n}" for n in range(len(metadata))]
    sample = write_out(
        docs.select(F.col(id).cast("long").alias("_id"), *_inputs(docs, text, metadata, size))
        .join(F.broadcast(chosen), "_id"), "sample")
    share = sample.agg(F.avg("good"), F.count("good")).first()
    if not share[1] or share[0] in (0.0, 1.0):
        return Model([], None, None, None, 1.0 if share[0] is None else float(share[0]))
    vocabulary = _vocabulary(sample, words)
    known = pa.array(vocabulary, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 300):
                part = batch.slice(at, 300)
                a = text_features(part.column("text"), known)
                b = meta_features([part.column(n) for n in names], part.column("size"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("good"),
                     pa.array([r.tobytes() for r in a], pa.binary()),
                     pa.array([r.tobytes() for r in b], pa.binary())], ["_id", "good", "a", "b"])

    # Bounded by the sample's size and the number of words.
    found = sample.mapInArrow(run, "_id long, good double, a binary, b binary").orderBy("_id").toArrow()
    y = np.asarray(found.column("good").combine_chunks().to_numpy(zero_copy_only=False), np.float64)
    a, b = (np.frombuffer(b"".join(found.column(c).to_pylist()), np.float32).reshape(len(y), -1) for c in "ab")
    hashes = np.array([xxhash.xxh3_64_intdigest(str(i)) % 5 for i in found.column("_id").to_pylist()])
    calibrate = hashes == 0
    for rows in (calibrate, ~calibrate):
        if len(np.unique(y[rows])) < 2:
            return Model([], None, None, None, float(share[0]))

    # Words and metadata are 0 or 1, the shape of a text is numbers.
    bits = len(vocabulary), b.shape[1]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, POOL_ROWS):
                part = batch.slice(at, POOL_ROWS)
                own = (text_features(part.column("text"), known),
                       meta_features([part.column(n) for n in names], part.column("size")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pack_rows(*m)], pa.binary()) for m in zip(own, bits)], ["a", "b"])

    others = docs.select(F.col(id).cast("long").alias("_id"), *_inputs(docs, text, metadata, size)).join(
        F.broadcast(chosen.select("_id")), "_id", "left_anti").drop("_id")
    blocks = write_out(others.mapInArrow(packed, "a binary, b binary"), "pool")
    text_view, page_view, mix = co_train(
        a, b, y, calibrate, frame_pool(blocks, (a.shape[1], b.shape[1]), bits), rounds)
    return Model(vocabulary, text_view, page_view, mix, float(share[0]))


def _vocabulary(sample: DataFrame, words: int) -> list[str]:
    """The words whose log-odds of good against bad stand out most from chance, half for each side."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = word_lists(pc.fill_null(batch.column("text"), ""))
            for good, own in zip(batch.column("good").to_pylist(), lists):
                found = own.values.unique()
                yield pa.RecordBatch.from_arrays(
                    [found, pa.array(np.full(len(found), good))], ["word", "good"])

    total = sample.agg(F.sum("good").alias("good"), F.count("good").alias("all")).first()
    good, bad = float(total["good"]), float(total["all"] - total["good"])
    counts = sample.mapInArrow(run, "word string, good double").filter("word != ''").groupBy("word").agg(
        F.sum("good").alias("g"), F.count("good").alias("n")).filter(F.col("n") >= LEAST_DOCUMENTS)
    g, b = F.col("g") + 0.5, F.col("n") - F.col("g") + 0.5
    odds = F.log(g / (good + 1 - g)) - F.log(b / (bad + 1 - b))
    chance = F.sqrt(1 / g + 1 / b)
    counts = write_out(counts.select("word", (odds / chance).alias("z")), "word-odds")
    rows = counts.filter("z < 0").orderBy("z", "word").limit(words // 2).unionByName(
        counts.filter("z > 0").orderBy(F.desc("z"), "word").limit(words - words // 2))
    return sorted(row["word"] for row in rows.collect())


def score(
    docs: DataFrame, model: Model, carried: list, *, text: str = "text",
    metadata: tuple[str, ...] = ("lang", "source"), size: str = "n_chars",
) -> DataFrame:
    """The `carried` columns of every row with text_probability, page_probability and probability."""
    names = [f"meta{n}" for n in range(len(metadata))]
    rows = docs.select(*carried, *_inputs(docs, text, metadata, size))
    kept = [c for c in rows.columns if c not in ("text", "size", *names)]
    known = pa.array(model.vocabulary, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 300):
                part = batch.slice(at, 300)
                odds = model.odds(
                    text_features(part.column("text"), known),
                    meta_features([part.column(n) for n in names], part.column("size")))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], *[pa.array(p, pa.float64()) for p in odds]],
                    [*kept, "text_probability", "page_probability", "probability"])

    schema = rows.select(*kept).schema
    for name in ("text_probability", "page_probability", "probability"):
        schema = schema.add(name, "double")
    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", accept: float = ACCEPT, **names) -> DataFrame:
    """One row per input row: id, both views' probabilities of good, their combination, kept."""
    model = fit(docs, labels, id=id, **names)
    inputs = {k: v for k, v in names.items() if k in ("text", "metadata", "size")}
    rows = score(docs, model, [F.col(id).alias("id")], **inputs)
    keep = F.lit(True) if model.text is None else F.col("probability") >= accept
    return rows.withColumn("kept", keep).withColumnRenamed("id", id)


def accepted(docs: DataFrame, labels: DataFrame, *, accept: float = ACCEPT, **names) -> DataFrame:
    """The rows of `docs` that the classifier keeps, with their columns."""
    model = fit(docs, labels, **names)
    if model.text is None:
        return docs
    inputs = {k: v for k, v in names.items() if k in ("text", "metadata", "size")}
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return score(docs, model, [whole], **inputs).filter(F.col("probability") >= accept).select("doc.*")
