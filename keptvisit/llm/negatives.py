"""Hard negatives from Hilbert-ordered blocks with zone maps.

Rows are laid out along a Hilbert curve and written as Parquet rows of one block
each, with the smallest and largest value of every dimension and the labels it
holds. Interval arithmetic over these zone maps gives bounds for the product of
an anchor with any row of a block. Only blocks whose bounds reach what an anchor
still looks for are read: first for its positives, its nearest rows of the same
label, where its own block gives the score to beat; then for its windows, the
scores of other labels from `least` to 100 % of a positive's score. Every anchor
and block that may matter meet, so the result is exact.

The planning step compares anchors with zone maps in bounded groups; blocks and
anchors then meet in tasks that hold one run of blocks and one batch of anchors.

Components become floor(256 * x); scores are integer inner products, computed in
doubles where these hold them exactly and in 64-bit integers elsewhere.

Defined cases: rows without id, label or vector or with null or non-finite
components take no part, nor do rows whose score with itself might not fit a
long; of rows of one id the one with the smallest label, then the smallest
vector, takes part; vectors meet those of their own length only; an empty vector
scores 0; an anchor without positives or without rows in a window gives no rows
there; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keptvisit.llm import groups
from keptvisit.session import shuffle_partitions, write_out

SCALE = 256
POSITIVES = NEGATIVES = 5
LEAST = 80
BLOCK, RUN, BATCH_RUNS = 1024, 8, 64
PLAN_BLOCKS, PLAN_ANCHORS = 16384, 16384
CURVE_DIMENSIONS, CURVE_BITS = 64, 2

_ROWS = "id long, label long, size int, vector binary"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of small whole numbers on the Hilbert curve, as rows of bytes.

    The cell numbers are transposed to the curve's index by undoing its
    rotations from the highest bit down, then Gray decoded.
    """
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    level = top
    while level > 1:
        rest = np.uint32(level - 1)
        for d in range(n):
            turned = (x[d] & np.uint32(level)) != 0
            swapped = np.where(turned, 0, (x[0] ^ x[d]) & rest).astype(np.uint32)
            x[0] ^= np.where(turned, rest, swapped).astype(np.uint32)
            x[d] ^= swapped
        level >>= 1
    for d in range(1, n):
        x[d] ^= x[d - 1]
    flip = np.zeros(x.shape[1], np.uint32)
    level = top
    while level > 1:
        flip ^= np.where(x[n - 1] & np.uint32(level), np.uint32(level - 1), 0).astype(np.uint32)
        level >>= 1
    x ^= flip
    planes = [(x >> np.uint32(bit)) & 1 for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    largest = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if largest < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest product of each anchor with any point of each box.

    In doubles, widened by more than their rounding can take away.
    """
    a, low, high = (m.astype(np.float64) for m in (anchors, low, high))
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    slack = 1e-9 * (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T)
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def _label_bits(labels: np.ndarray) -> np.ndarray:
    return np.left_shift(np.uint64(1), np.mod(labels, 64).astype(np.uint64))


def first_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores first, then smaller ids."""
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def usable(vectors: DataFrame, shifted: Column, id: str, vector: str, label: str) -> DataFrame:
    """id, label, size and the whole-number vector (as bytes) of the rows that take part."""
    cells = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**50))
    rows = vectors.filter(
        F.col(id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite
    ).select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
             cells.alias("cells"))
    square = F.aggregate("cells", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    largest = F.greatest(F.lit(0.0), *[F.coalesce(f("cells").cast("double"), F.lit(0.0))
                                       for f in (F.array_max, lambda c: -F.array_min(c))])
    rows = rows.filter((square < 2.0**62) & (largest < 2.0**31 - 1))
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, shifted).otherwise(F.col("label")))
    repeated = write_out(
        rows.groupBy("id").count().filter("count > 1").select("id"), "repeated")
    if not repeated.isEmpty():
        one = rows.join(repeated, "id", "left_semi").groupBy("id").agg(
            F.min(F.struct("label", "cells")).alias("row")).select("id", "row.*")
        rows = rows.join(repeated, "id", "left_anti").unionByName(one)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cells")
            sizes = np.asarray(cells.value_lengths()).astype(np.int32)
            flat = np.asarray(cells.flatten()).astype("<i4")
            ends = np.cumsum(sizes)
            packed = [flat[end - n:end].tobytes() for end, n in zip(ends, sizes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(sizes), pa.array(packed, pa.binary())],
                ["id", "label", "size", "vector"])

    return rows.mapInArrow(run, _ROWS)


def _matrix(column: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<i4").astype(np.int64).reshape(len(column), size)


def _spread(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and deviation of every dimension, per vector length: exact totals of all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            sizes = np.asarray(batch.column("size"))
            for size in np.unique(sizes).tolist():
                mine = _matrix(batch.column("vector").filter(pa.array(sizes == size)).to_pylist(), size)
                mine = mine[:, :CURVE_DIMENSIONS].astype(np.float64)
                new = [np.full(mine.shape[1], float(len(mine))), mine.sum(axis=0), (mine**2).sum(axis=0)]
                totals[size] = [a + b for a, b in zip(totals.get(size, [0, 0, 0]), new)]
        for size, (n, one, two) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), size, np.int32)), pa.array(np.arange(len(n), dtype=np.int32)),
                 pa.array(n), pa.array(one), pa.array(two)], ["size", "at", "n", "one", "two"])

    found = rows.select("size", "vector").mapInArrow(
        run, "size int, at int, n double, one double, two double").groupBy("size", "at").agg(
        F.sum("n").alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two"))
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    # One row per dimension of each vector length.
    table = found.orderBy("size", "at").toPandas()
    for size, part in table.groupby("size"):
        mean = (part["one"] / part["n"]).to_numpy()
        out[int(size)] = mean, np.sqrt(np.maximum((part["two"] / part["n"]).to_numpy() - mean**2, 1e-9))
    return out


def in_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows along the Hilbert curve, a block of at most `block` per Parquet row, with its zone map."""
    spread = _spread(rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("size"))
            where = np.empty(batch.num_rows, object)
            where[:] = b""
            for size in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == size)
                if size == 0:
                    continue
                cells = _matrix(batch.column("vector").take(pa.array(mine)).to_pylist(), size)
                mean, deviation = spread[size]
                scaled = (cells[:, :CURVE_DIMENSIONS] - mean) / deviation
                # Cell borders at the quartiles of a normal distribution.
                cell = np.digitize(scaled, [-0.674, 0.0, 0.674])
                for at, key in zip(mine, hilbert(cell, CURVE_BITS)):
                    where[at] = key.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(where.tolist(), pa.binary())], [*batch.schema.names, "place"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId() << 32, 0, None

        def packed(table: pa.Table) -> pa.RecordBatch:
            nonlocal made
            size = table.column("size")[0].as_py()
            cells = _matrix(table.column("vector").to_pylist(), size)
            labels = np.asarray(table.column("label"))
            out = pa.RecordBatch.from_pylist([{
                "run": part + made // RUN, "batch": part + made // RUN // BATCH_RUNS, "size": size,
                "ids": np.asarray(table.column("id")).tobytes(), "labels": labels.tobytes(),
                "vector": cells.astype("<i4").tobytes(),
                "low": cells.min(axis=0).astype("<i4").tobytes(),
                "high": cells.max(axis=0).astype("<i4").tobytes(),
                "kinds": int(np.bitwise_or.reduce(_label_bits(labels)).view(np.int64)),
            }], schema=pa.schema([
                ("run", pa.int64()), ("batch", pa.int64()), ("size", pa.int32()), ("ids", pa.binary()),
                ("labels", pa.binary()), ("vector", pa.binary()), ("low", pa.binary()),
                ("high", pa.binary()), ("kinds", pa.int64())]))
            made += 1
            return out

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows:
                sizes = np.asarray(held.column("size"))
                same = int(np.argmax(sizes != sizes[0])) if (sizes != sizes[0]).any() else len(sizes)
                if same == len(sizes) and same < block:
                    break
                yield packed(held.slice(0, min(same, block)))
                if same <= block and same < len(sizes):
                    # A run of blocks holds vectors of one length.
                    made = -(-made // RUN) * RUN
                held = held.slice(min(same, block))
        if held is not None and held.num_rows:
            yield packed(held)

    laid = rows.mapInArrow(place, _ROWS + ", place binary")
    laid = laid.repartitionByRange(shuffle_partitions(rows.sparkSession), "size", "place", "id")
    return write_out(
        laid.sortWithinPartitions("size", "place", "id").mapInArrow(
            pack, "run long, batch long, size int, ids binary, labels binary, vector binary, "
                  "low binary, high binary, kinds long"), "blocks")


def anchors_of(blocks: DataFrame, every: int, k: int) -> DataFrame:
    """The anchors of all blocks, each with the score of its k-th positive in its own block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
                mine = np.flatnonzero(ids % every == 0)
                if not len(mine):
                    continue
                cells = np.frombuffer(row["vector"], "<i4").astype(np.int64).reshape(len(ids), row["size"])
                scores = products(cells[mine], cells)
                floor = np.full(len(mine), -np.inf)
                for n, at in enumerate(mine):
                    same = labels == labels[at]
                    same[at] = False
                    if same.sum() >= k:
                        floor[n] = np.partition(scores[n][same], -k)[-k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mine), row["batch"])), pa.array(np.full(len(mine), row["size"], np.int32)),
                     pa.array(ids[mine]), pa.array(labels[mine]),
                     pa.array([cells[at].astype("<i4").tobytes() for at in mine], pa.binary()),
                     pa.array(floor)], ["batch", "size", "id", "label", "vector", "floor"])

    found = blocks.select("batch", "size", "ids", "labels", "vector").mapInArrow(
        run, "batch long, size int, id long, label long, vector binary, floor double")
    return write_out(found.withColumn("windows", F.lit(None).cast("binary")), "anchors")


def wanted(low: np.ndarray, high: np.ndarray, floor: np.ndarray, windows: list) -> np.ndarray:
    """Which blocks (columns) each anchor (row) must read: for windows if it has some, else for positives."""
    need = high >= floor[:, None]
    for row, window in enumerate(windows):
        if window is not None:
            edges = np.frombuffer(window, np.int64).reshape(-1, 3)
            need[row] = ((high[row][None] >= edges[:, :1]) & (low[row][None] <= edges[:, 1:2])).any(axis=0)
    return need


def plan(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """The (run, batch) pairs of blocks and anchors that must meet; a run has vectors of one size."""
    zones = blocks.select(
        "run", "size", "low", "high", "kinds", F.lit(0).alias("asks"), F.lit(0.0).alias("floor"),
        F.lit(None).cast("binary").alias("windows"))
    asking = anchors.select(
        F.col("batch").alias("run"), "size", F.col("vector").alias("low"), F.lit(b"").alias("high"),
        F.col("label").alias("kinds"), F.lit(1).alias("asks"), "floor", "windows")
    at_least = shuffle_partitions(blocks.sparkSession)
    n_zones = -(-blocks.count() // PLAN_BLOCKS) or 1
    n_asking = max(at_least, -(-anchors.count() // PLAN_ANCHORS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    share = lambda n: F.pmod(F.xxhash64("run"), F.lit(n)).cast("int")
    met = zones.select("*", share(n_zones).alias("z"), every(n_asking).alias("a")).unionByName(
        asking.select("*", every(n_zones).alias("z"), share(n_asking).alias("a")))

    def decode(table: pa.Table) -> groups.Columns:
        out = groups.numbers(table, "run", "size", "kinds", "asks", "floor")
        for name in ("low", "high", "windows"):
            out[name] = np.empty(table.num_rows, object)
            out[name][:] = table.column(name).to_pylist()
        return out

    def work(columns: groups.Columns) -> groups.Columns | None:
        asks = columns["asks"] == 1
        if asks.all() or not asks.any():
            return None
        size = int(columns["size"][0])
        low, high = (_matrix(list(columns[c][~asks]), size) for c in ("low", "high"))
        runs, kinds = columns["run"][~asks], columns["kinds"][~asks].view(np.uint64)
        found = set()
        points, batches = columns["low"][asks], columns["run"][asks]
        labels, floor, windows = (columns[c][asks] for c in ("kinds", "floor", "windows"))
        for at in range(0, len(points), 256):
            here = slice(at, at + 256)
            least, most = bounds(_matrix(list(points[here]), size), low, high)
            need = wanted(least, most, floor[here], list(windows[here]))
            bits = _label_bits(labels[here])[:, None]
            for n, window in enumerate(windows[here]):
                need[n] &= (kinds & bits[n] != 0) if window is None else (kinds != bits[n])
            rows, cols = np.nonzero(need)
            found.update(zip(runs[cols].tolist(), batches[here][rows].tolist()))
        if not found:
            return None
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        return {"run": pairs[:, 0], "batch": pairs[:, 1], "size": np.full(len(pairs), size, np.int32)}

    pairs = groups.run_groups(met, ["size", "z", "a"], "run long, batch long, size int", decode, work)
    return write_out(pairs.distinct(), "pairs")


def _meet(blocks: DataFrame, anchors: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of every pair: the run's blocks and the batch's anchors."""
    no = lambda kind: F.lit(None).cast(kind)
    boxes = blocks.drop("batch", "size", "kinds").join(pairs.drop("size"), "run").select(
        "run", "batch", F.lit(0).alias("asks"), F.lit(0).cast("long").alias("id"),
        F.lit(0).cast("long").alias("label"), "vector", "ids", "labels", "low", "high",
        F.lit(0.0).alias("floor"), no("binary").alias("windows"))
    asking = anchors.join(pairs, ["batch", "size"]).select(
        "run", "batch", F.lit(1).alias("asks"), "id", "label", "vector",
        *[no("binary").alias(c) for c in ("ids", "labels", "low", "high")], "floor", "windows")
    return boxes.unionByName(asking)


def _decode(table: pa.Table) -> groups.Columns:
    out = groups.numbers(table, "asks", "id", "label", "floor")
    for name in ("vector", "ids", "labels", "low", "high", "windows"):
        out[name] = np.empty(table.num_rows, object)
        out[name][:] = table.column(name).to_pylist()
    return out


def _scored(columns: groups.Columns):
    """For each anchor and block that must meet: the anchor's row, ids, labels and scores of the block."""
    asks = columns["asks"] == 1
    if asks.all() or not asks.any():
        return
    size = len(columns["vector"][asks][0]) // 4
    points = _matrix(list(columns["vector"][asks]), size)
    floor, windows = columns["floor"][asks], columns["windows"][asks]
    for block in np.flatnonzero(~asks):
        ids, labels = (np.frombuffer(columns[c][block], np.int64) for c in ("ids", "labels"))
        low, high = (_matrix([columns[c][block]], size) for c in ("low", "high"))
        least, most = bounds(points, low, high)
        reading = np.flatnonzero(wanted(least, most, floor, list(windows))[:, 0])
        cells = np.frombuffer(columns["vector"][block], "<i4").astype(np.int64).reshape(len(ids), size)
        for at in range(0, len(reading), 512):
            some = reading[at:at + 512]
            for row, scores in zip(some, products(points[some], cells)):
                yield row, ids, labels, scores


def _best(kept: dict, key, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
    """Add to what is kept under a key; only the first k stay."""
    if key in kept:
        ids, scores = np.concatenate([kept[key][0], ids]), np.concatenate([kept[key][1], scores])
    top = first_of(scores, ids, k)
    kept[key] = ids[top], scores[top]


def positives(blocks: DataFrame, anchors: DataFrame, k: int = POSITIVES) -> DataFrame:
    """anchor_id, positive_id, positive_score: the k nearest other rows of each anchor's label."""
    def work(columns: groups.Columns) -> groups.Columns | None:
        anchor = columns["id"][columns["asks"] == 1]
        label = columns["label"][columns["asks"] == 1]
        kept: dict = {}
        for row, ids, labels, scores in _scored(columns):
            same = np.flatnonzero((labels == label[row]) & (ids != anchor[row]))
            if len(same):
                _best(kept, row, ids[same], scores[same], k)
        if not kept:
            return None
        return {"anchor_id": np.concatenate([np.full(len(i), anchor[row]) for row, (i, _) in kept.items()]),
                "positive_id": np.concatenate([i for i, _ in kept.values()]),
                "positive_score": np.concatenate([s for _, s in kept.values()])}

    found = groups.run_groups(
        _meet(blocks, anchors, plan(blocks, anchors)), ["run", "batch"],
        "anchor_id long, positive_id long, positive_score long", _decode, work)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return write_out(
        found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k), "positives")


def with_windows(anchors: DataFrame, found: DataFrame, least: int = LEAST) -> DataFrame:
    """Anchors that have a window: from `least` percent of a positive's score up to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [sorted(set(s)) for s in batch.column("scores").to_pylist()]
            # Rounded up; a positive with a score below 0 has no window.
            edges = [np.array([(-(-least * s // 100), s, s) for s in own], np.int64).tobytes() for own in scores]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(edges, pa.binary())], ["id", "windows"])

    # At most k scores an anchor.
    edges = found.filter("positive_score >= 0").groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list("positive_score").alias("scores")).mapInArrow(run, "id long, windows binary")
    return write_out(anchors.drop("windows").join(edges, "id").select(*anchors.columns), "windows")


def mine(
    vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    every: int = 100, k: int = POSITIVES, n: int = NEGATIVES, least: int = LEAST, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by `every`. Before anything else
    the label of rows whose id is divisible by 7 moves on by one of ten.
    """
    rows = write_out(usable(vectors, (F.col("label") + 1) % 10, id, vector, label), "vectors")
    blocks = in_blocks(rows, block)
    anchors = anchors_of(blocks, every, k)
    found = positives(blocks, anchors, k)
    asking = with_windows(anchors, found, least)

    def work(columns: groups.Columns) -> groups.Columns | None:
        asks = columns["asks"] == 1
        anchor, label = columns["id"][asks], columns["label"][asks]
        edges = [np.frombuffer(w, np.int64).reshape(-1, 3) for w in columns["windows"][asks]]
        kept: dict = {}
        for row, ids, labels, scores in _scored(columns):
            spans = edges[row]
            far = np.flatnonzero((labels != label[row]) & (scores >= spans[0, 0]) & (scores <= spans[-1, 1]))
            if not len(far):
                continue
            far = far[np.lexsort((ids[far], -scores[far]))]
            falling = -scores[far]
            for low, high, _ in spans.tolist():
                start = np.searchsorted(falling, -high)
                some = far[start:start + n]
                some = some[scores[some] >= low]
                if len(some):
                    _best(kept, (row, high), ids[some], scores[some], n)
        if not kept:
            return None
        full = lambda value: np.concatenate([
            np.full(len(i), value(key)) for key, (i, _) in kept.items()]).astype(np.int64)
        return {"anchor_id": full(lambda key: anchor[key[0]]), "positive_score": full(lambda key: key[1]),
                "negative_id": np.concatenate([i for i, _ in kept.values()]),
                "negative_score": np.concatenate([s for _, s in kept.values()])}

    near = groups.run_groups(
        _meet(blocks, asking, plan(blocks, asking)), ["run", "batch"],
        "anchor_id long, positive_score long, negative_id long, negative_score long", _decode, work)
    order = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    # Positives of equal scores share their window.
    return found.drop("place").join(ranked, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle(table: str = "embeddings") -> str:
    """DuckDB SQL for the rows of `mine` on tables without repeated ids."""
    return f"""
with t as (
  select vec_id as id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end) as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from {table}
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.id as anchor, t.id as other, a.label = t.label as same,
    cast(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * t.v[i])) as bigint) as score
  from t a, t where a.id % 100 = 0 and t.id <> a.id and len(a.v) = len(t.v)),
p as (
  select * from s where same
  qualify row_number() over (partition by anchor order by score desc, other) <= {POSITIVES}),
n as (
  select p.anchor as anchor_id, p.other as positive_id, s.other as negative_id,
    p.score as positive_score, s.score as negative_score,
    row_number() over (partition by p.anchor, p.other order by s.score desc, s.other) as rank
  from p join s on s.anchor = p.anchor and not s.same
    and {LEAST} * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from n where rank <= {NEGATIVES}"""
