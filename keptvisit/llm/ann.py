"""Nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts: each set of
vertices is halved at the median of its second spectral coordinate. A small
classifier then learns, for a vector, how likely its neighbours lie in each
part. Every vector is indexed under its most probable part; a query goes to its
most probable parts, and what is found there is reranked by the exact inner
product. The number of parts a query visits is the least that reaches the target
recall on sample queries that the classifier did not see.

Parts of any size are cut into chunks, and the queries of a part too; every two
meet in a task of their own, which keeps only the nearest of each query. Equal
vectors of a chunk are scored once, for their smallest ids.

Vectors of each length have partitions of their own; lengths with few vectors
are one part, which is searched whole. The number of parts grows with the
vectors, as far as the sample can tell parts apart.

Bounds, all parameters: the graph and the classifier of a length are fitted on at
most `sample` vectors, those with the smallest hashes of their ids. Every usable
vector is indexed.

Nearness is the largest inner product in double precision, ties go to the
smaller id.

Defined cases: vectors that are null, empty, zero or have null or non-finite
components take no part, nor do rows without id; a query finds vectors of its own
length, but no rows of its own id; repeated rows of one id and vector are
one candidate; fewer candidates than `k` are all returned; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keptvisit.llm import groups
from keptvisit.llm.neardup import matrix, unit, usable
from keptvisit.session import write_out

SAMPLE = 6000
PARTS = 16
NEIGHBOURS = 20
TARGET_RECALL = 0.97
# Vectors a part should have, sample vectors it needs, and vectors of a length that make parts worth while.
PART_VECTORS, PART_SAMPLE, FEW_VECTORS = 4096, 24, 1000
# More rows of part sizes than this are not broadcast.
FEW_PARTS = 10_000
HIDDEN = 64
CHUNK_VECTORS, CHUNK_QUERIES = 8192, 1024
SEED = 31


def nearest_in(vectors: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest inner products of each query among the vectors."""
    out = []
    for at in range(0, len(queries), 1000):
        scores = queries[at:at + 1000] @ vectors.T
        out.append(np.argpartition(-scores, min(k, scores.shape[1] - 1), axis=1)[:, :k])
    return np.concatenate(out)


def halved(neighbours: np.ndarray, members: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Which members go to the second half: a balanced cut along the graph's second eigenvector."""
    n = len(members)
    place = np.full(len(neighbours), -1)
    place[members] = np.arange(n)
    to = place[neighbours[members]]
    start = np.repeat(np.arange(n), to.shape[1])[to.ravel() >= 0]
    to = to.ravel()[to.ravel() >= 0]
    degree = np.maximum(np.bincount(start, minlength=n) + np.bincount(to, minlength=n), 1)
    root = np.sqrt(degree)
    x = rng.normal(size=n)
    for _ in range(60):
        x -= root * (x @ root) / (root @ root)
        y = x / root
        moved = np.bincount(start, y[to], n) + np.bincount(to, y[start], n)
        x = 0.5 * x + 0.5 * moved / root
        x /= max(np.linalg.norm(x), 1e-300)
    second = np.zeros(n, bool)
    second[np.argsort(x / root, kind="stable")[n // 2:]] = True
    return second


def balanced_parts(neighbours: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """The part of each vertex; parts is a power of two."""
    label = np.zeros(len(neighbours), np.int64)
    count = 1
    while count < parts:
        for part in range(count):
            members = np.flatnonzero(label == part)
            if len(members) > 1:
                label[members[halved(neighbours, members, rng)]] += count
        count *= 2
    return label


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Router:
    """A small network from a vector to the probabilities of the parts, and the parts to visit."""

    layers: tuple[np.ndarray, ...]
    visits: int

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return _softmax(np.tanh(unit(vectors) @ a + b) @ c + d)

    def parts(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """The `count` most probable parts of each vector, the likeliest first."""
        return np.argsort(-self.probabilities(vectors), axis=1, kind="stable")[:, :count]


def train_router(vectors: np.ndarray, wanted: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """Layers fitted to the wanted probabilities by Adam steps on the cross-entropy."""
    x = unit(vectors)
    dim, parts = x.shape[1], wanted.shape[1]
    layers = [rng.normal(size=(dim, HIDDEN)) * (2 / dim) ** 0.5, np.zeros(HIDDEN),
              rng.normal(size=(HIDDEN, parts)) / HIDDEN**0.5, np.zeros(parts)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for step in range(1, 601):
        rows = rng.integers(0, len(x), min(512, len(x)))
        hidden = np.tanh(x[rows] @ layers[0] + layers[1])
        error = (_softmax(hidden @ layers[2] + layers[3]) - wanted[rows]) / len(rows)
        back = error @ layers[2].T * (1 - hidden**2)
        slopes = [x[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
        for k, slope in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope**2
            layers[k] = layers[k] - 0.02 * (first[k] / (1 - 0.9**step)) / (
                np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return tuple(layers)


def fit(vectors: np.ndarray, parts: int = PARTS, target: float = TARGET_RECALL, k: int = NEIGHBOURS) -> Router:
    """A router for the sample's vectors, its visits set on a tenth that it was not trained on."""
    rng = np.random.default_rng(SEED)
    own = np.arange(len(vectors))
    test = own % 10 == 0
    if (~test).sum() < 2 * parts:
        return Router((np.zeros((vectors.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1)
    known = vectors[~test]
    near = nearest_in(known, known, k + 1)
    label = balanced_parts(near, parts, rng)
    wanted = np.zeros((len(known), parts))
    for column in near.T:
        wanted[np.arange(len(known)), label[column]] += 1
    wanted /= wanted.sum(axis=1, keepdims=True)
    router = Router(train_router(known, wanted, rng), parts)
    # Where the index would put the neighbours of queries that were not seen.
    home = router.parts(known, 1)[:, 0]
    order = router.parts(vectors[test], parts)
    rank = np.argsort(order, axis=1)
    found = nearest_in(known, vectors[test], k)
    reached = np.take_along_axis(rank, home[found], axis=1)
    recall = [(reached <= visits).mean() for visits in range(parts)]
    return Router(router.layers, next((v + 1 for v, r in enumerate(recall) if r >= target), parts))


def part_count(vectors: int, sample: int, least: int = PARTS) -> int:
    """A power of two: `least` parts or more as the vectors grow, while the sample can fill them."""
    parts = least
    while parts * PART_VECTORS < vectors and 2 * parts * PART_SAMPLE <= min(sample, vectors):
        parts *= 2
    return parts


def _routed(rows: DataFrame, routers: dict[int, Router], visiting: bool) -> DataFrame:
    """id, vector, size and parts of each row: all that it visits, or the one it is indexed under."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("size"))
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                router = routers.get(size)
                if router is None:
                    found = np.zeros((part.num_rows, 1), np.int32)
                else:
                    found = router.parts(
                        matrix(part.column("vector")), router.visits if visiting else 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(
                        np.arange(0, found.size + 1, found.shape[1], dtype=np.int32), found.ravel())],
                    [*part.schema.names, "parts"])

    return rows.mapInArrow(run, "id long, vector array<double>, size int, parts array<int>")


def _chunks(count: Column, size: int) -> Column:
    return F.greatest(F.ceil(count / size), F.lit(1)).cast("int")


def _decode(table: pa.Table) -> groups.Columns:
    # A table may hold groups of several lengths; a group has one.
    flat = table.column("vector").combine_chunks()
    ends = np.cumsum(np.asarray(table.column("size")).astype(np.int64))
    values = np.asarray(flat.flatten(), np.float64)
    vectors = np.empty(table.num_rows, object)
    for at, (start, end) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends)):
        vectors[at] = values[start:end]
    return groups.numbers(table, "id", "asks") | {"vector": vectors}


def first_copies(vector: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Without the copies of a vector beyond the k smallest ids, which can be no query's k nearest."""
    if not len(vector):
        return vector, ids
    whole = np.ascontiguousarray(vector).view(np.dtype((np.void, vector.shape[1] * 8))).ravel()
    _, kind = np.unique(whole, return_inverse=True)
    order = np.lexsort((ids, kind))
    starts = np.flatnonzero(np.concatenate([[True], kind[order][1:] != kind[order][:-1]]))
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    kept = order[place < k]
    return vector[kept], ids[kept]


def _nearest_work(k: int):
    def work(columns: groups.Columns) -> groups.Columns | None:
        asks = columns["asks"].astype(bool)
        if asks.all() or not asks.any():
            return None
        query, vector = (np.stack(list(columns["vector"][rows])) for rows in (asks, ~asks))
        query_id, vector_id = columns["id"][asks], columns["id"][~asks]
        vector, vector_id = first_copies(vector, vector_id, k + 1)
        found = []
        for at in range(0, len(query) if len(vector) else 0, 256):
            block = query[at:at + 256]
            scores = block @ vector.T
            scores[query_id[at:at + 256, None] == vector_id[None, :]] = -np.inf
            if len(vector) > k:
                # The product of matrices rounds as it likes; what may be in the first k is scored anew.
                least = np.partition(scores, len(vector) - k, axis=1)[:, len(vector) - k]
                near = scores >= (least - 1e-9 * np.maximum(np.abs(least), 1))[:, None]
                near &= np.isfinite(scores)
            else:
                near = np.isfinite(scores)
            i, j = np.nonzero(near)
            exact = (block[i] * vector[j]).sum(axis=1)
            order = np.lexsort((vector_id[j], -exact, i))
            i, j, exact = i[order], j[order], exact[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            keep = rank < k
            found.append((query_id[at + i[keep]], vector_id[j[keep]], exact[keep]))
        if not found:
            return None
        return {"query_id": np.concatenate([f[0] for f in found]),
                "vec_id": np.concatenate([f[1] for f in found]),
                "score": np.concatenate([f[2] for f in found])}

    return work


def search(
    vectors: DataFrame, is_query: Column, *, id: str = "vec_id", vector: str = "embedding",
    k: int = NEIGHBOURS, parts: int = PARTS, sample: int = SAMPLE, target: float = TARGET_RECALL,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k nearest found of every row that asks.

    `is_query` is a condition on the column `id` of this operator's rows.
    """
    rows = vectors.select(
        F.col(id).cast("long").alias("id"),
        F.transform(F.col(vector), lambda x: x.cast("double")).alias("vector"),
    ).filter(usable(F.col("vector")) & F.col("id").isNotNull())
    rows = write_out(rows.withColumn("size", F.size("vector")).distinct(), "vectors")
    many = rows.groupBy("size").count().filter(F.col("count") >= FEW_VECTORS).orderBy("size").collect()
    routers = {}
    for size, count in many:
        # Bounded by the sample's size.
        chosen = rows.filter(F.col("size") == size).orderBy(
            F.xxhash64(F.lit("sample"), "id"), "id", "vector").limit(sample).select("vector").toArrow()
        routers[size] = fit(matrix(chosen.column("vector")), part_count(count, sample, parts), target, k)
    index = write_out(_routed(rows, routers, False).select(
        "id", "vector", "size", F.col("parts")[0].alias("part")), "index")
    asked = write_out(_routed(rows.filter(is_query), routers, True).select(
        "id", "vector", "size", F.explode("parts").alias("part")), "asked")
    sizes = index.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n_vectors")).join(
        asked.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n_queries")), ["size", "part"]).select(
        "size", "part", _chunks(F.col("n_vectors"), CHUNK_VECTORS).alias("v_chunks"),
        _chunks(F.col("n_queries"), CHUNK_QUERIES).alias("q_chunks"))
    # One row per part of a length.
    if sizes.count() <= FEW_PARTS:
        sizes = F.broadcast(sizes)
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    chunk = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    met = index.join(sizes, ["size", "part"]).select(
        "id", "vector", "size", "part", chunk("v_chunks").alias("v"), every("q_chunks").alias("q"),
        F.lit(0).alias("asks"),
    ).unionByName(asked.join(sizes, ["size", "part"]).select(
        "id", "vector", "size", "part", every("v_chunks").alias("v"), chunk("q_chunks").alias("q"),
        F.lit(1).alias("asks")))
    found = groups.run_groups(
        met, ["size", "part", "v", "q"], "query_id long, vec_id long, score double", _decode, _nearest_work(k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # Repeated ids with other vectors: the best score of an id counts.
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
