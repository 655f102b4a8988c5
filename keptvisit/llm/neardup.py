"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations.

Each vector is turned by three rounds of random signs and a fast Hadamard
transform. Its hash is the axis it points along most, with its sign: the nearest
corner of the cross-polytope. Several hashes make a table's bucket; a vector is
also put in the buckets where one hash takes the second or third best axis
(multiprobe). Vectors that share a bucket are verified by their cosine in double
precision, and all pairs of a component of verified links are counted.

Equal vectors are one class. Pairs are counted where they meet and not emitted.

Defined cases: a vector that is null, empty, zero or has null or non-finite
components links with nothing, nor does a row without id (component null); only
vectors of one length are compared; repeated rows are one vector and give a row
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit.llm import groups
from keptvisit.session import write_out

THRESHOLD = 0.95
TABLES, PROBES = 16, 6
CHUNK = 2048
SEED = 11


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(
        (F.size(vector) > 0) & F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column with lists of one length as a matrix in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each column; the height is a power of two."""
    height, n = x.shape
    step = 1
    while step < height:
        pairs = x.reshape(height // (2 * step), 2, step, n)
        x = np.empty_like(pairs)
        np.add(pairs[:, 0], pairs[:, 1], out=x[:, 0])
        np.subtract(pairs[:, 0], pairs[:, 1], out=x[:, 1])
        x = x.reshape(height, n)
        step *= 2
    return x


def rotated(vectors: np.ndarray, number: int) -> np.ndarray:
    """The rows padded to a power of two and turned by the rotation of that number."""
    n, dim = vectors.shape
    width = 1 << max(2, (dim - 1).bit_length())
    rng = np.random.default_rng([SEED, dim, number])
    x = np.zeros((width, n), np.float32)
    x[:dim] = vectors.T
    for _ in range(3):
        x = hadamard(x * rng.choice(np.array([-1, 1], np.float32), (width, 1))) / np.float32(width**0.5)
    return x.T


def hashes_for(rows: int, dim: int, probes: int = PROBES) -> int:
    """Hashes per bucket, so that unrelated vectors rarely meet: about as many buckets as entries."""
    corners = 2 << max(2, (dim - 1).bit_length())
    return max(1, ceil(log(max(2, rows * probes)) / log(corners)))


def probed(vectors: np.ndarray, rows: int, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """The buckets of each row, tables x probes, for unit vectors of one length."""
    n, dim = vectors.shape
    parts = hashes_for(rows, dim, probes)
    out = np.empty((n, tables, probes), np.uint64)
    at = np.arange(n)[:, None]
    for table in range(tables):
        codes, gaps = [], []
        for part in range(parts):
            x = rotated(vectors, table * parts + part)
            size = np.abs(x)
            best = np.argpartition(-size, 2, axis=1)[:, :3]
            best = np.take_along_axis(best, np.argsort(-size[at, best], axis=1), axis=1)
            codes.append((2 * best + (x[at, best] < 0)).astype(np.uint64))
            gaps.append(size[at, best[:, :1]] - size[at, best])
        # Instead of the best axis of one hash its second or third, the closest first.
        changes = np.concatenate([g[:, 1:] for g in gaps], axis=1)
        chosen = np.argsort(changes, axis=1)[:, :probes - 1]
        for probe in range(probes):
            bucket = np.full(n, np.uint64(xxhash.xxh3_64_intdigest(f"{dim}:{table}")))
            for part in range(parts):
                rank = np.zeros(n, np.int64)
                if probe and probe - 1 < chosen.shape[1]:
                    pick = chosen[:, probe - 1]
                    rank = np.where(pick // 2 == part, pick % 2 + 1, 0)
                bucket = (bucket ^ codes[part][np.arange(n), rank]) * np.uint64(0x9E3779B97F4A7C15)
                bucket ^= bucket >> np.uint64(29)
            out[:, table, probe] = bucket
    return out.reshape(n, -1)


def _buckets(classes: DataFrame, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column("vector").value_lengths())
            for dim in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dim))
                for at in range(0, part.num_rows, 2000):
                    some = part.slice(at, 2000)
                    found = probed(unit(matrix(some.column("vector"))), rows)
                    yield pa.RecordBatch.from_arrays(
                        [some.column("key"), pa.ListArray.from_arrays(
                            np.arange(0, found.size + 1, found.shape[1], dtype=np.int32),
                            found.view(np.int64).ravel())], ["key", "buckets"])

    found = classes.select("key", "vector").mapInArrow(run, "key long, buckets array<long>")
    return found.select("key", F.explode(F.array_distinct("buckets")).alias("bucket"))


def _decode(table: pa.Table) -> groups.Columns:
    vectors = table.column("vector").combine_chunks()
    rows = np.empty(table.num_rows, object)
    flat, offsets = np.asarray(vectors.flatten(), np.float64), np.asarray(vectors.offsets)
    for at in range(table.num_rows):
        rows[at] = flat[offsets[at] - offsets[0]:offsets[at + 1] - offsets[0]]
    names = [n for n in table.column_names if n in ("key", "home", "low", "high", "copies")]
    return groups.numbers(table, *names) | {"vector": rows}


def _linked(columns: groups.Columns) -> tuple[np.ndarray, np.ndarray]:
    left, right = groups.crossing(columns)
    lengths = np.array([len(v) for v in columns["vector"]])
    found = []
    for dim in np.unique(lengths):
        a = left[lengths[left] == dim]
        b = a if right is None else right[lengths[right] == dim]
        if not len(a) or not len(b):
            continue
        u = unit(np.stack(columns["vector"][a]))
        w = u if right is None else unit(np.stack(columns["vector"][b]))
        close = u @ w.T >= THRESHOLD
        i, j = np.nonzero(np.triu(close, 1) if right is None else close)
        found.append((a[i], b[j]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _meet_work(columns: groups.Columns) -> groups.Columns | None:
    i, j = _linked(columns)
    if not len(i):
        return None
    root = groups.forest(len(columns["key"]), i, j)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return {"id": columns["key"][moved], "root": columns["key"][root[moved]]}


def _count_work(columns: groups.Columns) -> groups.Columns | None:
    i, j = _linked(columns)
    if not len(i):
        return None
    size, copies = len(columns["key"]), columns["copies"].astype(np.float64)
    links = np.bincount(i, copies[j], size) + np.bincount(j, copies[i], size)
    root = groups.forest(size, i, j)
    some = np.flatnonzero(links)
    return {"id": columns["key"][some], "root": columns["key"][root[some]],
            "n_links": links[some].astype(np.int64)}


def find(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per input row: id, n_links, component_id, kept."""
    rows = write_out(vectors.select(
        F.col(id).cast("long").alias("vec_id"),
        # 0.0 and -0.0 are one value, so that equal vectors have one key.
        F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0)).alias("vector"),
    ).withColumn("key", F.when(
        usable(F.col("vector")) & F.col("vec_id").isNotNull(), F.xxhash64("vector"))), "vectors")
    known = rows.filter("key is not null")
    classes = write_out(
        known.select("vec_id", "key").distinct().groupBy("key").agg(
            F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .join(known.groupBy("key").agg(F.first("vector").alias("vector")), "key"), "vector-classes")
    buckets = write_out(_buckets(classes, classes.count()), "buckets")
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_bucket")).filter("n_bucket > 1")
    met = groups.paired_chunks(
        buckets.join(shared, "bucket").join(classes.select("key", "vector"), "key"),
        "key", F.ceil(F.col("n_bucket") / CHUNK))
    edges = write_out(groups.run_groups(
        met, ["bucket", "low", "high"], "id long, root long", _decode, _meet_work), "near")
    found = groups.components(edges, "id", "root")
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("n_rows"))
    members = found.join(sizes, "component").join(
        classes.select(F.col("key").alias("id"), "vector", "copies"), "id").withColumnRenamed("id", "key")
    links = write_out(groups.run_groups(
        groups.paired_chunks(members, "key", F.ceil(F.col("n_rows") / CHUNK)),
        ["component", "low", "high"], "id long, root long, n_links long", _decode, _count_work), "links")
    result = groups.resolve(classes.select("key", "first_id", "copies"), links)
    return groups.with_results(rows.select("vec_id", "key"), result).select(
        F.col("vec_id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("group", "vec_id").alias("component_id"),
        F.coalesce(F.col("group") == F.col("vec_id"), F.lit(True)).alias("kept"))
