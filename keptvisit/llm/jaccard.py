"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles. MinHash bands bring candidates
together; the MinHash values of a candidate pair are then compared a few at a
time, and the pair is dropped as soon as the posterior probability that its
similarity reaches the threshold falls below the tolerance. What is left is
verified on the shingle sets themselves.

Texts with equal sets are one class and never compared with each other. Pairs
are counted in the task where they meet and are not emitted: a task returns the
number of links per class and a spanning forest.

Words are runs of characters other than ASCII white space, ASCII letters in
lower case. A text of one to four words has one shingle of all its words.

Defined cases: a null id, a null text and a text without words link with
nothing (a null id has a null group); repeated rows of one id are one document
and give a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keptvisit.llm import groups
from keptvisit.session import write_out

WORDS = 5
THRESHOLD = 0.8
# 32 bands of 4 values: a pair at the threshold misses all bands with probability 5e-8.
HASHES, BAND = 128, 4
STEPS = (16, 32, 64, HASHES)
TOLERANCE = 1e-6
CHUNK = 1024
CHUNK_SHINGLES = 1 << 20
FEW = 1_000_000
SEED = 7

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; empty without words."""
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten().dictionary_encode()
    hashes = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in flat.dictionary.to_pylist()), np.uint64, len(flat.dictionary))
    blank = flat.dictionary.to_pylist().index("") if "" in flat.dictionary.to_pylist() else -1
    codes = np.asarray(flat.indices)
    values = hashes[codes] if len(codes) else np.empty(0, np.uint64)
    offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    for start, stop in zip(offsets, offsets[1:]):
        x = values[start:stop]
        if blank >= 0 and stop > start:
            x = x[codes[start:stop] != blank]
        n = max(len(x) - words + 1, min(len(x), 1))
        s = x[:n].copy()
        for j in range(1, min(words, len(x))):
            s = s * _MULTIPLY + x[j:j + n]
        yield np.unique(_mixed(s))


@cache
def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = rng.integers(0, 2**63, (2, HASHES), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values of a set, 16 bits of each."""
    a, b = _family()
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        low = np.minimum(low, (np.multiply.outer(a, shingles[at:at + 512]) + b[:, None]).min(axis=1))
    return (low >> np.uint64(16)).astype(np.uint16)


def key_of(shingles: np.ndarray) -> int:
    """The key of the class of equal sets."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def profiles(docs: DataFrame, id: str, text: str) -> DataFrame:
    """doc_id, key, n (shingles) and sketch of every row; key and sketch are null without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = list(shingle_sets(part.column("text")))
                keep = [len(s) > 0 and i.is_valid for s, i in zip(sets, part.column("doc_id"))]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    pa.array([key_of(s) if k else None for s, k in zip(sets, keep)], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([sketch(s).tobytes() if k else None for s, k in zip(sets, keep)], pa.binary()),
                ], ["doc_id", "key", "n", "sketch"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, n int, sketch binary")


@cache
def least_matches(compared: int, threshold: float, tolerance: float) -> int:
    """The fewest equal values at which a pair is kept after `compared` comparisons.

    With an even prior the posterior of the similarity after m of n equal values
    is Beta(m + 1, n - m + 1); it exceeds t with the probability that a binomial
    of n + 1 trials with t is at most m.
    """
    total = 0.0
    for m in range(compared + 1):
        total += comb(compared + 1, m) * threshold**m * (1 - threshold) ** (compared + 1 - m)
        if total >= tolerance:
            return m
    return compared


def surviving(
    sketches: np.ndarray, left: np.ndarray, right: np.ndarray | None,
    threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that the posterior keeps: of `left` with `right`, or within `left`."""
    within = right is None
    a, b = sketches[left], sketches[left if within else right]
    equal = np.zeros((len(a), len(b)), np.uint8)
    for k in range(STEPS[0]):
        equal += a[:, k, None] == b[None, :, k]
    keep = equal >= least_matches(STEPS[0], threshold, tolerance)
    i, j = np.nonzero(np.triu(keep, 1) if within else keep)
    matches = equal[i, j].astype(np.int16)
    for done, upto in zip(STEPS, STEPS[1:]):
        if not len(i):
            break
        for at in range(0, len(i), 1 << 17):
            part = slice(at, at + (1 << 17))
            matches[part] += (a[i[part], done:upto] == b[j[part], done:upto]).sum(axis=1, dtype=np.int16)
        keep = matches >= least_matches(upto, threshold, tolerance)
        i, j, matches = i[keep], j[keep], matches[keep]
    return left[i], (left if within else right)[j]


def common(sets: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The number of common members for pairs of sets, by products of 0/1 matrices."""
    used, back = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = back[:len(i)], back[len(i):]
    lengths = [len(sets[u]) for u in used]
    _, member, count = np.unique(
        np.concatenate([sets[u] for u in used]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(used)), lengths)
    shared = count > 1
    row, column = row[shared[member]], (np.cumsum(shared) - 1)[member[shared[member]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(used), len(used)), np.float32)
    for low in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        block = np.zeros((len(used), min(4096, int(shared.sum()) - low)), np.float32)
        block[row[a:b], column[a:b] - low] = 1
        total += block @ block.T
    return total[i, j]


def _candidate_work(columns: groups.Columns) -> groups.Columns | None:
    left, right = groups.crossing(columns)
    i, j = surviving(columns["sketch"], left, right)
    if not len(i):
        return None
    root = groups.forest(len(columns["key"]), i, j)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return {"id": columns["key"][moved], "root": columns["key"][root[moved]]}


def _verify_work(columns: groups.Columns) -> groups.Columns | None:
    _, once = np.unique(columns["key"], return_index=True)
    columns = {name: values[once] for name, values in columns.items()}
    left, right = groups.crossing(columns)
    i, j = surviving(columns["sketch"], left, right)
    if not len(i):
        return None
    both = common(columns["shingles"], i, j)
    n = columns["n"].astype(np.float64)
    linked = both >= THRESHOLD * (n[i] + n[j] - both) - 1e-6
    i, j = i[linked], j[linked]
    size, copies = len(columns["key"]), columns["copies"].astype(np.float64)
    links = np.bincount(i, copies[j], size) + np.bincount(j, copies[i], size)
    root = groups.forest(size, i, j)
    some = np.flatnonzero(links)
    return {"id": columns["key"][some], "root": columns["key"][root[some]],
            "n_links": links[some].astype(np.int64)}


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per set of shingles: key, n, sketch, first_id, copies (distinct documents)."""
    known = rows.filter("key is not null")
    members = known.select("doc_id", "key").distinct().groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    looks = known.groupBy("key").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    return members.join(looks, "key")


def in_buckets(classes: DataFrame) -> DataFrame:
    """bucket, key and n_bucket for the buckets that several classes share."""
    width = BAND * 2
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(HASHES // BAND - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("sketch"), b * width + 1, F.lit(width))))
    rows = classes.select("key", F.explode(bands).alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_bucket")).filter("n_bucket > 1")
    return rows.join(shared, "bucket")


def join(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, group_id, n_links, kept, text_key.

    `group_id` is the smallest id reachable by links, `n_links` the number of
    other documents of at least the threshold's similarity, `kept` says that the
    document stands for its group. `text_key` tells apart the texts of one id.
    """
    rows = write_out(profiles(docs, id, text), "profiles")
    classes = write_out(classes_of(rows), "classes")
    met = groups.paired_chunks(
        in_buckets(classes).join(classes.select("key", "sketch"), "key"),
        "key", F.ceil(F.col("n_bucket") / CHUNK))
    edges = write_out(groups.run_groups(
        met, ["bucket", "low", "high"], "id long, root long",
        lambda t: groups.numbers(t, "key", "home", "low", "high")
        | {"sketch": groups.fixed(t, "sketch", np.uint16)},
        _candidate_work), "candidates")
    links = _verified(docs, id, text, classes, groups.components(edges, "id", "root"))
    result = groups.resolve(classes.select("key", "first_id", "copies"), links)
    return groups.with_results(rows.select("doc_id", "key"), result).select(
        F.col("doc_id").alias(id),
        F.coalesce("group", "doc_id").alias("group_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("group") == F.col("doc_id"), F.lit(True)).alias("kept"),
        F.col("key").alias("text_key"))


def with_key(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The rows as `doc`, with the `text_key` of their text as in `join`; null without words."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keys = [key_of(s) if len(s) else None for s in shingle_sets(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(keys, pa.int64())], ["doc", "text_key"])

    return rows.mapInArrow(run, rows.select("doc").schema.add("text_key", "long"))


def _verified(docs: DataFrame, id: str, text: str, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Links per class and a forest, from the shingle sets of the candidates' components."""
    members = write_out(
        found.join(classes.withColumnRenamed("key", "id"), "id")
        .select(F.col("id").alias("key"), "component", "n", "sketch", "first_id", "copies"), "members")
    wanted = members.select(F.col("first_id").alias("_id"), F.col("key").alias("_key"))
    if members.count() <= FEW:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).alias("text")).join(wanted, "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = list(shingle_sets(part.column("text")))
                # An id with several texts stands for the class it was taken for only.
                own = np.array([key_of(s) for s in sets], np.int64) == np.asarray(part.column("_key"))
                yield pa.RecordBatch.from_arrays([
                    part.column("_key").filter(pa.array(own)),
                    pa.array([s.tobytes() for s, k in zip(sets, own) if k], pa.binary()),
                ], ["key", "shingles"])

    sets = texts.mapInArrow(run, "key long, shingles binary")
    sizes = members.groupBy("component").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n_shingles"))
    rows = sets.join(members.drop("first_id"), "key").join(sizes, "component")
    met = groups.paired_chunks(rows, "key", F.greatest(
        F.ceil(F.col("n_rows") / CHUNK), F.ceil(F.col("n_shingles") / CHUNK_SHINGLES)))
    return write_out(groups.run_groups(
        met, ["component", "low", "high"], "id long, root long, n_links long",
        lambda t: groups.numbers(t, "key", "home", "low", "high", "n", "copies")
        | {"sketch": groups.fixed(t, "sketch", np.uint16),
           "shingles": groups.ragged(t, "shingles", np.uint64)},
        _verify_work), "links")
