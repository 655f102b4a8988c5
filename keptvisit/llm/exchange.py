"""Corpus-wide totals for keys that sit in packed units.

A unit is some documents packed into one row. Instead of one row per key, a unit
sends each part of the key range one block of its distinct keys with its own
values; the part adds up all units' blocks and answers every block in the order
of its keys, so an answer is only numbers. A key that all documents hold is one
entry per unit, and no task holds more than its part's distinct keys per unit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keptvisit.session import shuffle_partitions, write_out

# Adds up, or takes the smallest; in the order of an extractor's values.
SUM, MIN = "sum", "min"
UNIT_BYTES = 4 << 20


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit integers as compressed bytes, byte by byte of all entries."""
    out = []
    for values in arrays:
        planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()
        data = pa.compress(planes, codec="zstd", asbytes=True)
        out += [np.array([len(values), len(data)], np.int64).tobytes(), data]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    """The arrays of `pack`, as int64."""
    out, at = [], 0
    while at < len(data):
        count, size = np.frombuffer(data, np.int64, 2, at)
        planes = pa.decompress(data[at + 16:at + 16 + size], int(count) * 8, "zstd", asbytes=True)
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.int64).ravel())
        at += 16 + int(size)
    return out


def text_offsets(texts: pa.Array) -> np.ndarray:
    """Where each text begins in bytes, and the end; null takes none."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    return np.concatenate([[0], np.cumsum(sizes)])


def units(
    docs: DataFrame, text: str, pack_unit: Callable[[pa.RecordBatch], bytes], name: str,
    size: int = UNIT_BYTES,
) -> DataFrame:
    """A written table of (unit, payload): the rows of `docs`, about `size` bytes of text each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        weight = 0

        def packed() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([pack_unit(whole)], pa.binary())],
                ["unit", "payload"])

        for batch in batches:
            offsets = text_offsets(batch.column(text))
            at = 0
            while at < batch.num_rows:
                stop = int(np.searchsorted(offsets, offsets[at] + size - weight, "left"))
                stop = min(batch.num_rows, max(at + 1, stop))
                held.append(batch.slice(at, stop - at))
                weight += int(offsets[stop] - offsets[at])
                at = stop
                if weight >= size:
                    yield packed()
                    number, held, weight = number + 1, [], 0
        if sum(b.num_rows for b in held):
            yield packed()

    return write_out(docs.mapInArrow(run, "unit long, payload binary"), name)


def totals(
    table: DataFrame, extract: Callable[[bytes], tuple[np.ndarray, list[np.ndarray]]],
    ops: list[str], name: str, keys_per_unit: int = 1 << 20,
) -> DataFrame:
    """A written table of (unit, part, answers, fresh).

    `extract` gives a payload's sorted distinct keys (uint64) and its values per
    key (int64). The answers of a unit, by part, are `unpack`ed to one array per
    value in the order of its keys. `fresh` adds up to the number of distinct
    keys whose first total is above 0.
    """
    parts = max(shuffle_partitions(table.sparkSession), table.count() * keys_per_unit // (2 << 20))
    edges = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, payload in zip(batch.column("unit").to_pylist(), batch.column("payload").to_pylist()):
                keys, values = extract(payload)
                cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                some = [(p, a, b) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                for at in range(0, len(some), 64):
                    chunk = some[at:at + 64]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([p for p, _, _ in chunk], pa.int32()),
                        pa.array([unit] * len(chunk), pa.int64()),
                        pa.array([pack(np.diff(keys[a:b], prepend=np.uint64(0)), *[v[a:b] for v in values])
                                  for _, a, b in chunk], pa.binary()),
                    ], ["part", "unit", "asked"])

    def answer(group: pa.Table) -> pa.Table:
        blocks = [unpack(data) for data in group.column("asked").to_pylist()]
        keys = np.concatenate([np.cumsum(b[0].view(np.uint64), dtype=np.uint64) for b in blocks])
        distinct, place = np.unique(keys, return_inverse=True)
        found = []
        for k, op in enumerate(ops, 1):
            values = np.concatenate([b[k] for b in blocks])
            if op == SUM:
                found.append(np.bincount(place, values, len(distinct)).astype(np.int64))
            else:
                least = np.full(len(distinct), np.iinfo(np.int64).max)
                np.minimum.at(least, place, values)
                found.append(least)
        ends = np.cumsum([len(b[0]) for b in blocks])
        fresh = np.zeros(len(blocks), np.int64)
        fresh[0] = np.count_nonzero(found[0] > 0)
        return pa.table({
            "unit": group.column("unit"), "part": group.column("part"),
            "answers": pa.array([pack(*[f[place[b - len(own[0]):b]] for f in found])
                                 for b, own in zip(ends, blocks)], pa.binary()),
            "fresh": fresh})

    asked = table.mapInArrow(ask, "part int, unit long, asked binary")
    return write_out(
        asked.repartition(parts, "part").groupBy("part")
        .applyInArrow(answer, "unit long, part int, answers binary, fresh long"), name)


def answered(table: pa.Table) -> list[np.ndarray]:
    """A unit's answers in the order of its keys, from its rows of a `totals` table."""
    if not table.num_rows:
        return []
    order = np.argsort(np.asarray(table.column("part")), kind="stable")
    blocks = [unpack(table.column("answers")[int(at)].as_py()) for at in order]
    return [np.concatenate(values) for values in zip(*blocks)]


def with_answers(
    table: DataFrame, answers: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
) -> DataFrame:
    """`work` on each unit's row and its rows of answers."""
    return table.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(work, schema)
