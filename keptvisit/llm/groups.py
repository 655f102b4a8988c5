"""Work on groups of rows of any size, and connected components of links.

A group is met in one task when it is small. A larger one is cut into chunks
and every two chunks meet in a task of their own, so no task holds more than
two chunks and every pair of rows meets exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit.operators.ranks import attach
from keptvisit.session import shuffle_partitions, write_out

# Rows of one class that one task of the last join may hold.
HOT_COPIES = 1000

Columns = dict[str, np.ndarray]


def paired_chunks(rows: DataFrame, id: str, pieces: Column) -> DataFrame:
    """`rows` for every pair of chunks their group is cut into.

    `pieces` is the number of chunks of the row's group. A row's chunk is
    `home`; the row is repeated for each pair (`low`, `high`) that has it.
    """
    return (
        rows.withColumn("_pieces", F.greatest(pieces.cast("long"), F.lit(1)))
        .withColumn("home", F.pmod(F.xxhash64(id), F.col("_pieces")).cast("int"))
        .withColumn("_with", F.explode(F.sequence(F.lit(0), (F.col("_pieces") - 1).cast("int"))))
        .withColumn("low", F.least("home", "_with"))
        .withColumn("high", F.greatest("home", "_with"))
        .drop("_pieces", "_with")
    )


def run_groups(
    rows: DataFrame, keys: list[str], schema: str,
    decode: Callable[[pa.Table], Columns], work: Callable[[Columns], Columns | None],
) -> DataFrame:
    """`work` on the decoded rows of every group of equal (long or int) `keys`.

    The rows are laid out by key and sorted, and stream through the task; only
    the open group is held. `decode` turns a table into arrays with one entry
    per row, `work` returns arrays of the columns of `schema`.
    """
    names = [part.split()[0] for part in schema.split(",")]
    parts = shuffle_partitions(rows.sparkSession)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            first, final = ([batch.column(k)[at].as_py() for k in keys] for at in (0, batch.num_rows - 1))
            whole_run = first == final
            if held and first != last or not whole_run and held:
                start = _run_start(batch, keys) if first == last else 0
                if start:
                    held.append(batch.slice(0, start))
                    batch = batch.slice(start)
                yield from _worked(pa.Table.from_batches(held), keys, decode, work, names)
                held = []
                whole_run = [batch.column(k)[0].as_py() for k in keys] == final
            if not whole_run:
                cut = _last_run(batch, keys)
                yield from _worked(pa.Table.from_batches([batch.slice(0, cut)]), keys, decode, work, names)
                batch = batch.slice(cut)
            held.append(batch)
            last = final
        if held:
            yield from _worked(pa.Table.from_batches(held), keys, decode, work, names)

    return rows.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(stream, schema)


def _changes(table, keys: list[str]) -> np.ndarray:
    """Where a run of equal keys begins, the first row left out."""
    change = np.zeros(max(table.num_rows - 1, 0), bool)
    for k in keys:
        values = np.asarray(table.column(k))
        change |= values[1:] != values[:-1]
    return np.flatnonzero(change) + 1


def _run_start(batch: pa.RecordBatch, keys: list[str]) -> int:
    """Rows of the first run."""
    starts = _changes(batch, keys)
    return int(starts[0]) if len(starts) else batch.num_rows


def _last_run(batch: pa.RecordBatch, keys: list[str]) -> int:
    starts = _changes(batch, keys)
    return int(starts[-1]) if len(starts) else 0


def _worked(table, keys, decode, work, names) -> Iterator[pa.RecordBatch]:
    bounds = [0, *_changes(table, keys).tolist(), table.num_rows]
    columns = decode(table)
    found = []
    for start, stop in zip(bounds, bounds[1:]):
        out = work({name: values[start:stop] for name, values in columns.items()})
        if out is not None and len(out[names[0]]):
            found.append(out)
    if found:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([f[name] for f in found])) for name in names], names)


def numbers(table: pa.Table, *names: str) -> Columns:
    """Plain number columns without nulls as arrays."""
    return {name: np.asarray(table.column(name)) for name in names}


def fixed(table: pa.Table, name: str, dtype) -> np.ndarray:
    """A binary column of equal lengths as one matrix."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype).reshape(table.num_rows, -1)


def ragged(table: pa.Table, name: str, dtype) -> np.ndarray:
    """A binary column of any lengths as an array of arrays."""
    out = np.empty(table.num_rows, object)
    for at, value in enumerate(table.column(name).to_pylist()):
        out[at] = np.frombuffer(value, dtype)
    return out


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest position that each of n positions reaches by the links."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def crossing(columns: Columns) -> tuple[np.ndarray, np.ndarray | None]:
    """The positions to compare in a group of `paired_chunks`: all with all, or low with high."""
    if columns["low"][0] == columns["high"][0]:
        return np.arange(len(columns["home"])), None
    return (np.flatnonzero(columns["home"] == columns["low"][0]),
            np.flatnonzero(columns["home"] == columns["high"][0]))


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(id, component) for every id with a link; a component is a number of its own kind.

    Contraction in seeded random order: every vertex goes over to the vertex of
    its closed neighbourhood that comes first, the links go along, and links
    within a vertex vanish. Each round leaves a fraction of the vertices, so the
    rounds grow with the logarithm of their number. All steps are aggregates and
    joins; the joins are plain so that adaptive execution can split hot vertices.
    """
    def tidy(a: Column, b: Column, rows: DataFrame) -> DataFrame:
        return write_out(
            rows.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
            .filter("u < v").distinct(), "links")

    links = tidy(F.col(left), F.col(right), edges)
    steps = []
    while not links.isEmpty():
        order = lambda c: F.xxhash64(F.lit(len(steps) // 3), F.col(c))
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = both.groupBy("u").agg(F.min(order("v")).alias("h"), F.min_by("v", order("v")).alias("v"))
        step = write_out(first.select(
            "u", F.when(order("u") < F.col("h"), F.col("u")).otherwise(F.col("v")).alias("to")), "step")
        steps.append(step)
        moved = (
            links.join(step.withColumnRenamed("to", "tu"), "u")
            .join(step.select(F.col("u").alias("v"), F.col("to").alias("tv")), "v"))
        links = tidy(F.col("tu"), F.col("tv"), moved)
    if not steps:
        return links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    label = steps[-1]
    for step in reversed(steps[:-1]):
        later = label.select(F.col("u").alias("to"), F.col("to").alias("end"))
        label = step.join(later, "to", "left").select("u", F.coalesce("end", "to").alias("to"))
    return write_out(label.select(F.col("u").alias("id"), F.col("to").alias("component")), "components")


def resolve(members: DataFrame, links: DataFrame) -> DataFrame:
    """Per class its group and the number of documents linked with it.

    `members`: key, first_id and copies of each class; `links`: id, root and
    n_links, where id and root are keys of one group. Gives key, copies, `group`
    (the smallest first_id of the component) and `n_links`, copies included.
    """
    found = components(links.filter("id != root"), "id", "root")
    counts = links.groupBy("id").agg(F.sum("n_links").alias("linked"))
    smallest = (
        found.join(members.select(F.col("key").alias("id"), "first_id"), "id")
        .groupBy("component").agg(F.min("first_id").alias("smallest")))
    grouped = found.join(smallest, "component").select(F.col("id").alias("key"), "smallest")
    return (
        members.join(grouped, "key", "left")
        .join(counts.withColumnRenamed("id", "key"), "key", "left")
        .select("key", "copies", F.coalesce("smallest", "first_id").alias("group"),
                (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    )


def with_results(rows: DataFrame, result: DataFrame) -> DataFrame:
    """`rows` with the columns of `resolve` for their key; null without a key.

    Classes of very many copies are joined by broadcast, so that their rows stay
    where they are; rows without a key take no part in the join.
    """
    known = attach(rows.filter("key is not null"), result, ["key"], "copies", HOT_COPIES)
    return known.unionByName(rows.filter("key is null"), allowMissingColumns=True)
