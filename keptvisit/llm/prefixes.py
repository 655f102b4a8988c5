"""The prefix trie of conversations by truncation peeling.

A conversation is the path of its turns; a turn is 16 bytes, a hash of role and
text with the number of code points. Equal conversations are one class. Classes
are laid out by path, so that the members of every node stand side by side,
however many there are. Each task takes blocks of neighbouring classes and peels
them: from the greatest depth down, the conversations that end at a depth join
the nodes that are left of the depth below it, equal prefixes are grouped, their
aggregates complete the nodes of this depth, and the last turn is stripped.

A node may go on in the next block only if it is a prefix of the first or of the
last path of its block. These are kept open: a block hands on two paths with what
it knows of their prefixes, and peeling these paths in the same way closes them.
That last step is one task with two rows per block, about one row in 30,000.

Defined cases: rows without conv_id are left out; null role or text is empty;
turns are ordered by turn, null first, then by role and by the hash of the text;
a conversation may end up without turns and is then a member of the root only;
an empty table has no nodes, not even a root; other columns are ignored. The
turns of one conversation are held in one row, 16 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keptvisit.llm.groups import HOT_COPIES
from keptvisit.operators.ranks import attach
from keptvisit.session import shuffle_partitions, write_out

UNIT = 16
BLOCK_ROWS, BLOCK_BYTES = 65_536, 32 << 20
IDS_PER_PACK = 4096
NOTHING = hashlib.sha256(b"").hexdigest()
_NONE = np.iinfo(np.int64).max

_COUNTS = ["n", "first", "kids", "leaves", "saved"]
_NODE = ("conv_id long, depth long, parent long, n long, kids long, leaves long, saved long, ends string, "
         "block long, side int, path binary, records binary, record_ends array<string>")
_NAMES = [part.split()[0] for part in _NODE.split(", ")]


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id and path of every conversation, rebuilt with the head of its hundred's first one."""
    one = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select(
        (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), "conv_id",
        F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", F.concat(
            F.substring(F.unhex(F.md5(one)), 1, UNIT - 4),
            F.unhex(F.lpad(F.hex(F.char_length("text")), 8, "0"))).alias("unit")).alias("turn"))

    def whole(rows: DataFrame) -> DataFrame:
        # Laid out by base, so that grouping and joining need no further shuffle.
        return rows.repartition("base").groupBy("base", "conv_id").agg(
            F.transform(F.array_sort(F.collect_list("turn")), lambda t: t["unit"]).alias("own"))

    heads = whole(turns.filter("conv_id = base")).select("base", F.slice("own", 1, 5).alias("head"))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    rebuilt = whole(turns).join(heads, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", F.array().cast("array<binary>")), F.lit(1), head),
        F.slice("own", head + 1, F.greatest(F.size("own") - head, F.lit(0)))).alias("units"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column("units")
            data = b"".join(units.flatten().to_pylist())
            ends = np.cumsum(np.asarray(units.value_lengths()).astype(np.int64)) * UNIT
            starts = np.concatenate([[0], ends[:-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array([data[a:b] for a, b in zip(starts, ends)], pa.binary())],
                ["conv_id", "path"])

    return rebuilt.mapInArrow(joined, "conv_id long, path binary")


def _list_hashes(copies: DataFrame) -> DataFrame:
    """key and SHA-256 of the ascending ids of each key, comma-joined.

    Ids are packed into texts where they lie, in key and id order; the last step
    streams the packs of a key through one hash, and holds one pack.
    """
    parts = shuffle_partitions(copies.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
            out, at = [], 0
            for stop in range(1, len(keys) + 1):
                if stop == len(keys) or keys[stop] != keys[at] or stop - at == IDS_PER_PACK:
                    out.append((keys[at], ids[at], ",".join(map(str, ids[at:stop]))))
                    at = stop
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))],
                    ["key", "start", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, running = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if key != last:
                    if running is not None:
                        done.append((last, running.hexdigest()))
                    last, running = key, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["key", "ends"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([running.hexdigest()])], ["key", "ends"])

    packs = copies.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions(
        "key", "conv_id").mapInArrow(pack, "key binary, start long, ids string")
    return packs.repartition(parts, "key").sortWithinPartitions("key", "start").mapInArrow(
        digest, "key binary, ends string")


def classes(rebuilt: DataFrame) -> DataFrame:
    """path, n and first of each distinct conversation, and the hash of its ids."""
    keyed = write_out(rebuilt.withColumn("key", F.unhex(F.md5("path"))), "rebuilt")
    found = write_out(keyed.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first")), "classes")
    key = F.unhex(F.md5("path")).alias("key")
    shared = found.filter("n > 1").select(key, "n", F.lit(True).alias("shared"))
    copies = attach(keyed.select("key", "conv_id"), shared, ["key"], "n", HOT_COPIES).filter("shared")
    hashes = write_out(_list_hashes(copies.select("key", "conv_id")), "ids")
    single = found.filter("n = 1").withColumn("ends", F.sha2(F.col("first").cast("string").cast("binary"), 256))
    return single.unionByName(
        found.filter("n > 1").withColumn("key", F.unhex(F.md5("path"))).join(hashes, "key").drop("key"))


@dataclass
class Block:
    """Neighbouring distinct paths in order, and what is known of some of their prefixes.

    A record says of the prefix of `depth` turns of path `row` how many members
    end there or in closed children, the smallest of them, and the number of
    closed children with their leaves and saved tokens. `ends` is a place in
    `hashes`, or -1.
    """

    paths: list[bytes]
    row: np.ndarray
    depth: np.ndarray
    counts: dict[str, np.ndarray]
    ends: np.ndarray
    hashes: list

    def shape(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Turn hashes, where each path starts, its turns, and those it shares with the path before."""
        turns = np.array([len(p) // UNIT for p in self.paths], np.int64)
        starts = np.concatenate([[0], np.cumsum(turns)[:-1]])
        units = np.frombuffer(b"".join(self.paths), ">u8").reshape(-1, 2)
        shared = np.zeros(len(turns), np.int64)
        same, depth = np.arange(1, len(turns)), 0
        while len(same):
            same = same[(turns[same] > depth) & (turns[same - 1] > depth)]
            same = same[(units[starts[same] + depth] == units[starts[same - 1] + depth]).all(axis=1)]
            depth += 1
            shared[same] = depth
        return units, starts, turns, shared


@dataclass
class Peeled:
    """Closed nodes, open records and, for every record given, the first member of its node."""

    nodes: dict[str, np.ndarray]
    opened: dict[str, np.ndarray]
    first_of_record: np.ndarray


def peel(block: Block, closing: bool) -> Peeled:
    """All nodes of a block, the deepest first. With `closing` no node goes on elsewhere."""
    units, starts, turns, shared = block.shape()
    last, order = len(turns) - 1, np.argsort(-block.depth, kind="stable")
    falling = -block.depth[order]
    nothing = np.zeros(0, np.int64)
    live = {name: nothing for name in ("row", "open", "ends", *_COUNTS)}
    nodes: list[dict[str, np.ndarray]] = []
    opened: list[dict[str, np.ndarray]] = []
    first_of_record = np.zeros(len(block.row), np.int64)
    for depth in range(int(turns.max()), -1, -1):
        new = order[np.searchsorted(falling, -depth, "left"):np.searchsorted(falling, -depth, "right")]
        shut = live["open"] == 0
        # What is left of the depth below, its last turn stripped, and what ends here.
        row = np.concatenate([live["row"], block.row[new]])
        parts = {
            "n": np.where(shut, live["n"], 0), "first": np.where(shut, live["first"], _NONE),
            "kids": shut.astype(np.int64), "leaves": np.where(shut, live["leaves"], 0),
            "saved": np.where(shut, live["saved"], 0),
        }
        parts = {name: np.concatenate([parts[name], block.counts[name][new]]) for name in _COUNTS}
        ends = np.concatenate([np.full(len(shut), -1), block.ends[new]])
        by_row = np.argsort(row, kind="stable")
        row = row[by_row]
        begins = (shared[row] < depth) & np.concatenate([[True], row[1:] != row[:-1]])
        begins[0] = True
        at = np.flatnonzero(begins)
        node = {name: (np.minimum if name == "first" else np.add).reduceat(parts[name][by_row], at)
                for name in _COUNTS}
        node["ends"] = np.maximum.reduceat(ends[by_row], at)
        node["row"] = row[at]
        first_side = node["row"] == 0
        last_side = np.arange(len(at)) == (len(at) - 1 if turns[last] >= depth else -1)
        node["open"] = ((first_side | last_side) & (not closing)).astype(np.int64)
        length = (units[starts[node["row"]] + depth - 1, 1] & 0xFFFFFFFF).astype(np.int64) if depth else 0
        whole = node["open"] == 0
        node["leaves"] = np.where(whole & (node["kids"] == 0), 1, node["leaves"])
        node["saved"] = np.where(whole, node["saved"] + (node["n"] - 1) * length, node["saved"])
        place = np.empty(len(row), np.int64)
        place[by_row] = np.cumsum(begins) - 1
        above, mine = place[:len(shut)][shut], place[len(shut):]
        first_of_record[new] = node["first"][mine]
        side = np.where(whole, -1, np.where(first_side, 0, 1))
        nodes.append({name: live[name][shut] for name in (*_COUNTS, "ends")} | {
            "depth": np.full(shut.sum(), depth + 1), "parent": node["first"][above], "side": side[above]})
        opened.append({name: node[name][~whole] for name in (*_COUNTS, "ends")} | {
            "depth": np.full((~whole).sum(), depth), "side": side[~whole]})
        live = node
    if closing:
        nodes.append({name: live[name] for name in (*_COUNTS, "ends")} | {
            "depth": np.zeros(1, np.int64), "parent": np.full(1, _NONE), "side": np.full(1, -1)})
    gather = lambda parts: {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
    return Peeled(gather(nodes), gather(opened), first_of_record)


def _rows(count: int, **columns) -> pa.RecordBatch:
    kinds = {"ends": pa.string(), "side": pa.int32(), "path": pa.binary(), "records": pa.binary(),
             "record_ends": pa.list_(pa.string())}
    return pa.RecordBatch.from_arrays([
        pa.array(columns[name], kinds.get(name, pa.int64())) if name in columns
        else pa.nulls(count, kinds.get(name, pa.int64())) for name in _NAMES], _NAMES)


def _node_rows(nodes: dict[str, np.ndarray], hashes: list, block: int) -> pa.RecordBatch:
    parent = [None if p == _NONE or s >= 0 else p for p, s in zip(nodes["parent"].tolist(), nodes["side"].tolist())]
    return _rows(
        len(parent), conv_id=nodes["first"], depth=nodes["depth"], parent=parent, n=nodes["n"],
        kids=nodes["kids"], leaves=nodes["leaves"], saved=nodes["saved"],
        ends=[NOTHING if e < 0 else hashes[e] for e in nodes["ends"].tolist()],
        block=np.full(len(parent), block), side=nodes["side"].astype(np.int32))


def _peel_blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32

    def done(tables: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal number
        table = pa.Table.from_batches(tables)
        paths, n = table.column("path").to_pylist(), table.num_rows
        zeros = np.zeros(n, np.int64)
        block = Block(
            paths, np.arange(n), np.array([len(p) // UNIT for p in paths], np.int64),
            {"n": np.asarray(table.column("n")), "first": np.asarray(table.column("first")),
             "kids": zeros, "leaves": zeros, "saved": zeros},
            np.arange(n), table.column("ends").to_pylist())
        found = peel(block, closing=False)
        if len(found.nodes["n"]):
            yield _node_rows(found.nodes, block.hashes, number)
        for side, path in ((0, paths[0]), (1, paths[-1])):
            mine = np.flatnonzero(found.opened["side"] == side)
            if not len(mine):
                continue
            table = np.stack([found.opened[name][mine] for name in ("depth", *_COUNTS)], axis=1)
            ends = [None if e < 0 else block.hashes[e] for e in found.opened["ends"][mine].tolist()]
            yield _rows(1, block=[number], side=[side], path=[path], records=[table.astype("<i8").tobytes()],
                        record_ends=[ends])
        number += 1

    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, block_rows):
            part = batch.slice(at, block_rows)
            held.append(part)
            rows, size = rows + part.num_rows, size + part.nbytes
            if rows >= block_rows or size >= BLOCK_BYTES:
                yield from done(held)
                held, rows, size = [], 0, 0
    if held:
        yield from done(held)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Peel the open paths of all blocks; also say which member stands for each open prefix."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    records = [np.frombuffer(r, "<i8").reshape(-1, 6) for r in table.column("records").to_pylist()]
    known = np.concatenate(records)
    row = np.repeat(np.arange(len(records)), [len(r) for r in records])
    hashes = [e for ends in table.column("record_ends").to_pylist() for e in ends]
    ends = np.array([-1 if e is None else at for at, e in enumerate(hashes)])
    block = Block(table.column("path").to_pylist(), row, known[:, 0],
                  {name: known[:, at] for at, name in enumerate(_COUNTS, start=1)}, ends, hashes)
    found = peel(block, closing=True)
    yield _node_rows(found.nodes, hashes, -1)
    blocks, sides = (np.asarray(table.column(c))[row] for c in ("block", "side"))
    yield _rows(len(row), block=blocks, side=sides, depth=known[:, 0], conv_id=found.first_of_record)


def trie(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    laid = classes(paths(conversations)).repartitionByRange(
        shuffle_partitions(spark), "path").sortWithinPartitions("path")
    made = write_out(laid.select("path", "n", "first", "ends").mapInArrow(
        lambda batches: _peel_blocks(batches, block_rows), _NODE), "peeled")
    # Two rows per block, in path order.
    opened = made.filter("path is not null").select("path", "block", "side", "records", "record_ends")
    closed = write_out(
        opened.repartition(1).sortWithinPartitions("path").mapInArrow(_close, _NODE), "closed")
    nodes = made.filter("path is null")
    stands = closed.filter("n is null").select(
        "block", "side", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("known"))
    under_open = nodes.filter("side >= 0").join(stands, ["block", "side", "depth"]).withColumn(
        "parent", F.col("known")).select(*_NAMES)
    every = nodes.filter("side < 0").unionByName(under_open).unionByName(closed.filter("n is not null"))
    return every.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def oracle(table: str = "conversations") -> str:
    """DuckDB SQL for the rows of `trie`, turns of one number ordered by role and text."""
    # CRC-32 by its definition, bit by bit, over the decimal digits of the id.
    crc = """xor(4294967295, list_reduce(
    list_concat([4294967295::bigint], range(0, 8 * length(cast(conv_id as varchar)))),
    lambda c, i: (case when (case when i % 8 = 0
        then xor(c, ascii(substr(cast(conv_id as varchar), cast(i // 8 + 1 as integer), 1))::bigint) else c end) & 1 = 1
      then xor((case when i % 8 = 0
        then xor(c, ascii(substr(cast(conv_id as varchar), cast(i // 8 + 1 as integer), 1))::bigint) else c end) >> 1,
        3988292384::bigint)
      else (case when i % 8 = 0
        then xor(c, ascii(substr(cast(conv_id as varchar), cast(i // 8 + 1 as integer), 1))::bigint) else c end) >> 1
      end)))"""
    return f"""
with t as (
  select conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} as said,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as k
  from {table} where conv_id is not null),
c as (select conv_id, list(said order by k) as own from t group by conv_id),
h as (select conv_id, own, conv_id - conv_id % 100 as base, {crc} % 6 as h from c),
r as (
  select h.conv_id, list_concat(coalesce(b.own, [])[1:h], h.own[h + 1:]) as path
  from h left join c b on b.conv_id = h.base),
m as (
  select conv_id, len(path) as turns, unnest(range(0, len(path) + 1)) as depth, path from r),
n as (
  select depth, path[1:depth] as node, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where turns = depth), '')) as ends_sha256
  from m group by 1, 2),
f as (
  select n.*, p.conv_id as parent_conv_id,
    coalesce((n.n_convs - 1) * length(n.node[n.depth].text), 0) as own_saved,
    (select count(*) from n k where k.depth = n.depth + 1 and k.node[1:n.depth] = n.node) as n_children
  from n left join n p on p.depth = n.depth - 1 and p.node = n.node[1:n.depth - 1]),
u as (select unnest(range(0, depth + 1)) as up, node, own_saved, n_children from f),
s as (
  select up, node[1:up] as node, sum(own_saved) as saved_tokens, count(*) filter (where n_children = 0) as n_leaves
  from u group by 1, 2)
select f.conv_id, f.depth, f.parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
  cast(s.saved_tokens as bigint) as saved_tokens, f.ends_sha256
from f join s on s.up = f.depth and s.node = f.node"""
