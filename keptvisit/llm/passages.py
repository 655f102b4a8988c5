"""Substring dedup by content-defined chunking with a gear rolling hash.

A gear hash runs over the bytes of each text and a chunk ends where its upper
bits are zero. The place of a cut depends on the last 16 bytes only, so an
insertion shifts no cut behind it, and a repeated passage has the same chunks
wherever it stands. Chunks are looked up by digest over the whole corpus. Where
a run of chunks that other documents have too, with the pieces of chunk at its
ends, could hold a passage, every window of `words` words in it is looked up
exactly; what repeats is reported, and removed from all but the document with
the smallest id. A passage with fewer than two cuts of its own, as of one line
over and over, need not share a chunk; such windows are looked up wherever they
stand. That depends on the window alone, so all its copies are found.

Texts are compared with ASCII letters in lower case and every run of ASCII
white space as one space; places are counted in words.

Defined cases: a null text is empty; every input row is a document, so a
repeated row repeats its passages; a null id comes after all others; a passage
repeated within one document only is no repeat; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keptvisit.llm import exchange

WORDS = 50
WINDOW = 16  # bytes that a cut depends on
CUT_BITS = 4  # one byte in 16 ends a chunk
SEED = 23
LAST = np.iinfo(np.int64).max
_ROOT = 0x9E3779B97F4A7C15
_INVERSE = pow(_ROOT, -1, 1 << 64)


@cache
def _gear() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint32)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, base, np.uint64))])
                     for base in (_ROOT, _INVERSE))


def plain(texts: pa.Array) -> list[bytes]:
    """The texts as compared: words of lower case joined by one space."""
    return [b" ".join((t or "").encode().lower().split()) for t in texts.to_pylist()]


def cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Cuts of the gear hash in texts laid end to end; `bounds` has their starts and the end."""
    rolled = _gear()[data]
    step = 1
    while step < WINDOW:
        later = rolled.copy()
        later[step:] += rolled[:-step] << np.uint32(step)
        rolled, step = later, step * 2
    ends = np.flatnonzero(rolled >> np.uint32(32 - CUT_BITS) == 0) + 1
    start = bounds[np.searchsorted(bounds, ends, "left") - 1]
    # A cut needs its whole window in its own text.
    return ends[ends - start >= WINDOW]


class Chunked:
    """The texts of a unit, their words and chunks."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        data = b"".join(texts)
        raw = np.frombuffer(data, np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.cuts = cuts(raw, self.bounds) if len(raw) else np.empty(0, np.int64)
        ends = np.unique(np.concatenate([self.cuts, self.bounds[1:]]))
        ends = ends[ends > 0]
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        self.digests = np.fromiter(
            (xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())),
            np.uint64, len(ends))
        self.owner = np.searchsorted(self.bounds, starts, "right") - 1
        begin = self.bounds[self.owner]
        self.spaces = np.flatnonzero(raw == 32)
        spaces = np.concatenate([[0], np.cumsum(raw == 32)])
        # A passage may begin a window before the last cut that it does not share.
        self.first_word = spaces[np.maximum(starts - WINDOW, begin)] - spaces[begin]
        self.end_word = spaces[ends] - spaces[begin] + 1

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.digests, return_inverse=True)

    def uncut_windows(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Text and first word of every window with fewer than two cuts, so no whole chunk."""
        filled = self.bounds[1:] > self.bounds[:-1]
        starts = np.sort(np.concatenate([self.bounds[:-1][filled], self.spaces + 1]))
        ends = np.sort(np.concatenate([self.bounds[1:][filled], self.spaces]))
        starts, ends = starts[:max(len(starts) - words + 1, 0)], ends[words - 1:]
        first_cut = np.searchsorted(self.cuts, starts + WINDOW, "left")
        second = np.concatenate([self.cuts, [LAST, LAST]])[first_cut + 1]
        at = np.flatnonzero(second > ends)
        owner = np.searchsorted(self.bounds, starts[at], "right") - 1
        within = ends[at] <= self.bounds[owner + 1]
        at, owner = at[within], owner[within]
        before = np.searchsorted(self.spaces, self.bounds[owner], "left")
        return owner, np.searchsorted(self.spaces, starts[at], "left") - before


def holders(keys: np.ndarray, place: np.ndarray, owner: np.ndarray, ids: np.ndarray):
    """Per key the number of documents of the unit that hold it, and the smallest id of them."""
    pairs = np.unique(place * np.int64(max(len(ids), 1)) + owner)
    held, who = pairs // max(len(ids), 1), pairs % max(len(ids), 1)
    least = np.full(len(keys), LAST)
    np.minimum.at(least, held, ids[who])
    return keys, [np.bincount(held, minlength=len(keys)), least]


def _pack_texts(batch: pa.RecordBatch) -> bytes:
    ids = batch.column("id")
    texts = plain(batch.column("text"))
    raw = b"".join(texts)
    padded = np.frombuffer(raw + b"\0" * (-len(raw) % 8), np.int64)
    packed = pa.compress(padded, codec="zstd", asbytes=True)
    return exchange.pack(
        np.asarray(pc.fill_null(ids, LAST)), np.array([len(t) for t in texts], np.int64),
    ) + np.array([-1, len(raw)], np.int64).tobytes() + packed


def _read_texts(payload: bytes) -> tuple[np.ndarray, list[bytes]]:
    at = 0
    for _ in range(2):
        at += 16 + int(np.frombuffer(payload, np.int64, 2, at)[1])
    ids, lengths = exchange.unpack(payload[:at])
    size = int(np.frombuffer(payload, np.int64, 2, at)[1])
    raw = pa.decompress(payload[at + 16:], size + -size % 8, "zstd", asbytes=True)[:size]
    ends = np.cumsum(lengths)
    return ids, [raw[b - n:b] for b, n in zip(ends.tolist(), lengths.tolist())]


def _ask_chunks(payload: bytes):
    ids, texts = _read_texts(payload)
    unit = Chunked(texts)
    keys, place = unit.keys()
    return holders(keys, place, unit.owner, ids)


def window_keys(text: bytes, words: int) -> np.ndarray:
    """A key of every run of `words` words of a text."""
    parts = text.split()
    if len(parts) < words:
        return np.empty(0, np.uint64)
    values = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in parts), np.uint64, len(parts))
    up, down = _powers(1 << max(10, len(parts).bit_length()))
    running = np.concatenate([[np.uint64(0)], np.cumsum(values * up[:len(parts)], dtype=np.uint64)])
    found = (running[words:] - running[:-words]) * down[:len(parts) - words + 1]
    found = (found ^ (found >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return found ^ (found >> np.uint64(30))


def candidate_windows(unit: Chunked, repeated: np.ndarray, words: int) -> list[np.ndarray]:
    """Per text the windows that can repeat.

    They lie within runs of repeated chunks and the chunks beside them, or hold no whole chunk.
    """
    n = len(repeated)
    out = [np.empty(0, np.int64)] * len(unit.texts)
    if not n:
        return out
    change = np.flatnonzero((repeated[1:] != repeated[:-1]) | (unit.owner[1:] != unit.owner[:-1])) + 1
    firsts, lasts = np.concatenate([[0], change]), np.concatenate([change, [n]]) - 1
    some = repeated[firsts]
    firsts, lasts = firsts[some], lasts[some]
    before = np.maximum(firsts - 1, 0)
    before = np.where(unit.owner[before] == unit.owner[firsts], before, firsts)
    after = np.minimum(lasts + 1, n - 1)
    after = np.where(unit.owner[after] == unit.owner[lasts], after, lasts)
    low, high = unit.first_word[before], unit.end_word[after]
    wide = high - low >= words
    for doc, a, b in zip(unit.owner[firsts[wide]].tolist(), low[wide].tolist(), high[wide].tolist()):
        out[doc] = np.concatenate([out[doc], np.arange(a, b - words + 1)])
    owner, first = unit.uncut_windows(words)
    some = np.flatnonzero(np.diff(owner, prepend=-1))
    for doc, own in zip(owner[some].tolist(), np.split(first, some[1:])):
        out[doc] = np.concatenate([out[doc], own])
    return [np.unique(o) for o in out]


def _windows(words: int):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts = _read_texts(left.column("payload")[0].as_py())
        unit = Chunked(texts)
        answers = exchange.answered(right)
        repeated = answers[0][unit.keys()[1]] > 1 if answers else np.zeros(0, bool)
        found = candidate_windows(unit, repeated, words)
        rows, keys, starts, counts, lengths = [], [], [], [], []
        for at, own in enumerate(found):
            if len(own):
                every = window_keys(texts[at], words)
                own = own[own < len(every)]
                if len(own):
                    rows.append(ids[at])
                    keys.append(every[own])
                    starts.append(own)
                    counts.append(len(own))
                    lengths.append(len(texts[at].split()))
        if not rows:
            return pa.table({"unit": pa.array([], pa.int64()), "payload": pa.array([], pa.binary())})
        packed = exchange.pack(
            np.array(rows, np.int64), np.array(lengths, np.int64), np.array(counts, np.int64),
            np.concatenate(starts), np.concatenate(keys).view(np.int64))
        return pa.table({"unit": left.column("unit"), "payload": pa.array([packed], pa.binary())})

    return work


def _ask_windows(payload: bytes):
    ids, _, counts, _, keys = exchange.unpack(payload)
    distinct, place = np.unique(keys.view(np.uint64), return_inverse=True)
    return holders(distinct, place, np.repeat(np.arange(len(ids)), counts), ids)


def covered(starts: np.ndarray, words: int) -> list[tuple[int, int]]:
    """The union of windows as ranges of words."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > words)
    firsts = np.concatenate([[0], gap + 1])
    lasts = np.concatenate([gap, [len(starts) - 1]])
    return [(int(starts[a]), int(starts[b]) + words) for a, b in zip(firsts, lasts)]


def _spans(words: int):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, lengths, counts, starts, keys = exchange.unpack(left.column("payload")[0].as_py())
        n_docs, first = exchange.answered(right)
        place = np.unique(keys.view(np.uint64), return_inverse=True)[1]
        n_docs, first = n_docs[place], first[place]
        rows = []
        for at, (end, n) in enumerate(zip(np.cumsum(counts), counts)):
            own = slice(end - n, end)
            again = n_docs[own] > 1
            if not again.any():
                continue
            spans = covered(starts[own][again], words)
            removed = covered(starts[own][again & (first[own] != ids[at])], words)
            others = np.unique(first[own][again])
            rows.append({
                "id": None if ids[at] == LAST else int(ids[at]), "n_words": int(lengths[at]),
                "repeated_words": sum(b - a for a, b in spans),
                "removed_words": sum(b - a for a, b in removed),
                "n_documents": int(n_docs[own].max()),
                "spans": spans, "removed": removed,
                "first_ids": [int(i) for i in others if i != LAST],
            })
        return pa.Table.from_pylist([{
            **r, "spans": [{"start": a, "stop": b} for a, b in r["spans"]],
            "removed": [{"start": a, "stop": b} for a, b in r["removed"]]} for r in rows], _RESULT)

    return work


_RANGE = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_RESULT = pa.schema([
    ("id", pa.int64()), ("n_words", pa.int64()), ("repeated_words", pa.int64()),
    ("removed_words", pa.int64()), ("n_documents", pa.int64()),
    ("spans", _RANGE), ("removed", _RANGE), ("first_ids", pa.list_(pa.int64()))])


def repeats(docs: DataFrame, *, id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """One row per document with a passage of `words` or more words that another document has.

    Columns: id, n_words, repeated_words, removed_words, n_documents (the most
    that share a passage), `spans` and `removed` (ranges of words), first_ids
    (the documents in which the passages are kept).
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    packed = exchange.units(rows, "text", _pack_texts, "chunked")
    ops = [exchange.SUM, exchange.MIN]
    chunks = exchange.totals(packed, _ask_chunks, ops, "chunks", 1 << 18)
    windows = exchange.write_out(exchange.with_answers(
        packed, chunks, _windows(words), "unit long, payload binary"), "windows")
    found = exchange.totals(windows, _ask_windows, ops, "passages", 1 << 18)
    out = exchange.with_answers(
        windows, found, _spans(words),
        "id long, n_words long, repeated_words long, removed_words long, n_documents long, "
        "spans array<struct<start:long,stop:long>>, removed array<struct<start:long,stop:long>>, "
        "first_ids array<long>")
    return out.withColumnRenamed("id", id)


def report(found: DataFrame) -> DataFrame:
    """`repeats` with its ranges as start:stop, comma-joined."""
    text = lambda c: F.concat_ws(",", F.transform(
        c, lambda s: F.concat_ws(":", s["start"], s["stop"]))).alias(c)
    return found.select(*[text(c) if c in ("spans", "removed") else F.col(c) for c in found.columns])
