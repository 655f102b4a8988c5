"""SentencePiece encoding with source offsets, and decoding.

The model file is read here: pieces with scores and kinds, and the normaliser
with its compiled character map (a double array of prefixes and the texts they
become). Normalisation takes the longest prefix of the map at each place,
records for every normalised byte the source bytes it stands for, writes spaces
as the space mark and puts one before the text. Merging joins the neighbours of
the best score, the leftmost first, and characters without a piece become byte
pieces. Every piece is projected to the bytes of the source it came from; the
spans of a text tile it.

A merge cannot join two characters that stand side by side in no piece, so a
normalised text falls into runs that are merged alone. Without a character map
and where no piece has a space mark after another character, a text falls into
its words; a batch of texts is then encoded by its distinct words, and runs met
again are looked up.

Models must be byte-pair models with byte fallback and without user-defined
pieces; others raise ValueError.

Defined cases: a null text is empty and has no pieces; rows keep their id, also
null or repeated; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import struct
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keptvisit.llm.exchange import text_offsets

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Runs that a worker remembers in each of two generations.
REMEMBERED = 250_000
BATCH_CHARS = 1 << 20


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol buffer message: numbers, and the bytes of all else."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = 4 if kind == 5 else 8
            value = data[at:at + size]
            at += size
        yield tag >> 3, value


class CharacterMap:
    """A compiled character map: a double array over UTF-8 prefixes and their texts."""

    def __init__(self, data: bytes):
        size = struct.unpack_from("<I", data)[0] if data else 0
        self.units = struct.unpack_from(f"<{size // 4}I", data, 4) if data else ()
        self.texts = data[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest prefix at `at`, if there is one."""
        if not self.units:
            return None
        node, found = 0, None
        node ^= self._offset(self.units[0])
        for length, byte in enumerate(data[at:], 1):
            node ^= byte
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = length, self.texts[start:self.texts.index(b"\0", start)]
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 512) >> 6)


class Model:
    """A SentencePiece model."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        self.id_bytes: dict[int, int] = {}
        self.silent: set[int] = set()
        charsmap, self.dummy, self.squeeze, self.escape, kind = b"", True, True, True, 1
        for field, value in _fields(data):
            if field == 1:
                self._add(dict(_fields(value)))
            elif field == 2:
                kind = dict(_fields(value)).get(3, 1)
            elif field == 3:
                spec = dict(_fields(value))
                charsmap = spec.get(2, b"")
                self.dummy, self.squeeze, self.escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        if kind != 2 or len(self.byte_ids) != 256 or not self.escape:
            raise ValueError("the model must be a byte-pair model with byte fallback")
        self.map = CharacterMap(charsmap)
        self.pairs = {p[i:i + 2] for p in self.scores for i in range(len(p) - 1)}
        # Words can be taken apart at single spaces when no piece goes on after one.
        self.by_word = not charsmap and self.dummy and not self.squeeze and not any(
            pair[1] == MARK != pair[0] for pair in self.pairs)
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}
        # What each id stands for in bytes; control pieces are silent.
        self.spelled = pa.array([
            b"" if n in self.silent else bytes([self.id_bytes[n]]) if n in self.id_bytes
            else piece.replace(MARK, " ").encode() for n, piece in enumerate(self.pieces)], pa.binary())

    def _add(self, piece: dict) -> None:
        text, kind, number = piece[1].decode(), piece.get(3, NORMAL), len(self.pieces)
        self.pieces.append(text)
        if kind == USER_DEFINED:
            raise ValueError("user-defined pieces are not supported")
        if kind in (NORMAL, UNUSED):
            self.scores[text] = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            self.ids[text] = number
        elif kind == BYTE:
            self.byte_ids[int(text[3:5], 16)] = number
            self.id_bytes[number] = int(text[3:5], 16)
        elif kind == CONTROL:
            self.silent.add(number)

    def normalise(self, text: str, first: bool = True) -> tuple[str, list[int]]:
        """The normalised text, and per character the source byte at which it ends.

        `first` says that the text begins here, where the dummy space goes.
        """
        if not self.map.units and not self.squeeze:
            # Without a map every character stands for itself.
            sizes = [1] * len(text) if text.isascii() else [len(c.encode()) for c in text]
            mark = first and self.dummy and text != ""
            return (MARK if mark else "") + text.replace(" ", MARK), [0] * mark + list(accumulate(sizes))
        data = text.encode()
        parts: list[tuple[str, int]] = []
        at = 0
        while at < len(data):
            found = self.map.longest(data, at)
            if found is None:
                lead = data[at]
                length = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = length, data[at:at + length]
            at += found[0]
            parts.append((found[1].decode(), at))
        out: list[str] = []
        ends: list[int] = []

        def put(char: str, end: int) -> None:
            out.append(MARK if char == " " else char)
            ends.append(end)

        if self.squeeze:
            while parts and not parts[0][0].strip(" "):
                parts.pop(0)
        if first and self.dummy and parts:
            put(" ", 0)
        spaced = self.squeeze and bool(parts)
        for piece, end in parts:
            if spaced and self.squeeze:
                piece = piece.lstrip(" ")
            for char in piece:
                put(char, end)
            # What became nothing belongs to the character before it.
            if not piece and ends:
                ends[-1] = end
            if piece:
                spaced = piece.endswith(" ")
        if self.squeeze:
            while out and out[-1] == MARK:
                out.pop()
                ends.pop()
        if ends:
            ends[-1] = len(data)
        return "".join(out), ends

    def runs(self, text: str) -> Iterator[str]:
        """The parts of a normalised text that no merge can join."""
        start = 0
        for i in range(1, len(text)):
            if text[i - 1:i + 1] not in self.pairs:
                yield text[start:i]
                start = i
        if start < len(text):
            yield text[start:]

    def merge(self, text: str) -> list[str]:
        """The pieces of a normalised segment, characters without a piece alone."""
        parts = list(text)
        if len(parts) > 48:
            return self._merge_long(parts)
        score, never = self.scores.get, float("-inf")
        pairs = [score(a + b, never) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == never:
                break
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], never)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], never)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        after = list(range(1, len(parts))) + [-1]
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                both = parts[left] + parts[right]
                score = self.scores.get(both)
                if score is not None:
                    heapq.heappush(queue, (-score, left, right, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            _, left, right, both = heapq.heappop(queue)
            if not parts[left] or not parts[right] or parts[left] + parts[right] != both or after[left] != right:
                continue
            parts[left], parts[right] = both, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p]

    def encode(self, text: str, first: bool = True) -> tuple[list[int], list[int]]:
        """Piece ids, and the source byte at which each piece ends."""
        normal, stops = self.normalise(text, first)
        ids: list[int] = []
        ends: list[int] = []
        at = 0
        for run in self.runs(normal):
            for piece in self.merge(run):
                begin = stops[at - 1] if at else 0
                at += len(piece)
                number = self.ids.get(piece)
                if number is not None:
                    ids.append(number)
                    ends.append(stops[at - 1])
                    continue
                # Byte pieces: all but the last have an empty span.
                numbers = [self.byte_ids[b] for b in piece.encode()]
                ids += numbers
                ends += [begin] * (len(numbers) - 1) + [stops[at - 1]]
        return ids, ends

    def decode(self, ids: list[int], first: bool = True) -> str:
        """The text of the ids; runs of byte pieces are UTF-8, what is invalid is replaced."""
        out: list[str] = []
        held = bytearray()
        for number in ids:
            byte = self.id_bytes.get(number)
            if byte is not None:
                held.append(byte)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if number not in self.silent:
                piece = self.pieces[number]
                if first and not out and (self.dummy or self.squeeze) and piece.startswith(MARK):
                    piece = piece[1:]
                    out.append("")
                out.append(piece.replace(MARK, " "))
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out)

    def _run(self, run: str) -> tuple[bytes, bytes]:
        """Ids and lengths in bytes of the pieces of a run, looked up when it was met before."""
        found = self.young.get(run)
        if found is None:
            found = self.old.get(run)
            if found is None:
                ids, lengths = array("i"), array("i")
                for piece in self.merge(run):
                    number = self.ids.get(piece)
                    if number is None:
                        data = piece.encode()
                        ids.extend([self.byte_ids[b] for b in data])
                        lengths.extend([0] * (len(data) - 1) + [len(data)])
                    else:
                        ids.append(number)
                        lengths.append(len(piece) if piece.isascii() else len(piece.encode()))
                found = ids.tobytes(), lengths.tobytes()
            self.young[run] = found
            if len(self.young) > REMEMBERED:
                self.young, self.old = {}, self.young
        return found

    def _word(self, word: str) -> tuple[bytes, bytes]:
        """Ids and lengths in bytes of a space mark and a word."""
        text = MARK + word
        pairs, young = self.pairs, self.young
        if text in young:
            return young[text]
        cuts = [i for i in range(1, len(text)) if text[i - 1:i + 1] not in pairs]
        if not cuts:
            return self._run(text)
        runs = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        found = [young.get(run) or self._run(run) for run in runs]
        return b"".join([f[0] for f in found]), b"".join([f[1] for f in found])

    def _words(self, texts: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids and span lengths of texts whose words stand between single spaces."""
        words = pc.split_pattern(texts, " ")
        flat = words.flatten().dictionary_encode()
        found = [self._word(w) for w in flat.dictionary.to_pylist()]
        ids, lengths = (_lists([f[k] for f in found]).take(flat.indices) for k in (0, 1))
        counts = np.asarray(ids.value_lengths())
        begins = np.concatenate([[0], np.cumsum(counts)])
        bounds = np.asarray(words.offsets) - words.offsets[0].as_py()
        spans = np.array(lengths.flatten())
        later = np.ones(len(counts), bool)
        later[bounds[:-1]] = False
        # The first piece has the mark: the space before the word, or nothing in the source.
        spans[begins[:-1]] -= len(MARK.encode()) - later
        offsets = pa.array(begins[bounds].astype(np.int32))
        return (pa.ListArray.from_arrays(offsets, ids.flatten()),
                pa.ListArray.from_arrays(offsets, pa.array(spans)))

    def encode_batch(self, texts: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
        """`encode` for an array of texts: ids, and the source bytes of each piece."""
        texts = pc.fill_null(texts, "")
        if self.by_word:
            whole = pc.or_(pc.or_(pc.equal(texts, ""), pc.starts_with(texts, " ")),
                           pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, MARK)))
        else:
            whole = pa.array(np.ones(len(texts), bool))
        ids, lengths = [], []
        for text in texts.filter(whole).to_pylist():
            numbers, ends = self.encode(text)
            ids.append(array("i", numbers).tobytes())
            lengths.append(array("i", [b - a for a, b in zip([0, *ends], ends)]).tobytes())
        apart = texts.filter(pc.invert(whole))
        out = _lists(ids), _lists(lengths)
        if len(apart):
            out = tuple(pa.concat_arrays([a, b]) for a, b in zip(self._words(apart), out))
        place = np.argsort(np.argsort(np.asarray(whole), kind="stable"), kind="stable")
        return out[0].take(pa.array(place)), out[1].take(pa.array(place))

    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        """`decode` for an array of id lists."""
        spelled = pa.ListArray.from_arrays(ids.offsets, self.spelled.take(ids.values))
        data = pc.binary_join(spelled, b"").to_pylist()
        bounds, numbers = np.asarray(ids.offsets), np.asarray(ids.values)
        texts = []
        for at, raw in enumerate(data):
            own = numbers[bounds[at]:bounds[at + 1]]
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                texts.append(self.decode(own.tolist()))
                continue
            strip = (len(own) and (self.dummy or self.squeeze)
                     and self.pieces[own[0]].startswith(MARK))
            texts.append(text[1:] if strip else text)
        return pa.array(texts, pa.string())


_MODELS: dict[int, Model] = {}


def _lists(parts: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode(docs: DataFrame, model_file: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, `ids`, `lengths` and `decoded`.

    `lengths` are the source bytes of each piece, one after the other: their
    running sum gives the spans. `decoded` is the text of the ids.
    """
    with open(model_file, "rb") as file:
        data = file.read()
    Model(data)  # what it cannot handle shows here
    sent = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = hash(sent.value)
        if number not in _MODELS:
            _MODELS[number] = Model(sent.value)
        model = _MODELS[number]
        for batch in batches:
            sizes = text_offsets(batch.column("text"))
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(sizes, sizes[at] + BATCH_CHARS, "right")) - 1)
                part = batch.slice(at, stop - at)
                at = stop
                ids, lengths = model.encode_batch(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), ids, lengths, model.decode_batch(ids)],
                    ["id", "ids", "lengths", "decoded"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, ids array<int>, lengths array<int>, decoded string")
    return out.withColumnRenamed("id", id)


def digests(encoded: DataFrame) -> DataFrame:
    """Per row the number of ids and SHA-256 digests of ids, span lengths and decoded text."""
    comma = lambda c: F.sha2(F.concat_ws(",", F.col(c).cast("array<string>")), 256)
    others = [c for c in encoded.columns if c not in ("ids", "lengths", "decoded")]
    return encoded.select(
        *others, F.size("ids").cast("long").alias("n_tokens"), comma("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), comma("lengths").alias("lengths_sha256"))
