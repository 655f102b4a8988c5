"""The conversation trie beside a plain one of nested dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from keptvisit.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {conv: [t[2:] for t in sorted(turns)] for conv, turns in own.items()}
    rebuilt = {}
    for conv, turns in said.items():
        head = zlib.crc32(str(conv).encode()) % 6
        rebuilt[conv] = tuple(said.get(conv - conv % 100, [])[:head] + turns[head:])
    members = defaultdict(list)
    for conv, path in rebuilt.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(own) - 1) * len(node[-1][1]) if node else 0
    ends = lambda node: ",".join(str(c) for c in sorted(members[node]) if rebuilt[c] == node)
    return {
        (min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children[node],
         leaves[node], saved[node], hashlib.sha256(ends(node).encode()).hexdigest())
        for node, own in members.items()}


def made(seed, n):
    rng = random.Random(seed)
    texts = ["", "a", "b", "éé", "long " * 40]
    rows = []
    for conv in rng.sample(range(1500), n):
        for turn in range(rng.choice([1, 2, 3, 5, 9, 14])):
            rows.append((conv, turn, rng.choice(["user", "assistant"]) if turn > 2 else "user",
                         rng.choice(texts[:2] if rng.random() < 0.8 else texts)))
    # A hot group of equal conversations, some of which go on, and one very long one with a near copy.
    rows += [(2000 + c, t, "user", "same") for c in range(200) for t in range(7 if c % 5 else 9)]
    rows += [(c, t, "user", f"turn {t}" if (c, t) != (2301, 290) else "other") for c in (2300, 2301) for t in range(300)]
    return rows


@pytest.mark.parametrize("block_rows", [1, 3, 50, 65_536])
def test_equals_a_plain_trie(spark, block_rows):
    rows = made(block_rows, 400)
    found = [tuple(r) for r in prefixes.trie(spark.createDataFrame(rows, SCHEMA), block_rows).collect()]
    wanted = brute(rows)
    assert len(found) == len(wanted) and set(found) == wanted


def test_odd_rows(spark):
    rows = [
        (0, 1, "user", "b"), (0, None, None, None), (0, 0, "user", "a"), (0, 0, "user", "a"),
        (100, 0, "", ""), (100, 0, None, None), (7, 5, "user", "x" * 100_000), (None, 0, "user", "a"),
        (8, 0, "a", "bc"), (9, 0, "ab", "c"), (-5, 0, "user", "a"), (-105, 3, "user", "a"),
    ]
    frame = spark.createDataFrame(
        [(*row, "clash", 1) for row in rows], SCHEMA + ", path string, n long")
    found = [tuple(r) for r in prefixes.trie(frame, 2).collect()]
    # The remainder takes the sign of the id, so an id below 0 belongs to the hundred above it.
    plain = [(c, t, r, x) for c, t, r, x in rows if c is None or c >= 0]
    assert [tuple(r) for r in prefixes.trie(frame.filter("conv_id >= 0 or conv_id is null")).collect()] and {
        tuple(r) for r in prefixes.trie(frame.filter("conv_id >= 0")).collect()} == brute(plain)
    assert sum(depth == 0 for _, depth, *_ in found) == 1
    assert prefixes.trie(frame.limit(0)).collect() == []
    assert prefixes.trie(frame.filter("conv_id is null")).collect() == []
