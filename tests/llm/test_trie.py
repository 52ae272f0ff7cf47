"""The trie against a plain one, with shards of all sizes."""

from __future__ import annotations

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import trie
from touchline.llm.batches import fold
from touchline.llm.trie import Parentheses, build_trie, rebuilt, subtree_least

SCHEMA = "conv_id long, turn int, role string, text string, name int, path string"


def plain(rows: list[tuple]) -> list[tuple]:
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        whole[c] = [*own.get(base, [])[:h], *turns[h:]]
    nodes: dict[tuple, list[int]] = {}
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            nodes.setdefault(tuple(whole[c][:d]), []).append(c)
    kids: dict[tuple, int] = dict.fromkeys(nodes, 0)
    for path in nodes:
        if path:
            kids[path[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += kids[path] == 0
            saved[path[:d]] += (len(members) - 1) * words
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in members if len(whole[c]) == len(path))
        parent = nodes[path[:-1]][0] if path else None
        out.append((members[0], len(path), parent, len(members), kids[path], leaves[path], saved[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, scratch, rows: list[tuple], parts: int = 3) -> list[tuple]:
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)
    whole = rebuilt(turns, F.col("conv_id") - F.col("conv_id") % 20, fold("conv_id", 4).cast("int"))
    return sorted((tuple(r) for r in build_trie(scratch.write(whole), scratch).collect()), key=str)


def dialogues(n: int, seed: int, deep: int = 6) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["hello there", "hello", "", None, "a b\tc\nd", "a\x1cb", "é  é"]
    return [
        (c, t if rng.random() < 0.95 else None, rng.choice(["user", None, "bot"]) if rng.random() < 0.3 else "user", rng.choice(texts))
        for c in range(n)
        for t in range(rng.randrange(deep + 1))
    ]


@pytest.fixture
def small(monkeypatch):
    """Shards of few records, so that spines meet in several rounds."""
    monkeypatch.setattr(trie, "SHARD_TURNS", 20)
    monkeypatch.setattr(trie, "SHARD_RECORDS", 4)


def test_one_shard(spark, scratch):
    rows = dialogues(150, 1)
    rows = [(c, i, r, x) for i, (c, _, r, x) in enumerate(rows)]
    assert found(spark, scratch, rows) == plain(rows)


@pytest.mark.parametrize("seed", [2, 3])
def test_many_shards_of_many_rounds(spark, scratch, small, seed):
    rows = dialogues(400, seed)
    rows = [(c - 60, i, r, x) for i, (c, _, r, x) in enumerate(rows)]
    assert found(spark, scratch, rows) == plain(rows)


def test_equal_conversations_spread_over_shards(spark, scratch, small):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(4)]
    rows += [(c, t, "user", f"turn {min(t, 5)}") for c in range(300, 330) for t in range(2 + c % 7)]
    assert found(spark, scratch, rows) == plain(rows)


def test_long_conversations(spark, scratch, small):
    rows = [(c, t, "user", str(t % 7)) for c in range(5) for t in range(700 + 50 * c)]
    rows += [(c, 0, "user", "0") for c in range(40, 90)]
    assert found(spark, scratch, rows) == plain(rows)


def test_null_ids_ties_and_empty_tables(spark, scratch):
    rows = [(None, 1, "user", "x"), (5, 2, None, None), (5, None, "user", "first"), (7, 1, "user", "x" * 200_000)]
    assert found(spark, scratch, rows) == plain(rows)
    tied = [(5, 1, "user", "b"), (5, 1, "user", "a"), (5, 1, "user", "a")]
    assert found(spark, scratch, tied, 1) == found(spark, scratch, tied[::-1], 2)
    assert found(spark, scratch, []) == []


def naive_close(depth: list[int]) -> list[int]:
    stack, out, at = [], [0] * len(depth), 0
    for i, d in enumerate(depth):
        while stack and depth[stack[-1]] >= d:
            out[stack.pop()] = at
            at += 1
        stack.append(i)
        at += 1
    while stack:
        out[stack.pop()] = at
        at += 1
    return out


@pytest.mark.parametrize("shape", ["random", "chain", "star", "comb", "one"])
def test_find_close(shape):
    rng = random.Random(7)
    depth = {"chain": list(range(5000)), "star": [0] + [1] * 5000, "one": [0]}.get(shape)
    if depth is None:
        depth = [0]
        for _ in range(30_000):
            limit = depth[-1] + 1
            depth.append(limit if shape == "comb" and rng.random() < 0.6 else rng.randint(max(1, limit - 40), limit))
    tree = Parentheses(np.array(depth))
    assert tree.find_close().tolist() == naive_close(depth)


def test_subtree_least():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1000, 3000)
    size = np.minimum(rng.integers(1, 3000, 3000), 3000 - np.arange(3000))
    assert subtree_least(values, size).tolist() == [
        values[i : i + n].min() for i, n in enumerate(size.tolist())
    ]
