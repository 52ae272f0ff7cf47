"""The manifest against a plain recursive tree."""

from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from touchline.llm.batches import Scratch, fold
from touchline.llm.merkle import build_manifest, proof_digest
from touchline.llm.ranks import ranked

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, path int"


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(row: tuple) -> str:
    doc_id, text, lang, source, n_chars = row[:5]
    fields = [doc_id, source, lang, n_chars, text]
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def climb(nodes: list[str]) -> tuple[str, list[list[str]]]:
    """The top and, for every node, its siblings from below to the top, as (left, right)."""
    paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, covered = [], []
        for start in range(0, len(nodes), 8):
            run = nodes[start : start + 8]
            for i in range(len(run)):
                for x in under[start + i]:
                    paths[x].append(("".join(run[:i]), "".join(run[i + 1 :])))
            parents.append(h("".join(run)))
            covered.append([x for u in under[start : start + 8] for x in u])
        nodes, under = parents, covered
    return nodes[0], paths


def plain(rows: list[tuple]) -> list[tuple]:
    trees: dict[str, list[tuple]] = {}
    for row in rows:
        trees.setdefault("" if row[2] is None else "+" + row[2], []).append(row)
    order = sorted(trees, key=str.encode)
    tops = {}
    for name in order:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        tops[name] = climb([leaf(r) for r in trees[name]])
    root, over = climb([tops[name][0] for name in order])
    out = []
    for at, name in enumerate(order):
        top, paths = tops[name]
        for row, path in zip(trees[name], paths, strict=True):
            text = row[1]
            if row[0] is not None and text is not None and crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(x.lower() if "A" <= x <= "Z" else x for x in text)
            node = leaf((row[0], text, *row[2:]))
            for left, right in path + over[at]:
                node = h(left + node + right)
            proof = h("".join(a + b for a, b in path + over[at]))
            out.append((row[0], leaf(row), top, root, proof, node, node == root))
    return sorted(out, key=str)


def found(spark, rows: list[tuple]) -> list[tuple]:
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claimed = F.when(fold("doc_id", 3) == 0, lowered).otherwise(F.col("text"))
    manifest = build_manifest(docs, Scratch(spark), claimed={"text": claimed})
    out = manifest.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")), "folded_root", "verified"
    )
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [2], [8], [9], [1, 64, 65], [512, 1, 513, 7], [4100, 3]])
def test_trees_of_all_sizes_match_a_plain_tree(spark, sizes):
    rng = random.Random(len(sizes))
    rows, names = [], [None, "é", "en", "", "Z"]
    for name, n in zip(names, sizes, strict=False):
        for _ in range(n):
            text = rng.choice([None, "", "Über ABC é", "x" * rng.randrange(50), "Mixed Case\nText"])
            rows.append((rng.randrange(10**6), text, name, rng.choice([None, "", "web"]), rng.choice([None, 3])))
    assert found(spark, rows) == plain(rows)


def test_null_ids_repeated_rows_and_very_long_texts(spark):
    rows = [(None, "A", "en", "s", 1), (None, None, None, None, None), (3, "Same", "en", "s", 4)]
    rows += [(3, "Same", "en", "s", 4), (3, "other", "en", "s", 5), (0, "Ab" * 200_000, "en", None, 0)]
    assert found(spark, rows) == plain(rows)


def test_many_trees_make_a_forest_of_several_tiers(spark):
    rows = [(i, "T", f"lang {i}", "s", 1) for i in range(600)]
    assert found(spark, rows) == plain(rows)


def test_an_empty_table_has_no_leaves(spark):
    assert found(spark, []) == []


def test_places_run_through_all_partitions(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abbbbbbbb"), rng.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, id int").repartition(5)
    for group in (None, "g"):
        out = ranked(df, ["k", "id"], Scratch(spark), group).collect()
        for name in {r.g for r in out} if group else [None]:
            mine = sorted((r for r in out if name in (None, r.g)), key=lambda r: r.place)
            assert [r.place for r in mine] == list(range(len(mine)))
            assert {r.total for r in mine} == {len(mine)}
            keys = [(r.k, r.id) for r in mine]
            assert keys == sorted(keys)
