from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm.topk import RESOLUTIONS, integer_vector, statistics, top_k


def brute(rows, k, step):
    clean = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in clean if i % step == 0}):
        best = []
        for mine in [v for i, v in clean if i == q]:
            best += [(-sum(a * b for a, b in zip(mine, v, strict=True)), i) for i, v in clean
                     if i != q and len(v) == len(mine)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(best)[:k])]
    return out


def search(spark, rows, k=5, step=10, parts=3):
    frame = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(parts)
    ready = frame.select("id", integer_vector(F.col("embedding")).alias("vector"), F.lit(1).alias("dim"))
    found = top_k(ready.filter(F.col("id") % step == 0), ready, k)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("spread", [0.0, 0.2, 5.0])
def test_random_vectors(spark, spread):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 64))
    rows = [(i, (centres[i % 5] + spread * rng.normal(size=64)).astype("float32").tolist())
            for i in range(700)]
    assert search(spark, rows) == brute(rows, 5, 10)


def test_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5])] * 3) for i in range(40)]
    rows += [(100, [float("nan")] * 3), (110, [math.inf, 0.0, 0.0]), (120, [None, 1.0, 1.0]),
             (130, None), (None, [1.0] * 3), (140, []), (150, [1.0, 2.0]), (7, [1.0, 2.0]),
             (160, [1.0])]
    assert search(spark, rows) == brute(rows, 5, 10)
    assert search(spark, rows[:0]) == []


def test_large_values_are_exact(spark):
    rng = random.Random(6)
    rows = [(i, [float(rng.randint(-(2**20), 2**20)) for _ in range(4)]) for i in range(60)]
    assert search(spark, rows) == brute(rows, 5, 10)


def test_all_candidates_where_they_are_few(spark):
    rows = [(0, [1.0]), (1, [1.0]), (2, [1.0])]
    assert search(spark, rows) == [(0, 1, 1, 65536), (0, 2, 2, 65536)]


def test_bounds_hold():
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=(50, 64)), rng.normal(size=(60, 64))
    exact = a @ b.T
    coarse, fine = (statistics(a, n) @ statistics(b, n).T for n in RESOLUTIONS)
    assert (coarse >= exact - 1e-9).all() and (fine >= exact - 1e-9).all()
    assert (fine <= coarse + 1e-9).all()


def test_blocks_do_not_matter(spark, monkeypatch):
    from touchline.llm import topk

    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).astype("float32").tolist()) for i in range(400)]
    expected = search(spark, rows)
    for name, value in (("BLOCK_ROWS", 7), ("QUERY_ROWS", 5), ("TILE_BLOCKS", 2), ("AT_ONCE", 3)):
        monkeypatch.setattr(topk, name, value)
    assert search(spark, rows, parts=5) == expected
