from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from touchline.llm import batches as B
from touchline.llm.batches import bounded_sample, fold, labelled_sample, lists, map_slices


def test_slices_hold_every_row_once(docs, monkeypatch):
    monkeypatch.setattr(B, "SLICE_ROWS", 3)

    def setup():
        return lambda part: {"doc_id": part.column("doc_id"), "n": [part.num_rows] * part.num_rows}

    frame = docs([(i, "x") for i in range(50)])
    rows = map_slices(frame.select(F.col("doc_id").cast("int")), setup, {"doc_id": "long", "n": "int"}).collect()
    assert sorted(r.doc_id for r in rows) == list(range(50))


def test_lists():
    column = pa.array([[1, 2], None, [], [3]], pa.list_(pa.int64()))
    assert [x.tolist() for x in lists(column)] == [[1, 2], [], [], [3]]
    assert [x.tolist() for x in lists(column.slice(2))] == [[], [3]]
    assert lists(column.slice(4)) == []


def test_folds(spark):
    from zlib import crc32

    rows = spark.createDataFrame([(i,) for i in (0, 7, -3, 10**12, None)], "k long").select("k", fold("k", 4).alias("f"))
    assert {r.k: r.f for r in rows.collect()} == {
        k: -1 if k is None else crc32(str(k).encode()) % 4 for k in (0, 7, -3, 10**12, None)
    }


@pytest.mark.parametrize("parts", [1, 7])
def test_samples_are_bounded_and_the_same_at_any_partitioning(spark, parts):
    frame = spark.range(20_000).selectExpr("id", "IF(id % 10 = 0, 'rare', 'hot') AS kind")
    frame = frame.union(spark.createDataFrame([(1, None)], "id long, kind string")).repartition(parts)
    rows = bounded_sample(frame, "kind", 100, 1).collect()
    counts = {k: sum(r.kind == k for r in rows) for k in ("rare", "hot")}
    assert all(60 < n < 150 for n in counts.values()) and len(rows) == sum(counts.values())
    again = bounded_sample(frame.repartition(3), "kind", 100, 1).collect()
    assert sorted(rows) == sorted(again)
    assert len(bounded_sample(frame, "kind", 100, 1, total=20).collect()) < 50
    assert bounded_sample(frame, "kind", 10**6, 1).count() == 20_000
    assert bounded_sample(frame.limit(0), "kind", 10, 1).count() == 0


def test_a_hot_key_brings_one_text(spark):
    docs = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "concat('t', id) AS text")
    labels = spark.createDataFrame([(7, 1)] * 500 + [(8, 0), (None, 1), (10**9, 0)], "doc_id long, label int")
    rows = labelled_sample(docs, labels, "label", 1000, 1).collect()
    assert sorted((r.label, r.text) for r in rows) == [(0, "t8"), (1, "t0")]
