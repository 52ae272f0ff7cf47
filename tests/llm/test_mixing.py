from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm.mixing import fit_rates, mix, words_of


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def word_slots(frame):
    return [r.s for r in frame.orderBy("doc_id").select(words_of(F.col("text")).alias("s")).collect()]


def test_words(docs):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "One two\tone\r\n\nTWO  one"), (5, "one")]
    slots = word_slots(docs(rows))
    assert slots[:3] == [[], [], []]
    one = slots[4][0]
    assert [x == one for x in slots[3]] == [True, False, True, False, True] and slots[3][1] == slots[3][3]


def least_squares(mass, targets, steps=200_000):
    """Plain projected gradient from rates of 1, with a small constant step."""
    rates = np.ones(len(mass))
    step = 1 / np.linalg.eigvalsh(mass.T @ mass).max()
    for _ in range(steps):
        rates = np.maximum(0, rates - step * (mass @ (mass.T @ rates - targets)))
    return rates


@pytest.mark.parametrize("shares", [(0.5, 0.3, 0.2), (0.9, 0.05, 0.05), (0.99, 0.01, 0.0)])
def test_rates_meet_the_targets(spark, shares):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    tokens = rng.integers(1, 500, 300)
    rows = [(int(n), x.tolist()) for n, x in zip(tokens, p, strict=True)]
    table = spark.createDataFrame(rows, "mix_tokens long, mix_p array<double>").repartition(3)
    targets = np.array(shares) * tokens.sum()
    out = table.withColumn("rate", fit_rates(table, targets.tolist())).collect()
    rates = np.array([r.rate for r in out])
    mass = np.array([[r.mix_tokens * x for x in r.mix_p] for r in out])
    assert (rates >= 0).all()
    if min(shares) > 0:
        assert np.abs(mass.T @ rates - targets).max() <= 2e-4 * targets.sum()
    best = least_squares(mass, targets, 20_000)
    ours, theirs = (np.abs(mass.T @ x - targets).max() for x in (rates, best))
    assert ours <= max(theirs * 1.2, 2e-4 * targets.sum())


def test_targets_that_hold_already_change_nothing(spark):
    table = spark.createDataFrame([(10, [1.0, 0.0]), (10, [0.0, 1.0])], "mix_tokens long, mix_p array<double>")
    assert [r.r for r in table.select(fit_rates(table, [10.0, 10.0]).alias("r")).collect()] == [1.0, 1.0]


def test_a_domain_without_mass_is_left_as_it_is(spark):
    table = spark.createDataFrame([(10, [1.0, 0.0])] * 4, "mix_tokens long, mix_p array<double>")
    rates = [r.r for r in table.select(fit_rates(table, [20.0, 20.0]).alias("r")).collect()]
    assert rates == pytest.approx([0.5] * 4, abs=1e-3)


def corpus(spark, docs, rng, n=400):
    kinds = {"aa": ["the", "ing", "and"], "bb": ["sch", "ung", "ein"], "cc": ["cion", "que", "ado"]}
    rows, marks = [], []
    for i in range(n):
        kind = rng.choices(list(kinds), [8, 3, 1])[0]
        rows.append((i, " ".join(rng.choices(kinds[kind], k=rng.randint(5, 60)))))
        if i % 2:
            marks.append((i, kind))
    return docs(rows), spark.createDataFrame(marks, "doc_id long, domain string"), dict(marks)


def test_mixing_a_corpus(spark, docs, scratch):
    rng = random.Random(2)
    frame, marks, known = corpus(spark, docs, rng)
    odd = docs([(900, None), (901, ""), (901, ""), (None, "the ing and")])
    frame = frame.union(odd).withColumnRenamed("lang", "rate").withColumnRenamed("source", "posterior")
    targets = {"aa": 2, "bb": 1, "cc": 1}
    out = mix(frame, marks, targets, scratch)
    assert out.columns == ["doc_id", "text", "n_chars", "n_tokens", "posterior", "rate", "copies"]
    rows = out.collect()
    assert len(rows) == 404
    tokens = sum(r.n_tokens for r in rows)
    shares = [sum(r.rate * r.n_tokens * r.posterior[i] for r in rows) / tokens for i in range(3)]
    assert shares == pytest.approx([0.5, 0.25, 0.25], abs=1e-3)
    assert all(max(range(3), key=lambda i: r.posterior[i]) == ["aa", "bb", "cc"].index(known[r.doc_id])
               for r in rows if r.doc_id in known)
    assert all(sum(r.posterior) == pytest.approx(1) and abs(r.copies - r.rate) < 1 for r in rows)
    empty = [r for r in rows if r.doc_id in (900, 901)]
    assert [(r.n_tokens, r.rate, r.copies) for r in empty] == [(0, 1.0, 1)] * 3
    taken = sum(r.copies * r.n_tokens for r in rows)
    assert abs(taken - tokens) < 0.1 * tokens


def test_nothing_to_learn_from_or_to_mix(spark, docs, scratch):
    marks = spark.createDataFrame([(1, None), (None, "aa"), (2, "other")], "doc_id long, domain string")
    out = mix(docs([(1, "the ing"), (2, "the")]), marks, {"aa": 1, "bb": 1}, scratch).collect()
    assert all(r.posterior == pytest.approx([0.5, 0.5]) and r.rate == pytest.approx(1, abs=1e-3) for r in out)
    assert mix(docs([]), marks, {"aa": 1, "bb": 1}, scratch).count() == 0


def test_labels_that_repeat(spark, docs, scratch):
    frame, marks, _ = corpus(spark, docs, random.Random(3), 100)
    once = mix(frame, marks, {"aa": 1, "bb": 1, "cc": 1}, scratch)
    again = mix(frame, marks.union(marks), {"aa": 1, "bb": 1, "cc": 1}, scratch)
    assert [r.posterior for r in once.orderBy("doc_id").collect()] == [
        pytest.approx(r.posterior, abs=0.05) for r in again.orderBy("doc_id").collect()
    ]


def test_only_dataframe_functions_run(spark, docs, scratch):
    frame, marks, _ = corpus(spark, docs, random.Random(4), 60)
    plan = plan_of(mix(frame, marks, {"aa": 1, "bb": 1}, scratch))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "MapIn"))


def test_targets_out_of_reach_are_reported(spark):
    import warnings

    schema = "mix_tokens bigint, mix_p array<double>"
    apart = spark.createDataFrame([(10, [1.0, 0.0]), (10, [0.0, 1.0])], schema)
    alike = spark.createDataFrame([(10, [0.5, 0.5])] * 2, schema)
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)
        fit_rates(apart, [15.0, 5.0])
    with pytest.warns(RuntimeWarning, match=r"miss their targets by -5, \+5 of 20 tokens"):
        fit_rates(alike, [15.0, 5.0])
