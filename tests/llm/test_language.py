from __future__ import annotations

import random

import numpy as np
import pytest

from touchline.llm import language as L
from touchline.llm.language import LanguageModel, distinct_grams, fit_language_model, predict_language

SYLLABLES = {
    "aa": ["the", "ing", "and", "th", "er"], "bb": ["sch", "ung", "ein", "der", "ü"],
    "cc": ["cion", "que", "ado", "ñ", "el"],
}


def text_of(rng, lang, n=40):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def plain_grams(text):
    clean = "".join(c if c.isalpha() else "\0" for c in text.lower())
    clean = " " + " ".join(x for x in clean.split("\0") if x) + " "
    return {clean[i : i + n] for n in (1, 2, 3) for i in range(len(clean) - n + 1)}


def decoded(codes):
    out = set()
    for code in codes.tolist():
        chars = []
        while code:
            chars.append(chr(code & 0x1FFFFF))
            code >>= 21
        out.add("".join(reversed(chars)))
    return out


@pytest.mark.parametrize("text", ["a", "The Théory, 12 x!", "ÄÖ üß", "日本 語", "🙂a🙂", "x" * 50])
def test_grams_against_the_definition(text):
    assert decoded(distinct_grams(text)) == plain_grams(text)


def test_a_long_text_is_taken_in_parts(monkeypatch):
    rng = random.Random(1)
    text = text_of(rng, "bb", 3000)
    whole = distinct_grams(text)
    monkeypatch.setattr(L, "PART", 100)
    parts = distinct_grams(text)
    assert set(whole.tolist()) <= set(parts.tolist())
    # Parts add nothing but n-grams with a space where they were cut.
    assert all(" " in x for x in decoded(np.setdiff1d(parts, whole)))


def fitted(docs, rng, n=60):
    rows, langs = [], {}
    for i in range(n * 3):
        lang = list(SYLLABLES)[i % 3]
        rows.append((i, text_of(rng, lang)))
        langs[i] = lang
    frame = docs(rows).drop("lang")
    known = frame.sparkSession.createDataFrame(list(langs.items()), "doc_id long, lang string")
    return frame.join(known, "doc_id"), rows, langs


def test_held_out_accuracy_and_odd_texts(docs):
    rng = random.Random(2)
    frame, _, _ = fitted(docs, rng)
    model = fit_language_model(frame)
    assert model.languages == ["aa", "bb", "cc"]
    fresh = [(1000 + i, text_of(rng, lang, 30)) for i in range(30) for lang in [list(SYLLABLES)[i % 3]]]
    odd = [(1, None), (2, ""), (3, "12 !! 34"), (None, "the and"), (4, "the " * 100_000), (4, "the " * 100_000)]
    out = predict_language(docs(fresh + odd).withColumnRenamed("source", "score"), model).collect()
    found = {r.doc_id: (r.lang_pred, r.score) for r in out}
    assert all(found[1000 + i][0] == list(SYLLABLES)[i % 3] for i in range(30))
    assert found[1] == found[2] == found[3] == ("und", 0.0)
    assert found[None][0] == found[4][0] == "aa"
    assert all(0 <= s <= 1 for _, s in found.values()) and len(out) == 36
    assert predict_language(docs([]), model).count() == 0


def test_nothing_to_learn_from(docs):
    model = fit_language_model(docs([(1, "text without a label"), (2, None)]))
    assert model.languages == []
    assert predict_language(docs([(1, "abc")]), model).first().lang_pred == "und"
    one = fit_language_model(docs([(1, "just one text")], lang="xx"))
    assert predict_language(docs([(1, "just one")]), one).first().lang_pred == "xx"


def test_folded_weights_equal_the_kernel_regression():
    """Scores by n-gram weights are the same as kernels with landmarks times coefficients."""
    rng = random.Random(3)
    landmarks = [distinct_grams(text_of(rng, lang)) for lang in SYLLABLES for _ in range(5)]
    grams = np.unique(np.concatenate(landmarks))
    basis = L.presence(grams, landmarks)
    coefficients = np.random.default_rng(0).normal(size=(len(landmarks), 3))
    model = LanguageModel(list(SYLLABLES), grams, (basis.T @ coefficients).astype(np.float32))
    x = distinct_grams(text_of(rng, "cc"))
    kernels = [len(np.intersect1d(x, y)) / np.sqrt(len(x) * len(y)) for y in landmarks]
    direct = np.array(kernels) @ coefficients
    assert np.allclose(L.presence(grams, [x])[0] @ model.weights, direct, atol=1e-4)


def test_the_sample_does_not_depend_on_partitions(docs):
    rng = random.Random(4)
    frame, _, _ = fitted(docs, rng, 30)
    a, b = fit_language_model(frame), fit_language_model(frame.repartition(7))
    assert (a.grams == b.grams).all() and np.allclose(a.weights, b.weights, atol=1e-4)


def test_query_on_held_out_rows(spark):
    from touchline.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    out = QUERIES["op1_language"](spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 200 < len(held) < 300
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)
