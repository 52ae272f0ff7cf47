"""Fingerprints against a plain version, term by term."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest
import regex
import xxhash

from touchline.llm import imatch
from touchline.llm.imatch import fingerprints

WORDS = [f"word{i}" for i in range(40)] + ["Été", "naïve", "x1"]


def signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def text_hash(word: str) -> int:
    return signed(xxhash.xxh64(word.encode(), seed=42).intdigest()) % imatch.HASHES


def again(value: int, seed: int, width: int = 8) -> int:
    return xxhash.xxh64(value.to_bytes(width, "little", signed=True), seed=seed).intdigest()


def terms(text: str) -> set[int]:
    return {text_hash(w) for w in regex.findall(imatch.WORD, text.lower())}


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def fingerprint(text: str, lexicon: set[int]) -> str:
    mine = sorted(signed(again(t, 42)) for t in terms(text) & lexicon)
    rate = min(int(math.log2(max(len(mine) / imatch.PARTS, 1))), imatch.LAST_RATE)
    hashes = []
    for r in range(rate, rate + imatch.RATES):
        for part in range(imatch.PARTS):
            kept = [t for t in mine if t % imatch.PARTS == part and t // imatch.PARTS % (1 << r) == 0]
            value = again(part, again(r, 42, 4), 4)
            for t in kept:
                value = again(t, value)
            if kept:
                hashes.append(f"{value % (1 << 32):08X}")
    return " ".join(hashes) or "=" + md5(text)


def likeness(a: str, b: str) -> float:
    x, y = set(a.split(" ")), set(b.split(" "))
    return len(x & y) / len(x | y)


def plain(rows: list[tuple]) -> list[tuple]:
    rows = [(i, t or "") for i, t in rows]
    counts = Counter(t for _, text in rows for t in terms(text))
    least = max(imatch.LEAST_DOCS, imatch.LEAST * len(rows))
    most = max(imatch.LEAST_DOCS, imatch.MOST * len(rows))
    lexicon = {t for t, n in counts.items() if least <= n <= most}
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{'-' if r[0] is None else r[0]} {r[1]}".encode()).digest()))
    out = []
    for at, (i, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = (fingerprint(x, lexicon) for x in (text, edited, following))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, other,
                    likeness(own, other), likeness(own, after)))
    return sorted(out, key=str)


def found(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def wide(monkeypatch):
    """A band that holds most words of a small corpus."""
    monkeypatch.setattr(imatch, "MOST", 0.7)


def corpus(n: int) -> list[tuple]:
    rng = random.Random(n)
    return [(i * 3, " ".join(rng.choices(WORDS, k=rng.randint(0, 30)))) for i in range(n)]


def test_all_columns_match_a_plain_version(docs, scratch, wide):
    rows = corpus(60)
    rows += [(200, None), (201, ""), (202, " ,;"), (203, "日本語 é" * 40), (None, "word1 word2"), (204, "word3 " * 30_000)]
    rows += [(9, rows[2][1]), (9, rows[3][1]), (12, rows[4][1]), (12, rows[4][1]), (12, rows[4][1])]
    table = docs(rows).withColumnRenamed("lang", "place").withColumnRenamed("source", "fingerprint")
    assert found(fingerprints(table, scratch)) == plain(rows)


def test_the_band_of_the_query(docs, scratch):
    rows = corpus(250)
    assert found(fingerprints(docs(rows), scratch)) == plain(rows)


def test_one_document_follows_itself_and_none_gives_no_rows(docs, scratch):
    assert found(fingerprints(docs([(1, "a b c d")]), scratch)) == plain([(1, "a b c d")])
    assert found(fingerprints(docs([]), scratch)) == []


def test_an_edit_is_nearer_than_the_next_document(docs, scratch, wide):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=200))) for i in range(200)]
    rows += [(500, rows[0][1])]
    out = fingerprints(docs(rows), scratch).collect()
    assert sum(r.near_edited > r.near_next for r in out) >= 0.97 * len(out)
    same = [r.fingerprint for r in out if r.doc_id in (0, 500)]
    assert same[0] == same[1]


def test_only_dataframe_functions_run(docs, scratch):
    plan = fingerprints(docs(corpus(20)), scratch)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEval", "Arrow")


def test_the_lexicon_is_a_constant_not_a_column(docs, scratch):
    """Its bits are put into the expression, so that no row carries them."""
    lexicon = imatch.fit_lexicon(docs(corpus(20)).select("text"), scratch)
    out = imatch.with_fingerprint(docs(corpus(20)), "text", lexicon, "f")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    outside = [x for x in plan.splitlines() if "lexicon bits" in x]
    assert not outside, outside
