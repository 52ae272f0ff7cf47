"""Secrets in texts: fixed patterns, and tokens that look random.

A token is random if a battery of tests (uniform use of its alphabet, runs about
the median, serial correlation) can't tell it from noise. Short words pass such
tests by chance. So each token's evidence is compared with that of text of like
length, short words of the corpus put together at random, each as often as all
whole texts have it, and the false
discoveries are held to a share among the tokens of one encoding and length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import Rows, Scratch, Work, map_slices

KINDS = ("assign", "access", "hex", "random")
#: Share of false discoveries that is accepted.
FALSE_SHARE = 0.01
#: Steps of the evidence, and tokens of one class of length.
STEPS, LENGTH_STEP, LONGEST = 100, 4, 64
#: Made-up tokens of each length, and words of the counted ones that they are drawn from.
NULL_TOKENS, DRAWN = 10_000, 1 << 19
#: Made-up tokens beyond which their tail is taken as exponential.
TAIL = 100

# Fixed patterns of keys; (?ai: takes ASCII letters in either case.
_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # same as runs of any length, short ones dropped
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{12,}")
_WORD = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z]{2,11}(?![A-Za-z0-9+/_-])")
#: Words that stand in for a corpus's own, so that there is a text to compare with.
REFERENCE = (
    "the of and to in is that for it was on are as with they be at one have this from by hot word "
    "but what some we can out other were all there when up use your how said an each she which do "
    "their time if will way about many then them write would like these her long make thing see "
    "him two has look more day could go come did number sound no most people my over know water "
    "than call first who may down side been now find any new work part take get place made live"
).split()

# Encodings by the narrowest alphabet that holds a token, in this order.
ALPHABETS = (
    "0123456789",
    "0123456789abcdef",
    "0123456789ABCDEF",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
)
LOWER, CAMEL = 3, 6
# Place of each byte in each alphabet, -1 if it has none.
_PLACES = np.full((len(ALPHABETS), 256), -1)
for _row, _alphabet in zip(_PLACES, ALPHABETS, strict=True):
    _row[list(_alphabet.encode())] = range(len(_alphabet))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points, end exclusive."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _normal_tail(z: np.ndarray) -> np.ndarray:
    return 0.5 * np.array([math.erfc(x) for x in (z / math.sqrt(2)).tolist()])


def _noise(tokens: list[str], given: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Randomness and number of the alphabet of tokens of one length; ``given`` sets the
    alphabet."""
    n = len(tokens[0])
    letters = np.frombuffer("".join(tokens).encode(), np.uint8).reshape(len(tokens), n)
    fits = np.stack([(places[letters] >= 0).all(axis=1) for places in _PLACES])
    alphabet = np.where(fits.any(axis=0), fits.argmax(axis=0), len(ALPHABETS) - 1)
    if given is not None:
        alphabet[:] = given
    values = np.maximum(_PLACES[alphabet[:, None], letters], 0)
    sizes = np.array([len(x) for x in ALPHABETS])[alphabet]
    width = len(ALPHABETS[-1])
    cells = (np.arange(len(tokens))[:, None] * width + values).ravel()
    counts = np.bincount(cells, minlength=len(tokens) * width).reshape(len(tokens), width)
    chi = (counts.astype(float) ** 2).sum(axis=1) * sizes / n - n
    # Cube-root approximation of the chi-squared distribution.
    degrees = sizes - 1
    cube = np.cbrt(np.maximum(chi, 0) / degrees) - 1 + 2 / (9 * degrees)
    tests = [_normal_tail(cube / np.sqrt(2 / (9 * degrees)))]
    above = values > np.median(values, axis=1, keepdims=True)
    a = above.sum(axis=1)
    b = n - a
    runs = 1 + (above[:, 1:] != above[:, :-1]).sum(axis=1)
    mean = 1 + 2 * a * b / n
    spread = np.sqrt(np.maximum(1e-9, (mean - 1) * (mean - 2) / max(1, n - 1)))
    mixed = (a > 0) & (b > 0) & (n > 2)
    tests.append(np.where(mixed, 2 * _normal_tail(np.abs(runs - mean) / spread), 0.0))
    centred = values - values.mean(axis=1, keepdims=True)
    power = (centred**2).sum(axis=1)
    products = (centred[:, 1:] * centred[:, :-1]).sum(axis=1)
    lag = np.where(power > 0, products / np.where(power > 0, power, 1), 1.0)
    tests.append(2 * _normal_tail(np.abs(lag) * math.sqrt(n)))
    half = -sum(np.log(np.maximum(p, 1e-300)) for p in tests)
    return np.minimum(1.0, np.exp(-half) * (1 + half + half * half / 2)), alphabet


def randomness(token: str) -> float:
    """Combined probability (0 to 1) that noise over the token's alphabet looks less even.

    Fisher's combination of three tests: chi-squared of the symbols' counts, runs
    above and below the median, and correlation with the next symbol. Near 0: text.
    """
    return float(_noise([token])[0][0])


def judged(tokens: list[str], given: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Evidence and alphabet of each token. Evidence is the randomness in STEPS steps of
    its logarithm; 0 is the least."""
    levels, alphabets = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
    by_length: dict[int, list[int]] = {}
    for i, token in enumerate(tokens):
        by_length.setdefault(len(token), []).append(i)
    lowest = 1e-12
    for places in by_length.values():
        noise, alphabets[places] = _noise([tokens[i] for i in places], given)
        share = 1 - np.log(np.maximum(noise, lowest)) / math.log(lowest)
        levels[places] = np.minimum(STEPS - 1, (STEPS * share).astype(int))
    return levels, alphabets


def evidence(token: str) -> int:
    return int(judged([token])[0][0])


def length_class(n: int) -> int:
    return min(n, LONGEST) // LENGTH_STEP


@dataclass(frozen=True)
class Thresholds:
    """Least evidence of a discovery, by class of length and alphabet."""

    least: dict[tuple[int, int], int]


SPANS = {
    "doc_id": "long", "starts": "array<int>", "ends": "array<int>", "kinds": "array<int>",
    "classes": "array<int>", "alphabets": "array<int>", "levels": "array<int>",
}


def free_tokens(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Start and end of the tokens, and of what fixed patterns leave of them."""
    covered = sorted((start, end) for start, _, end in spans)
    out = []
    for m in _TOKEN.finditer(text):
        at, stop = m.span()
        for start, end in covered:
            if start < stop and end > at:
                out.append((at, start))
                at = end
        out.append((at, stop))
    return [(start, end) for start, end in out if end - start >= 12]


def _setup(key: str) -> Work:
    def work(batch: pa.RecordBatch) -> Rows:
        out: dict[str, list] = {name: [] for name in SPANS}
        out["doc_id"] = batch.column(key)
        texts = [x or "" for x in batch.column("text").to_pylist()]
        bases = [base_spans(x) for x in texts]
        free = [free_tokens(x, spans) for x, spans in zip(texts, bases, strict=True)]
        tokens = [x[s:e] for x, found in zip(texts, free, strict=True) for s, e in found]
        judgements = zip(*(x.tolist() for x in judged(tokens)), strict=True)
        for spans, found in zip(bases, free, strict=True):
            rows = [(s, e, k, 0, 0, 0) for s, k, e in spans]
            for s, e in found:
                level, alphabet = next(judgements)
                rows.append((s, e, 3, length_class(e - s), alphabet, level))
            for i, name in enumerate(list(SPANS)[1:]):
                out[name].append([r[i] for r in rows])
        return out

    return work


def _count_words() -> Work:
    def work(batch: pa.RecordBatch) -> Rows:
        texts = (x or "" for x in batch.column("text").to_pylist())
        counts: Counter[str] = Counter()
        for word, n in Counter(_WORD.findall("\n".join(texts))).items():
            counts[word.lower()] += n
        return {"word": list(counts), "n": list(counts.values())}

    return work


def count_words(docs: DataFrame) -> DataFrame:
    """How often each short word, in lower case, stands in all whole texts. Words that are
    tokens are not among them, and repeated rows count as often as they are there."""
    counts = map_slices(docs.select("text"), _count_words, {"word": "string", "n": "long"})
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def words_to_draw_from(counts: DataFrame, total: int) -> list[str]:
    """Every word as often as it was counted among ``total``, and those of REFERENCE.

    Where that makes more than DRAWN words, each comes as often as its share of them, whose
    fraction is rounded up with that chance: a rare word has its weight as well.
    """
    chance = F.pmod(F.xxhash64(F.lit(9), "word"), F.lit(1 << 30)) / (1 << 30)
    copies = F.floor(F.col("n") * min(1.0, DRAWN / max(1, total)) + chance)
    rows = counts.select("word", copies.alias("copies")).filter("copies > 0").collect()
    return [r["word"] for r in sorted(rows) for _ in range(r["copies"])] + REFERENCE


def made_up(words: list[str], length: int, alphabet: int) -> list[str]:
    """Stretches of words put together at random, as text of an alphabet would be: in lower
    case, or as names, WordByWord, with a number after one word in ten and a mark after
    one in four where the alphabet has them."""
    rng = np.random.default_rng([length, alphabet])
    number = NULL_TOKENS * (length // 2 + 1)
    drawn = [words[i] for i in rng.integers(0, len(words), number)]
    if alphabet >= CAMEL:
        drawn = [x.title() for x in drawn]
    if alphabet > CAMEL:
        numbers = rng.integers(0, 1000, number).tolist()
        drawn = [f"{x}{n}" if n < 100 else x for x, n in zip(drawn, numbers, strict=True)]
    if alphabet > CAMEL + 1:
        marks = rng.choice(["_", "-", "/", *[""] * 9], number).tolist()
        drawn = [x + mark for x, mark in zip(drawn, marks, strict=True)]
    text = "".join(drawn)
    return [text[i * length : (i + 1) * length] for i in range(NULL_TOKENS)]


def text_chances(words: list[str], length: int, alphabet: int) -> np.ndarray:
    """The chance that text of ``length`` has this evidence or more, by evidence.

    It is counted over NULL_TOKENS made-up tokens. Where TAIL or fewer of them are left it falls exponentially,
    at the rate of those that reach beyond, so that it has no least value but that
    of noise.
    """
    levels = np.sort(judged(made_up(words, length, alphabet), alphabet)[0])
    reached = NULL_TOKENS - np.searchsorted(levels, np.arange(STEPS))
    chances = (1 + reached) / (1 + NULL_TOKENS)
    start = int(levels[-TAIL])
    rate = 1 / (1 + (levels[-TAIL:] - start).mean())
    steps = np.arange(STEPS) - start
    tail = chances[start] * np.exp(-rate * np.maximum(steps, 0))
    return np.where(steps > 0, tail, chances)


def fit_thresholds(spans: DataFrame, words: list[str]) -> Thresholds:
    """Thresholds from a count of all tokens by length, alphabet and evidence.

    A token's chance is that of text as long as the shortest token of its class, in
    lower case for all alphabets without both cases.
    The step-up rule over the chances of the tokens of one class and alphabet sets
    their threshold. The counts are a table of bounded size.
    """
    tokens = spans.select(F.explode(F.arrays_zip("kinds", "classes", "alphabets", "levels")).alias("t"))
    rows = (
        tokens.select("t.*")
        .filter("kinds = 3")
        .groupBy("classes", "alphabets", "levels")
        .agg(F.count("*").alias("n"))
        .collect()
    )
    tables: dict[tuple[int, int], np.ndarray] = {}
    for r in rows:
        tables.setdefault((r["classes"], r["alphabets"]), np.zeros(STEPS))[r["levels"]] = r["n"]
    least = {}
    chances: dict[tuple[int, int], np.ndarray] = {}
    for kind, tokens_at in tables.items():
        like = (LENGTH_STEP * kind[0], kind[1] if kind[1] >= CAMEL else LOWER)
        if like not in chances:
            chances[like] = text_chances(words, *like)
        found = tokens_at[::-1].cumsum()[::-1]
        good = np.flatnonzero((found > 0) & (chances[like] <= FALSE_SHARE * found / found[0]))
        least[kind] = int(good.min()) if good.size else STEPS
    return Thresholds(least)


def scan_secrets(docs: DataFrame, scratch: Scratch, key: str = "doc_id") -> DataFrame:
    """doc_id and spans (kind, start, end; by start, then kind) of every whole text.

    Kinds: assign, access and hex from fixed patterns, random from the tests; a
    random token has 12 characters or more, and ends where another span begins. A
    null text counts as empty and has no span. Rows are scanned one by one, repeated
    rows repeat, and only ``text`` and ``key`` are read. What the texts hold is kept in
    a scratch table for the corpus-wide thresholds, and so are the counts of all their
    short words.
    """
    found = scratch.write(map_slices(docs.select(key, "text"), lambda: _setup(key), SPANS))
    counts = scratch.write(count_words(docs))
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    least = fit_thresholds(found, words_to_draw_from(counts, total)).least
    zipped = F.arrays_zip("starts", "kinds", "ends", "classes", "alphabets", "levels")

    def kept(x: Column) -> Column:
        of = F.lit(STEPS)
        for (kind, alphabet), value in least.items():
            if value < STEPS:
                same = (x["classes"] == kind) & (x["alphabets"] == alphabet)
                of = F.when(same, value).otherwise(of)
        return (x["kinds"] < 3) | (x["levels"] >= of)

    names = F.array(*map(F.lit, KINDS))
    spans = F.transform(
        F.array_sort(F.transform(
            F.filter(zipped, kept),
            lambda x: F.struct(x["starts"].alias("start"), x["kinds"].alias("k"), x["ends"].alias("end")),
        )),
        lambda x: F.struct(
            F.element_at(names, x["k"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end")
        ),
    )
    return found.select(F.col("doc_id").alias(key), spans.alias("spans"))
