"""Quality by votes of the nearest labelled texts in a latent-semantic space."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import Rows, Work, labelled_sample, lists, map_slices

#: Hashed terms, latent dimensions, labelled texts of each class, and voters.
TERMS, LATENT, FIT_ROWS, VOTERS = 2048, 48, 1500, 15
#: Directions beyond the latent ones while these are sought, and times they are multiplied.
SPARE, ITERATIONS = 16, 24
#: Characters of a word's shape beyond which it stands by its hash.
LONG_SHAPE = 64
#: Documents in one matrix product.
BLOCK = 256
#: Words whose term a task remembers; beyond it, it starts afresh.
CACHE_WORDS = 200_000

_RUNS = regex.compile(r"(\p{Lu})\p{Lu}+|(\p{L})\p{L}+|(\p{N})\p{N}+|([^\p{L}\p{N}])\4+")


@dataclass(frozen=True)
class QualityModel:
    """weight: inverse document frequency by term; axes: terms by latent dimensions;
    vectors and labels of the labelled texts; prior: share of label 1."""

    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def _run(m: regex.Match) -> str:
    """One mark, or two, for a run of like characters."""
    if m[1]:
        return "AA"
    if m[2]:
        return "Aa" if m[2].isupper() else "a"
    return "0" if m[3] else m[4]


def shape(word: str) -> str:
    """A word without its letters: ``Abc###`` becomes ``Aa#``."""
    if word.isalpha() and len(word) > 1:
        if word.islower():
            return "a"
        if word.isupper():
            return "AA"
        if word[1:].islower():
            return "Aa"
    form = _RUNS.sub(_run, word)
    return form if len(form) <= LONG_SHAPE else f"long {xxhash.xxh3_64_hexdigest(form)}"


def slot(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term) % TERMS


WORD_AGAIN, LINE_AGAIN = slot("word again"), slot("line again")


class Terms:
    """Turns texts into counts of hashed terms.

    Terms are words, shapes of words, and marks for words and lines that repeat
    what stands before them.
    """

    def __init__(self) -> None:
        self._known: dict[str, int] = {}
        self._shapes: dict[str, int] = {}

    def _word(self, word: str) -> int:
        """Slots of the word and of its shape, as one number."""
        form = shape(word)
        if form not in self._shapes:
            if len(self._shapes) > CACHE_WORDS:
                self._shapes.clear()
            self._shapes[form] = slot("s " + form)
        return slot("w " + word.lower()) * TERMS + self._shapes[form]

    def count(self, text: str) -> np.ndarray:
        words = text.split()
        if not words:
            return np.zeros(TERMS, np.float32)
        if len(self._known) > CACHE_WORDS:
            self._known.clear()
        counts, known = Counter(words), self._known
        for word in counts:
            if word not in known:
                known[word] = self._word(word)
        slots = np.fromiter(map(known.__getitem__, counts), np.int64, len(counts))
        times = np.fromiter(counts.values(), np.float64, len(counts))
        out = np.bincount(slots // TERMS, times, TERMS) + np.bincount(slots % TERMS, times, TERMS)
        out[WORD_AGAIN] += sum(map(eq, words, islice(words, 1, None)))
        lines = [x for x in text.split("\n") if x.strip()]
        out[LINE_AGAIN] += (len(lines) - len(set(lines))) * len(words) / len(lines)
        return out.astype(np.float32)


def weighted(weight: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Roots of each term's share of a text, times the term's weight."""
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return np.sqrt(shares) * weight


def latent(weight: np.ndarray, axes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Unit vectors of rows of counts; rows without a known term stay zero."""
    vectors = weighted(weight, counts) @ axes
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.where(norms > 1e-9, vectors / np.maximum(norms, 1e-9), 0).astype(np.float32)


def fit_quality_model(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> QualityModel:
    """Fit on a bounded sample of labelled texts.

    ``labels`` holds ``key`` and ``quality`` (0 or 1); rows with another or no
    value are ignored. Per class about FIT_ROWS texts are used, whole; their
    counts of terms come to the driver. Without labels every score is 0.5.
    """
    marks = labels.filter("quality IN (0, 1)").select(
        key, F.col("quality").cast("int").alias("label")
    )
    known = docs.filter(F.col("text").isNotNull())
    sample = labelled_sample(known, marks, "label", FIT_ROWS, 6, key)

    def setup() -> Work:
        terms = Terms()

        def work(batch: pa.RecordBatch) -> Rows:
            counts = [terms.count(x) for x in batch.column("text").to_pylist()]
            kept = [np.flatnonzero(x) for x in counts]
            return {
                "label": batch.column("label"),
                "slots": kept,
                "times": [x[i].astype(float) for x, i in zip(counts, kept, strict=True)],
            }

        return work

    shape = {"label": "int", "slots": "array<long>", "times": "array<double>"}
    found = map_slices(sample, setup, shape).toArrow().combine_chunks()
    columns = [x.combine_chunks() for x in found.columns]
    labels_of, slots, times = columns[0].to_numpy(), lists(columns[1]), lists(columns[2])
    rows = sorted(
        range(len(slots)), key=lambda i: (labels_of[i], slots[i].tobytes(), times[i].tobytes())
    )
    marks_of = labels_of[rows].astype(np.float32)
    if not rows:
        none = np.zeros((0, LATENT), np.float32)
        return QualityModel(np.ones(TERMS), np.zeros((TERMS, LATENT)), none, marks_of, 0.5)
    held = np.bincount(np.concatenate(slots), minlength=TERMS)
    weight = (np.log((1 + len(rows)) / (1 + held)) + 0.1).astype(np.float32)

    def blocks() -> Iterator[np.ndarray]:
        """The counts of BLOCK texts at a time, so that they never stand in memory as a whole."""
        for start in range(0, len(rows), BLOCK):
            part = rows[start : start + BLOCK]
            counts = np.zeros((len(part), TERMS), np.float32)
            for out, i in zip(counts, part, strict=True):
                out[slots[i]] = times[i]
            yield counts

    axes = main_axes(weight, blocks)
    vectors = np.concatenate([latent(weight, axes, x) for x in blocks()])
    return QualityModel(weight, axes, vectors, marks_of, float(marks_of.mean()))


def main_axes(weight: np.ndarray, blocks: Callable[[], Iterable[np.ndarray]]) -> np.ndarray:
    """The LATENT directions in which weighted counts vary most, by subspace iteration.

    A few more directions than wanted are multiplied with the texts and made orthogonal again
    and again; a matrix of terms by terms is never formed.
    """
    start = np.random.default_rng(6).standard_normal((TERMS, LATENT + SPARE))
    axes = np.linalg.qr(start)[0].astype(np.float32)
    for _ in range(ITERATIONS):
        moved = np.zeros(axes.shape, np.float64)
        for counts in blocks():
            rows = weighted(weight, counts)
            moved += rows.T @ (rows @ axes)
        axes = np.linalg.qr(moved)[0].astype(np.float32)
    small = np.zeros((LATENT + SPARE,) * 2)
    for counts in blocks():
        inside = weighted(weight, counts) @ axes
        small += inside.T @ inside
    _, turned = np.linalg.eigh(small)
    return np.ascontiguousarray(axes @ turned[:, ::-1][:, :LATENT].astype(np.float32))


def votes(model: QualityModel, counts: np.ndarray) -> np.ndarray:
    """Scores of rows of counts: the neighbours' labels weighted by similarity.

    Neighbours are found by exact cosine products with all labelled vectors.
    """
    own = latent(model.weight, model.axes, counts)
    near = own @ model.vectors.T
    k = min(VOTERS, near.shape[1])
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, best, axis=1), 0) ** 4
    total = weight.sum(axis=1)
    score = (weight * model.labels[best]).sum(axis=1) / np.maximum(total, 1e-12)
    return np.where(total > 1e-9, score, model.prior)


def score_quality(
    docs: DataFrame, model: QualityModel, key: str = "doc_id", carried: bool = False
) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score at least 0.5) of every whole text.

    With ``carried`` all columns of ``docs`` stay as well, but for those of the
    names score and predicted. Null and empty texts get the share of label 1 among
    the labelled texts. Rows are scored one by one, and repeated rows repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    rows = docs.drop("score", "predicted") if carried else docs.select(key, "text")
    scored = rows.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    names = scored.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, terms = QualityModel(**shared.value), Terms()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            scores = np.full(len(texts), model.prior)
            for start in range(0, len(texts) if len(model.vectors) else 0, BLOCK):
                part = texts[start : start + BLOCK]
                counts = np.array([terms.count(x or "") for x in part])
                scores[start : start + len(part)] = votes(model, counts)
            scores = np.clip(scores, 0, 1)
            found = {"score": pa.array(scores), "predicted": pa.array((scores >= 0.5).astype("int32"))}
            columns = [found.get(name, batch.column(name)) for name in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    scored = scored.mapInArrow(run, scored.schema)
    return scored if carried else scored.select(key, "score", "predicted")
