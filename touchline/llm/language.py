"""Language identification by string kernels.

The kernel of two texts is the number of distinct character n-grams (n = 1 to 3)
that both hold, divided by the root of the product of their own numbers. Landmark
texts span the feature space (Nystroem); a ridge regression per language against
all others gives the scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import Rows, Work, bounded_sample, map_slices

UNKNOWN = "und"
NGRAM = 3
#: Rows per language that are landmarks, and that the regression is fitted on, and
#: landmarks of all languages together.
LANDMARKS, FIT_ROWS, MOST_LANDMARKS = 48, 400, 1000
RIDGE = 1e-3
#: Characters of a text handled at once; the sets of its parts are united.
PART = 1 << 18
#: Texts in one matrix product.
BLOCK = 64

_LETTER = regex.compile(r"\p{L}")
_OTHER = regex.compile(r"[^\p{L}]+")


@dataclass(frozen=True)
class LanguageModel:
    """languages, the sorted n-grams of all landmarks, and a weight for each n-gram
    and language: landmark presence times normalised kernel coefficients."""

    languages: list[str]
    grams: np.ndarray
    weights: np.ndarray


def distinct_grams(text: str) -> np.ndarray:
    """Sorted codes of the distinct n-grams of the lower-cased letters, words apart.

    21 bits hold a character, so that codes of up to three never collide.
    """
    found = np.zeros(0, np.uint64)
    for start in range(0, len(text), PART):
        part = _OTHER.sub(" ", f" {text[max(0, start - NGRAM) : start + PART].lower()} ")
        chars = np.frombuffer(part.encode("utf-32-le"), np.uint32).astype(np.uint64)
        code, codes = chars, [chars]
        for n in range(1, NGRAM):
            code = (code[:-1] << np.uint64(21)) | chars[n:]
            codes.append(code)
        found = np.union1d(found, np.concatenate(codes))
    return found


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def presence(grams: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """A row for each text: 1 / root of its number of n-grams where it has a landmark's."""
    out = np.zeros((len(texts), max(1, grams.size)), np.float32)
    for row, own in zip(out, texts, strict=True):
        if own.size and grams.size:
            at = np.minimum(np.searchsorted(grams, own), grams.size - 1)
            row[at[grams[at] == own]] = own.size**-0.5
    return out


def fit_language_model(docs: DataFrame, labels: str = "lang", key: str = "doc_id") -> LanguageModel:
    """Fit on a bounded sample of the labelled rows of ``docs``.

    At most about LANDMARKS (MOST_LANDMARKS in all) and FIT_ROWS texts of each of the
    256 most frequent languages are used, whole. Landmarks come to the driver as sets of n-grams, the
    others only as their kernels with the landmarks. Without a usable row the
    model knows no language.
    """
    usable = docs.filter(F.col("text").rlike(r"\p{L}")).select(key, labels, "text")
    shape = {"label": "string", "grams": "array<long>"}

    def landmark_setup() -> Work:
        def work(batch: pa.RecordBatch) -> Rows:
            texts = batch.column("text").to_pylist()
            return {
                "label": batch.column(labels),
                "grams": [distinct_grams(x).view(np.int64) for x in texts],
            }

        return work

    chosen = bounded_sample(usable, labels, LANDMARKS, 1, MOST_LANDMARKS)
    rows = map_slices(chosen, landmark_setup, shape).collect()
    own = sorted((r["label"], tuple(r["grams"])) for r in rows)
    landmarks = [np.array(g, np.int64).view(np.uint64) for _, g in own]
    if not landmarks:
        return LanguageModel([], np.zeros(0, np.uint64), np.zeros((1, 0), np.float32))
    grams = np.unique(np.concatenate(landmarks))
    basis = presence(grams, landmarks)
    shared = docs.sparkSession.sparkContext.broadcast((grams, basis))

    def kernel_setup() -> Work:
        grams, basis = shared.value

        def work(batch: pa.RecordBatch) -> Rows:
            texts = [distinct_grams(x) for x in batch.column("text").to_pylist()]
            kernels = [presence(grams, [x])[0] @ basis.T for x in texts]
            return {"label": batch.column(labels), "kernel": [k.astype(float) for k in kernels]}

        return work

    fitted = bounded_sample(usable, labels, FIT_ROWS, 2)
    rows = map_slices(fitted, kernel_setup, {"label": "string", "kernel": "array<double>"}).collect()
    rows = sorted(((r["label"], r["kernel"]) for r in rows)) or [
        (label, list(k)) for (label, _), k in zip(own, (basis @ basis.T).astype(float), strict=True)
    ]
    languages = sorted({label for label, _ in own} | {label for label, _ in rows})
    # Nystroem features: kernels times the root of the landmarks' inverse kernel.
    values, vectors = np.linalg.eigh((basis @ basis.T).astype(np.float64))
    good = values > 1e-8 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.array([k for _, k in rows]) @ root
    targets = np.array([[float(label == x) for x in languages] for label, _ in rows])
    gram = features.T @ features + RIDGE * len(rows) * np.eye(features.shape[1])
    coefficients = root @ np.linalg.solve(gram, features.T @ targets)
    return LanguageModel(languages, grams, (basis.T @ coefficients).astype(np.float32))


def predict_language(docs: DataFrame, model: LanguageModel, key: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every whole text.

    Null texts, texts without a letter, and all texts under a model without
    languages get ``und`` and 0. Equal scores go to the first language by name.
    Rows are scored one by one; only ``text`` and ``key`` are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def setup() -> Work:
        model = LanguageModel(**shared.value)

        def work(batch: pa.RecordBatch) -> Rows:
            texts = batch.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            known = [i for i, x in enumerate(texts) if model.languages and has_letter(x)]
            for start in range(0, len(known), BLOCK):
                rows = known[start : start + BLOCK]
                block = presence(model.grams, [distinct_grams(texts[i]) for i in rows])
                for i, values in zip(rows, block @ model.weights, strict=True):
                    best = int(values.argmax())
                    names[i] = model.languages[best]
                    scores[i] = float(min(1.0, max(0.0, values[best])))
            return {key: batch.column(key), "lang_pred": names, "score": scores}

        return work

    return map_slices(
        docs.select(key, "text"), setup, {key: "long", "lang_pred": "string", "score": "double"}
    )

