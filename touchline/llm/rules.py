"""Quality rules: counts within a text, and lines that many documents of a host share."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import Rows, Scratch, Work, map_slices

# Fixed: what parts words, and what counts as a symbol.
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window whose repetition counts.
WINDOW = 8

STATS = {
    "doc_id": "long", "host": "string", "n_words": "long", "word_chars": "long",
    "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "content": "long", "lines": "array<long>", "line_words": "array<long>",
}
_DIGITS = re.compile(r"\d+")


@dataclass(frozen=True)
class LineLimits:
    """A line goes where it stands in more than ``documents`` different texts of its
    host and in more than ``share`` of them; a document goes with less than ``left``
    of its words left."""

    documents: int = 20
    share: float = 0.02
    left: float = 0.3


def repeated_words(words: list[bytes]) -> int:
    """Words within windows of WINDOW words that the text holds twice or more.

    Windows are numbered exactly, by doubling: numbers of pairs of numbers.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    width = 1
    while width < WINDOW:
        pairs = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        ids = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        width *= 2
    twice = np.bincount(ids)[ids] > 1
    steps = np.zeros(n + 1, np.int64)
    steps[: twice.size] += twice
    steps[WINDOW : WINDOW + twice.size] -= twice
    return int((steps.cumsum()[:n] > 0).sum())


def normal_line(words: list[bytes]) -> int:
    """Hash of a line: lower case, single spaces, every number alike."""
    text = _DIGITS.sub("0", b" ".join(words).decode("utf-8", "replace").lower())
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def text_stats(text: str) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, hash of the
    normalised text, and its distinct normalised lines with their words."""
    words = text.encode().split()
    by_line: dict[int, int] = {}
    full = []
    for line in text.split("\n"):
        if own := line.encode().split():
            full.append(line)
            key = normal_line(own)
            by_line[key] = by_line.get(key, 0) + len(own)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(full) - len(set(full)),
        repeated_words(words),
        xxhash.xxh3_64_intdigest(b" ".join(words).lower()) - (1 << 63),
        list(by_line),
        list(by_line.values()),
    )


def _setup(key: str, host: str) -> Work:
    def work(batch: pa.RecordBatch) -> Rows:
        rows = [text_stats(x or "") for x in batch.column("text").to_pylist()]
        names = list(STATS)[2:]
        return {"doc_id": batch.column(key), "host": batch.column(host)} | {
            name: [r[i] for r in rows] for i, name in enumerate(names)
        }

    return work


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def frequent_lines(stats: DataFrame, limits: LineLimits) -> DataFrame:
    """host and line of the lines above the limits.

    A text counts once in its host, however many copies of it there are, so that
    copies of a good document don't make its lines frequent.
    """
    host = F.coalesce("host", F.lit(""))
    texts = stats.select(host.alias("host"), "content").distinct()
    sizes = texts.groupBy("host").agg(F.count("*").alias("texts"))
    lines = stats.select(host.alias("host"), "content", F.explode("lines").alias("line"))
    counts = (
        lines.distinct()
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > limits.documents)
    )
    return (
        counts.join(sizes, "host")
        .filter(F.col("n") > limits.share * F.col("texts"))
        .select("host", "line")
    )


def apply_rules(
    docs: DataFrame,
    scratch: Scratch,
    limits: LineLimits = LineLimits(),  # noqa: B008
    key: str = "doc_id",
    host: str = "source",
) -> DataFrame:
    """Counts of every whole text, and whether the document is kept.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_removed_words (words of removed lines), base_failed and kept. A null text
    has no word and fails, as an empty one does. A null host is a host of its own
    (the same as an empty name). Repeated rows get the same result each. Only
    ``text``, ``key`` and ``host`` are read. Texts are read once; their counts and
    line hashes are kept in a scratch table.
    """
    stats = scratch.write(
        map_slices(docs.select(key, host, "text"), lambda: _setup(key, host), STATS)
    )
    # One row of a text and id, with nulls replaced so that they join.
    row = ["host", "id", "no_id", "content"]
    keys = [
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.col("doc_id").isNull().alias("no_id"),
        F.col("content"),
    ]
    lines = stats.select(*keys, F.explode(F.arrays_zip("lines", "line_words")).alias("x"))
    # Written first: a join whose sides are both shuffled for it can split a hot line.
    frequent = scratch.write(frequent_lines(stats, limits)).withColumnRenamed("host", "its_host")
    removed = (
        lines.select(*row, "x.lines", "x.line_words")
        .join(frequent, (F.col("host") == F.col("its_host")) & (F.col("lines") == F.col("line")))
        .distinct()
        .groupBy(*row)
        .agg(F.sum("line_words").alias("n_removed_words"))
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    joined = stats.select("doc_id", *keys, *counts).join(removed, row, "left")
    gone = F.coalesce("n_removed_words", F.lit(0))
    depleted = F.col("n_words") - gone < limits.left * F.col("n_words")
    return joined.select(
        F.col("doc_id").alias(key), *counts, gone.alias("n_removed_words"),
        base_failed().alias("base_failed"), (~base_failed() & ~depleted).alias("kept"),
    )
