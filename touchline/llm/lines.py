"""Deduplication of lines by winnowing.

A run is a stretch of lines with MIN_WORDS words or more. Its fingerprints are the
smallest line hashes of all windows, a window being the fewest lines from (or up
to) a line that hold so many words. Windows depend on nothing but their own
lines, so two equal runs share every window and with it a fingerprint.

Passages that begin or end within a line are found the same way with words for
lines: a window is MIN_WORDS words, wherever lines break, and its fingerprint the
smallest hash of its pieces of half that length. Every window with a shared
fingerprint is compared, which extends a match word by word.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import Rows, Scratch, Work, lists, map_slices

MIN_WORDS = 50
#: Slots of 64 bits that mark texts; a broadcast table of this size at any size of the tables.
SLOTS = 1 << 18
#: Powers that a task keeps of each base of its hashes.
KEPT_POWERS = 1 << 16
# What parts words, the same as for lines.
_WORD = re.compile(r"[^ \t\n\v\f\r]+")
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))

LINES = {"id": "long", "content": "long", "hashes": "array<long>", "words": "array<int>"}
PRINTS = {"id": "long", "content": "long", "mark": "long"}
WINDOWS = {
    "w1": "long", "w2": "long", "id": "long", "content": "long", "first": "int", "last": "int",
}
WORD_PRINTS = {"id": "long", "content": "long", "marks": "array<long>"}
WORD_WINDOWS = {"w1": "long", "w2": "long", "id": "long", "content": "long", "first": "int"}


def full_lines(text: str) -> list[tuple[int, list[bytes]]]:
    """Number and words of each line that has a word."""
    lines = ((i, x.encode().split()) for i, x in enumerate(text.split("\n")))
    return [(i, words) for i, words in lines if words]


def line_hashes(text: str) -> tuple[list[int], list[int]]:
    """Hashes of the lines that have a word, spaces aside, and their words."""
    lines = full_lines(text)
    hashes = [xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63) for _, words in lines]
    return hashes, [len(words) for _, words in lines]


def windows(words: np.ndarray, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of all windows: the shortest ones from and up to each line."""
    ends = np.cumsum(words)
    if not len(ends) or ends[-1] < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = ends - words
    last = np.searchsorted(ends, starts + least)
    forward = np.flatnonzero(last < len(words))
    first = np.searchsorted(starts, ends - least, side="right") - 1
    backward = np.flatnonzero(ends >= least)
    pairs = np.concatenate(
        [np.stack([forward, last[forward]], 1), np.stack([first[backward], backward], 1)]
    )
    pairs = np.unique(pairs, axis=0)
    return pairs[:, 0], pairs[:, 1]


def minima(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Line with the smallest hash of each window, the later one of equals.

    First and last lines don't fall from window to window.
    """
    line: deque[int] = deque()
    out, reached = np.zeros(len(first), np.int64), 0
    values = hashes.tolist()
    for w, (a, b) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
        while reached <= b:
            while line and values[line[-1]] >= values[reached]:
                line.pop()
            line.append(reached)
            reached += 1
        while line[0] < a:
            line.popleft()
        out[w] = line[0]
    return out


def _new_powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(max(0, n - 1), np.uint64(base))])[:n]


@lru_cache
def _kept_powers(base: int) -> np.ndarray:
    powers = _new_powers(base, KEPT_POWERS)
    powers.setflags(write=False)
    return powers


def _powers(base: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1; those of texts of ordinary length are kept, not to be changed."""
    return _kept_powers(base)[:n] if n <= KEPT_POWERS else _new_powers(base, n)


@lru_cache
def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def window_hash(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, base: int) -> np.ndarray:
    """A hash of the lines of each window."""
    with np.errstate(over="ignore"):
        mixed = hashes.view(np.uint64) ^ (hashes.view(np.uint64) >> np.uint64(29))
        mixed = mixed * np.uint64(0xBF58476D1CE4E5B9) ^ base
        # Sums of line i times base ** i; a window's is shifted back to its first line.
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mixed * _powers(int(base), len(hashes)), out=sums[1:])
        back = _powers(_inverse(int(base)), len(hashes))
        value = (sums[last + 1] - sums[first]) * back[first] + (last - first).astype(np.uint64)
        value = value * np.uint64(0x94D049BB133111EB)
    return (value ^ (value >> np.uint64(32))).view(np.int64)


def window_hashes(
    hashes: np.ndarray, first: np.ndarray, last: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the lines of each window."""
    return tuple(window_hash(hashes, first, last, base) for base in _BASES)


def word_hashes(text: str) -> np.ndarray:
    """Hash of each word."""
    words = text.encode().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def word_marks(hashes: np.ndarray, least: int) -> np.ndarray:
    """The fingerprint of each window of ``least`` words: the smallest hash of its
    pieces of half as many words."""
    piece = max(1, least // 2)
    if len(hashes) < least:
        return np.zeros(0, np.int64)
    first = np.arange(len(hashes) - piece + 1)
    values = window_hash(hashes, first, first + piece - 1, _BASES[0])
    width, wanted = 1, least - piece + 1
    while width < wanted:
        step = min(width, wanted - width)
        values = np.minimum(values[:-step], values[step:])
        width += step
    return values


def _word_fingerprints(least: int) -> Work:
    def work(batch: pa.RecordBatch) -> Rows:
        texts = batch.column("text").to_pylist()
        marks = [np.unique(word_marks(word_hashes(x or ""), least)) for x in texts]
        kept = [i for i, x in enumerate(marks) if len(x)]
        at = pa.array(kept, pa.int64())
        return {x: batch.column(x).take(at) for x in ("id", "content")} | {
            "marks": [marks[i] for i in kept]
        }

    return work


def _extend_words(least: int) -> Work:
    def work(batch: pa.RecordBatch) -> Rows:
        keys, contents, texts = (batch.column(x).to_pylist() for x in ("id", "content", "text"))
        sizes, found = [], [np.zeros((3, 0), np.int64)]
        for text, marks in zip(texts, lists(batch.column("marks")), strict=True):
            hashes = word_hashes(text)
            first = np.flatnonzero(np.isin(word_marks(hashes, least), marks))
            found.append(np.stack([*window_hashes(hashes, first, first + least - 1), first]))
            sizes.append(len(first))
        w1, w2, first = np.concatenate(found, axis=1)
        at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        return {
            "w1": w1, "w2": w2, "first": first.astype(np.int32),
            "id": pa.array(keys, pa.int64()).take(at), "content": pa.array(contents, pa.int64()).take(at),
        }

    return work


def _read_lines() -> Work:
    def work(batch: pa.RecordBatch) -> Rows:
        out: dict[str, list] = {name: [] for name in LINES}
        rows = zip(*(batch.column(x).to_pylist() for x in ("id", "content", "text")), strict=True)
        for key, content, text in rows:
            hashes, words = line_hashes(text or "")
            if sum(words) >= MIN_WORDS:
                for name, value in zip(LINES, (key, content, hashes, words), strict=True):
                    out[name].append(value)
        return out

    return work


def _lists(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    return [np.array(x, np.int64) for x in batch.column(name).to_pylist()]


def _fingerprints() -> Work:
    def work(batch: pa.RecordBatch) -> Rows:
        out: dict[str, list] = {name: [] for name in PRINTS}
        keys = zip(batch.column("id").to_pylist(), batch.column("content").to_pylist(), strict=True)
        lines = zip(_lists(batch, "hashes"), _lists(batch, "words"), strict=True)
        for (key, content), (hashes, words) in zip(keys, lines, strict=True):
            marks = hashes[np.unique(minima(hashes, *windows(words)))].tolist()
            out["id"] += [key] * len(marks)
            out["content"] += [content] * len(marks)
            out["mark"] += marks
        return out

    return work


def _extend() -> Work:
    def work(batch: pa.RecordBatch) -> Rows:
        out: dict[str, list] = {name: [] for name in WINDOWS}
        keys = zip(batch.column("id").to_pylist(), batch.column("content").to_pylist(), strict=True)
        lines = zip(*(_lists(batch, x) for x in ("hashes", "words", "marks")), strict=True)
        for (key, content), (hashes, words, marks) in zip(keys, lines, strict=True):
            first, last = windows(words)
            met = np.isin(hashes[minima(hashes, first, last)], marks)
            first, last = first[met], last[met]
            w1, w2 = window_hashes(hashes, first, last)
            for name, values in (("w1", w1), ("w2", w2), ("first", first), ("last", last)):
                out[name] += values.tolist()
            out["id"] += [key] * len(first)
            out["content"] += [content] * len(first)
        return out

    return work


def _same(a: DataFrame, b: DataFrame) -> Column:
    """Rows of one document; null ids are equal to each other."""
    return a["id"].eqNullSafe(b["id"]) & (a["content"] == b["content"])


def repeated_runs(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """id, content and runs (first and last line) of the documents with later repeats.

    ``docs`` has id, content (hash of the text) and text. Lines are numbered among
    those that have a word. A document stands before another one if (id, content)
    does; a null id stands first.
    """
    lines = scratch.write(map_slices(docs.select("id", "content", "text"), _read_lines, LINES))
    marks = scratch.write(map_slices(lines, _fingerprints, PRINTS))
    # Written first: a join whose sides are both shuffled for it can split a hot key.
    twice = scratch.write(
        marks.groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select("mark")
    )
    met = (
        marks.join(twice, "mark")
        .groupBy(F.col("id"), F.col("content"))
        .agg(F.collect_set("mark").alias("marks"))
    )
    joined = lines.join(met, _same(lines, met)).select(
        lines["id"], lines["content"], "hashes", "words", "marks"
    )
    # A match is extended over all windows that hold its fingerprint.
    found = scratch.write(map_slices(joined, _extend, WINDOWS))
    place = F.struct("id", "content", "first")
    earliest = scratch.write(
        found.groupBy("w1", "w2")
        .agg(F.count("*").alias("n"), F.min(place).alias("earliest"))
        .filter("n > 1")
        .select("w1", "w2", "earliest")
    )
    return (
        found.join(earliest, ["w1", "w2"])
        .filter(place > F.col("earliest"))
        .groupBy("id", "content")
        .agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("runs"))
    )


def _slot() -> Column:
    return F.pmod("content", F.lit(SLOTS)).alias("slot")


def _bit() -> Column:
    return F.expr("shiftleft(1L, CAST(pmod(shiftrightunsigned(content, 32), 64) AS INT))")


def marked(docs: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with the column marked: true for all whose ``content`` is in ``texts``, and
    for a few others, so that most texts that a join would not match aren't shuffled."""
    bits = scratch.write(texts.groupBy(_slot()).agg(F.bit_or(_bit()).alias("bits")))
    held = F.coalesce("bits", F.lit(0).cast("long")).bitwiseAND(_bit()) != 0
    joined = docs.join(F.broadcast(bits), _slot() == F.col("slot"), "left")
    return joined.withColumn("marked", held).drop("slot", "bits")


def repeated_words(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """id, content and runs (first words of the windows) of the documents with later
    repeats of MIN_WORDS words, wherever lines break; no runs: every word.

    ``docs`` and the order of documents are as in ``repeated_runs``. A later copy of a
    whole text loses every word, and is not compared by windows.
    """
    least = MIN_WORDS
    found = map_slices(
        docs.select("id", "content", "text"), lambda: _word_fingerprints(least), WORD_PRINTS
    )
    marks = scratch.write(found)
    texts = marks.select("id", "content").distinct()
    firsts = scratch.write(
        texts.groupBy("content")
        .agg(F.min(F.struct("id")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("content").alias("copied"), "first")
    )
    later = (F.col("content") == F.col("copied")) & (F.struct("id") > F.col("first"))
    copies = scratch.write(texts.join(firsts, later).select("id", "content"))
    marks = marks.join(firsts, later, "left_anti").select(
        "id", "content", F.explode("marks").alias("mark")
    )
    # Written first: a join whose sides are both shuffled for it can split a hot key.
    twice = scratch.write(
        marks.groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select("mark")
    )
    met = scratch.write(
        marks.join(twice, "mark")
        .groupBy(F.col("id"), F.col("content"))
        .agg(F.collect_set("mark").alias("marks"))
    )
    docs = marked(docs, met, scratch).filter("marked")
    # Repeated rows bring the same places, so that they don't repeat each other.
    joined = docs.join(met, _same(docs, met)).select(
        docs["id"], docs["content"], docs["text"], "marks"
    )
    found = scratch.write(map_slices(joined, lambda: _extend_words(least), WORD_WINDOWS))
    place = F.struct("id", "content", "first")
    earliest = scratch.write(
        found.groupBy("w1", "w2")
        .agg(F.count("*").alias("n"), F.min(place).alias("earliest"))
        .filter("n > 1")
        .select("w1", "w2", "earliest")
    )
    runs = (
        found.join(earliest, ["w1", "w2"])
        .filter(place > F.col("earliest"))
        .groupBy("id", "content")
        .agg(F.collect_set("first").alias("runs"))
    )
    return runs.unionByName(copies.withColumn("runs", F.array().cast("array<int>")))


def without_words(text: str, firsts: list[int], least: int = MIN_WORDS) -> tuple[str, int]:
    """The text without the windows that begin at the words ``firsts`` (none: without any
    word), and how many lines lost words. Lines left without a word go."""
    lines = text.split("\n")
    spots = [[m.span() for m in _WORD.finditer(x)] for x in lines]
    total = sum(map(len, spots))
    steps = np.zeros(total + 1, np.int64)
    starts = np.array(firsts, np.int64)
    steps[starts] += 1
    np.add.at(steps, starts + least, -1)
    gone = (steps.cumsum()[:total] > 0) if firsts else np.ones(total, bool)
    out, touched, at = [], 0, 0
    for line, words in zip(lines, spots, strict=True):
        lost = gone[at : at + len(words)]
        at += len(words)
        if not lost.any():
            out.append(line)
            continue
        touched += 1
        if lost.all():
            continue
        kept, end = "", 0
        for (start, stop), cut in zip(words, lost.tolist(), strict=True):
            if not cut:
                kept += line[end if kept or not end else start : stop]
            end = stop
        if not lost[-1]:
            kept += line[end:]
        out.append(kept)
    return "\n".join(out), touched


def without_runs(text: str, runs: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the lines of the runs, and how many lines went."""
    lines = text.split("\n")
    numbers = [i for i, _ in full_lines(text)]
    steps = np.zeros(len(numbers) + 1, np.int64)
    for first, last in runs:
        steps[first] += 1
        steps[last + 1] -= 1
    gone = {i for i, n in zip(numbers, steps.cumsum().tolist(), strict=False) if n > 0}
    return "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores added until no column has it."""
    while name.lower() in {x.lower() for x in columns}:
        name += "_"
    return name


def dedup_lines(
    docs: DataFrame, scratch: Scratch, key: str = "doc_id", removed: str = "n_removed_lines",
    within: bool = False,
) -> DataFrame:
    """``docs`` with every later repeat of a run taken out of ``text``, and a count.

    A line goes if it lies in a stretch of lines with MIN_WORDS words or more, all
    of which stand in the same order further ahead: in a document with a smaller
    ``key``, or earlier in its own. The earliest place of every run stays. Blank
    lines are skipped when lines are compared, and stay. All columns are returned;
    ``n_chars``, if there, is counted anew where lines went; a column named like
    ``removed`` is replaced. A null text stays null with 0 removed lines. Rows
    with equal key and text are one document and get the same result; documents
    with equal key (or none) and other texts are told apart by their texts' hash.

    With ``within`` runs are of words, wherever lines break: a word goes if it lies in
    MIN_WORDS words or more that stand in the same order further ahead. Of a line
    that loses some words the others stay, and it counts as a removed one.
    """
    repeats, without = (repeated_words, without_words) if within else (repeated_runs, without_runs)
    docs = docs.drop(removed)
    content, runs = (unused(x, docs.columns) for x in ("content", "runs"))
    hashed = docs.withColumn(content, F.xxhash64("text"))
    found = repeats(
        hashed.select(F.col(key).cast("long").alias("id"), F.col(content).alias("content"), "text"),
        scratch,
    ).select(F.col("id").alias("run_id"), F.col("content").alias("run_content"), F.col("runs").alias("run_lines"))
    own = hashed.select(
        *[F.col(f"`{x}`").alias(f"doc {x}") for x in docs.columns], F.col(content).alias("its content")
    )
    same = F.col(f"`doc {key}`").cast("long").eqNullSafe(F.col("run_id")) & (
        F.col("`its content`") == F.col("run_content")
    )
    if within:
        found = scratch.write(found)
        texts = found.select(F.col("run_content").alias("content"))
        own = marked(own.withColumnRenamed("its content", "content"), texts, scratch)
        own = own.withColumnRenamed("content", "its content")
        rest = own.filter("NOT marked").withColumn("run_lines", F.lit(None).cast("array<int>"))
        joined = own.filter("marked").join(found, same, "left").select(*rest.columns).union(rest)
    else:
        joined = own.join(found, same, "left")
    joined = joined.select(
        *[F.col(f"`doc {x}`").alias(x) for x in docs.columns], F.col("run_lines").alias(runs)
    )
    joined = joined.withColumn(removed, F.lit(0).cast("long"))
    schema = joined.drop(runs).schema
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(name) for name in names}
            spans = batch.column(runs)
            rows = np.flatnonzero(~np.array(spans.is_null().to_pylist(), bool)).tolist()
            if rows:
                texts = columns["text"].to_pylist()
                counts = [0] * len(texts)
                chars = columns["n_chars"].to_pylist() if "n_chars" in columns else None
                for i in rows:
                    pairs = spans[i].as_py()
                    if not within:
                        pairs = [(x["first"], x["last"]) for x in pairs]
                    texts[i], counts[i] = without(texts[i], pairs)
                    if chars is not None:
                        chars[i] = len(texts[i])
                columns["text"] = pa.array(texts, columns["text"].type)
                columns[removed] = pa.array(counts, columns[removed].type)
                if chars is not None:
                    columns["n_chars"] = pa.array(chars, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return joined.mapInArrow(run, schema)
