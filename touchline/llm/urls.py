"""URL rules by a cascade of Bloom filters: exact membership without a join.

Level 1 holds the listed keys. Some keys of the corpus that are not listed pass
it; level 2 holds these. Some listed keys pass level 2; level 3 holds those, and
so on until a level lets nothing wrong through. A key of the corpus is listed
exactly if the first level that refuses it is an even one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.batches import Rows, Scratch, Work, map_slices

#: Bits for each key of the first level and of the later, smaller ones; probes.
BITS_FIRST, BITS_LATER, PROBES = 12, 4, 4
#: Bytes of all levels together, which are broadcast; a longer list raises.
MOST_BYTES = 512 << 20
MOST_LEVELS = 64


@dataclass(frozen=True)
class Cascade:
    """Levels as arrays of 64-bit words."""

    levels: list[np.ndarray]


def _probe(a: np.ndarray, b: np.ndarray, level: int, i: int, words: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a + np.uint64(i + 1) * (b | np.uint64(1)) + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(words * 64)


def passes(words: np.ndarray, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether keys with hashes ``a`` and ``b`` pass one level."""
    out = np.ones(len(a), bool)
    for i in range(PROBES):
        bit = _probe(a, b, level, i, len(words))
        out &= (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return out


def listed(cascade: Cascade, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether keys of the corpus are listed."""
    out, open_ = np.zeros(len(a), bool), np.ones(len(a), bool)
    for level, words in enumerate(cascade.levels):
        passed = passes(words, level, a, b)
        out[open_ & ~passed] = level % 2 == 1
        open_ &= passed
    out[open_] = len(cascade.levels) % 2 == 1
    return out


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(F.lit(1), key).alias("a"), F.xxhash64(F.lit(2), key).alias("b")]


def _as_hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(x).to_numpy(zero_copy_only=False).view(np.uint64) for x in "ab")


def _level(keys: DataFrame, level: int, words: int) -> np.ndarray:
    """The filter of all keys; its words are combined in Spark, and bounded in number."""

    def setup() -> Work:
        def work(batch: pa.RecordBatch) -> Rows:
            a, b = _as_hashes(batch)
            bits = np.concatenate([_probe(a, b, level, i, words) for i in range(PROBES)])
            one = np.uint64(1) << (bits & np.uint64(63))
            return {"word": (bits >> np.uint64(6)).astype(np.int64), "bits": one.view(np.int64)}

        return work

    rows = (
        map_slices(keys.select("a", "b"), setup, {"word": "long", "bits": "long"})
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .collect()
    )
    out = np.zeros(words, np.uint64)
    if rows:
        out[[r["word"] for r in rows]] = np.array([r["bits"] for r in rows], np.int64).view(np.uint64)
    return out


def build_cascade(keys: DataFrame, universe: DataFrame, scratch: Scratch) -> Cascade:
    """The cascade of the listed ``keys`` over all ``universe`` keys (columns ``key``).

    Null keys are ignored and repeated ones count once. No listed key: no level,
    nothing is listed. Levels over MOST_BYTES raise, since all are broadcast.
    """
    wanted = keys.filter("key IS NOT NULL").select("key").distinct()
    others = universe.filter("key IS NOT NULL").select("key").distinct()
    # The only join, while building: which keys of the corpus are not listed.
    others = others.join(wanted, "key", "left_anti")
    inside, outside = (scratch.write(x.select(*_hashes(F.col("key")))) for x in (wanted, others))
    levels: list[np.ndarray] = []
    while (n := inside.count()) and len(levels) < MOST_LEVELS:
        level = len(levels)
        words = 1 + n * (BITS_LATER if level else BITS_FIRST) // 64
        if 8 * (words + sum(map(len, levels))) > MOST_BYTES:
            raise ValueError(f"{n} keys need more than {MOST_BYTES} bytes of filters")
        levels.append(_level(inside, level, words))
        shared = outside.sparkSession.sparkContext.broadcast(levels[-1])

        def setup(level: int = level, shared=shared) -> Work:  # noqa: ANN001
            def work(batch: pa.RecordBatch) -> Rows:
                a, b = _as_hashes(batch)
                good = passes(shared.value, level, a, b)
                return {"a": a[good].view(np.int64), "b": b[good].view(np.int64)}

            return work

        wrong = scratch.write(map_slices(outside, setup, {"a": "long", "b": "long"}))
        inside, outside = wrong, inside
    if len(levels) == MOST_LEVELS and inside.count():
        raise ValueError("two keys have equal hashes")
    return Cascade(levels)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for a null or where there is no ``://``."""
    mark = F.locate("://", url)
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and the start of a path."""

    action: str
    host: str
    path: str


def candidate_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Keys a rule may have to fit a URL: suffixes of the host, starts of the path.

    Starts are as long as the paths of the rules are. Longer keys come first;
    of equally long ones the one with the longer host.
    """
    labels = F.split(host, r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    starts = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths])
    starts = F.filter(starts, lambda x: x.isNotNull())
    pairs = F.flatten(F.transform(hosts, lambda h: F.transform(
        starts, lambda p: F.struct(
            (-F.length(h) - F.length(p)).alias("order"), (-F.length(h)).alias("host_order"),
            F.concat(h, p).alias("key"),
        ),
    )))
    return F.transform(F.array_sort(pairs), lambda x: x["key"])


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    scratch: Scratch,
    blocked: DataFrame | None = None,
    key: str = "page_id",
) -> DataFrame:
    """page_id, host, path, rule and verdict of every URL.

    The longest rule that fits decides; ``rule`` is its host and path. Else the
    method's own list decides: ``blocked`` (column ``key``) holds hosts that are
    blocked with their subdomains, and every other URL is allowed. Rules are few
    and listed in a cascade like the blocked hosts, over all keys of all URLs. A
    URL that is null or has no ``://`` has an empty host and path. Repeated rows
    repeat, an empty table gives no row, and only ``url`` and ``key`` are read.
    """
    spark = pages.sparkSession
    host, path = split_url(F.col("url"))
    parts = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    lengths = sorted({len(r.path) for r in rules}) or [0]
    parts = parts.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    hosts = candidate_keys(F.col("host"), F.lit(""), [0])
    parts = scratch.write(parts.withColumn("hosts", hosts))
    named = {r.host + r.path: r.action for r in rules}
    wanted = spark.createDataFrame([(x,) for x in named], "key string")
    rule_filter = build_cascade(wanted, parts.select(F.explode("keys").alias("key")), scratch)
    host_filter = Cascade([])
    if blocked is not None:
        host_filter = build_cascade(blocked, parts.select(F.explode("hosts").alias("key")), scratch)
    shared = spark.sparkContext.broadcast((rule_filter.levels, host_filter.levels))

    def hashes(name: str, seed: int) -> Column:
        return F.transform(name, lambda x: F.xxhash64(F.lit(seed), x)).alias(f"{name}_{seed}")

    def setup() -> Work:
        cascades = [Cascade(levels) for levels in shared.value]

        def first(batch: pa.RecordBatch, name: str, cascade: Cascade) -> np.ndarray:
            """Number, from 1, of the first listed key of each row; 0 for none."""
            column = batch.column(f"{name}_1")
            a = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            b = batch.column(f"{name}_2").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            found = np.flatnonzero(listed(cascade, a, b))
            sizes = np.array([len(x) for x in column.to_pylist()], np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            start = np.cumsum(sizes) - sizes
            out = np.zeros(len(sizes), np.int32)
            out[row[found][::-1]] = (found - start[row[found]] + 1)[::-1]
            return out

        def work(batch: pa.RecordBatch) -> Rows:
            kept = {x: batch.column(x) for x in ("page_id", "host", "path")}
            rule = first(batch, "keys", cascades[0])
            keys = batch.column("keys").to_pylist()
            names = [x[i - 1] if i else None for x, i in zip(keys, rule.tolist(), strict=True)]
            return kept | {"rule": names, "listed": first(batch, "hosts", cascades[1]) > 0}

        return work

    shape = {"page_id": "long", "host": "string", "path": "string", "rule": "string", "listed": "boolean"}
    hashed = parts.select("page_id", "host", "path", "keys", *[
        hashes(name, seed) for name in ("keys", "hosts") for seed in (1, 2)
    ])
    judged = map_slices(hashed, setup, shape).withColumnRenamed("page_id", key)
    verdict: Column = F.when(F.col("listed"), "block").otherwise("allow")
    for name, action in named.items():
        verdict = F.when(F.col("rule") == name, action).otherwise(verdict)
    return judged.select(key, "host", "path", "rule", verdict.alias("verdict"))


def blocked_hosts(spark: SparkSession, hosts: Sequence[str]) -> DataFrame:
    """A list of hosts as a table for ``judge_urls``."""
    return spark.createDataFrame([(x,) for x in hosts], "key string")
