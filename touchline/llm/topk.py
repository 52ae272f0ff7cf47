"""Exact top-k search by inner product, with segment statistics from coarse to fine.

The distance of two vectors is at least that of their segments' means and
deviations: for a segment of n values, n * ((mean - mean')^2 + (dev - dev')^2).
With the lengths of both vectors, a lower bound of the distance is an upper bound
of the inner product: the sum of n * (mean * mean' + dev * dev').
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Segments of the resolutions, coarse to fine.
RESOLUTIONS = (4, 16)
#: Vectors in a block of candidates and in a block of queries.
BLOCK_ROWS, QUERY_ROWS = 1024, 2048
#: Blocks of candidates that one task compares with a block of queries, and the
#: queries of it that are compared at a time.
TILE_BLOCKS, AT_ONCE = 4, 64
#: Values up to here have exact products in doubles for up to 2**9 dimensions.
EXACT = 1 << 22
#: Share of a block from which on it is cheaper to multiply it as a whole.
DENSE = 0.02
#: What rounding may add to a bound, as a share of the product of the lengths.
ROUNDING = 1e-10


def integer_vector(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as doubles; null unless all are finite."""
    values = F.transform(vector, lambda x: F.floor(F.lit(scale).cast("double") * x.cast("double")))
    most = F.lit(1.7e308)
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) <= most, F.lit(False)))
    return F.when(finite & vector.isNotNull(), values)


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, scaled by the roots of their lengths."""
    parts = np.array_split(vectors, min(segments, max(1, vectors.shape[1])), axis=1)
    columns = []
    for part in parts:
        root = np.sqrt(part.shape[1])
        if part.shape[1]:
            columns += [part.mean(axis=1) * root, part.std(axis=1) * root]
    return np.stack(columns, axis=1) if columns else np.zeros((len(vectors), 1))


def exact_in_doubles(a: np.ndarray, b: np.ndarray) -> bool:
    return max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) <= EXACT


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``, pair by pair."""
    if exact_in_doubles(a, b):
        return np.einsum("ij,ij->i", a, b)
    exact = [sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for r, s in zip(a, b, strict=True)]
    return np.array(exact, object)


class Best:
    """The k best candidates of each query of a block, kept while blocks pass by."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self._stats = [statistics(vectors, n) for n in RESOLUTIONS]
        self._norms = np.linalg.norm(vectors, axis=1)
        self._found: list[list[tuple]] = [[] for _ in ids]
        self._least = np.full(len(ids), -np.inf)

    def _add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        new: dict[int, list[tuple]] = {}
        for q, i, s in zip(rows.tolist(), ids.tolist(), scores.tolist(), strict=True):
            new.setdefault(q, []).append((-int(s), i))
        for q, found in new.items():
            self._found[q] = sorted(self._found[q] + found)[: self.k]
            if len(self._found[q]) == self.k:
                # The next smaller double, since a large score may be rounded.
                self._least[q] = np.nextafter(-float(self._found[q][-1][0]), -np.inf)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take in a block of candidates."""
        stats = [statistics(vectors, n) for n in RESOLUTIONS]
        for start in range(0, len(self.ids), AT_ONCE):
            self._offer(np.arange(start, min(start + AT_ONCE, len(self.ids))), ids, vectors, stats)

    def _offer(
        self, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, stats: list[np.ndarray]
    ) -> None:
        bound = self._stats[0][queries] @ stats[0].T
        norms = np.linalg.norm(vectors, axis=1)
        bound += ROUNDING * (1 + np.outer(self._norms[queries], norms))
        bound[self.ids[queries][:, None] == ids[None, :]] = -np.inf
        # The most promising ones first, for a threshold that refuses the others.
        few = min(self.k, len(ids))
        own = np.argpartition(-bound, few - 1, axis=1)[:, :few].ravel()
        at = np.repeat(np.arange(len(queries)), few)
        able = (bound[at, own] > -np.inf) & (bound[at, own] >= self._least[queries[at]])
        at, own = at[able], own[able]
        rows = queries[at]
        self._add(rows, ids[own], _products(self.vectors[rows], vectors[own]))
        bound[at, own] = -np.inf
        alive = (bound >= self._least[queries][:, None]) & (bound > -np.inf)
        for mine, theirs in zip(self._stats[1:], stats[1:], strict=True):
            if alive.mean() > DENSE:
                fine = mine[queries] @ theirs.T
                fine += ROUNDING * (1 + np.outer(self._norms[queries], norms))
                alive &= fine >= self._least[queries][:, None]
            else:
                at, own = np.nonzero(alive)
                fine = np.einsum("ij,ij->i", mine[queries[at]], theirs[own])
                fine += ROUNDING * (1 + self._norms[queries[at]] * norms[own])
                alive[at, own] = fine >= self._least[queries[at]]
        at, own = np.nonzero(alive)
        rows = queries[at]
        if alive.mean() > DENSE and exact_in_doubles(self.vectors[queries], vectors):
            products = np.where(alive, self.vectors[queries] @ vectors.T, -np.inf)
            # Only the k best of each query, and their equals, can be among the best.
            kth = np.partition(products, -few, axis=1)[:, -few]
            scores = products[at, own]
            keep = scores >= np.maximum(kth[at], self._least[rows])
        else:
            scores = _products(self.vectors[rows], vectors[own])
            keep = np.array(scores >= self._least[rows], bool)
        self._add(rows[keep], ids[own[keep]], scores[keep])

    def rows(self) -> list[tuple[int, int, int]]:
        return [
            (int(q), i, -s) for q, best in zip(self.ids, self._found, strict=True) for s, i in best
        ]


def _unpacked(ids: bytes, values: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, np.int64)
    small = len(values) == 2 * dim * len(numbers)
    flat = np.frombuffer(values, np.int16 if small else np.float64)
    return numbers, flat.astype(np.float64).reshape(len(numbers), dim)


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows (id, vector) of one dimension in blocks: dim, ids, values."""
    schema = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            vectors = batch.column("vector")
            lengths = np.array([len(x) for x in vectors], np.int64)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(lengths) - lengths
            for dim in np.unique(lengths).tolist():
                chosen = np.flatnonzero(lengths == dim)
                for at in range(0, len(chosen), size):
                    part = chosen[at : at + size]
                    values = flat[starts[part][:, None] + np.arange(dim)]
                    small = np.abs(values).max(initial=0) < 1 << 15
                    values = values.astype(np.int16 if small else np.float64)
                    columns = [[dim], [ids[part].tobytes()], [values.tobytes()]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                        schema=schema,
                    )

    return rows.mapInArrow(run, "dim int, ids binary, `values` binary")


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's ``k`` best candidates.

    Both tables hold ``id`` and ``vector`` (whole numbers as doubles). A candidate
    with the query's own id is left out, equal scores go to the smaller id, and a
    query with fewer candidates gets them all. Only vectors of equal length are
    compared; rows with a null id or vector take no part. Rows that repeat a
    candidate count each; rows that repeat a query's id are one query, with the
    best of their scores. Scores beyond 64 bits stop at their limits.

    Both tables are cut into blocks. Tiles of a few blocks of candidates and of one
    block of queries, more or less, are formed by a join on numbers dealt out on
    both sides; each candidate goes to as many tiles as there are query blocks.
    """
    complete = "id IS NOT NULL AND vector IS NOT NULL"
    queries = queries.select("id", "vector").filter(complete)
    candidates = candidates.select("id", "vector").filter(complete)
    across = max(1, -(-queries.count() // QUERY_ROWS))
    along = max(1, -(-candidates.count() // (BLOCK_ROWS * TILE_BLOCKS)))
    tasks = max(1, int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = _packed(queries, QUERY_ROWS).select(
        F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("values").alias("q_values"),
        F.pmod(F.xxhash64("ids"), F.lit(across)).alias("q_across"),
        F.explode(F.sequence(F.lit(0), F.lit(along - 1))).alias("q_along"),
    )
    rest = _packed(candidates, BLOCK_ROWS).select(
        "*",
        F.pmod(F.xxhash64("ids"), F.lit(along)).alias("along"),
        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across"),
    )
    joined = rest.repartition(tasks, "dim", "across", "along").join(
        blocks.repartition(tasks, "q_dim", "q_across", "q_along"),
        (F.col("dim") == F.col("q_dim"))
        & (F.col("across") == F.col("q_across"))
        & (F.col("along") == F.col("q_along")),
    )
    joined = joined.select("dim", "ids", "values", "q_ids", "q_values")
    shape = T.StructType(
        [T.StructField(x, T.LongType()) for x in ("query_id", "vec_id", "score")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, Best] = {}
        for batch in batches:
            for row in batch.to_pylist():
                name, dim = (row["q_ids"], row["q_values"]), row["dim"]
                if name not in best:
                    best[name] = Best(*_unpacked(row["q_ids"], row["q_values"], dim), k)
                best[name].offer(*_unpacked(row["ids"], row["values"], dim))
        found = [r for x in best.values() for r in x.rows()]
        limit = 1 << 63
        columns = [
            pa.array([r[0] for r in found], pa.int64()),
            pa.array([r[1] for r in found], pa.int64()),
            pa.array([max(-limit, min(limit - 1, r[2])) for r in found], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    near = joined.mapInArrow(run, shape)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
