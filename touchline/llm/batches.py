"""Run numpy code over the rows of a DataFrame, a bounded number at a time."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import scratch_dir

ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()),
}
Rows = dict[str, Any]
Work = Callable[[pa.RecordBatch], Rows]

# Rows and bytes of text that a task turns into Python objects at once. A single
# longer text is taken whole.
SLICE_ROWS = 512
SLICE_BYTES = 4 << 20


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if batch.num_rows:
        mean = max(1, batch.nbytes // batch.num_rows)
        step = max(1, min(SLICE_ROWS, SLICE_BYTES // mean))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def as_arrow(values: Any, kind: pa.DataType) -> pa.Array:
    """Values as an Arrow array; a column that is carried along may be of a narrower type."""
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def map_slices(df: DataFrame, setup: Callable[[], Work], schema: dict[str, str]) -> DataFrame:
    """Apply ``setup()``, called once in each task, to slices of the rows.

    The function it returns maps a record batch to columns named in ``schema``,
    of any common length. It must not depend on how the rows are sliced.
    """
    arrow = pa.schema([(name, ARROW[kind]) for name, kind in schema.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = setup()
        for batch in batches:
            for part in _slices(batch):
                columns = work(part)
                yield pa.RecordBatch.from_arrays(
                    [as_arrow(columns[field.name], field.type) for field in arrow], schema=arrow
                )

    return df.mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind in schema.items()))


def lists(column: pa.Array) -> list[np.ndarray]:
    """The rows of a column of arrays of whole numbers without nulls inside; a null
    row is empty."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []


def tucked(docs: DataFrame, kept: Sequence[str], name: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with the columns in ``kept`` and all others in one struct called ``name``, so
    that no name of theirs can clash; and the columns that bring them back, in order."""
    held = {x.lower() for x in kept}
    mine = [x for x in docs.columns if x.lower() in held]
    others = [x for x in docs.columns if x.lower() not in held]
    if not others:
        return docs, [F.col(x) for x in mine]
    inside = F.struct(*[F.col(f"`{x}`").alias(f"c{i}") for i, x in enumerate(others)])
    back = {x: F.col(f"`{name}`")[f"c{i}"].alias(x) for i, x in enumerate(others)}
    return docs.select(*mine, inside.alias(name)), [back.get(x, F.col(x)) for x in docs.columns]


class Scratch:
    """Intermediate tables in a new folder that all executors share."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._folder = spark, scratch_dir(spark)

    def write(self, df: DataFrame) -> DataFrame:
        """Write the rows as a table, which ends their lineage, and read it back."""
        path = f"{self._folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)


def fold(key: Column | str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; -1 for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string")) % folds, F.lit(-1))


def bounded_sample(
    df: DataFrame, by: str, size: int, seed: int, total: int | None = None
) -> DataFrame:
    """About ``size`` distinct rows of each value of ``by``, chosen by a hash of the row,
    or fewer if that would make more than ``total`` rows.

    All rows are counted first (combined before the shuffle); a value with fewer
    rows than ``size`` keeps them all. At most 256 values are kept, the most
    frequent ones. The choice is the same at any partitioning.
    """
    counts = (
        df.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), by)
        .limit(256)
        .collect()
    )
    if total is not None and counts:
        size = min(size, max(1, total // len(counts)))
    draw = F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(1 << 30))
    wanted = F.lit(0)
    for row in counts:
        share = min(1.0, size / row["n"])
        wanted = F.when(F.col(by) == row[by], int(share * (1 << 30))).otherwise(wanted)
    return df.filter(F.col(by).isNotNull() & (draw < wanted)).dropDuplicates()


def labelled_sample(
    docs: DataFrame, labels: DataFrame, by: str, size: int, seed: int, key: str = "doc_id"
) -> DataFrame:
    """Documents of about ``size`` keys of each value of ``by`` in ``labels`` (key, by).

    Keys are drawn from the labels alone, so that they are few enough to broadcast
    at any size of the tables, and no text is shuffled but theirs. A key with
    several rows in ``docs`` or ``labels`` brings one of its texts, the smallest.
    """
    drawn = bounded_sample(labels.filter(F.col(key).isNotNull()).select(key, by), by, size, seed)
    drawn = drawn.select(F.col(key).alias("label_key"), F.col(by).alias("label"))
    joined = docs.select(key, "text").join(F.broadcast(drawn), F.col(key) == F.col("label_key"))
    return joined.groupBy("label_key").agg(F.min("label").alias(by), F.min("text").alias("text"))
