"""States that a new batch of rows is merged into, instead of reading all history again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.latest import latest_per_key


def merge_latest(
    state: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str],
    nulls: str = "first",
) -> DataFrame:
    """The newest row of every key, of an earlier result and a batch of new rows.

    ``state`` is what ``latest_per_key`` or this function returned for all rows before. A row
    that has lost once can never win later, so ranking the winners and the batch gives what
    ranking all rows would give, ties and rows without a date included, however rows are
    dealt to batches. A batch may hold rows again that were merged before; it can't take any
    back. Work grows with keys and batch, not with history.
    """
    rows = state.unionByName(batch.select(*state.columns))
    return latest_per_key(rows, keys, order_col, tie_breakers, nulls)


def distinct_state(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The distinct whole numbers of ``column`` by group, as exact bitmaps of 32,768 bits.

    One row for each group and range of numbers that it has, in ``bucket`` and ``bits``. A hot
    group spreads over its ranges, and each task sends one bitmap of a range at most.
    Groups without a value have a row without a bucket. Compact where numbers are dense;
    otherwise most of the 4 KB of a bitmap are zeros, which Parquet packs.
    """
    return (
        df.withColumn("bucket", F.bitmap_bucket_number(column))
        .groupBy(*keys, "bucket")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("bits"))
    )


def merge_distinct(state: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of all rows, from the states of two parts of them, which may overlap."""
    both = state.unionByName(batch)
    return both.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(state: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The number of distinct values by group; 0 for a group without any."""
    held = F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits")).otherwise(0)
    return state.groupBy(*keys).agg(F.sum(held).alias(name))
