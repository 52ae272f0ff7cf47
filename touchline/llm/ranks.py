"""Places of rows in a global order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.batches import Scratch

#: Bits that Spark's increasing ids leave for the rows of one partition.
ROW_BITS = 33


def ranked(
    rows: DataFrame, order: Sequence[str], scratch: Scratch, group: str | None = None
) -> DataFrame:
    """``rows`` with place (from 0) and total, over all rows or within each ``group``.

    Rows are dealt by ranges of (group, order), so that a hot group spreads over many
    partitions, sorted and written once with an increasing id. Rows of each partition and
    group are counted, and only these counts are added up. Nulls come first; rows equal
    in ``order`` take any of their places. ``group`` must not be null. The columns
    ``part``, ``row``, ``start``, ``place`` and ``total`` must not be among the others.
    """
    keys = [group] if group else []
    by = [*keys, *order]
    kept = scratch.write(
        rows.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("row", ROW_BITS))
    )
    # One row for each partition and group: as many as there are partitions and groups.
    runs = kept.groupBy(*keys, "part").agg(F.min("row").alias("least"), F.count("*").alias("n"))
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        *keys,
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("least")).alias("start"),
        F.sum("n").over(whole).alias("total"),
    )
    return (
        kept.join(starts, [*keys, "part"])
        .withColumn("place", F.col("row") + F.col("start"))
        .drop("row", "part", "start")
    )
