"""The history of a table that is replaced as a whole, as intervals of validity."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.dates import as_of_column

#: Columns that a history adds: a digest of the row, and the days it holds from and up to.
ROW_HASH, VALID_FROM, VALID_TO = "row_hash", "valid_from", "valid_to"


def row_hash(columns: Sequence[str]) -> Column:
    """A digest of all values with their types; nulls and empty texts differ."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def snapshot(
    history: DataFrame | None, current: DataFrame, keys: Sequence[str], day: date | str
) -> DataFrame:
    """``history`` brought up to ``current``, the table as it is on ``day``.

    A row holds from the first day it was seen until the day it was seen changed or gone,
    exclusive; rows that hold still have no end. Unchanged rows stay as they are, so a
    repeated day adds nothing. If a day is repeated with other rows, they replace what the day
    had begun. ``keys`` identify a row of ``current`` and must not be null. Days must not
    go back: a row that holds from a later day raises.

    Ended intervals pass through without a shuffle; rows that hold are matched with
    ``current`` by key.
    """
    columns = current.columns
    at = as_of_column(day)
    fresh = current.withColumn(ROW_HASH, row_hash(columns))
    if history is None:
        return fresh.withColumn(VALID_FROM, at).withColumn(VALID_TO, F.lit(None).cast("date"))
    order = [*columns, ROW_HASH, VALID_FROM, VALID_TO]
    held = history.filter(F.col(VALID_TO).isNull()).select(F.struct(*order).alias("old"))
    new = fresh.select(F.struct(*columns, ROW_HASH).alias("new"))
    same_key = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    both = held.join(new, same_key, "full")

    late = F.col(f"old.{VALID_FROM}") > at
    text = F.concat(F.lit("the history has rows of "), F.col(f"old.{VALID_FROM}").cast("string"), F.lit(", after "), at.cast("string"))
    begun = F.when(late, F.raise_error(text).cast("date")).otherwise(F.col(f"old.{VALID_FROM}"))
    unchanged = F.coalesce(F.col(f"old.{ROW_HASH}") == F.col(f"new.{ROW_HASH}"), F.lit(False))

    def row(side: str, start: Column, end: Column) -> Column:
        values = [F.col(f"{side}.{c}").alias(c) for c in [*columns, ROW_HASH]]
        return F.struct(*values, start.alias(VALID_FROM), end.alias(VALID_TO))

    open_end = F.lit(None).cast("date")
    kept = F.when(unchanged, row("old", begun, open_end))
    # What began this very day and is not so any more never held.
    ended = F.when(~unchanged & F.col("old").isNotNull() & (begun < at), row("old", begun, at))
    started = F.when(~unchanged & F.col("new").isNotNull(), row("new", at, open_end))
    rows = both.select(F.explode(F.array_compact(F.array(kept, ended, started))).alias("row"))
    past = history.filter(F.col(VALID_TO).isNotNull()).select(*order)
    return past.unionByName(rows.select("row.*"))


def as_it_was(history: DataFrame, day: date | str) -> DataFrame:
    """The rows that held on a day."""
    at = as_of_column(day)
    still = F.col(VALID_TO).isNull() | (F.col(VALID_TO) > at)
    return history.filter((F.col(VALID_FROM) <= at) & still).drop(ROW_HASH, VALID_FROM, VALID_TO)
