"""The newest row of every key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.joins import lookup


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str],
    nulls: str = "first",
) -> DataFrame:
    """Keep the row with the highest ``order_col`` for every key.

    Rows of one date are told apart by ``tie_breakers``, ascending; list enough
    of them to cover every column read later and the result depends on values
    alone. ``nulls="first"`` lets a row without a date win, ``"last"`` lets it lose.

    Because only rank 1 is kept, Spark drops all but one row per key and task
    ahead of the shuffle, so a key with a third of all rows moves little.
    """
    if nulls not in ("first", "last"):
        raise ValueError(f'nulls must be "first" or "last", not {nulls!r}')
    if not tie_breakers:
        raise ValueError("tie_breakers must name at least one column")
    order = F.col(order_col)
    newest = order.desc_nulls_first() if nulls == "first" else order.desc_nulls_last()
    ties = [F.col(name).asc_nulls_last() for name in tie_breakers]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(newest, *ties))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def attach_latest(
    df: DataFrame,
    history: DataFrame,
    key: str,
    order_col: str,
    columns: Mapping[str, str],
    tie_breakers: Sequence[str],
    nulls: str = "first",
) -> DataFrame:
    """Left-join ``columns`` (new name -> column) of the newest ``history`` row."""
    newest = latest_per_key(history, [key], order_col, tie_breakers, nulls)
    return lookup(df, newest, key, key, columns)
