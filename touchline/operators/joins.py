"""Equi-joins that bring along named columns only.

No join carries a broadcast hint. Spark broadcasts the other side if its size is
below ``spark.sql.autoBroadcastJoinThreshold`` (file size when planning, measured
size under adaptive execution). Beyond that it shuffles both sides and splits the
partitions that hold a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.checks import check_distinct_names


def lookup(
    df: DataFrame,
    dimension: DataFrame,
    key: str | Column,
    dimension_key: str,
    columns: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Add ``columns`` (new name -> column of ``dimension``) by an equi-join.

    ``key`` is a column or an expression over ``df``. Since every column taken
    gets a name of its own, one dimension can be looked up in several roles.
    ``how="inner"`` drops the rows without a match.
    """
    check_distinct_names([*df.columns, *columns])
    wanted = [F.col(source).alias(name) for name, source in columns.items()]
    side = dimension.select(F.col(dimension_key).alias("_lookup_key"), *wanted)
    key = F.col(key) if isinstance(key, str) else key
    return df.join(side, key == F.col("_lookup_key"), how).drop("_lookup_key")


def star_join(left: DataFrame, right: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """All columns of both sides; raises if a name occurs on both."""
    check_distinct_names([*left.columns, *right.columns])
    return left.join(right, on, how)
