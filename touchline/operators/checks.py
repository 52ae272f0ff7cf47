"""Checks on names and keys."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_distinct_names(names: Iterable[str]) -> None:
    """Raise if two columns differ at most in case, before anything is computed."""
    clashes = sorted(n for n, k in Counter(name.lower() for name in names).items() if k > 1)
    if clashes:
        raise ValueError(f"column names occur more than once: {', '.join(clashes)}")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise if a key occurs twice, else return ``df`` (runs one job).

    A dimension with a repeated key multiplies the rows that look it up. The
    counts are pre-aggregated, so a hot key does not gather in one task.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    examples = repeated.limit(5).collect()
    if examples:
        raise ValueError(f"keys {list(keys)} are not unique, for example {examples}")
    return df
