"""Reconciliation of a recorded value with newer, dated observations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.dates import ColumnOrName, column


@dataclass(frozen=True)
class Dated:
    """An observation: its label, its date column and the values it offers."""

    label: str
    date: str
    values: Mapping[str, ColumnOrName]


def reconcile_latest(
    df: DataFrame,
    observations: Sequence[Dated],
    recorded: Mapping[str, ColumnOrName],
    recorded_label: str,
    label_column: str,
) -> DataFrame:
    """Add the values of the observation dated later than all the others.

    On a tie, or if any date is missing, no observation is known to be the
    latest and the recorded values stand. ``label_column`` tells which won.
    """

    def is_latest(observation: Dated) -> Column:
        others = [o for o in observations if o is not observation]
        return reduce(and_, [F.col(observation.date) > F.col(o.date) for o in others])

    def choose(values: Sequence[Column], fallback: Column) -> Column:
        chosen = F.when(is_latest(observations[0]), values[0])
        for observation, value in zip(observations[1:], values[1:]):
            chosen = chosen.when(is_latest(observation), value)
        return chosen.otherwise(fallback)

    if len(observations) < 2:
        raise ValueError("at least two observations are needed")
    columns = {
        name: choose([column(o.values[name]) for o in observations], column(fallback))
        for name, fallback in recorded.items()
    }
    columns[label_column] = choose([F.lit(o.label) for o in observations], F.lit(recorded_label))
    return df.select("*", *[value.alias(name) for name, value in columns.items()])
