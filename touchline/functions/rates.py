"""Rates with a safe denominator, percentages and league points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.constants import POINTS_PER_DRAW, POINTS_PER_WIN
from touchline.functions.dates import ColumnOrName, column


def per_unit(amount: ColumnOrName, units: ColumnOrName, digits: int = 2) -> Column:
    """``amount`` per unit, rounded; null if there are no units or a side is null."""
    return F.round(F.try_divide(column(amount).cast("double"), column(units)), digits)


def pct(part: ColumnOrName, whole: ColumnOrName, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, rounded; null if ``whole`` is 0."""
    return F.round(F.try_divide(column(part).cast("double"), column(whole)) * 100, digits)


def league_points(wins: ColumnOrName, draws: ColumnOrName) -> Column:
    return column(wins) * POINTS_PER_WIN + column(draws) * POINTS_PER_DRAW
