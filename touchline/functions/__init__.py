"""Column-to-column functions, all built from JVM-side expressions."""

from touchline.functions.dates import (
    age_at,
    as_of_column,
    date_parts,
    last_recorded,
    staleness_flag,
)
from touchline.functions.flags import bool_flag, outside_dimension_flag, staleness_note
from touchline.functions.rates import league_points, pct, per_unit

__all__ = [
    "age_at",
    "as_of_column",
    "bool_flag",
    "date_parts",
    "last_recorded",
    "league_points",
    "outside_dimension_flag",
    "pct",
    "per_unit",
    "staleness_flag",
    "staleness_note",
]
