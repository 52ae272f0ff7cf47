"""Two-valued flags and the data-quality note."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.constants import FRESH_NOTE, NOTE_DATE_FORMAT, STALE_NOTE_PREFIX
from touchline.functions.dates import ColumnOrName, column


def bool_flag(condition: Column) -> Column:
    """A condition as TRUE or FALSE, with unknown counted as FALSE."""
    return F.coalesce(condition, F.lit(False))


def staleness_note(is_stale: ColumnOrName, day: ColumnOrName) -> Column:
    """A warning that names the last record, or the text for fresh data."""
    warning = F.concat(F.lit(STALE_NOTE_PREFIX), F.date_format(column(day), NOTE_DATE_FORMAT))
    return F.when(column(is_stale), warning).otherwise(F.lit(FRESH_NOTE))


def outside_dimension_flag(
    attribute: ColumnOrName, derived_key: ColumnOrName, recorded_key: ColumnOrName
) -> Column:
    """TRUE if a key moved away from the recorded one to where ``attribute`` is null."""
    moved = column(derived_key) != column(recorded_key)
    return bool_flag(column(attribute).isNull() & moved)
