"""Ages, last-record dates and staleness."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from touchline.constants import NO_RECORD_DATE, STALE_AFTER_MONTHS

ColumnOrName = Column | str


def column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_day(day: date | str) -> date:
    """A day given as a date or as yyyy-mm-dd; anything else raises."""
    return date.fromisoformat(day) if isinstance(day, str) else date(day.year, day.month, day.day)


def one_day(spark: SparkSession, as_of: date | str | None = None) -> date:
    """The reference day of a whole run: the given one, or today in the session's zone."""
    if as_of is None:
        return spark.range(1).select(F.current_date()).first()[0]
    return parse_day(as_of)


def as_of_column(as_of: date | str | None = None) -> Column:
    """The reference day as a DATE column; the current date if none is given."""
    return F.current_date() if as_of is None else F.lit(parse_day(as_of))


def date_parts(day: ColumnOrName) -> dict[str, Column]:
    """Year, month and day of month of a date."""
    day = column(day)
    return {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}


def age_at(birth: ColumnOrName, at: ColumnOrName) -> Column:
    """Whole years from ``birth`` to ``at``; null if either is null.

    Both dates are read as the number yyyymmdd. Their difference holds the years
    in its ten-thousands, less one while (month, day) has not been reached; so
    somebody born on 29 February ages on 1 March of a common year.
    """

    def yyyymmdd(day: ColumnOrName) -> Column:
        parts = date_parts(day)
        return parts["year"] * 10000 + parts["month"] * 100 + parts["day"]

    return F.floor((yyyymmdd(at) - yyyymmdd(birth)) / 10000).cast("int")


def last_recorded(*days: ColumnOrName) -> Column:
    """The latest of several dates, or the no-record date if all are null."""
    no_record = F.lit(NO_RECORD_DATE).cast("date")
    known = [F.coalesce(column(day), no_record) for day in days]
    return F.greatest(*known) if len(known) > 1 else known[0]


def staleness_flag(
    day: ColumnOrName, as_of: date | str | None = None, months: int = STALE_AFTER_MONTHS
) -> Column:
    """TRUE if ``day`` lies more than ``months`` before the reference day."""
    threshold = F.add_months(as_of_column(as_of), -months)
    return F.coalesce(column(day) < threshold, F.lit(False))
