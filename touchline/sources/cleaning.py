"""Cleaning steps between the raw scan and the staging table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from touchline.constants import NULL_TOKENS
from touchline.functions.dates import as_of_column
from touchline.sources.tables import TableSpec


def normalise_columns(df: DataFrame) -> DataFrame:
    """Upper-case all column names."""
    return df.toDF(*[name.upper() for name in df.columns])


def select_by_position(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Keep columns by ordinal."""
    return df.select(*[df.columns[i] for i in positions])


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn texts that stand for a missing value into null, in all text columns."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    if not tokens or not texts:
        return df
    missing = [F.lit(token) for token in tokens]
    return df.withColumns({c: F.when(~F.col(c).isin(missing), F.col(c)) for c in texts})


def _or_raise(text: Column, what: str, *values: Column) -> Column:
    """The first value that is not null, or an error if there is a text but no value.

    Later values are computed only for texts that the earlier ones cannot read.
    """
    error = F.raise_error(F.concat(F.lit(f"not a {what}: "), text))
    return F.coalesce(*values, F.when(text.isNotNull(), error))


def parse_dates(df: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Parse text to timestamps without a time zone; nulls stay null.

    A text that is no date raises, or becomes null if not ``strict``.
    """
    parsed = {}
    for name in columns:
        value = F.col(name).try_cast("timestamp_ntz")
        parsed[name] = _or_raise(F.col(name), f"date in {name}", value) if strict else value
    return df.withColumns(parsed)


def parse_numbers(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Parse text to the given types; raises on text that is no such number.

    Whole numbers may be written with a zero fraction ("12.0").
    """
    parsed = {}
    for name, dtype in types.items():
        if dtype == "string":
            continue
        text = F.col(name)
        values = [text.try_cast(dtype)]
        if dtype == "bigint":
            number = text.try_cast("decimal(38,6)")
            values.append(F.when(number == F.floor(number), number.try_cast(dtype)))
        parsed[name] = _or_raise(text, f"{dtype} in {name}", *values)
    return df.withColumns(parsed)


# Texts that are whole numbers, and numbers: digits, a point, an exponent.
WHOLE = r"^\s*[+-]?\d+\s*$"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Texts that a cast to bigint reads, unless they are too large. A cast that fails costs an error
# inside, many times as much as a match.
CASTABLE = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"


def unlisted(df: DataFrame, spec: TableSpec) -> list[str]:
    """The text columns of a cleaned table whose type its recipe does not tell."""
    listed = {*spec.types, *spec.dates}
    texts = (f.name for f in df.schema if isinstance(f.dataType, StringType))
    return [name for name in texts if name not in listed]


# Kinds of values, each more general than the one before: a column is of the most general
# kind of its values. Whole numbers beyond a bigint are text, so that no digit is lost.
KINDS = ("bigint", "double", "string")


def kind(text: Column) -> Column:
    """The kind of one value, as a place in KINDS; a null has none.

    Only texts that look like a number are cast.
    """
    return (
        F.when(text.isNull(), None)
        .when(text.rlike(CASTABLE) & text.try_cast("bigint").isNotNull(), 0)
        .when(~text.rlike(NUMBER) | text.rlike(WHOLE), 2)
        .when(text.try_cast("double").isNotNull(), 1)
        .otherwise(2)
    )


def kinds(columns: Sequence[str]) -> list[Column]:
    """One aggregate for each column, as ``kind <place>``: the most general kind of its values.

    Aggregates of parts merge, so they can be observed while the rows are written.
    """
    return [F.max(kind(F.col(name))).alias(f"kind {i}") for i, name in enumerate(columns)]


def types_of(found: Mapping[str, int | None], columns: Sequence[str]) -> dict[str, str]:
    """bigint or double by column, from the aggregates above; texts are left out."""
    places = {name: found[f"kind {i}"] for i, name in enumerate(columns)}
    return {name: KINDS[x] for name, x in places.items() if x is not None and KINDS[x] != "string"}


def infer_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """bigint or double for the text columns in which every value is such a number.

    One pass over all rows decides, never a sample; nulls do not count. A column
    without a value stays text, and so does one whose whole numbers exceed a
    bigint.
    """
    return types_of(df.agg(*kinds(columns)).first().asDict(), columns) if columns else {}


def drop_future(df: DataFrame, column: str, as_of: date | str | None = None) -> DataFrame:
    """Keep rows up to midnight at the start of the reference day.

    Apply it before dates lose their time: a row later on that day is dropped,
    and so is a row without a date.
    """
    return df.filter(F.col(column) <= as_of_column(as_of))


def narrow_timestamps(df: DataFrame) -> DataFrame:
    """Cast every timestamp column, with or without time zone, to a date."""
    stamps = [f.name for f in df.schema if isinstance(f.dataType, (TimestampType, TimestampNTZType))]
    return df.withColumns({c: F.col(c).cast("date") for c in stamps}) if stamps else df


def clean(
    raw: DataFrame,
    spec: TableSpec,
    as_of: date | str | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """Apply a table's recipe to its raw text columns."""
    df = null_tokens_to_null(normalise_columns(raw), null_tokens)
    df = parse_dates(df, spec.dates)
    if spec.future_bound:
        df = drop_future(df, spec.future_bound, as_of)
    if spec.positions is not None:
        df = select_by_position(df, spec.positions)
    return narrow_timestamps(parse_numbers(df, spec.types))
