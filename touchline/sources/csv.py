"""CSV scan with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All columns of one or more CSV files; text if no ``schema`` is given.

    Doubled quotes are decoded. A row with too few or too many values, and a
    header that differs from the schema, raise instead of shifting values. That
    check needs all values of a row, so the parser does not skip columns. A
    quoted line break needs ``multi_line``, which reads each file in one task.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("multiLine", multi_line)
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)
