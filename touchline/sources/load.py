"""Full-refresh load of the staging tables with an audit."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.constants import NULL_TOKENS
from touchline.functions.dates import one_day
from touchline.operators.checks import assert_unique
from touchline.sources.cleaning import clean, kinds, parse_numbers, types_of, unlisted
from touchline.sources.csv import read_table_csv
from touchline.sources.store import Store
from touchline.sources.tables import STAGING, TableSpec
from touchline.together import run_together


@dataclass(frozen=True)
class LoadResult:
    """The audit of one load: files (or parts, of a load in parts) and rows that it wrote, and
    whether all rows that reached the writers are in those files."""

    table: str
    success: bool
    chunks: int
    rows: int

    def __str__(self) -> str:
        return f"{self.table}: success {self.success}, chunks {self.chunks}, rows {self.rows}"


#: The partition column of tables that are loaded in parts.
PART = "load_part"


def _content(df: DataFrame, in_parts: bool = False) -> tuple[int, int]:
    """Files (or parts) with rows, and rows, of a table just written; no column is read."""
    chunk = F.col(PART if in_parts else "_metadata.file_path")
    by_file = df.groupBy(chunk.alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    row = by_file.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")).first()
    return row["files"], row["rows"] or 0


def _replace(
    spark: SparkSession, new: str, name: str, store: Store, schema: StructType, key: Sequence[str], written: int,
    in_parts: bool = False,
) -> LoadResult:
    """Audit and check prepared rows, then let them replace the table; they go if that fails."""
    try:
        files, rows = _content(store.read(spark, new, schema), in_parts)
        if key:
            assert_unique(store.read(spark, new, schema), key)
        store.publish(spark, new, name)
    except BaseException:
        store.discard(spark, new)
        raise
    return LoadResult(name, rows == written, files, written)


def load_table(
    df: DataFrame,
    name: str,
    store: Store,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    key: Sequence[str] = (),
    load_id: str | None = None,
    parts: int | None = None,
) -> LoadResult:
    """Write a table and audit what this load wrote.

    The default replaces the table, so that a repeated load adds no rows twice; a ``key``
    that repeats raises before that, and the old table stays. With ``partition_by``, each
    value goes to few files, a hot one to several.

    ``mode="append"`` with a ``load_id`` adds the rows as a partition of that name, in place
    of what an earlier try of the same load left there: a load that is repeated adds its rows
    once, and loads of different ids may run side by side, each counting its own files.
    Without an id the rows are added to whatever is there, and the audit counts what came
    to be there meanwhile, so such appends must not run side by side.

    With ``parts`` the rows are dealt to that many parts, each a partition of its own (see PART)
    of any number of files, and the audit counts parts instead of files. The tasks that read the
    rows write them, so no task takes a whole part.
    """
    spark, in_parts = df.sparkSession, parts is not None
    if in_parts:
        if partition_by or load_id is not None or parts < 1 or PART in map(str.lower, df.columns):
            raise ValueError("1 or more parts are the only partitions, of rows without such a column")
        part = F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("string")
        df = df.withColumn(PART, F.concat(F.lit(f"load-{uuid.uuid4().hex}-"), part))
    if load_id is not None and (partition_by or mode != "append"):
        raise ValueError("a load id makes a partition of its own, of appended rows")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    # Observed last, in the stage that writes: a task that is repeated after the
    # loss of an executor is counted once there.
    audit = Observation(f"load {name}")
    partition_by = [PART] if in_parts else partition_by
    observed = df.observe(audit, F.count(F.lit(1)).alias("rows"))
    if mode == "append" and load_id is not None:
        store.append_load(observed, name, load_id)
        written = audit.get["rows"]
        if written:
            files, rows = _content(store.read_load(spark, name, load_id))
        else:
            # Nothing was written, so nothing has replaced an earlier try.
            store.drop_load(spark, name, load_id)
            files, rows = 0, 0
    elif mode == "append":
        there = store.exists(spark, name)
        before = _content(store.files(spark, name), in_parts) if there else (0, 0)
        store.append(observed, name, partition_by)
        after = _content(store.files(spark, name), in_parts)
        files, rows = after[0] - before[0], after[1] - before[1]
        written = audit.get["rows"]
    elif mode == "overwrite":
        new = store.prepare(observed, name, partition_by)
        return _replace(spark, new, name, store, df.schema, key, audit.get["rows"], in_parts)
    else:
        raise ValueError(f"mode {mode} is neither overwrite nor append")
    return LoadResult(name, rows == written, files, written)


def load_raw(
    raw: DataFrame,
    spec: TableSpec,
    store: Store,
    as_of: date | str | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    check_keys: bool = True,
) -> LoadResult:
    """Clean a raw table by its recipe and load it, with one scan of the raw files.

    Columns whose type the recipe does not tell are written as text, while the most general
    kind of their values is observed. If some hold numbers only, they are cast from the
    written text, column by column, instead of parsing the raw files again.
    """
    spark, key = raw.sparkSession, spec.key if check_keys else ()
    cleaned = clean(raw, spec, as_of, null_tokens)
    texts = unlisted(cleaned, spec)
    if not texts:
        return load_table(cleaned, spec.name, store, key=key)
    seen = Observation(f"kinds of {spec.name}")
    observed = cleaned.observe(seen, F.count(F.lit(1)).alias("rows"), *kinds(texts))
    as_text = store.prepare(observed, spec.name)
    types = types_of(seen.get, texts)
    if not types:
        return _replace(spark, as_text, spec.name, store, cleaned.schema, key, seen.get["rows"])
    try:
        typed = parse_numbers(store.read(spark, as_text, cleaned.schema), types)
        return load_table(typed, spec.name, store, key=key)
    finally:
        store.discard(spark, as_text)


def path_of(source: str | Mapping[str, str], name: str) -> str:
    """Where the raw files of a table are."""
    return source[name] if isinstance(source, Mapping) else f"{source}/{name}.csv"


def load_all(
    spark: SparkSession,
    source: str | Mapping[str, str],
    store: Store,
    as_of: date | str | None = None,
    specs: Mapping[str, TableSpec] = STAGING,
    null_tokens: Sequence[str] = NULL_TOKENS,
    check_keys: bool = True,
) -> list[LoadResult]:
    """Load every raw table by its own recipe; the loads run side by side.

    ``source`` is a folder with ``<table>.csv`` files (or folders of CSV files),
    or a mapping from table to path. A dimension whose key repeats raises, since it
    would multiply the rows of the marts, and the old table stays; without
    ``check_keys`` it is loaded.
    """
    day = one_day(spark, as_of)

    def load(spec: TableSpec) -> LoadResult:
        raw = read_table_csv(spark, path_of(source, spec.name), multi_line=spec.multi_line)
        return load_raw(raw, spec, store, day, null_tokens, check_keys)

    return run_together(spark, [partial(load, spec) for spec in specs.values()])
