"""Reading raw CSV files, cleaning them and writing tables."""

from touchline.sources.cleaning import (
    clean,
    drop_future,
    infer_types,
    narrow_timestamps,
    normalise_columns,
    null_tokens_to_null,
    parse_dates,
    parse_numbers,
    select_by_position,
)
from touchline.sources.csv import read_table_csv
from touchline.sources.load import LoadResult, load_all, load_raw, load_table, path_of
from touchline.sources.store import CatalogStore, PathStore, Store, fingerprint_of_files
from touchline.sources.tables import STAGING, TableSpec

__all__ = [
    "CatalogStore",
    "LoadResult",
    "PathStore",
    "STAGING",
    "Store",
    "TableSpec",
    "clean",
    "drop_future",
    "fingerprint_of_files",
    "infer_types",
    "load_all",
    "load_raw",
    "load_table",
    "narrow_timestamps",
    "normalise_columns",
    "null_tokens_to_null",
    "parse_dates",
    "parse_numbers",
    "path_of",
    "read_table_csv",
    "select_by_position",
]
