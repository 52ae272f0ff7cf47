"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from registry.oracle import ORACLE
from registry.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", entry_points.SMOKE_DIR)
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, "" if v is None else str(v)) for v in row))


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = oracle.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    ours = ordered(tuple(r) for r in df.select(columns).collect())
    theirs = ordered(expected.select(*[f'"{c}"' for c in columns]).fetchall())
    assert ours == theirs


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 200
    assert len(df.columns) == 19


def test_output_order(spark):
    rows = entry_points.queries()["mart_team_performance"](spark, SF_DIR).collect()
    keys = [(r.club_name, -r.season) for r in rows]
    assert keys == sorted(keys)


def test_invariants(spark):
    queries = entry_points.queries()
    club = queries["mart_player_current_club"](spark, SF_DIR)
    kept = club.filter("club_data_source = 'Original Record'")
    assert kept.filter("possible_non_european_transfer").isEmpty()
    assert club.count() == club.select("player_id").distinct().count()
    team = queries["mart_team_performance"](spark, SF_DIR)
    assert team.filter("total_wins + total_draws + total_losses > total_games").isEmpty()
    assert team.filter("total_points <> 3 * total_wins + total_draws").isEmpty()
