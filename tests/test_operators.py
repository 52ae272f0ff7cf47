from __future__ import annotations

import pytest
from helpers import day, dicts
from pyspark.sql import functions as F

from touchline.operators import (
    Dated,
    assert_unique,
    attach_latest,
    latest_per_key,
    lookup,
    reconcile_latest,
    star_join,
)
from touchline.operators.matches import results_per_side, season_totals, two_sided


@pytest.fixture
def history(spark):
    rows = [
        (1, day("2020-01-01"), "a"),
        (1, day("2021-01-01"), "c"),
        (1, day("2021-01-01"), "b"),
        (2, None, "null"),
        (2, day("2021-01-01"), "dated"),
        (3, None, "only"),
    ]
    return spark.createDataFrame(rows, "k int, d date, v string")


@pytest.mark.parametrize(
    ("nulls", "expected"),
    [
        ("first", {1: "b", 2: "null", 3: "only"}),
        ("last", {1: "b", 2: "dated", 3: "only"}),
    ],
)
@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_latest_per_key(history, nulls, expected, partitions):
    newest = latest_per_key(history.repartition(partitions), ["k"], "d", ["v"], nulls)
    assert newest.columns == history.columns
    assert {r.k: r.v for r in newest.collect()} == expected


def test_latest_per_key_wants_ties_and_a_null_rule(history):
    with pytest.raises(ValueError, match="tie_breakers"):
        latest_per_key(history, ["k"], "d", [])
    with pytest.raises(ValueError, match="nulls"):
        latest_per_key(history, ["k"], "d", ["v"], "middle")


def test_attach_latest_keeps_keys_without_history(spark, history):
    keys = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    rows = attach_latest(keys, history, "k", "d", {"value": "v"}, ["v"]).collect()
    assert {(r.k, r.value) for r in rows} == {(1, "b"), (9, None), (None, None)}


def test_lookup_in_two_roles_and_by_expression(spark):
    facts = spark.createDataFrame([(1, 2), (3, None)], "home int, away int")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "id int, name string")
    both = lookup(lookup(facts, dim, "home", "id", {"h": "name"}), dim, "away", "id", {"a": "name"})
    assert {tuple(r) for r in both.collect()} == {(1, 2, "one", "two"), (3, None, None, None)}
    key = F.coalesce("away", F.lit(1))
    derived = lookup(facts, dim, key, "id", {"name": "name"}, "inner")
    assert {r.name for r in derived.collect()} == {"two", "one"}


def test_joins_reject_equal_names(spark):
    left = spark.createDataFrame([(1, "x")], "id int, name string")
    right = spark.createDataFrame([(1, "y")], "key int, NAME string")
    with pytest.raises(ValueError, match="name"):
        star_join(left, right, left["id"] == right["key"])
    with pytest.raises(ValueError, match="name"):
        lookup(left, right, "id", "key", {"Name": "NAME"})


def test_assert_unique(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    assert assert_unique(df, ["a", "b"]) is df
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(df, ["a"])


@pytest.mark.parametrize(
    ("dates", "winner"),
    [
        (("2001-05-01", "2001-04-01", "2001-03-01"), "a"),
        (("2001-04-01", "2001-05-01", "2001-03-01"), "b"),
        (("2001-04-01", "2001-03-01", "2001-05-01"), "c"),
        (("2001-05-01", "2001-05-01", "2001-03-01"), "recorded"),
        (("2001-05-01", None, "2001-03-01"), "recorded"),
        ((None, None, None), "recorded"),
    ],
)
def test_reconcile_any_number_of_observations(spark, dates, winner):
    df = spark.createDataFrame([tuple(day(d) for d in dates)], "da date, db date, dc date")
    observations = [Dated(x, f"d{x}", {"v": F.lit(x)}) for x in "abc"]
    chosen = reconcile_latest(df, observations, {"v": F.lit("recorded")}, "recorded", "source")
    assert tuple(chosen.first()[-2:]) == (winner, winner)


def test_two_sided_results(spark):
    matches = spark.createDataFrame(
        [(1, 10, 20, 2, 1, 10), (1, 10, 20, 2, 1, 10), (2, 20, 10, None, 1, 20)],
        "game_id int, h int, a int, hg int, ag int, attendance int",
    )
    sides = {
        "Home": {"club": "h", "goals_for": "hg", "goals_against": "ag"},
        "Away": {"club": "a", "goals_for": "ag", "goals_against": "hg"},
    }
    rows = two_sided(matches, sides, ["game_id", "attendance"])
    assert rows.count() == 6
    results = {(r["club"], r["game_type"]): r for r in dicts(results_per_side(rows, ["club", "game_type"]))}
    repeated = results[10, "Home"]
    assert (repeated["total_games"], repeated["wins"], repeated["goals_for"]) == (1, 2, 4)
    unknown = results[20, "Home"]
    assert (unknown["total_games"], unknown["wins"], unknown["draws"], unknown["losses"]) == (1, 0, 0, 0)
    assert (unknown["goals_for"], unknown["goals_against"]) == (None, 1)


def test_attendance_is_the_mean_of_side_means(spark):
    rows = spark.createDataFrame(
        [(i, "Home", 10, 1, 0) for i in range(3)] + [(9, "Away", 20, 1, 0)],
        "game_id int, side string, attendance int, goals_for int, goals_against int",
    )
    per_side = results_per_side(rows.withColumn("club", F.lit(1)), ["club", "side"])
    assert season_totals(per_side, ["club"]).first().avg_attendance == 15.0
