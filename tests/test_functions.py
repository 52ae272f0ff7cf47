from __future__ import annotations

from datetime import date, timedelta
from fractions import Fraction
from random import Random

import pytest
from helpers import day
from pyspark.sql import functions as F

from touchline import functions as fn


def test_age_around_birthdays(spark):
    cases = [
        ("2000-05-10", "2020-05-09", 19),
        ("2000-05-10", "2020-05-10", 20),
        ("2000-05-10", "2020-05-11", 20),
        ("2000-02-29", "2023-02-28", 22),
        ("2000-02-29", "2023-03-01", 23),
        ("2000-02-29", "2024-02-29", 24),
        ("2000-05-10", "1999-12-31", -1),
        ("2000-05-10", "1999-01-01", -2),
        (None, "2020-05-10", None),
        ("2000-05-10", None, None),
    ]
    df = spark.createDataFrame([(day(b), day(a), e) for b, a, e in cases], "b date, a date, e int")
    for row in df.select("b", "a", "e", fn.age_at("b", "a").alias("age")).collect():
        assert row.age == row.e, row


def test_age_matches_plain_python(spark):
    random = Random(7)
    start = date(1950, 1, 1)
    pairs = [
        (start + timedelta(random.randrange(30000)), start + timedelta(random.randrange(30000)))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(pairs, "b date, a date")
    for row in df.select("b", "a", fn.age_at("b", "a").alias("age")).collect():
        reached = (row.a.month, row.a.day) >= (row.b.month, row.b.day)
        assert row.age == row.a.year - row.b.year - (0 if reached else 1)


def test_last_recorded(spark):
    rows = [
        (day("2001-05-01"), day("2001-04-01"), day("2001-05-01")),
        (None, day("2001-04-01"), day("2001-04-01")),
        (None, None, day("1900-01-01")),
        (day("1850-01-01"), day("1860-01-01"), day("1860-01-01")),
        (day("1850-01-01"), None, day("1900-01-01")),
    ]
    df = spark.createDataFrame(rows, "a date, b date, e date")
    for row in df.select("a", "b", "e", fn.last_recorded("a", "b").alias("x")).collect():
        assert row.x == row.e, row


@pytest.mark.parametrize(
    ("when", "as_of", "stale"),
    [
        ("2000-12-30", "2001-06-30", False),
        ("2000-12-29", "2001-06-30", True),
        ("2024-02-29", "2024-08-31", False),
        ("2024-02-28", "2024-08-31", True),
        ("2030-01-01", "2024-08-31", False),
        (None, "2024-08-31", False),
    ],
)
def test_staleness_is_strict_and_clamps_to_month_end(spark, when, as_of, stale):
    df = spark.createDataFrame([(day(when),)], "d date")
    assert df.select(fn.staleness_flag("d", as_of)).first()[0] is stale


def test_as_of_defaults_to_today(spark):
    row = spark.range(1).select(fn.as_of_column(), F.current_date()).first()
    assert row[0] == row[1]


def test_staleness_note(spark):
    df = spark.createDataFrame([(True, day("1900-01-01")), (False, day("2001-01-02"))], "s boolean, d date")
    notes = [r[0] for r in df.select(fn.staleness_note("s", "d")).collect()]
    assert notes == [
        "Warning: No recent data available. Last record from 1900-01-01",
        "Data recent and reliable",
    ]


@pytest.mark.parametrize(
    ("attribute", "derived", "recorded", "outside"),
    [
        (None, 2, 1, True),
        (None, 1, 1, False),
        (5, 2, 1, False),
        (None, 2, None, False),
        (None, None, 1, False),
    ],
)
def test_outside_dimension_flag(spark, attribute, derived, recorded, outside):
    df = spark.createDataFrame([(attribute, derived, recorded)], "a int, d int, r int")
    assert df.select(fn.outside_dimension_flag("a", "d", "r")).first()[0] is outside


def test_rates_round_half_up_and_guard_the_denominator(spark):
    rows = [(5, 0, None), (23, 40, 0.58), (None, 3, None), (1, None, None), (2, 3, 0.67)]
    df = spark.createDataFrame(rows, "n bigint, d bigint, e double")
    for row in df.select("*", fn.per_unit("n", "d").alias("rate")).collect():
        assert row.rate == row.e, row


def test_rate_of_a_sum_with_a_null_is_null(spark):
    df = spark.createDataFrame([(None, 2, 4)], "goals bigint, assists bigint, games bigint")
    assert df.select(fn.per_unit(F.col("goals") + F.col("assists"), "games")).first()[0] is None


def test_rates_equal_exact_fractions(spark):
    limit = 400
    pairs = spark.range(limit).selectExpr("id AS a").crossJoin(
        spark.range(1, limit).selectExpr("id AS b")
    )
    for row in pairs.select("a", "b", fn.per_unit("a", "b").alias("rate")).toLocalIterator():
        exact = int(Fraction(row.a, row.b) * 100 + Fraction(1, 2))
        assert row.rate == exact / 100, row


def test_large_counts_keep_all_digits(spark):
    df = spark.createDataFrame([(16777217, 1)], "n bigint, d bigint")
    assert df.select(fn.per_unit("n", "d", 0)).first()[0] == 16777217.0


def test_percentages_and_points(spark):
    df = spark.createDataFrame([(1, 3, 2), (0, 0, 0)], "w bigint, g bigint, d bigint")
    rows = df.select(fn.pct("w", "g"), fn.league_points("w", "d")).collect()
    assert [tuple(r) for r in rows] == [(33.33, 5), (None, 0)]


def test_bool_flag_counts_unknown_as_false(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (None, 1)], "a int, b int")
    assert [r[0] for r in df.select(fn.bool_flag(F.col("a") < F.col("b"))).collect()] == [
        True, False, False,
    ]
