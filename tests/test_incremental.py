"""Merged states, histories and rules against plain versions."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from touchline import operators as op

COLUMNS = "k int, day date, a int, b string"


def random_rows(rng, n):
    days = [None, *(date(2020, 1, d) for d in range(1, 6))]
    return [
        (rng.choice([None, 1, 2, 3, 4, 5]), rng.choice(days), rng.choice([None, 1, 2]), rng.choice([None, "x", "y"]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("nulls", ["first", "last"])
@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_any_split_into_batches_gives_the_newest_rows(spark, nulls, parts):
    rng = random.Random(parts)
    rows = random_rows(rng, 200)
    dealt = [[] for _ in range(parts)]
    for row in rows:
        dealt[rng.randrange(parts)].append(row)
    order = (["k"], "day", ["a", "b"], nulls)
    state = op.latest_per_key(spark.createDataFrame([], COLUMNS), *order)
    for at, batch in enumerate(dealt):
        # Columns of a batch in another order, and more of them.
        df = spark.createDataFrame(batch, COLUMNS).select("b", "a", "day", "k", F.lit(1).alias("more"))
        state = op.merge_latest(state, df, *order)
        if at % 5 == 4:
            state = spark.createDataFrame(state.collect(), COLUMNS)
    whole = op.latest_per_key(spark.createDataFrame(rows, COLUMNS), *order)
    assert sorted(map(str, state.collect())) == sorted(map(str, whole.collect()))


    for row in whole.collect():
        mine = [r for r in rows if r[0] == row.k]
        dates = [r[1] for r in mine]
        if nulls == "first" and None in dates:
            assert row.day is None
        else:
            assert row.day == max((d for d in dates if d), default=None)


def test_rows_merged_twice_change_nothing(spark):
    rows = spark.createDataFrame(random_rows(random.Random(9), 60), COLUMNS)
    order = (["k"], "day", ["a", "b"])
    state = op.latest_per_key(rows, *order)
    assert sorted(map(str, op.merge_latest(state, rows, *order).collect())) == sorted(map(str, state.collect()))


def test_bitmaps_of_overlapping_batches_count_exactly(spark):
    rng = random.Random(4)
    pool = [None, 0, 1, -1, -32768, -32769, 32767, 32768, 32769, 65536, 10**12, -(10**12), *range(100, 160)]
    rows = [(rng.choice(["a", "b", None]), rng.choice(pool)) for _ in range(600)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, id long").repartition(3)
    parts = [op.distinct_state(spark.createDataFrame(rows[i : i + 250], "g string, id long"), ["g"], "id") for i in (0, 200, 400)]
    state = op.merge_distinct(op.merge_distinct(parts[0], parts[1], ["g"]), parts[2], ["g"])
    found = {(r.g, r.n) for r in op.distinct_counts(state, ["g"], "n").collect()}
    assert found == {(r.g, r.n) for r in df.groupBy("g").agg(F.count_distinct("id").alias("n")).collect()}
    assert ("none", 0) in found
    assert op.distinct_counts(op.distinct_state(df.limit(0), ["g"], "id"), ["g"], "n").isEmpty()


# --- snapshots ---------------------------------------------------------------


def replayed(days):
    """Intervals of (key, value) from whole tables by day."""
    out, held = [], {}
    for day, rows in days:
        for key in [k for k in held if rows.get(k, "gone") != held[k][0] or k not in rows]:
            value, start = held.pop(key)
            out.append((key, value, start, day))
        for key, value in rows.items():
            held.setdefault(key, (value, day))
    return sorted([*out, *[(k, v, s, None) for k, (v, s) in held.items()]], key=str)


def taken(spark, days):
    history = None
    for day, rows in days:
        current = spark.createDataFrame(list(rows.items()), "k int, v string").withColumn("z", F.lit(None).cast("int"))
        history = op.snapshot(history, current, ["k"], day)
        history = spark.createDataFrame(history.collect(), history.schema)
    return history


def intervals(history):
    return sorted(((r.k, r.v, r.valid_from, r.valid_to) for r in history.collect()), key=str)


def test_histories_match_a_replay(spark):
    rng = random.Random(6)
    days = []
    for d in range(1, 9):
        rows = {k: rng.choice(["x", "", None, "y"]) for k in range(12) if rng.random() < 0.8}
        days.append((date(2024, 1, d), rows))
    history = taken(spark, days)
    assert intervals(history) == replayed(days)
    for day, rows in days:
        held = op.as_it_was(history, day)
        assert held.columns == ["k", "v", "z"]
        assert {r.k: r.v for r in held.collect()} == rows


def test_a_repeated_day_adds_nothing_and_replaces_what_it_had_begun(spark):
    first, second = (date(2024, 1, 1), {1: "a", 2: "b"}), (date(2024, 1, 5), {1: "a", 2: "c"})
    once = taken(spark, [first, second])
    assert intervals(taken(spark, [first, second, second, second])) == intervals(once)
    mended = taken(spark, [first, second, (date(2024, 1, 5), {1: "d", 2: "b"})])
    assert intervals(op.as_it_was(mended, "2024-01-05").withColumns({"valid_from": F.lit(0), "valid_to": F.lit(0)})) == [
        (1, "d", 0, 0), (2, "b", 0, 0),
    ]
    assert not [x for x in intervals(mended) if x[2] == x[3]]


def test_days_must_not_go_back(spark):
    with pytest.raises(Exception, match="after 2024-01-01"):
        taken(spark, [(date(2024, 1, 5), {1: "a"}), (date(2024, 1, 1), {1: "b"})])


# --- rules -------------------------------------------------------------------


def test_rules_count_the_rows_that_break_them(spark):
    tables = {
        "t": spark.createDataFrame(
            [(1, "a", 5.0), (1, "b", None), (None, "z", -1.0), (None, None, 11.0), (2, "a", 10.0), (2, "a", 0.0)],
            "id int, kind string, x double",
        ),
        "u": spark.createDataFrame([("a",), ("a",), (None,)], "kind string"),
        "none": spark.createDataFrame([], "id int"),
    }
    rules = {
        "t": [
            op.NotNull("id"), op.Accepted("kind", ["a", "b"]), op.Within("x", 0, 10), op.Within("x", low=0),
            op.Unique(["id"]), op.Unique(["id", "kind"]), op.References("kind", "u", "kind"),
        ],
        "none": [op.NotNull("id"), op.Unique(["id"]), op.References("id", "t", "id")],
    }
    found = {(r.table_name, r.rule): r.violations for r in op.violations(tables, rules).collect()}
    assert found == {
        ("t", "id is not null"): 2, ("t", "kind is one of a, b"): 1,
        ("t", "x is at least 0 and at most 10"): 2, ("t", "x is at least 0"): 1,
        ("t", "id is unique"): 2, ("t", "id, kind is unique"): 1, ("t", "kind is in u.kind"): 2,
        ("none", "id is not null"): 0, ("none", "id is unique"): 0, ("none", "id is in t.id"): 0,
    }
    with pytest.raises(ValueError, match=r"t: id is not null \(2 rows\)"):
        op.assert_rules(tables, rules)
    op.assert_rules(tables, {"none": rules["none"]})


def test_rules_of_rows_take_one_pass(spark):
    df = spark.range(10).selectExpr("id", "id % 2 AS x")
    plan = op.violations({"t": df}, {"t": [op.NotNull("id"), op.Within("x", 0, 1), op.Accepted("x", [0, 1])]})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Range (") == 1
