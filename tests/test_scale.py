"""Plans and results under the conditions of large or skewed tables."""

from __future__ import annotations

import re
from contextlib import redirect_stdout
from io import StringIO

import pytest
from helpers import tables

import __spark_entry__ as entry_points
from registry import adapter
from registry.queries import QUERIES
from touchline import plans
from touchline.operators import latest_per_key
from touchline.sources import select_by_position

SF_DIR = entry_points.SMOKE_DIR
MARTS = sorted(name for name in QUERIES if name.startswith("mart_"))


def plan_of(df) -> str:
    text = StringIO()
    with redirect_stdout(text):
        df.explain()
    return text.getvalue()


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_one_row_per_key_and_task_reaches_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 1)], "k int, d int, v int")
    plan = plan_of(latest_per_key(df, ["k"], "d", ["v"]))
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "Final" in above
    assert "WindowGroupLimit" in below and "Partial" in below


@pytest.mark.parametrize("name", MARTS)
def test_plans_stay_in_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def hinted(df) -> bool:
    return "Hint" in df._jdf.queryExecution().analyzed().toString()


def test_the_library_hints_no_join(spark, hot):
    current = plans.player_current_club(hot, "2001-06-30")
    for df in (
        current,
        plans.player_performance(hot, current),
        plans.player_valuation(hot, current, "2001-06-30"),
        plans.team_performance(hot),
    ):
        assert not hinted(df)


@pytest.mark.parametrize("name", sorted(adapter.TABLES))
def test_domain_tables_need_no_join_and_no_job(spark, name):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"plan {name}", "")
    df = adapter.TABLES[name](spark, SF_DIR)
    assert not hinted(df) and "Join" not in plan_of(df)
    assert not jobs.getJobIdsForGroup(f"plan {name}")


def test_every_line_item_has_a_place(spark):
    tables = adapter.Sources(spark, SF_DIR)
    items = adapter.given(spark, SF_DIR, "lineitem")
    assert tables["transfers"].count() + tables["player_valuations"].count() == items.count()
    cards = items.filter("l_linestatus = 'O' AND l_returnflag <> 'R'")
    assert tables["appearances"].count() == cards.count()
    for name, given in (("clubs", "supplier"), ("competitions", "nation"), ("players", "part")):
        assert tables[name].count() == adapter.given(spark, SF_DIR, given).count()


def test_rates_scan_the_orders_once(spark):
    plan = plan_of(QUERIES["per_unit_rates"](spark, SF_DIR))
    assert plan.count("/orders.parquet") == 1


@pytest.mark.parametrize(
    ("name", "ranked"), [("mart_player_performance", 0), ("mart_player_valuation", 2)]
)
def test_marts_read_the_written_current_club(spark, name, ranked):
    """What is ranked are transfers and valuations, never appearances."""
    df = QUERIES[name](spark, SF_DIR)
    assert any("player_current_club" in file for file in df.inputFiles())
    assert plan_of(df).count("Window [row_number()") == ranked


def test_games_are_scanned_once_for_both_sides(spark):
    plan = plan_of(QUERIES["two_sided_union"](spark, SF_DIR))
    assert plan.count("/orders.parquet") == 1


def test_columns_and_filters_reach_the_scan(spark):
    df = select_by_position(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"), [0, 3])
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan_of(df.filter("l_linenumber = 1")))
    assert schema.group(1) == "l_orderkey:bigint,l_linenumber:int"
    plan = plan_of(QUERIES["mart_player_valuation"](spark, SF_DIR))
    assert "EqualTo(l_linestatus,O)" in plan
    assert "l_comment" not in plan and "l_tax" not in plan


@pytest.mark.parametrize("name", MARTS)
def test_marts_do_not_depend_on_broadcasts(spark, conf, name):
    with_broadcast = rows_of(QUERIES[name](spark, SF_DIR))
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__optimizer__disableHints="true",
    )
    without = QUERIES[name](spark, SF_DIR)
    assert rows_of(without) == with_broadcast
    assert "Broadcast" not in plan_of(without)


@pytest.fixture
def hot(spark):
    """One player, club, competition and game hold a third or more of the rows."""

    def some(hot_value, other):
        return f"IF(id % 3 = 0, {hot_value}, {other})"

    data = tables(spark)
    count = 60000
    ids = spark.range(0, count, 1, 16)
    data["games"] = spark.range(0, 3000, 1, 8).selectExpr(
        "id AS game_id", f"{some(1, 'id % 7')} AS competition_id", "2000 + id % 3 AS season",
        "date_add(date'2000-01-01', CAST(id % 400 AS INT)) AS date",
        f"{some(1, 'id % 50')} AS home_club_id", "(id + 1) % 50 AS away_club_id",
        "id % 4 AS home_club_goals", "id % 3 AS away_club_goals", "id AS attendance",
    )
    data["appearances"] = ids.selectExpr(
        f"{some(5, 'id % 997')} AS player_id", f"{some(7, 'id % 3000')} AS game_id",
        f"{some(1, 'id % 50')} AS player_club_id", f"{some(1, 'id % 7')} AS competition_id",
        "date_add(date'2000-01-01', CAST(id % 400 AS INT)) AS date", "id % 2 AS goals",
        "id % 3 AS assists", "id % 90 AS minutes_played", "id % 2 AS yellow_cards",
        "id % 5 AS red_cards",
    )
    data["transfers"] = ids.selectExpr(
        f"{some(5, 'id % 997')} AS player_id", "id % 50 AS to_club_id",
        "concat('C', id % 50) AS to_club_name",
        "date_add(date'2000-01-01', CAST(id % 500 AS INT)) AS transfer_date",
        "double(id) AS transfer_fee",
    )
    data["players"] = spark.range(997).selectExpr(
        "id AS player_id", "concat('P', id) AS name", "id % 50 AS current_club_id",
        "concat('C', id % 50) AS current_club_name", "'A' AS position", "'B' AS sub_position",
        "date_add(date'1975-01-01', CAST(id AS INT)) AS date_of_birth",
        "date'2030-06-30' AS contract_expiration_date", "1.0D AS highest_market_value_in_eur",
    )
    data["clubs"] = spark.range(45).selectExpr(
        "id AS club_id", "concat('C', id) AS name", "id % 9 AS domestic_competition_id"
    )
    data["competitions"] = spark.range(6).selectExpr(
        "id AS competition_id", "concat('K', id) AS name", "concat('L', id) AS country_name"
    )
    return data


SHUFFLED_AND_SKEWED = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__shuffle__partitions": "16",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "32k",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "48k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


def test_hot_keys_are_split_in_shuffled_joins(spark, conf, hot):
    expected = rows_of(plans.player_performance(hot, plans.player_current_club(hot, "2001-06-30")))
    conf(**SHUFFLED_AND_SKEWED)
    shuffled = plans.player_performance(hot, plans.player_current_club(hot, "2001-06-30"))
    assert rows_of(shuffled) == expected
    assert "skew=true" in plan_of(shuffled)


def test_a_hot_game_is_split_though_the_grouping_could_use_its_partitions(spark, conf, hot):
    expected = rows_of(plans.player_performance(hot, plans.player_current_club(hot, "2001-06-30")))
    conf(**{**SHUFFLED_AND_SKEWED, "spark__sql__autoBroadcastJoinThreshold": "30000"})
    mixed = plans.player_performance(hot, plans.player_current_club(hot, "2001-06-30"))
    assert rows_of(mixed) == expected
    final = plan_of(mixed).split("Initial Plan")[0]
    assert "BroadcastHashJoin [competition_id" in final
    assert re.search(r"SortMergeJoin\(skew=true\) \[game_id", final)


def test_a_hot_club_does_not_reach_the_join_with_its_games(spark, conf, hot):
    expected = rows_of(plans.team_performance(hot))
    conf(**SHUFFLED_AND_SKEWED)
    shuffled = plans.team_performance(hot)
    assert rows_of(shuffled) == expected
    # Below the join with the clubs, the games are grouped before it reads them.
    below = plan_of(shuffled).split("SortMergeJoin [club_id", 1)[1]
    assert re.search("HashAggregate|Generate", below).group() == "HashAggregate"


def test_a_hot_player_in_every_latest_record(spark, conf, hot):
    conf(**SHUFFLED_AND_SKEWED)
    newest = latest_per_key(hot["transfers"], ["player_id"], "transfer_date", ["transfer_fee"])
    hottest = newest.filter("player_id = 5").first()
    best = hot["transfers"].filter("player_id = 5").agg({"transfer_date": "max"}).first()[0]
    assert hottest.transfer_date == best
    assert newest.count() == 997


def test_a_refresh_ranks_the_transfers_once(spark, hot, tmp_path):
    from touchline.plans.newest import LATEST_TRANSFERS, latest_transfers

    newest = LATEST_TRANSFERS["first"]
    from touchline.sources import PathStore, load_table

    store = PathStore(str(tmp_path))
    alone = plans.player_current_club(hot, "2001-06-30")
    ranked_alone = plan_of(alone).count("Window [row_number()")
    load_table(latest_transfers(hot), newest, store)
    shared = {**hot, newest: store.read(spark, newest)}
    current = plans.player_current_club(shared, "2001-06-30")
    assert ranked_alone == 2
    assert plan_of(current).count("Window [row_number()") == 1
    assert rows_of(current) == rows_of(alone)
    valuation = plans.player_valuation(shared, current, "2001-06-30")
    expected = plans.player_valuation(hot, alone, "2001-06-30")
    assert rows_of(valuation) == rows_of(expected)


def test_players_without_a_club_are_a_hot_key(spark, conf, hot):
    """A third of the players, and more, derive no club: null is the hot key of a join."""
    hot["players"] = hot["players"].selectExpr(
        "*", "IF(player_id % 3 > 0, NULL, current_club_id) AS club"
    ).drop("current_club_id").withColumnRenamed("club", "current_club_id")
    hot["transfers"] = hot["transfers"].filter("player_id % 3 = 0")
    hot["appearances"] = hot["appearances"].filter("player_id % 3 = 0")
    current = plans.player_current_club(hot, "2001-06-30")
    assert current.filter("derived_current_club_id IS NULL").count() == 664
    expected = rows_of(plans.player_valuation(hot, current, "2001-06-30"))
    conf(**SHUFFLED_AND_SKEWED)
    shuffled = plans.player_valuation(hot, plans.player_current_club(hot, "2001-06-30"), "2001-06-30")
    assert rows_of(shuffled) == expected
