"""Domain tables derived from the given order and line-item tables.

Every given row has a place. So that every branch of the marts is met, some keys
are changed to ones that no other table has (negative ids), or are null: no club
ends in 7, there is no competition 24, every eleventh player has no recorded club,
every fiftieth no birth date, and some players neither transfers nor appearances.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.together import run_together

AS_OF = "2001-06-30"

# The given tables, so that no job has to look into their files first.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _whole(column: str) -> Column:
    return F.floor(column).cast("bigint")


def _club_name(key: str | Column) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("Supplier#"), F.lpad(key.cast("string"), 9, "0"))


def _moved(condition: Column, key: Column) -> Column:
    """The key, or where the condition holds one that no table refers to."""
    return F.when(condition, -key).otherwise(key)


def clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return given(spark, sf_dir, "supplier").select(
        _moved(key % 10 == 7, key).alias("club_id"),
        F.col("s_name").alias("name"),
        _unless(key % 10 == 9, F.col("s_nationkey").cast("bigint")).alias(
            "domestic_competition_id"
        ),
    )


def competitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations; the country is named after the region's number, so no join is needed."""
    key = F.col("n_nationkey").cast("bigint")
    return given(spark, sf_dir, "nation").select(
        _moved(key == 24, key).alias("competition_id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("Country "), F.col("n_regionkey").cast("string")).alias("country_name"),
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    birth = F.date_add(F.lit("1960-02-29").cast("date"), (key * 37 % 9000).cast("int"))
    return given(spark, sf_dir, "part").select(
        key.alias("player_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("position"),
        F.col("p_brand").alias("sub_position"),
        _unless(key % 50 == 0, birth).alias("date_of_birth"),
        _unless(key % 11 == 0, key % 10).alias("current_club_id"),
        _club_name(key % 10).alias("current_club_name"),
        F.lit("2002-06-30").cast("date").alias("contract_expiration_date"),
        F.col("p_retailprice").alias("highest_market_value_in_eur"),
    )


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of status F; the others are valuations, and in part appearances."""
    player = F.col("l_partkey")
    return (
        given(spark, sf_dir, "lineitem")
        .filter("l_linestatus = 'F'")
        .select(
            _moved(player % 20 == 1, player).alias("player_id"),
            F.col("l_suppkey").alias("to_club_id"),
            _club_name("l_suppkey").alias("to_club_name"),
            _unless(F.col("l_orderkey") % 400 == 0, F.col("l_shipdate").cast("date")).alias(
                "transfer_date"
            ),
            F.col("l_extendedprice").alias("transfer_fee"),
        )
    )


def appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    player = F.col("l_partkey")
    return (
        given(spark, sf_dir, "lineitem")
        .filter("l_returnflag <> 'R' AND l_linestatus = 'O'")
        .select(
            _moved(player % 20 == 2, player).alias("player_id"),
            F.col("l_orderkey").alias("game_id"),
            F.col("l_suppkey").alias("player_club_id"),
            (F.col("l_orderkey") % 25).alias("competition_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            (F.col("l_linenumber") % 3).cast("bigint").alias("goals"),
            (_whole("l_quantity") % 2).alias("assists"),
            _whole("l_quantity").alias("minutes_played"),
            F.when(F.col("l_returnflag") == "A", 1).otherwise(0).cast("bigint").alias(
                "yellow_cards"
            ),
            F.when(F.col("l_returnflag") == "N", 1).otherwise(0).cast("bigint").alias("red_cards"),
        )
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as games, without those after the reference day."""
    return all_games(spark, sf_dir).filter(F.col("date") <= F.lit(AS_OF).cast("date"))


def all_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    return given(spark, sf_dir, "orders").select(
        key.alias("game_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.year("o_orderdate").cast("bigint").alias("season"),
        (key % 25).alias("competition_id"),
        (key % 10).alias("home_club_id"),
        (customer % 10).alias("away_club_id"),
        _unless(key % 97 == 0, key * 7 % 5).alias("home_club_goals"),
        (customer * 3 % 4).alias("away_club_goals"),
        _whole("o_totalprice").alias("attendance"),
    )


def player_valuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        given(spark, sf_dir, "lineitem")
        .filter("l_linestatus = 'O'")
        .select(
            F.col("l_partkey").alias("player_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_extendedprice").alias("market_value_in_eur"),
        )
    )


def club_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-column table; it is loaded, but no mart reads it."""
    return all_games(spark, sf_dir).select("game_id", F.col("home_club_id").alias("club_id"))


TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "appearances": appearances,
    "clubs": clubs,
    "club_games": club_games,
    "competitions": competitions,
    "games": games,
    "players": players,
    "player_valuations": player_valuations,
    "transfers": transfers,
}


class Sources(Mapping[str, DataFrame]):
    """The domain tables by name, each derived when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._sf_dir = spark, sf_dir
        self._derived: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._derived:
            self._derived[name] = TABLES[name](self._spark, self._sf_dir)
        return self._derived[name]

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


def filler(i: int, key: str) -> Column:
    """Column ``i`` of a raw file that no mart names: whole numbers, fractions, or text
    with the marks that CSV has to quote, by its place; some values are missing."""
    key = F.col(key)
    value = (
        (key * i).cast("string"),
        (key + 0.25 * i).cast("decimal(20,2)").cast("string"),
        F.concat(F.lit(f'x{i}, "q" '), key.cast("string")),
    )[i % 3]
    return F.when(key % 13 != 5, value).alias(f"filler_{i}")


def _padded(df: DataFrame, width: int, kept_after: dict[int, str]) -> DataFrame:
    """Spread the columns over a raw file of ``width`` columns with fillers."""
    return df.select(
        *[
            F.col(kept_after[i]) if i in kept_after else filler(i, kept_after[0])
            for i in range(width)
        ]
    )


def _kick_off() -> Column:
    """A game's day with a time: midnight itself on the reference day, else a second
    before or after midnight, or the afternoon. Days stay as they are."""
    times = F.element_at(
        F.array(*map(F.lit, ("00:00:00", "00:00:01", "15:30:00", "23:59:59"))),
        (F.col("game_id") % 4 + 1).cast("int"),
    )
    on_the_day = F.col("date") == F.lit(AS_OF).cast("date")
    return F.concat_ws(" ", "date", F.when(on_the_day, "00:00:00").otherwise(times))


def raw_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The domain tables as raw files have them: more columns, and future games."""
    frames = dict(Sources(spark, sf_dir))
    frames["games"] = _padded(
        all_games(spark, sf_dir).withColumn("date", _kick_off()),
        23,
        {
            0: "game_id", 1: "competition_id", 2: "season", 4: "date", 5: "home_club_id",
            6: "away_club_id", 7: "home_club_goals", 8: "away_club_goals", 15: "attendance",
        },
    )
    frames["clubs"] = _padded(
        frames["clubs"], 17, {0: "club_id", 2: "name", 3: "domestic_competition_id"}
    )
    frames["competitions"] = _padded(
        frames["competitions"], 11, {0: "competition_id", 2: "name", 8: "country_name"}
    )
    return frames


def write_raw_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Write the raw files as CSV with a header and return the folder."""

    def write(name: str, df: DataFrame) -> None:
        df.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}.csv")

    run_together(spark, [partial(write, *item) for item in raw_files(spark, sf_dir).items()])
    return folder
