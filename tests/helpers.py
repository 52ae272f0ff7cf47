"""Small domain tables for the tests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "appearances": "player_id bigint, game_id bigint, player_club_id bigint, "
    "competition_id bigint, date date, goals bigint, assists bigint, minutes_played bigint, "
    "yellow_cards bigint, red_cards bigint",
    "clubs": "club_id bigint, name string, domestic_competition_id bigint",
    "competitions": "competition_id bigint, name string, country_name string",
    "games": "game_id bigint, competition_id bigint, season bigint, date date, "
    "home_club_id bigint, away_club_id bigint, home_club_goals bigint, away_club_goals bigint, "
    "attendance bigint",
    "players": "player_id bigint, name string, current_club_id bigint, "
    "current_club_name string, position string, sub_position string, date_of_birth date, "
    "contract_expiration_date date, highest_market_value_in_eur double",
    "player_valuations": "player_id bigint, market_value_in_eur double, date date",
    "transfers": "player_id bigint, to_club_id bigint, to_club_name string, "
    "transfer_date date, transfer_fee double",
}


def columns(table: str) -> list[str]:
    return [field.split()[0] for field in SCHEMAS[table].split(", ")]


def tables(spark: SparkSession, **rows: Sequence[Sequence]) -> dict[str, DataFrame]:
    """All domain tables; those without rows are empty."""
    return {
        name: spark.createDataFrame([tuple(r) for r in rows.get(name, [])], schema)
        for name, schema in SCHEMAS.items()
    }


def day(text: str | None) -> date | None:
    return None if text is None else date.fromisoformat(text)


def player(
    player_id: int, club: int | None = 1, club_name: str | None = "One", born: str | None = None
):
    return (player_id, f"P{player_id}", club, club_name, "Attack", "Winger", day(born),
            day("2030-06-30"), 5.0)


def transfer(
    player_id: int, club: int, name: str, when: str | None, fee: float | None = 1.0
):
    return (player_id, club, name, day(when), fee)


def appearance(
    player_id: int,
    game: int,
    club: int,
    when: str | None,
    goals: int | None = 0,
    assists: int | None = 0,
    minutes: int = 90,
    competition: int = 1,
    yellow: int = 0,
    red: int = 0,
):
    return (player_id, game, club, competition, day(when), goals, assists, minutes, yellow, red)


def game(
    game_id: int,
    home: int,
    away: int,
    home_goals: int | None,
    away_goals: int | None,
    attendance: int | None = 100,
    season: int = 2020,
    when: str = "2020-09-01",
    competition: int = 1,
):
    return (game_id, competition, season, day(when), home, away, home_goals, away_goals,
            attendance)


def dicts(df: DataFrame) -> list[dict]:
    return [row.asDict() for row in df.collect()]
