"""Mart: player performance by age, season, club and competition."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import age_at, per_unit
from touchline.operators import lookup

GROUP_KEYS = ("player_id", "player_age", "season", "playing_club_name", "competition_name")

TOTALS = {
    "total_goals": "goals",
    "total_assists": "assists",
    "total_minutes": "minutes_played",
    "total_yellow_cards": "yellow_cards",
    "total_red_cards": "red_cards",
}


def appearances_in_context(
    sources: Mapping[str, DataFrame], player_columns: Mapping[str, str]
) -> DataFrame:
    """Appearances with game date, season, club, competition and ``player_columns``.

    Appearances without a known game, player or competition are dropped; an
    unknown club stays, without a name. The games come first, so that only ids
    and measures are shuffled by game and the names are added after.
    """
    facts = sources["appearances"].select(
        F.col("player_id").alias("player_id"),
        F.col("game_id").alias("game_id"),
        F.col("player_club_id").alias("player_club_id"),
        F.col("competition_id").alias("competition_id"),
        *[F.col(measure).alias(measure) for measure in TOTALS.values()],
    )
    in_games = lookup(
        facts,
        sources["games"],
        "game_id",
        "game_id",
        {"game_date": "date", "season": "season"},
        "inner",
    )
    of_players = lookup(
        in_games, sources["players"], "player_id", "player_id", player_columns, "inner"
    )
    for_clubs = lookup(
        of_players, sources["clubs"], "player_club_id", "club_id", {"playing_club_name": "name"}
    )
    return lookup(
        for_clubs,
        sources["competitions"],
        "competition_id",
        "competition_id",
        {"competition_name": "name"},
        "inner",
    )


def player_performance(sources: Mapping[str, DataFrame], current_club: DataFrame) -> DataFrame:
    """Totals and per-game rates; a birthday within a season splits it.

    Clubs and competitions are grouped by name, so those that share one merge.
    Of the players only the birth date takes part in the grouping. The texts that
    describe a player (whose id is unique) join the few grouped rows.

    ``current_club`` is the current-club mart, best read back after it was written.
    """
    grouped = (
        appearances_in_context(sources, {"date_of_birth": "date_of_birth"})
        .withColumn("player_age", age_at("date_of_birth", "game_date"))
        .groupBy(*GROUP_KEYS)
        .agg(
            F.count_distinct("game_id").alias("games_played"),
            *[F.sum(measure).alias(total) for total, measure in TOTALS.items()],
        )
    )
    described = lookup(
        grouped,
        sources["players"],
        "player_id",
        "player_id",
        {"player_name": "name", "position": "position", "sub_position": "sub_position"},
        "inner",
    )
    with_club = lookup(
        described,
        current_club,
        "player_id",
        "player_id",
        {"current_club": "derived_current_club_name", "data_quality_note": "data_quality_note"},
    )
    contributions = F.col("total_goals") + F.col("total_assists")
    return with_club.select(
        "player_id",
        "player_name",
        "position",
        "sub_position",
        "player_age",
        "season",
        "playing_club_name",
        "competition_name",
        "games_played",
        *TOTALS,
        "current_club",
        "data_quality_note",
        per_unit("total_goals", "games_played").alias("goals_per_game"),
        per_unit("total_assists", "games_played").alias("assists_per_game"),
        per_unit("total_minutes", "games_played", 0).alias("avg_minutes_per_game"),
        per_unit("total_yellow_cards", "games_played").alias("yellow_cards_per_game"),
        per_unit("total_red_cards", "games_played").alias("red_cards_per_game"),
        per_unit(contributions, "games_played").alias("goal_contributions_per_game"),
    )
