"""Mart: club results by competition and season."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.constants import AWAY, HOME
from touchline.functions import league_points, pct, per_unit
from touchline.operators import lookup, results_per_side, season_totals, two_sided

SEASON_KEYS = ("club_id", "club_name", "competition_name", "club_nationality", "season")

SIDES = {
    HOME: {
        "club_id": "home_club_id",
        "goals_for": "home_club_goals",
        "goals_against": "away_club_goals",
    },
    AWAY: {
        "club_id": "away_club_id",
        "goals_for": "away_club_goals",
        "goals_against": "home_club_goals",
    },
}


def games_by_side(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One row per game and side; games of unknown competitions are dropped."""
    games = sources["games"].select(
        F.col("game_id").alias("game_id"),
        F.col("season").alias("season"),
        "competition_id",
        "home_club_id",
        "away_club_id",
        "home_club_goals",
        "away_club_goals",
        F.col("attendance").alias("attendance"),
    )
    named = lookup(
        games,
        sources["competitions"],
        "competition_id",
        "competition_id",
        {"competition_name": "name"},
        "inner",
    )
    return two_sided(named, SIDES, ["game_id", "season", "competition_name", "attendance"])


def with_club(rows: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Add club name and nationality; rows of unknown clubs are dropped.

    A club's nationality is the country of its domestic competition, if known.
    """
    clubs = lookup(
        sources["clubs"],
        sources["competitions"],
        "domestic_competition_id",
        "competition_id",
        {"_country": "country_name"},
    )
    return lookup(
        rows,
        clubs,
        "club_id",
        "club_id",
        {"club_name": "name", "club_nationality": "_country"},
        "inner",
    )


def club_seasons_by_side(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Results of each club, competition name and season, home and away apart.

    The games are grouped by club id before the clubs are looked up: club ids are
    unique, so the result is the same, and no game is shuffled by its club.
    """
    keys = ["club_id", "competition_name", "season", "game_type"]
    return with_club(results_per_side(games_by_side(sources), keys), sources)


def team_performance(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Results, goals, attendance and points of each club, newest season first."""
    totals = season_totals(club_seasons_by_side(sources), SEASON_KEYS)
    points = league_points("total_wins", "total_draws")
    return totals.select(
        *SEASON_KEYS,
        "total_games",
        "total_wins",
        "total_draws",
        "total_losses",
        "total_goals_for",
        "total_goals_against",
        (F.col("total_goals_for") - F.col("total_goals_against")).alias("goal_difference"),
        F.round("avg_attendance", 0).alias("avg_attendance"),
        pct("total_wins", "total_games").alias("win_percentage"),
        pct("total_draws", "total_games").alias("draw_percentage"),
        pct("total_losses", "total_games").alias("loss_percentage"),
        per_unit("total_goals_for", "total_games").alias("avg_goals_scored_per_game"),
        per_unit("total_goals_against", "total_games").alias("avg_goals_conceded_per_game"),
        points.alias("total_points"),
        per_unit(points, "total_games").alias("points_per_game"),
    ).orderBy(F.asc_nulls_last("club_name"), F.desc_nulls_first("season"))
