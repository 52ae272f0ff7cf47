"""Mart: valuation profile of every player."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import age_at, as_of_column
from touchline.operators import attach_latest, lookup
from touchline.plans.newest import VALUATION_TIES, latest_transfers


def with_latest_values(
    players: DataFrame, sources: Mapping[str, DataFrame], nulls: str = "first"
) -> DataFrame:
    """Add the latest market value and the latest transfer fee, with their dates."""
    valued = attach_latest(
        players,
        sources["player_valuations"],
        "player_id",
        "date",
        {"current_market_value": "market_value_in_eur", "last_valuation_date": "date"},
        VALUATION_TIES,
        nulls,
    )
    return lookup(
        valued,
        latest_transfers(sources, nulls),
        "player_id",
        "player_id",
        {"last_transfer_fee": "transfer_fee", "last_transfer_date": "transfer_date"},
    )


def with_current_league(df: DataFrame, sources: Mapping[str, DataFrame], club_id: str) -> DataFrame:
    """Add the domestic league of a club and the country of that league."""
    of_club = lookup(
        df,
        sources["clubs"],
        club_id,
        "club_id",
        {"_domestic_competition_id": "domestic_competition_id"},
    )
    return lookup(
        of_club,
        sources["competitions"],
        "_domestic_competition_id",
        "competition_id",
        {"current_league": "name", "league_country": "country_name"},
    ).drop("_domestic_competition_id")


def player_valuation(
    sources: Mapping[str, DataFrame],
    current_club: DataFrame,
    as_of: date | str | None = None,
    nulls: str = "first",
) -> DataFrame:
    """One row per player: age, current club and league, market values, last fee."""
    players = sources["players"].select(
        F.col("player_id").alias("player_id"),
        F.col("name").alias("player_name"),
        F.col("position").alias("position"),
        F.col("sub_position").alias("sub_position"),
        age_at("date_of_birth", as_of_column(as_of)).alias("current_age"),
        F.col("contract_expiration_date").alias("contract_expiration_date"),
        F.col("highest_market_value_in_eur").alias("historical_highest_value"),
    )
    with_club = lookup(
        with_latest_values(players, sources, nulls),
        current_club,
        "player_id",
        "player_id",
        {
            "current_club": "derived_current_club_name",
            "club_data_source": "club_data_source",
            "potentially_outdated": "potentially_outdated",
            "data_quality_note": "data_quality_note",
            "_current_club_id": "derived_current_club_id",
        },
    )
    return with_current_league(with_club, sources, "_current_club_id").select(
        "player_id",
        "player_name",
        "position",
        "sub_position",
        "current_age",
        "current_club",
        "current_league",
        "league_country",
        "club_data_source",
        "potentially_outdated",
        "data_quality_note",
        "contract_expiration_date",
        "current_market_value",
        "last_valuation_date",
        "historical_highest_value",
        "last_transfer_fee",
        "last_transfer_date",
    )
