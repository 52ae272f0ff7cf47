"""Mart: the reconciled current club of every player."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.constants import FROM_APPEARANCE, FROM_RECORD, FROM_TRANSFER
from touchline.functions import (
    last_recorded,
    outside_dimension_flag,
    staleness_flag,
    staleness_note,
)
from touchline.operators import Dated, attach_latest, lookup, reconcile_latest, star_join
from touchline.plans.newest import APPEARANCE_TIES, latest_transfers


def with_latest_records(sources: Mapping[str, DataFrame], nulls: str = "first") -> DataFrame:
    """Players with their recorded club, latest transfer and latest appearance."""
    players = sources["players"].select(
        F.col("player_id").alias("player_id"),
        F.col("name").alias("player_name"),
        F.col("current_club_id").alias("recorded_current_club_id"),
        F.col("current_club_name").alias("recorded_current_club_name"),
    )
    with_transfer = lookup(
        players,
        latest_transfers(sources, nulls),
        "player_id",
        "player_id",
        {
            "latest_transfer_club_id": "to_club_id",
            "latest_transfer_club_name": "to_club_name",
            "latest_transfer_date": "transfer_date",
        },
    )
    return attach_latest(
        with_transfer,
        sources["appearances"],
        "player_id",
        "date",
        {"latest_appearance_club_id": "player_club_id", "latest_appearance_date": "date"},
        APPEARANCE_TIES,
        nulls,
    )


def reconcile_club(status: DataFrame) -> DataFrame:
    """Add the derived club id, its provenance, and a name if a record gives one.

    An appearance names no club. Its name is that of the derived club itself, so
    ``stated_club_name`` is null there and is filled when that club is looked up.
    """
    return reconcile_latest(
        status,
        [
            Dated(
                FROM_TRANSFER,
                "latest_transfer_date",
                {
                    "derived_current_club_id": "latest_transfer_club_id",
                    "stated_club_name": "latest_transfer_club_name",
                },
            ),
            Dated(
                FROM_APPEARANCE,
                "latest_appearance_date",
                {
                    "derived_current_club_id": "latest_appearance_club_id",
                    "stated_club_name": F.lit(None).cast("string"),
                },
            ),
        ],
        recorded={
            "derived_current_club_id": "recorded_current_club_id",
            "stated_club_name": "recorded_current_club_name",
        },
        recorded_label=FROM_RECORD,
        label_column="club_data_source",
    )


def player_current_club(
    sources: Mapping[str, DataFrame], as_of: date | str | None = None, nulls: str = "first"
) -> DataFrame:
    """One row per player: records, derived club, all club columns, quality notes.

    The club table is joined once: where an appearance wins, the club to be named
    and the derived club are the same. ``nulls`` tells whether a transfer or an
    appearance without a date counts as the latest.
    """
    reconciled = reconcile_club(with_latest_records(sources, nulls))
    clubs = sources["clubs"]
    joined = star_join(reconciled, clubs, F.col("derived_current_club_id") == clubs["club_id"])

    name = F.when(F.col("club_data_source") == FROM_APPEARANCE, clubs["name"]).otherwise(
        F.col("stated_club_name")
    )
    last_day = last_recorded("latest_transfer_date", "latest_appearance_date")
    stale = staleness_flag(last_day, as_of)
    return joined.select(
        "player_id",
        "player_name",
        "recorded_current_club_id",
        "recorded_current_club_name",
        "latest_transfer_club_id",
        "latest_transfer_club_name",
        "latest_transfer_date",
        "latest_appearance_club_id",
        "latest_appearance_date",
        "derived_current_club_id",
        name.alias("derived_current_club_name"),
        "club_data_source",
        last_day.alias("last_recorded_date"),
        stale.alias("potentially_outdated"),
        *[clubs[column] for column in clubs.columns],
        staleness_note(stale, last_day).alias("data_quality_note"),
        outside_dimension_flag(
            clubs["domestic_competition_id"],
            "derived_current_club_id",
            "recorded_current_club_id",
        ).alias("possible_non_european_transfer"),
    )
