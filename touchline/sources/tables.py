"""What is known about the raw tables, and how each is cleaned."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from touchline.constants import CLUBS_POSITIONS, COMPETITIONS_POSITIONS, GAMES_POSITIONS


@dataclass(frozen=True)
class TableSpec:
    """The cleaning recipe of one table; column names are upper case.

    ``types`` lists columns whose type is known; a load infers those of the others.
    ``positions`` are the ordinals to keep, all of them if None. Rows whose
    ``future_bound`` lies after the reference day are dropped. ``multi_line``
    allows quoted line breaks, at the price of one task per file; without it a
    line break inside a value is an error, never a wrong row. ``key`` names the
    columns that identify a row of a dimension.
    """

    name: str
    types: Mapping[str, str] = field(default_factory=dict)
    dates: Sequence[str] = ()
    positions: Sequence[int] | None = None
    future_bound: str | None = None
    multi_line: bool = False
    key: Sequence[str] = ()


def _typed(dtype: str, *columns: str) -> dict[str, str]:
    return dict.fromkeys(columns, dtype)


# Ids of competitions are texts or numbers, but alike in all tables that join on them.
# Tables are split freely; only two small dimensions may hold quoted line breaks.
STAGING = {
    spec.name: spec
    for spec in (
        TableSpec(
            "appearances",
            types={
                **_typed("string", "COMPETITION_ID"),
                **_typed(
                    "bigint", "PLAYER_ID", "GAME_ID", "PLAYER_CLUB_ID", "GOALS", "ASSISTS",
                    "MINUTES_PLAYED", "YELLOW_CARDS", "RED_CARDS",
                ),
            },
            dates=("DATE",),
        ),
        TableSpec(
            "clubs",
            types={
                **_typed("bigint", "CLUB_ID"),
                **_typed("string", "NAME", "DOMESTIC_COMPETITION_ID"),
            },
            positions=CLUBS_POSITIONS,
            multi_line=True,
            key=("CLUB_ID",),
        ),
        TableSpec("club_games"),
        TableSpec(
            "competitions",
            types=_typed("string", "COMPETITION_ID", "NAME", "COUNTRY_NAME"),
            positions=COMPETITIONS_POSITIONS,
            multi_line=True,
            key=("COMPETITION_ID",),
        ),
        TableSpec(
            "games",
            types={
                **_typed("string", "COMPETITION_ID"),
                **_typed(
                    "bigint", "GAME_ID", "SEASON", "HOME_CLUB_ID", "AWAY_CLUB_ID",
                    "HOME_CLUB_GOALS", "AWAY_CLUB_GOALS", "ATTENDANCE",
                ),
            },
            dates=("DATE",),
            positions=GAMES_POSITIONS,
            future_bound="DATE",
        ),
        TableSpec(
            "players",
            types={
                **_typed("bigint", "PLAYER_ID", "CURRENT_CLUB_ID"),
                **_typed("double", "HIGHEST_MARKET_VALUE_IN_EUR"),
                **_typed("string", "NAME", "CURRENT_CLUB_NAME", "POSITION", "SUB_POSITION"),
            },
            dates=("DATE_OF_BIRTH", "CONTRACT_EXPIRATION_DATE"),
            key=("PLAYER_ID",),
        ),
        TableSpec(
            "player_valuations",
            types={
                **_typed("bigint", "PLAYER_ID"),
                **_typed("double", "MARKET_VALUE_IN_EUR"),
            },
            dates=("DATE",),
        ),
        TableSpec(
            "transfers",
            types={
                **_typed("bigint", "PLAYER_ID", "TO_CLUB_ID"),
                **_typed("double", "TRANSFER_FEE"),
                **_typed("string", "TO_CLUB_NAME"),
            },
            dates=("TRANSFER_DATE",),
        ),
    )
}
