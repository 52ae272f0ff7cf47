"""The newest transfer, appearance and valuation of every player.

Each list of tie breakers covers all columns that the marts read from the winning
row, so a tie cannot make a mart depend on the order in which rows arrive.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from touchline.operators import latest_per_key

TRANSFER_TIES = ("to_club_id", "to_club_name", "transfer_fee")
APPEARANCE_TIES = ("game_id", "player_club_id")
VALUATION_TIES = ("market_value_in_eur",)

# Names of the prepared tables, by how they rank a transfer without a date.
LATEST_TRANSFERS = {
    "first": "latest_transfers",
    "last": "latest_transfers_nulls_last",
}


def latest_transfers(sources: Mapping[str, DataFrame], nulls: str = "first") -> DataFrame:
    """The newest transfer of every player, which two marts read.

    A refresh writes it once and passes it on among the sources; otherwise it is
    derived from the transfers. A prepared table that ranks nulls the other way
    raises.
    """
    wanted = LATEST_TRANSFERS[nulls]
    if wanted in sources:
        return sources[wanted]
    if others := [name for name in LATEST_TRANSFERS.values() if name in sources]:
        raise ValueError(f"transfers are prepared as {others[0]}, but {wanted} is asked for")
    return latest_per_key(
        sources["transfers"].select(
            "player_id", "to_club_id", "to_club_name", "transfer_date", "transfer_fee"
        ),
        ["player_id"],
        "transfer_date",
        TRANSFER_TIES,
        nulls,
    )
