"""Two-sided match aggregation: every match counts once for either side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def two_sided(
    matches: DataFrame,
    sides: Mapping[str, Mapping[str, str]],
    shared: Sequence[str],
    side_column: str = "game_type",
) -> DataFrame:
    """One row per match and side, from a single scan of ``matches``.

    ``sides`` maps a side's label to (new name -> column); ``shared`` columns are
    repeated for each side.
    """
    rows = [
        F.struct(
            F.lit(label).alias(side_column),
            *[F.col(source).alias(name) for name, source in columns.items()],
        )
        for label, columns in sides.items()
    ]
    return matches.select(*shared, F.inline(F.array(*rows)))


def results_per_side(
    rows: DataFrame,
    keys: Sequence[str],
    game: str = "game_id",
    scored: str = "goals_for",
    conceded: str = "goals_against",
    attendance: str = "attendance",
) -> DataFrame:
    """Games, results, goals and mean attendance per key; keep the side in ``keys``.

    A repeated match row counts once as a game, but again in results and goals. A
    match without a score counts as a game with no result. Spark shuffles by keys
    and game first, so a club with a third of all games spreads over the tasks.
    """
    ours, theirs = F.col(scored), F.col(conceded)
    return rows.groupBy(*keys).agg(
        F.count_distinct(game).alias("total_games"),
        F.count_if(ours > theirs).alias("wins"),
        F.count_if(ours == theirs).alias("draws"),
        F.count_if(ours < theirs).alias("losses"),
        F.sum(scored).alias("goals_for"),
        F.sum(conceded).alias("goals_against"),
        F.avg(attendance).alias("avg_attendance"),
    )


def season_totals(per_side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides together; attendance is the mean of the side means, not of games."""
    return per_side.groupBy(*keys).agg(
        F.sum("total_games").alias("total_games"),
        F.sum("wins").alias("total_wins"),
        F.sum("draws").alias("total_draws"),
        F.sum("losses").alias("total_losses"),
        F.sum("goals_for").alias("total_goals_for"),
        F.sum("goals_against").alias("total_goals_against"),
        F.avg("avg_attendance").alias("avg_attendance"),
    )
