"""The four marts and the full refresh."""

from touchline.plans.current_club import player_current_club
from touchline.plans.performance import player_performance
from touchline.plans.refresh import RefreshResult, run_refresh, write_mart
from touchline.plans.teams import team_performance
from touchline.plans.valuation import player_valuation

__all__ = [
    "RefreshResult",
    "player_current_club",
    "player_performance",
    "player_valuation",
    "run_refresh",
    "team_performance",
    "write_mart",
]
