"""DataFrame-to-DataFrame operators."""

from touchline.operators.checks import assert_unique, check_distinct_names
from touchline.operators.constraints import (
    Accepted,
    NotNull,
    References,
    Unique,
    Within,
    assert_rules,
    violations,
)
from touchline.operators.incremental import (
    distinct_counts,
    distinct_state,
    merge_distinct,
    merge_latest,
)
from touchline.operators.joins import lookup, star_join
from touchline.operators.latest import attach_latest, latest_per_key
from touchline.operators.matches import results_per_side, season_totals, two_sided
from touchline.operators.reconcile import Dated, reconcile_latest
from touchline.operators.snapshots import as_it_was, snapshot

__all__ = [
    "Accepted",
    "Dated",
    "NotNull",
    "References",
    "Unique",
    "Within",
    "as_it_was",
    "assert_rules",
    "assert_unique",
    "attach_latest",
    "check_distinct_names",
    "distinct_counts",
    "distinct_state",
    "latest_per_key",
    "lookup",
    "merge_distinct",
    "merge_latest",
    "reconcile_latest",
    "results_per_side",
    "season_totals",
    "snapshot",
    "star_join",
    "two_sided",
    "violations",
]
