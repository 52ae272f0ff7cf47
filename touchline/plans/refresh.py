"""The ordered job: refresh the staging tables, then build the marts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from touchline.constants import NULL_TOKENS
from touchline.functions.dates import one_day
from touchline.plans.current_club import player_current_club
from touchline.plans.ledger import Ledger, digest, recipe
from touchline.plans.newest import LATEST_TRANSFERS, latest_transfers
from touchline.plans.performance import player_performance
from touchline.plans.teams import team_performance
from touchline.plans.valuation import player_valuation
from touchline.sources.csv import read_table_csv
from touchline.sources.load import LoadResult, load_raw, load_table, path_of
from touchline.sources.store import Store, fingerprint_of_files
from touchline.sources.tables import STAGING, TableSpec
from touchline.together import run_together


@dataclass(frozen=True)
class RefreshResult:
    staging: list[LoadResult]
    marts: list[LoadResult]


def write_mart(
    df: DataFrame, name: str, store: Store, partition_by: Sequence[str] = ()
) -> LoadResult:
    """Create or replace a mart table from a query; column names must differ."""
    return load_table(df, name, store, "overwrite", partition_by)


def run_refresh(
    spark: SparkSession,
    source: str | Mapping[str, str],
    staging: Store,
    marts: Store,
    as_of: date | str | None = None,
    specs: Mapping[str, TableSpec] = STAGING,
    null_tokens: Sequence[str] = NULL_TOKENS,
    check_keys: bool = True,
    nulls: str = "first",
    resume: bool = False,
    attempts: int = 1,
) -> RefreshResult:
    """Load all tables, then write the four marts in order of dependency.

    Each table is replaced as a whole, so a run can be repeated after any
    failure. What two marts read, the newest transfers and the current clubs, is
    written once and read back. One reference day and one order of nulls hold
    for the whole run. A dimension with a repeated key raises before it replaces
    the old one.

    With ``resume``, steps that an earlier run has finished are left out, if the raw files,
    the reference day, the settings, the library's code and the tables they wrote and read are
    as they were; a ledger beside the staging tables tells. Of a run that failed only the rest
    is done. With more ``attempts`` a run that fails is resumed at once, that many times in all.
    """
    day = one_day(spark, as_of)
    settings = (specs, tuple(null_tokens), check_keys, nulls)
    for attempt in range(1, attempts + 1):
        ledger = Ledger(spark, staging) if resume or attempts > 1 else None
        try:
            return _refresh(spark, source, staging, marts, day, settings, ledger, resume or attempt > 1)
        except Exception:
            if attempt == attempts:
                raise
    raise ValueError("attempts must be 1 or more")


def _refresh(
    spark: SparkSession,
    source: str | Mapping[str, str],
    staging: Store,
    marts: Store,
    as_of: date,
    settings: tuple,
    ledger: Ledger | None,
    resume: bool,
) -> RefreshResult:
    specs, null_tokens, check_keys, nulls = settings
    newest = LATEST_TRANSFERS[nulls]
    known = ledger.open() if ledger else {}
    code = recipe() if ledger else ""
    versions: dict[str, str] = {}

    def step(name: str, store: Store, action: Callable[[], LoadResult], *inputs: object) -> LoadResult:
        """Run a step that depends on ``inputs``, or take it from the ledger."""
        if ledger is None:
            return action()
        fingerprint = digest(code, name, as_of, *inputs)
        result, versions[name] = ledger.run(known if resume else {}, name, fingerprint, store, action)
        return result

    def made(*names: str) -> list[str]:
        return [versions.get(name, "") for name in names]

    def load(spec: TableSpec) -> LoadResult:
        path = path_of(source, spec.name)

        def action() -> LoadResult:
            raw = read_table_csv(spark, path, multi_line=spec.multi_line)
            return load_raw(raw, spec, staging, as_of, null_tokens, check_keys)

        files = fingerprint_of_files(spark, path) if ledger else ""
        return step(spec.name, staging, action, path, files, spec, null_tokens, check_keys)

    loaded = run_together(spark, [partial(load, spec) for spec in specs.values()])
    tables = {name: staging.read(spark, name) for name in specs}

    def prepare_newest() -> LoadResult:
        return load_table(latest_transfers(tables, nulls), newest, staging)

    def mart(name: str, build: Callable[[], DataFrame], *inputs: str) -> Callable[[], LoadResult]:
        return lambda: step(name, marts, lambda: write_mart(build(), name, marts), nulls, *made(*inputs))

    ranked, teams = run_together(
        spark,
        [
            lambda: step(newest, staging, prepare_newest, nulls, *made("transfers")),
            mart("team_performance", lambda: team_performance(tables), "games", "clubs", "competitions"),
        ],
    )
    tables[newest] = staging.read(spark, newest)
    current = mart(
        "player_current_club", lambda: player_current_club(tables, as_of, nulls),
        "players", "appearances", "clubs", newest,
    )()
    club = marts.read(spark, "player_current_club")
    players = run_together(
        spark,
        [
            mart(
                "player_performance", lambda: player_performance(tables, club),
                "appearances", "games", "players", "clubs", "competitions", "player_current_club",
            ),
            mart(
                "player_valuation", lambda: player_valuation(tables, club, as_of, nulls),
                "players", "player_valuations", "clubs", "competitions", newest, "player_current_club",
            ),
        ],
    )
    return RefreshResult([*loaded, ranked], [current, teams, *players])
