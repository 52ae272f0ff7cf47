"""One Spark query per registered operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.adapter import AS_OF, Sources, given, write_raw_files
from touchline import functions as fn
from touchline import operators as op
from touchline import plans
from touchline import sources as src
from touchline.plans.current_club import reconcile_club, with_latest_records
from touchline.plans.performance import appearances_in_context
from touchline.plans.teams import SEASON_KEYS, SIDES, club_seasons_by_side, games_by_side, with_club
from touchline.plans.newest import TRANSFER_TIES
from touchline.plans.valuation import with_current_league, with_latest_values
from touchline.session import scratch_dir, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under the name of its function."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


# --- marts -------------------------------------------------------------------


@query
def mart_player_current_club(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.player_current_club(Sources(spark, sf_dir), AS_OF)


def written_current_club(spark: SparkSession, tables: Sources) -> DataFrame:
    """The current-club mart as a table, which the other marts read."""
    store = src.PathStore(scratch_dir(spark))
    src.load_table(plans.player_current_club(tables, AS_OF), "player_current_club", store)
    return store.read(spark, "player_current_club")


@query
def mart_player_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Sources(spark, sf_dir)
    return plans.player_performance(tables, written_current_club(spark, tables))


@query
def mart_player_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Sources(spark, sf_dir)
    return plans.player_valuation(tables, written_current_club(spark, tables), AS_OF)


@query
def mart_team_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.team_performance(Sources(spark, sf_dir))


# --- composite operators -----------------------------------------------------


@query
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    transfers = Sources(spark, sf_dir)["transfers"]
    return op.latest_per_key(transfers, ["player_id"], "transfer_date", TRANSFER_TIES)


@query
def latest_per_key_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    transfers = Sources(spark, sf_dir)["transfers"]
    return op.latest_per_key(transfers, ["player_id"], "transfer_date", TRANSFER_TIES, "last")


@query
def attach_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Sources(spark, sf_dir)
    return with_latest_values(tables["players"].select("player_id"), tables)


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_latest_records(Sources(spark, sf_dir))


@query
def reconcile_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_club(_status(spark, sf_dir)).select(
        "player_id", "derived_current_club_id", "stated_club_name", "club_data_source"
    )


@query
def last_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = fn.last_recorded("latest_transfer_date", "latest_appearance_date")
    return _status(spark, sf_dir).select("player_id", day.alias("last_recorded_date"))


@query
def staleness_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = fn.last_recorded("latest_transfer_date", "latest_appearance_date")
    stale = fn.staleness_flag(day, AS_OF)
    return _status(spark, sf_dir).select("player_id", stale.alias("potentially_outdated"))


@query
def staleness_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = fn.last_recorded("latest_transfer_date", "latest_appearance_date")
    note = fn.staleness_note(fn.staleness_flag(day, AS_OF), day)
    return _status(spark, sf_dir).select("player_id", note.alias("data_quality_note"))


@query
def outside_dimension_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    reconciled = reconcile_club(_status(spark, sf_dir))
    clubs = Sources(spark, sf_dir)["clubs"]
    looked_up = op.lookup(
        reconciled,
        clubs,
        "derived_current_club_id",
        "club_id",
        {"domestic_competition_id": "domestic_competition_id"},
    )
    outside = fn.outside_dimension_flag(
        "domestic_competition_id", "derived_current_club_id", "recorded_current_club_id"
    )
    return looked_up.select("player_id", "club_data_source", outside.alias("outside"))


@query
def age_at_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = fn.age_at("date_of_birth", "game_date").alias("player_age")
    return (
        appearances_in_context(Sources(spark, sf_dir), {"date_of_birth": "date_of_birth"})
        .groupBy(age)
        .agg(F.count(F.lit(1)).alias("appearances"), F.sum("goals").alias("total_goals"))
    )


@query
def age_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = fn.age_at("date_of_birth", fn.as_of_column(AS_OF))
    players = Sources(spark, sf_dir)["players"]
    return players.select("player_id", "date_of_birth", age.alias("current_age"))


@query
def per_unit_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = (
        appearances_in_context(Sources(spark, sf_dir), {"position": "position"})
        .groupBy("position", "season")
        .agg(
            F.count_distinct("game_id").alias("games_played"),
            F.sum("goals").alias("goals"),
            F.sum("assists").alias("assists"),
            F.sum("minutes_played").alias("minutes"),
        )
    )
    return totals.select(
        "position",
        "season",
        "games_played",
        fn.per_unit("goals", "games_played").alias("goals_per_game"),
        fn.per_unit("assists", "games_played").alias("assists_per_game"),
        fn.per_unit("minutes", "games_played", 0).alias("avg_minutes_per_game"),
        fn.per_unit(F.col("goals") + F.col("assists"), "games_played").alias(
            "goal_contributions_per_game"
        ),
        fn.per_unit("goals", F.col("games_played") - F.col("games_played")).alias("no_games"),
    )


@query
def two_sided_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return club_seasons_by_side(Sources(spark, sf_dir))


def _season_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.season_totals(two_sided_union(spark, sf_dir), SEASON_KEYS)


@query
def conditional_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = Sources(spark, sf_dir)["games"]
    rows = op.two_sided(games, SIDES, ["game_id", "season", "attendance"])
    keys = ["club_id", "season", "game_type"]
    return op.results_per_side(rows, keys).select(*keys, "wins", "draws", "losses")


@query
def outcome_percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _season_totals(spark, sf_dir).select(
        *SEASON_KEYS,
        fn.pct("total_wins", "total_games").alias("win_percentage"),
        fn.pct("total_draws", "total_games").alias("draw_percentage"),
        fn.pct("total_losses", "total_games").alias("loss_percentage"),
    )


@query
def league_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = fn.league_points("total_wins", "total_draws")
    return _season_totals(spark, sf_dir).select(
        *SEASON_KEYS,
        points.alias("total_points"),
        (F.col("total_goals_for") - F.col("total_goals_against")).alias("goal_difference"),
        fn.per_unit(points, "total_games").alias("points_per_game"),
        fn.per_unit("total_goals_for", "total_games").alias("scored_per_game"),
        fn.per_unit("total_goals_against", "total_games").alias("conceded_per_game"),
    )


# --- joins -------------------------------------------------------------------


@query
def left_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Sources(spark, sf_dir)
    facts = tables["appearances"].select("player_id", "game_id", "player_club_id")
    return op.lookup(facts, tables["clubs"], "player_club_id", "club_id", {"club_name": "name"})


@query
def join_derived_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clubs by a key that a CASE derives: the home club, or on a loss the away club."""
    tables = Sources(spark, sf_dir)
    winner = F.when(
        F.col("home_club_goals") < F.col("away_club_goals"), F.col("away_club_id")
    ).otherwise(F.col("home_club_id"))
    facts = tables["games"].select("game_id", "home_club_id", "away_club_id",
                                   "home_club_goals", "away_club_goals")
    return op.lookup(facts, tables["clubs"], winner, "club_id", {"unbeaten_club": "name"})


@query
def inner_fact_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Sources(spark, sf_dir)
    facts = tables["appearances"].select("player_id", "game_id", "goals", "minutes_played")
    return op.lookup(
        facts, tables["games"], "game_id", "game_id", {"day": "date", "season": "season"}, "inner"
    )


@query
def inner_dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Sources(spark, sf_dir)
    facts = tables["games"].select("game_id", "home_club_id", "competition_id")
    named = op.lookup(
        facts, tables["clubs"], "home_club_id", "club_id", {"club_name": "name"}, "inner"
    )
    return op.lookup(
        named,
        tables["competitions"],
        "competition_id",
        "competition_id",
        {"competition_name": "name"},
        "inner",
    )


@query
def role_playing_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Competitions in two roles: that of the game, and the home club's domestic one."""
    tables = Sources(spark, sf_dir)
    facts = tables["games"].select("game_id", "home_club_id", "competition_id")
    of_game = op.lookup(
        facts,
        tables["competitions"],
        "competition_id",
        "competition_id",
        {"competition_name": "name"},
        "inner",
    )
    with_club = op.lookup(
        of_game,
        tables["clubs"],
        "home_club_id",
        "club_id",
        {"domestic_competition_id": "domestic_competition_id"},
        "inner",
    )
    return op.lookup(
        with_club,
        tables["competitions"],
        "domestic_competition_id",
        "competition_id",
        {"club_nationality": "country_name"},
    )


@query
def two_hop_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Sources(spark, sf_dir)
    derived = reconcile_club(_status(spark, sf_dir)).select("player_id", "derived_current_club_id")
    return with_current_league(derived, tables, "derived_current_club_id")


# --- aggregates --------------------------------------------------------------


@query
def group_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        appearances_in_context(Sources(spark, sf_dir), {"position": "position"})
        .groupBy("position", "season", "playing_club_name")
        .agg(
            F.sum("goals").alias("total_goals"),
            F.sum("assists").alias("total_assists"),
            F.sum("minutes_played").alias("total_minutes"),
            F.sum("yellow_cards").alias("total_yellow_cards"),
            F.sum("red_cards").alias("total_red_cards"),
        )
    )


@query
def count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        appearances_in_context(Sources(spark, sf_dir), {"position": "position"})
        .groupBy("position", "season")
        .agg(
            F.count_distinct("game_id").alias("games_played"),
            F.count("game_id").alias("appearances"),
        )
    )


@query
def avg_of_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _season_totals(spark, sf_dir).select(
        *SEASON_KEYS, F.round("avg_attendance", 0).alias("avg_attendance")
    )


# --- projections, scalars, sort ----------------------------------------------


@query
def project_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names resolve in either case."""
    return Sources(spark, sf_dir)["players"].select(
        F.col("PLAYER_ID").alias("player_id"),
        F.col("Name").alias("player_name"),
        F.col("current_club_id").alias("recorded_current_club_id"),
        F.col("HIGHEST_MARKET_VALUE_IN_EUR").alias("historical_highest_value"),
    )


@query
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Sources(spark, sf_dir)
    transfers, clubs = tables["transfers"].alias("t"), tables["clubs"]
    joined = op.star_join(transfers, clubs, F.col("t.to_club_id") == clubs["club_id"])
    return joined.select("t.*", *clubs.columns, clubs["club_id"].isNull().alias("is_unknown"))


@query
def case_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, away = F.col("home_club_goals"), F.col("away_club_goals")
    return Sources(spark, sf_dir)["games"].select(
        "game_id",
        F.when(home > away, "Home").when(away > home, "Away").otherwise("Neither").alias("winner"),
        (home != away).alias("decided"),
    )


@query
def bool_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, away = F.col("home_club_goals"), F.col("away_club_goals")
    return Sources(spark, sf_dir)["games"].select(
        "game_id",
        fn.bool_flag(home > away).alias("home_win"),
        fn.bool_flag(home.isNull() | (home + away == 0)).alias("no_goals_known"),
    )


@query
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fn.date_parts("date_of_birth")
    return Sources(spark, sf_dir)["players"].select(
        "player_id", *[part.alias(f"birth_{name}") for name, part in parts.items()]
    )


@query
def sorted_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Sources(spark, sf_dir)
    return (
        with_club(games_by_side(tables), tables)
        .groupBy("club_name", "season")
        .agg(F.count_distinct("game_id").alias("total_games"))
        .orderBy(F.asc_nulls_last("club_name"), F.desc_nulls_first("season"))
    )


@query
def project_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.select_by_position(given(spark, sf_dir, "lineitem"), [0, 1, 2, 3, 5, 8])


@query
def drop_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events up to a midnight: the bound is compared with the time of day."""
    events = src.drop_future(given(spark, sf_dir, "events"), "ts", "2024-01-15")
    return events.select("event_id", "user_id", F.col("ts").cast("date").alias("day"))


@query
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written as text, with every 101st unreadable in the second column."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    texts = given(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.alias("strict_date"),
        F.when(F.col("o_orderkey") % 101 == 0, "unknown").otherwise(text).alias("lenient_date"),
    )
    strict = src.parse_dates(texts, ["strict_date"])
    return src.narrow_timestamps(src.parse_dates(strict, ["lenient_date"], strict=False))


@query
def narrow_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.narrow_timestamps(given(spark, sf_dir, "events"))


# --- load --------------------------------------------------------------------


@query
def load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appearances through a CSV file and back."""
    folder = f"{scratch_dir(spark)}/appearances.csv"
    appearances = Sources(spark, sf_dir)["appearances"]
    appearances.write.option("header", True).csv(folder)
    return src.clean(src.read_table_csv(spark, folder), src.STAGING["appearances"])


def as_rows(name: str, df: DataFrame) -> DataFrame:
    """All columns of a table as one text, by upper-case name: fractions with four
    decimals, dates and whole numbers as they are written, a null by name."""
    texts = []
    for column, dtype in sorted((c.upper(), t) for c, t in df.dtypes):
        value = F.col(column)
        if dtype == "double":
            value = value.cast("decimal(38,4)")
        texts.append(F.coalesce(value.cast("string"), F.lit("~null~")))
    return df.select(
        F.lit(name).alias("table_name"),
        F.lit(len(texts)).alias("columns"),
        F.concat_ws("|", *texts).alias("row_text"),
    )


@query
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables loaded twice over; every row and column of the staging tables."""
    scratch = scratch_dir(spark)
    raw = write_raw_files(spark, sf_dir, f"{scratch}/raw")
    staging = src.PathStore(f"{scratch}/staging")
    src.load_all(spark, raw, staging, AS_OF)
    src.load_all(spark, raw, staging, AS_OF)
    src.PathStore(scratch).discard(spark, "raw")
    tables = [as_rows(name, staging.read(spark, name)) for name in src.STAGING]
    return reduce(DataFrame.unionByName, tables)


@query
def empty_and_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers emptied and appended to, twice over."""
    store = src.PathStore(scratch_dir(spark))
    for _ in range(2):
        store.empty(spark, "transfers")
        src.load_table(Sources(spark, sf_dir)["transfers"], "transfers", store, mode="append")
    return store.read(spark, "transfers")


# Parts that the audited tables are written in, for each load.
PARTS = (3, 2)


@query
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the audits report of loads in a known number of parts: each domain table
    replaced in 3 parts, then appended to in 2."""
    store = src.PathStore(scratch_dir(spark))
    results = []
    for name, df in Sources(spark, sf_dir).items():
        for mode, parts in zip(("overwrite", "append"), PARTS, strict=True):
            audit = src.load_table(df, name, store, mode, parts=parts)
            results.append((audit.table, mode, audit.success, audit.chunks, audit.rows))
    return spark.createDataFrame(
        results,
        "table_name string, mode string, success boolean, chunks int, row_count bigint",
    )


@query
def refresh_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files to staging to marts; all rows of the four marts as they were written."""
    scratch = scratch_dir(spark)
    raw = write_raw_files(spark, sf_dir, f"{scratch}/raw")
    marts = src.PathStore(f"{scratch}/marts")
    written = plans.run_refresh(spark, raw, src.PathStore(f"{scratch}/staging"), marts, AS_OF)
    for used in ("raw", "staging"):
        src.PathStore(scratch).discard(spark, used)
    tables = [as_rows(load.table, marts.read(spark, load.table)) for load in written.marts]
    return reduce(DataFrame.unionByName, tables)


def awkward_text() -> Column:
    """Whole texts, some of them empty, a missing-value token, or with quotes and commas."""
    kind = F.col("doc_id") % 10
    quoted = F.concat(F.lit('"a", "b"\n,'), "text", F.lit('"'))
    return F.when(kind == 1, "NA").when(kind == 2, "").when(kind == 3, quoted).otherwise(F.col("text"))


@query
def csv_whole_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text through a CSV file with quoted line breaks, and back."""
    folder = f"{scratch_dir(spark)}/documents.csv"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.select("doc_id", awkward_text().alias("text")).write.option("header", True).option(
        "escape", '"'
    ).csv(folder)
    spec = src.TableSpec("documents", types={"DOC_ID": "bigint"}, multi_line=True)
    return src.clean(src.read_table_csv(spark, folder, multi_line=True), spec)


@query
def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clubs and club games as loaded: the types of columns that no recipe lists."""
    scratch = scratch_dir(spark)
    raw = write_raw_files(spark, sf_dir, f"{scratch}/raw")
    staging = src.PathStore(f"{scratch}/staging")
    specs = {name: src.STAGING[name] for name in ("clubs", "club_games")}
    src.load_all(spark, raw, staging, AS_OF, specs)
    src.PathStore(scratch).discard(spark, "raw")
    kinds = []
    for name in specs:
        loaded = staging.read(spark, name)
        types = F.array(*[F.lit(f"{c} {t}") for c, t in loaded.dtypes])
        kinds.append(
            loaded.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count", F.explode(types).alias("column_type")
            )
        )
    return reduce(DataFrame.unionByName, kinds)


# --- kept up to date ---------------------------------------------------------


class StoppedOnce(src.PathStore):
    """A store whose driver is lost, once, while it replaces the valuations."""

    def publish(self, spark: SparkSession, new: str, name: str) -> None:
        if name == "player_valuation" and not self.exists(spark, "stopped"):
            self.write(spark.range(1).toDF("id"), "stopped")
            raise RuntimeError("stopped on purpose")
        super().publish(spark, new, name)


@query
def refresh_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh that fails at its last mart and is resumed; all rows of the four marts."""
    scratch = scratch_dir(spark)
    raw = write_raw_files(spark, sf_dir, f"{scratch}/raw")
    staging, marts = src.PathStore(f"{scratch}/staging"), StoppedOnce(f"{scratch}/marts")
    written = plans.run_refresh(spark, raw, staging, marts, AS_OF, attempts=2)
    for used in ("raw", "staging"):
        src.PathStore(scratch).discard(spark, used)
    tables = [as_rows(load.table, marts.read(spark, load.table)) for load in written.marts]
    return reduce(DataFrame.unionByName, tables)


@query
def versions_behind_a_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers of a catalog table after it was replaced: what readers get now, and the
    version before, which readers that have started may still read."""
    database = f"touchline_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_dir(spark)}'")
    store, transfers = src.CatalogStore(database), Sources(spark, sf_dir)["transfers"]
    src.load_table(transfers.limit(0), "transfers", store)
    src.load_table(transfers.filter("player_id % 2 = 0"), "transfers", store)
    src.load_table(transfers, "transfers", store)
    _, before = store.versions(spark, "transfers")
    now, old = store.read(spark, "transfers"), store.read(spark, before)
    return now.withColumn("version", F.lit("now")).unionByName(old.withColumn("version", F.lit("before")))


@query
def loads_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers appended in three loads, two of which are repeated after a first try."""
    store, transfers = src.PathStore(scratch_dir(spark)), Sources(spark, sf_dir)["transfers"]

    def load(i: int, rows: DataFrame) -> None:
        src.load_table(rows, "transfers", store, "append", load_id=f"load-{i}")

    part = F.pmod("player_id", F.lit(3))
    for i in (0, 1):
        load(i, transfers.filter((part == i) & (F.col("transfer_fee") > 20_000)))
    for i in (2, 1, 0, 0):
        load(i, transfers.filter(part == i))
    return store.read(spark, "transfers")


def batches(df: DataFrame, by: Column, n: int) -> list[DataFrame]:
    """All rows, dealt to ``n`` batches."""
    return [df.filter(F.pmod(by, F.lit(n)) == i) for i in range(n)]


@query
def latest_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest transfer of every player, from four batches merged one after the other."""
    transfers = Sources(spark, sf_dir)["transfers"]
    store, order = src.PathStore(scratch_dir(spark)), ("transfer_date", TRANSFER_TIES)
    first, *rest = batches(transfers, F.xxhash64("to_club_id", "transfer_fee"), 4)
    src.load_table(op.latest_per_key(first, ["player_id"], *order), "newest", store)
    for batch in rest:
        merged = op.merge_latest(store.read(spark, "newest"), batch, ["player_id"], *order)
        src.load_table(merged, "newest", store)
    return store.read(spark, "newest")


@query
def distinct_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct games by position and season, from the bitmaps of three batches by day."""
    keys = ["position", "season"]
    facts = appearances_in_context(Sources(spark, sf_dir), {"position": "position"})
    store = src.PathStore(scratch_dir(spark))
    first, *rest = batches(facts, F.unix_date("game_date").cast("bigint"), 3)
    src.load_table(op.distinct_state(first, keys, "game_id"), "games", store)
    for batch in rest:
        merged = op.merge_distinct(store.read(spark, "games"), op.distinct_state(batch, keys, "game_id"), keys)
        src.load_table(merged, "games", store)
    return op.distinct_counts(store.read(spark, "games"), keys, "games_played")


# Days of the snapshots; the second one is taken twice.
SNAPSHOT_DAYS = ("1998-12-31", "2000-03-31", "2000-03-31", AS_OF)


@query
def current_club_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current-club mart over three reference days, as intervals of unchanged rows."""
    tables, store = Sources(spark, sf_dir), src.PathStore(scratch_dir(spark))
    history = None
    for day in SNAPSHOT_DAYS:
        mart = plans.player_current_club(tables, day)
        src.load_table(op.snapshot(history, mart, ["player_id"], day), "history", store)
        history = store.read(spark, "history")
    return history.select(
        "player_id", "derived_current_club_id", "last_recorded_date", "potentially_outdated",
        "data_quality_note", "valid_from", "valid_to",
    )


DATA_RULES = {
    "players": [
        op.Unique(["player_id"]), op.NotNull("date_of_birth"), op.NotNull("current_club_id"),
        op.References("current_club_id", "clubs", "club_id"),
    ],
    "clubs": [
        op.Unique(["club_id"]), op.Within("club_id", low=0), op.NotNull("domestic_competition_id"),
        op.References("domestic_competition_id", "competitions", "competition_id"),
    ],
    "competitions": [op.Unique(["competition_id"]), op.NotNull("name")],
    "games": [
        op.Unique(["game_id"]), op.NotNull("home_club_goals"), op.Accepted("home_club_goals", [0, 1, 2, 3]),
        op.Within("attendance", 0, 200_000), op.References("home_club_id", "clubs", "club_id"),
    ],
    "appearances": [
        op.Accepted("goals", [0, 1, 2]), op.Within("minutes_played", 1, 45),
        op.Unique(["player_id", "game_id"]), op.References("game_id", "games", "game_id"),
        op.References("player_id", "players", "player_id"),
    ],
    "transfers": [
        op.NotNull("transfer_date"), op.Within("transfer_fee", high=100_000.0),
        op.References("player_id", "players", "player_id"),
    ],
    "player_valuations": [op.NotNull("date"), op.Within("market_value_in_eur", low=1000.0)],
    "club_games": [op.References("game_id", "games", "game_id")],
}


@query
def data_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of each rule over all domain tables."""
    return op.violations(Sources(spark, sf_dir), DATA_RULES)
