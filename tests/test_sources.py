from __future__ import annotations

from datetime import datetime

import pytest
from helpers import day, dicts
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from touchline import sources as src
from touchline.functions.dates import one_day
from touchline.plans import run_refresh
from touchline.plans.newest import LATEST_TRANSFERS, latest_transfers
from touchline.session import scratch_dir
from touchline.sources import cleaning

AS_OF = "2001-06-30"
FAILURES = (PySparkException, Py4JJavaError)


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,name\n1,"a ""q"" b"\n2,"two\nlines"\n3,"x, y"\n')
    rows = src.read_table_csv(spark, path, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", 'a "q" b'), ("2", "two\nlines"), ("3", "x, y")]


@pytest.mark.parametrize(
    "text",
    [
        'id,name,x\n1,"two\nlines",2\n',
        'id,name\n1,"last\nvalue"\n',
        "id,name\n1\n",
        "id,name\n1,a,b\n",
    ],
)
def test_rows_that_do_not_fit_raise(spark, tmp_path, text):
    path = write(tmp_path / "a.csv", text)
    with pytest.raises(FAILURES):
        src.read_table_csv(spark, path).collect()
    with pytest.raises(FAILURES):
        src.read_table_csv(spark, path).select("id").collect()


def test_csv_with_a_schema_checks_the_header(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,day\n7,2001-02-03\n")
    row = src.read_table_csv(spark, path, "id bigint, day date").first()
    assert tuple(row) == (7, day("2001-02-03"))
    with pytest.raises(FAILURES):
        src.read_table_csv(spark, path, "day date, id bigint").collect()


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA", 1), ("", 2), ("Nadia", 3), (None, 4)], "name string, n int")
    names = [r.name for r in src.null_tokens_to_null(df).collect()]
    assert names == [None, None, "Nadia", None]
    assert [r.name for r in src.null_tokens_to_null(df, ()).collect()][0] == "NA"


def test_dates_strict_and_lenient(spark):
    df = spark.createDataFrame([("2001-02-03",), ("2001-02-03 04:05:06",), (None,)], "d string")
    parsed = [r.d for r in src.parse_dates(df, ["d"]).collect()]
    assert parsed == [datetime(2001, 2, 3), datetime(2001, 2, 3, 4, 5, 6), None]
    bad = spark.createDataFrame([("garbage",)], "d string")
    assert src.parse_dates(bad, ["d"], strict=False).first().d is None
    with pytest.raises(FAILURES, match="garbage"):
        src.parse_dates(bad, ["d"]).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strictness_does_not_depend_on_the_session(spark, conf, ansi):
    conf(spark__sql__ansi__enabled=ansi)
    spec = src.TableSpec("t", types={"N": "bigint", "X": "double"}, dates=("D",))
    good = spark.createDataFrame([("12.0", "1.5", "2001-01-01"), ("", "NA", None)], "n string, x string, d string")
    assert [tuple(r) for r in src.clean(good, spec).collect()] == [
        (12, 1.5, day("2001-01-01")), (None, None, None),
    ]
    for row in [("12.5", "1", "2001-01-01"), ("x", "1", "2001-01-01"), ("1", "x", "2001-01-01"),
                ("1", "1", "2001-13-01")]:
        with pytest.raises(FAILURES):
            src.clean(spark.createDataFrame([row], "n string, x string, d string"), spec).collect()


def test_drop_future_compares_before_narrowing(spark):
    times = ["2001-06-30 00:00:00", "2001-06-30 15:00:00", "2001-07-01 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "d string")
    kept = src.narrow_timestamps(src.drop_future(src.parse_dates(df, ["d"]), "d", AS_OF))
    assert [r.d for r in kept.collect()] == [day("2001-06-30")]


def test_narrow_finds_both_kinds_of_timestamp(spark):
    df = spark.sql(
        "SELECT 1 AS n, timestamp'2001-02-03 04:05:06' AS a, "
        "timestamp_ntz'2001-02-03 04:05:06' AS b, date'2001-02-03' AS c, '2001-02-03 04' AS d"
    )
    assert [t for _, t in src.narrow_timestamps(df).dtypes] == ["int", "date", "date", "date", "string"]


def test_positions_and_upper_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert src.select_by_position(src.normalise_columns(df), [0, 2]).columns == ["A", "C"]


def wide(width, columns, rows):
    """CSV text of ``width`` columns with the named ones at their positions."""
    header = [columns.get(i, f"extra_{i}") for i in range(width)]
    lines = [[str(row.get(name, f"x{i}")) for i, name in enumerate(header)] for row in rows]
    return "\n".join(",".join(line) for line in [header, *lines]) + "\n"


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    files = {
        "appearances": "appearance_id,player_id,game_id,player_club_id,competition_id,date,goals,"
        "assists,minutes_played,yellow_cards,red_cards\n"
        "1_1,1,1,1,L1,2001-05-01,1,0,90,0,0\n1_2,1,2,1,L1,2001-06-20,1,2,80,1,0\n"
        "1_3,1,3,1,L1,2001-07-20,9,9,90,0,0\n",
        "clubs": wide(
            17,
            {0: "club_id", 2: "name", 3: "domestic_competition_id"},
            [
                {"club_id": 1, "name": '"FC ""One"", Town"', "domestic_competition_id": "L1"},
                {"club_id": 2, "name": '"Two\nLines"', "domestic_competition_id": ""},
            ],
        ),
        "club_games": "game_id,club_id\n1,1\n2,1\n",
        "competitions": wide(
            11,
            {0: "competition_id", 2: "name", 8: "country_name"},
            [{"competition_id": "L1", "name": "League", "country_name": "Somewhere"}],
        ),
        "games": wide(
            23,
            {0: "game_id", 1: "competition_id", 2: "season", 4: "date", 5: "home_club_id",
             6: "away_club_id", 7: "home_club_goals", 8: "away_club_goals", 15: "attendance"},
            [
                {"game_id": i, "competition_id": "L1", "season": 2000, "date": when,
                 "home_club_id": 1, "away_club_id": 2, "home_club_goals": 2,
                 "away_club_goals": "", "attendance": "1000.0"}
                for i, when in ((1, "2001-05-01"), (2, "2001-06-30"), (3, "2001-07-20"))
            ],
        ),
        "players": "player_id,name,current_club_id,current_club_name,position,sub_position,"
        "date_of_birth,contract_expiration_date,highest_market_value_in_eur\n"
        "1,NA,1.0,One,Attack,,1980-07-25,,1500000.5\n",
        "player_valuations": "player_id,date,market_value_in_eur\n1,2001-01-01,5\n",
        "transfers": "player_id,to_club_id,to_club_name,transfer_date,transfer_fee\n"
        "1,2,Two,2002-01-01,\n",
    }
    for name, text in files.items():
        write(folder / f"{name}.csv", text)
    return str(folder)


def test_load_all_is_repeatable(spark, tmp_path, raw):
    store = src.PathStore(str(tmp_path / "staging"))
    first = src.load_all(spark, raw, store, AS_OF, check_keys=True)
    again = src.load_all(spark, raw, store, AS_OF)
    assert first == again
    assert {r.table: r.rows for r in first} == {
        "appearances": 3, "clubs": 2, "club_games": 2, "competitions": 1, "games": 2,
        "players": 1, "player_valuations": 1, "transfers": 1,
    }
    assert all(r.success and r.chunks >= 1 for r in first)
    assert str(first[0]).startswith("appearances: success True")
    assert len(store.read(spark, "clubs").columns) == 13
    assert len(store.read(spark, "competitions").columns) == 10
    assert len(store.read(spark, "games").columns) == 19
    names = {r.CLUB_ID: r.NAME for r in store.read(spark, "clubs").collect()}
    assert names == {1: 'FC "One", Town', 2: "Two\nLines"}
    player = store.read(spark, "players").first()
    assert (player.NAME, player.CURRENT_CLUB_ID) == (None, 1)
    assert player.DATE_OF_BIRTH == day("1980-07-25")


def test_load_keeps_null_tokens_as_text_if_told_so(spark, tmp_path, raw):
    store = src.PathStore(str(tmp_path / "staging"))
    specs = {"players": src.STAGING["players"]}
    src.load_all(spark, raw, store, AS_OF, specs, null_tokens=("",))
    assert store.read(spark, "players").first().NAME == "NA"


def test_repeated_keys_raise_by_default_and_keep_the_old_table(spark, tmp_path, raw):
    doubled = write(tmp_path / "c.csv", wide(15, {0: "club_id"}, [{"club_id": 1}] * 2))
    specs = {"clubs": src.STAGING["clubs"]}
    store = src.PathStore(str(tmp_path / "staging"))
    src.load_all(spark, raw, store, specs=specs)
    with pytest.raises(ValueError, match="not unique"):
        src.load_all(spark, {"clubs": doubled}, store, specs=specs)
    assert sorted(r.CLUB_ID for r in store.read(spark, "clubs").collect()) == [1, 2]
    src.load_all(spark, {"clubs": doubled}, store, specs=specs, check_keys=False)
    assert store.read(spark, "clubs").count() == 2
    paths = {name: f"{raw}/{name}.csv" for name in src.STAGING} | {"clubs": doubled}
    with pytest.raises(ValueError, match="not unique"):
        run_refresh(spark, paths, store, src.PathStore(str(tmp_path / "marts")), AS_OF)


def test_types_of_unlisted_columns_follow_from_all_rows(spark):
    df = spark.createDataFrame(
        [("1", "1", "1", None, "12345678901234567890", "1d"),
         ("-2", "2.5", "x", None, "1", "2"),
         (None, "1e3", "3", None, "2", "3")],
        "whole string, number string, word string, none string, huge string, odd string",
    )
    found = src.infer_types(df, df.columns)
    assert found == {"whole": "bigint", "number": "double"}
    typed = src.parse_numbers(df, found)
    assert [tuple(r)[:2] for r in typed.collect()] == [(1, 1.0), (-2, 2.5), (None, 1000.0)]
    assert src.infer_types(df.limit(0), df.columns) == {}


def test_only_texts_like_whole_numbers_are_cast_to_find_a_kind(spark):
    """A cast that fails raises and catches an error for each value."""
    texts = [
        None, "", " ", "-", "+", "+-1", "1", "-1", "+1", " 12\t", "1\n", "\n1\n\n", "\x01 12", "12\x7f", "1 2", "007",
        "9223372036854775807", "9223372036854775808", "-9223372036854775808", "9" * 30, "1.", ".5", "1.0", "-2.50",
        "1e5", "1E-3", "1e999", ".", "e5", "1.2.3", "nan", "Infinity", "1f", "1d", "0x10", "x1", "2001-01-02", "\u0661",
        "\u00a01", "1L", "12.0 ", "\x1f1.5",
    ]
    text = F.col("t")
    by_casts = (
        F.when(text.isNull(), None)
        .when(text.try_cast("bigint").isNotNull(), 0)
        .when(text.rlike(cleaning.WHOLE) | ~text.rlike(cleaning.NUMBER), 2)
        .when(text.try_cast("double").isNotNull(), 1)
        .otherwise(2)
    )
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", cleaning.kind(text).alias("kind"), by_casts.alias("wanted")).collect():
        assert row.kind == row.wanted, repr(row.t)
    plan = df.select(cleaning.kind(text).alias("kind"))._jdf.queryExecution().analyzed().toString()
    assert plan.index("RLIKE") < plan.lower().index("try_cast")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", ["2024-13-01", "31.08.2024", ""])
def test_a_bad_reference_day_raises(spark, conf, ansi, bad):
    conf(spark__sql__ansi__enabled=ansi)
    df = spark.sql("SELECT date'2024-01-01' AS d")
    with pytest.raises(ValueError):
        src.drop_future(df, "d", bad)
    with pytest.raises(ValueError):
        one_day(spark, bad)


def test_the_reference_day_is_one_value(spark):
    assert one_day(spark, "2024-08-31") == one_day(spark, day("2024-08-31")) == day("2024-08-31")
    assert one_day(spark, datetime(2024, 8, 31, 15)) == day("2024-08-31")
    assert one_day(spark) == spark.sql("SELECT current_date()").first()[0]


@pytest.fixture(params=["path", "catalog"])
def store(request, spark, tmp_path):
    if request.param == "path":
        yield src.PathStore(str(tmp_path / "tables"))
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS staging")
        yield src.CatalogStore("staging")
        spark.sql("DROP DATABASE staging CASCADE")


def test_stores_overwrite_append_and_empty(spark, store):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert src.load_table(df, "t", store).rows == 2
    assert src.load_table(df, "t", store).rows == 2
    assert store.read(spark, "t").count() == 2
    src.load_table(df, "t", store, mode="append")
    assert store.read(spark, "t").count() == 4
    store.empty(spark, "t", "absent")
    assert store.read(spark, "t").count() == 0
    assert store.read(spark, "t").columns == ["id", "name"]


def test_audits_count_their_own_write(spark, store):
    df = spark.range(1000).toDF("id")
    first = src.load_table(df.repartition(3), "t", store)
    assert (first.success, first.chunks, first.rows) == (True, 3, 1000)
    more = src.load_table(df.repartition(2), "t", store, mode="append")
    assert (more.success, more.chunks, more.rows) == (True, 2, 1000)
    again = src.load_table(df.repartition(4), "t", store)
    assert (again.success, again.chunks, again.rows) == (True, 4, 1000)
    assert store.read(spark, "t").count() == 1000
    fresh = src.load_table(df.repartition(2), "u", store, mode="append")
    assert (fresh.success, fresh.chunks, fresh.rows) == (True, 2, 1000)
    nothing = src.load_table(df.limit(0), "u", store)
    assert (nothing.success, nothing.rows) == (True, 0)
    with pytest.raises(ValueError, match="neither"):
        src.load_table(df, "t", store, mode="ignore")


def test_a_failed_overwrite_leaves_the_old_rows(spark, store):
    src.load_table(spark.range(5).toDF("id"), "t", store)
    bad = spark.range(0, 100, 1, 4).selectExpr("IF(id = 99, raise_error('no'), id) AS id")
    with pytest.raises(FAILURES):
        src.load_table(bad, "t", store)
    assert store.read(spark, "t").count() == 5
    with pytest.raises(FAILURES):
        store.write(bad, "t")
    assert store.read(spark, "t").count() == 5


def test_leftovers_of_a_failed_write_can_be_emptied(spark, tmp_path):
    store = src.PathStore(str(tmp_path / "tables"))
    (tmp_path / "tables" / "t" / "_temporary").mkdir(parents=True)
    store.empty(spark, "t")
    src.load_table(spark.range(5).toDF("id"), "t", store, mode="append")
    assert store.read(spark, "t").count() == 5


def test_stores_reject_equal_names(spark, store):
    df = spark.sql("SELECT 1 AS a, 2 AS A")
    with pytest.raises(ValueError, match="more than once"):
        store.write(df, "t")


def test_partitioned_write(spark, store):
    df = spark.range(1000).selectExpr("id", "id % 3 AS season")
    assert src.load_table(df, "t", store, partition_by=["season"]).rows == 1000
    back = store.read(spark, "t")
    assert {(r.season, r["count"]) for r in back.groupBy("season").count().collect()} == {
        (0, 334), (1, 333), (2, 333),
    }
    assert len(back.inputFiles()) <= 2 * 3


def test_refresh_writes_all_marts(spark, tmp_path, raw):
    staging, marts = src.PathStore(str(tmp_path / "s")), src.PathStore(str(tmp_path / "m"))
    result = run_refresh(spark, raw, staging, marts, AS_OF)
    assert {r.table: r.rows for r in result.marts} == {
        "player_current_club": 1, "player_performance": 1, "player_valuation": 1,
        "team_performance": 2,
    }
    (club,) = dicts(marts.read(spark, "player_current_club"))
    assert len(club) == 29
    assert (club["club_data_source"], club["derived_current_club_name"]) == ("Latest Transfer", "Two")
    assert club["possible_non_european_transfer"] is True
    (stats,) = dicts(marts.read(spark, "player_performance"))
    assert (stats["games_played"], stats["total_goals"], stats["player_age"]) == (2, 2, 20)
    assert (stats["assists_per_game"], stats["avg_minutes_per_game"]) == (1.0, 85.0)
    repeated = run_refresh(spark, raw, staging, marts, AS_OF)
    assert repeated == result


def test_the_order_of_nulls_holds_for_the_whole_refresh(spark, tmp_path, raw):
    transfers = write(
        tmp_path / "t.csv",
        "player_id,to_club_id,to_club_name,transfer_date,transfer_fee\n"
        "1,1,One,,\n1,2,Two,2002-01-01,7\n",
    )
    paths = {name: f"{raw}/{name}.csv" for name in src.STAGING} | {"transfers": transfers}
    found = {}
    for nulls in ("first", "last"):
        staging = src.PathStore(str(tmp_path / f"s-{nulls}"))
        marts = src.PathStore(str(tmp_path / f"m-{nulls}"))
        run_refresh(spark, paths, staging, marts, AS_OF, nulls=nulls)
        club = marts.read(spark, "player_current_club").first()
        value = marts.read(spark, "player_valuation").first()
        found[nulls] = (club.club_data_source, value.last_transfer_fee)
    assert found == {"first": ("Original Record", None), "last": ("Latest Transfer", 7.0)}


def test_a_table_prepared_for_the_other_order_of_nulls_raises(spark):
    prepared = spark.createDataFrame([(1,)], "player_id bigint")
    sources = {"transfers": prepared, LATEST_TRANSFERS["first"]: prepared}
    assert latest_transfers(sources) is prepared
    with pytest.raises(ValueError, match="nulls_last"):
        latest_transfers(sources, "last")


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark).startswith(shared)
    assert scratch_dir(spark) != scratch_dir(spark)
