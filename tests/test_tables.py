"""The table store, loads, streams, files and saved models."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from fieldhouse import schemas as sc
from fieldhouse.operators import cleaning as cl
from fieldhouse.operators import profile as pf
from fieldhouse.operators import shape as sh
from fieldhouse.operators.longform import to_long
from fieldhouse.operators.nested import odds_lines, odds_table
from fieldhouse.plans import loads
from fieldhouse.sources.files import processed_name, read_file, write_by_value, write_file
from fieldhouse.sources.tables import TableStore
from fieldhouse.streaming.landing import follow_landing

SPEC = sc.TableSpec("Things", ("id",), "id string, season string, a int, b string", partition_by=("season",))
FLAT = sc.TableSpec("Flat", ("id",), "id string, a int", identity=("rowId",))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, season string, a int, b string")


def stored(store, spec=SPEC):
    return {r["id"]: r for r in store.read(spec).collect()}


@pytest.fixture()
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def test_upsert_removes_emptied_partitions(spark, store):
    store.upsert(frame(spark, [("m", "2023", 1, "x"), ("k", "2022", 1, "x"), ("n", None, 1, "x")]), SPEC)
    store.upsert(frame(spark, [("m", "2024", 2, "x"), ("n", "20/25 é", 1, "x")]), SPEC)
    assert sorted((r["id"], r["season"], r["a"]) for r in store.read(SPEC).collect()) == [("k", "2022", 1), ("m", "2024", 2), ("n", "20/25 é", 1)]
    store.upsert(frame(spark, [("n", "2022", 1, "x")]), SPEC)
    assert sorted((r["id"], r["season"]) for r in store.read(SPEC).collect()) == [("k", "2022"), ("m", "2024"), ("n", "2022")]
    assert not [f for f in os.listdir(store.path(SPEC)) if f.startswith("season=20%2F") or "HIVE_DEFAULT" in f]


@pytest.mark.parametrize("spec", [SPEC, FLAT])
def test_a_version_cut_short_is_not_read_and_the_load_can_be_repeated(spark, store, monkeypatch, spec):
    names = [f.name for f in spec.schema.fields]
    rows = lambda v, s: frame(spark, [("m", s, v, "x"), ("k", "2022", 1, "x")]).select(*names)
    store.upsert(rows(1, "2023"), spec)
    whole = TableStore._write

    def fail(self, df, path, *rest):
        whole(self, df, path, *rest)
        os.remove(f"{path}/_SUCCESS")
        raise OSError("cut short")

    before = store.path(spec)
    reader = store.read(spec)
    monkeypatch.setattr(TableStore, "_write", fail)
    with pytest.raises(OSError):
        store.upsert(rows(2, "2024"), spec)
    monkeypatch.undo()
    again = TableStore(spark, store.root)
    assert again.path(spec) == before and sorted((r["id"], r["a"]) for r in again.read(spec).collect()) == [("k", 1), ("m", 1)]
    assert again.upsert(rows(2, "2024"), spec).updated == 1
    assert sorted((r["id"], r["a"]) for r in again.read(spec).collect()) == [("k", 1), ("m", 2)]
    assert sorted(r["a"] for r in reader.collect()) == [1, 1]  # a reader of the version before
    assert again.upsert(rows(2, "2024"), spec).unchanged == 2 and len(os.listdir(f"{store.root}/{spec.name}")) == 2


def test_only_touched_partitions_are_overwritten(spark, store):
    store.upsert(frame(spark, [("a", "2022", 1, "x"), ("b", "2023", 1, "x")]), SPEC)
    files = lambda s: sorted(os.listdir(f"{store.path(SPEC)}/season={s}"))
    path, old, kept = store.path(SPEC), files(2023), files(2022)
    store.upsert(frame(spark, [("b", "2023", 2, "x"), ("c", "2024", 1, "x")]), SPEC)
    assert store.path(SPEC) == path and files(2022) == kept and files(2023) != old
    assert sorted((r["id"], r["a"]) for r in store.read(SPEC).collect()) == [("a", 1), ("b", 2), ("c", 1)]


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_upsert_cases(spark, store, broadcast_rows):
    spark.conf.set("fieldhouse.broadcast_rows", str(broadcast_rows))
    try:
        first = frame(spark, [("same", "2023", 1, "x"), ("changed", "2023", 1, "x"), ("to_null", "2023", 1, "x"),
                              ("from_null", "2024", None, "x"), ("kept", "2022", 9, "z")])
        assert store.upsert(first, SPEC).inserted == 5
        old = stored(store)
        second = frame(spark, [("same", "2023", 1, "x"), ("changed", "2023", 2, "x"), ("to_null", "2023", None, "x"),
                               ("from_null", "2024", 5, "x"), ("new", "2024", 7, "n")])
        dry = store.upsert(second, SPEC, dry_run=True)
        assert (dry.inserted, dry.updated, dry.unchanged) == (1, 3, 1) and len(stored(store)) == 5
        done = store.upsert(second, SPEC)
        assert (done.inserted, done.updated, done.unchanged) == (1, 3, 1)
        new = stored(store)
        assert {k: (r["season"], r["a"], r["b"]) for k, r in new.items()} == {
            "same": ("2023", 1, "x"), "changed": ("2023", 2, "x"), "to_null": ("2023", None, "x"),
            "from_null": ("2024", 5, "x"), "new": ("2024", 7, "n"), "kept": ("2022", 9, "z")}
        assert new["same"]["update_date"] == old["same"]["update_date"]
        assert new["changed"]["update_date"] > old["changed"]["update_date"]
        assert new["changed"]["insert_date"] == old["changed"]["insert_date"]
        again = store.upsert(second, SPEC)
        assert (again.inserted, again.updated, again.unchanged) == (0, 0, 5)
        assert stored(store) == new
    finally:
        spark.conf.unset("fieldhouse.broadcast_rows")


def test_row_moves_to_another_partition(spark, store):
    store.upsert(frame(spark, [("m", "2023", 1, "x"), ("o", "2023", 1, "x")]), SPEC)
    store.upsert(frame(spark, [("m", "2024", 1, "x")]), SPEC)
    assert {k: r["season"] for k, r in stored(store).items()} == {"m": "2024", "o": "2023"}


def test_repeated_source_key_is_refused(spark, store):
    with pytest.raises(ValueError, match="share a key"):
        store.upsert(frame(spark, [("a", "2023", 1, "x"), ("a", "2023", 2, "x")]), SPEC)


def test_bad_values_become_null(spark, store):
    store.upsert(spark.createDataFrame([("a", "2023", "seven", "x", "extra")], "id string, season string, a string, b string, c string"), SPEC)
    assert stored(store)["a"]["a"] is None and "c" not in store.read(SPEC).columns


def test_copy_new_and_counts(spark, store):
    src = spark.createDataFrame([("a", 1, 10), ("b", 2, 11)], "id string, a int, rowId int")
    assert store.copy_new(src, FLAT) == 2 and store.copy_new(src, FLAT) == 0
    more = src.union(spark.createDataFrame([("c", 3, 12)], src.schema))
    summary = store.copy_all({"Flat": more}, [FLAT])
    assert summary.first()["inserted"] == 1
    assert store.counts([FLAT]).first().asDict() == {"table": "Flat", "rows": 3}
    assert "rowId" not in store.read(FLAT).columns
    store.append(src.drop("rowId"), FLAT)
    assert store.read(FLAT).count() == 5


def test_load_guard(spark, store):
    spec = sc.TableSpec("Days", ("id",), "id string, day date")
    rows = spark.createDataFrame([("a", dt.date(2024, 5, 1))], "id string, day date")
    assert store.load_unless_present(rows, spec, "day", "2024-05-01", "2024-05-31").inserted == 1
    assert store.load_unless_present(rows, spec, "day", "2024-05-01", "2024-05-31").inserted == 0
    assert pf.has_data(store.read(spec), "day", "2024-05-01", "2024-05-31")
    assert not pf.has_data(store.read(spec), "day", "2025-05-01", "2025-05-31")


def test_dependency_order():
    names = list(sc.BASEBALL_TABLES)
    assert names.index("TeamInfo") < names.index("GameInfo") < names.index("TeamBoxscore")
    assert names.index("PlayerInfo") < names.index("PlayerBoxscore")
    assert sc.BASEBALL_TABLES["StatcastPitches"].keys == ("game_pk", "at_bat_number", "pitch_number")


def test_ddl(spark):
    ddl = sh.create_table_ddl("t", SPEC.schema, SPEC.keys)
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS t") and "insert_date TIMESTAMP" in ddl and "'keys' = 'id'" in ddl


def _landing(tmp_path, name, docs, part="0"):
    folder = tmp_path / "landing" / name
    os.makedirs(folder, exist_ok=True)
    (folder / f"{part}.json").write_text("\n".join(json.dumps(x) for x in docs))
    return str(folder)


def _schedule(game_id, status, when, score):
    return {"season": 2024, "games": [{"game_id": game_id, "game_datetime": when, "away_id": 2, "away_name": "A", "home_id": 1,
                                       "home_name": "H", "away_score": score, "home_score": 3, "status": status}]}


def test_build_tables_and_look_back(spark, store, tmp_path):
    _landing(tmp_path, "TeamInfo", [{"season": 2024, "teams": [{"id": 1, "name": "One", "abbreviation": "ONE"}, {"id": 2, "name": "Two"}]}])
    _landing(tmp_path, "GameInfo", [
        _schedule(10, "Postponed", "2024-05-01T18:00:00Z", None), _schedule(10, "Final", "2024-05-03T18:00:00Z", 4),
        _schedule(10, "Final", "2024-05-02T18:00:00Z", 5), _schedule(11, None, "2024-03-01T18:00:00Z", 1)])
    log = loads.build_tables(store, loads.BASEBALL_LOADS, str(tmp_path / "landing"), as_of=dt.date(2024, 5, 4))
    by = {r["step"]: r for r in log.collect()}
    assert by["TeamInfo"]["inserted"] == 1  # the team without abbreviation goes
    assert by["GameInfo"]["inserted"] == 1 and by["GameInfo"]["success"]
    assert not by["PlayerInfo"]["success"] and by["PlayerInfo"]["error"]
    game = store.read(sc.BASEBALL_TABLES["GameInfo"]).first()
    assert (game["game_id"], game["away_score"], game["game_type"]) == ("10", 5, "R")
    loads.build_tables(store, loads.BASEBALL_LOADS, str(tmp_path / "landing"), only=["GameInfo"], seasons=[2024])
    assert store.read(sc.BASEBALL_TABLES["GameInfo"]).count() == 2


def test_stream_takes_each_file_once(spark, store, tmp_path):
    path = _landing(tmp_path, "GameInfo", [_schedule(1, "Final", "2024-05-01T18:00:00Z", 1)])
    which, check = loads.BASEBALL_LOADS["GameInfo"], str(tmp_path / "check")
    follow_landing(store, which, path, check).awaitTermination()
    assert store.read(which.spec).count() == 1
    _landing(tmp_path, "GameInfo", [_schedule(1, "Final", "2024-05-01T18:00:00Z", 9), _schedule(2, "Final", "2024-05-02T18:00:00Z", 2)], "1")
    follow_landing(store, which, path, check, files_per_batch=1).awaitTermination()
    assert {r["game_id"]: r["away_score"] for r in store.read(which.spec).collect()} == {"1": 9, "2": 2}


def test_stream_sets_rows_outside_the_window_aside(spark, store, tmp_path):
    path = _landing(tmp_path, "GameInfo", [_schedule(1, "Final", "2024-05-01T18:00:00Z", 1), _schedule(2, "Final", "2024-04-01T18:00:00Z", 2),
                                           _schedule(3, "Final", "2024-05-03T18:00:00Z", 3)])
    which = loads.BASEBALL_LOADS["GameInfo"]
    follow_landing(store, which, path, str(tmp_path / "check"), as_of=dt.date(2024, 5, 2), back=3).awaitTermination()
    assert [r["game_id"] for r in store.read(which.spec).collect()] == ["1"]
    aside = spark.read.parquet(f"{store.root}/_rejected/{which.spec.name}").collect()
    assert len(aside) == 2 and all('"game_id"' in r["document"] for r in aside)


def test_a_side_without_team_fails_when_the_rows_are_made(spark):
    rows = spark.createDataFrame([(1, 2, 3), (2, None, 3)], "gameId int, homeTeamId int, awayTeamId int")
    assert to_long(rows, [], base=["gameId"]).count() == 4
    long = to_long(rows, [], base=["gameId"], complete=True)
    with pytest.raises(Exception, match="homeTeamId is missing in .*2"):
        long.collect()
    assert to_long(rows.where("homeTeamId IS NOT NULL"), [], base=["gameId"], complete=True).count() == 2


@pytest.mark.parametrize("name", ["csv", "json", "parquet"])
def test_files(spark, tmp_path, name):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    path = write_file(df, str(tmp_path / f"x.{name}"))
    back = read_file(spark, path, "k string, n int" if name != "json" else None)
    assert sorted((r["k"], r["n"]) for r in back.collect()) == [("a", 1), ("b", 2)]


def test_file_errors_and_names(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        read_file(spark, "x.xlsx")
    assert processed_name("/d/games.csv") == "/d/games_processed.csv"
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    assert sorted(x for x in os.listdir(write_by_value(df, "k", str(tmp_path / "by"))) if "=" in x) == ["k=a", "k=b"]


def test_same_player_under_both_teams(spark):
    rows = spark.createDataFrame([("g", "p", "home", 1, "x"), ("g", "p", "away", 0, "3"), ("g", "q", "away", 0, "1")],
                                 "game_id string, player_id string, team_id string, is_home int, runs string")
    got = {r["player_id"]: (r["team_id"], r["runs"]) for r in cl.clean_player_boxscores(rows).collect()}
    assert got == {"p": ("away", 3), "q": ("away", 1)}


def test_pitch_edge_cases(spark):
    rows = spark.createDataFrame(
        [(1.0, "2024-05-01", 1, 1, "10", "20", None, "x" * 150, "nan", 1), (1.0, "2024-05-01", 1, 1, "11", "20", "true", "late", "home_run", 2),
         (None, "2024-05-01", 1, 1, "10", "20", None, "n", "nan", 3), (2.0, "2024-05-01", 1, 1, "10", "?", None, "n", "nan", 4),
         (3.0, "2024-05-01", 1, 1, "10", "20", None, "x" * 150, "nan", 5)],
        "game_pk double, game_date string, at_bat_number int, pitch_number int, pitcher string, batter string, barrel string, "
        "player_name string, events string, arrived int").withColumn("home_run", F.lit(0))
    got = {r["game_pk"]: r for r in cl.clean_pitches(rows, ["arrived"]).collect()}
    assert set(got) == {"1", "3"}
    assert got["1"]["pitcher"] == 11 and got["1"]["barrel"] == 1 and got["1"]["home_run"] == 1
    assert got["3"]["barrel"] == 0 and len(got["3"]["pitcher_name"]) == 100 and got["3"]["events"] is None
    assert got["3"]["batter_name"] is None


def test_broken_odds_pages_are_skipped(spark):
    pages = spark.createDataFrame([("2024-05-01", "total", None), ("2024-05-01", "total", "<html>no data</html>"),
                                   ("2024-05-01", "total", '<script id="__NEXT_DATA__">{broken</script>'),
                                   ("2024-05-01", "total", '<script id="__NEXT_DATA__">{"props":{"pageProps":{"oddsTables":[]}}}</script>')],
                                  "date string, bet_type string, html string")
    assert odds_table(odds_lines(pages)).count() == 0


def test_required_columns(spark):
    with pytest.raises(ValueError, match="team_abbr"):
        cl.clean_teams(spark.createDataFrame([("1", "2024", "x")], "team_id string, season string, team_name string"))
    assert sh.empty_like(spark.range(3)).count() == 0
    assert sh.preview(spark.range(9), 4).count() == 4


def _pitches(spark, days, speed="95.5"):
    rows = [(700000 + i, d, int(d[:4]), 1, 1, 10, 20, speed, "foul", "home", "NYY", "BOS", i) for i, d in enumerate(days)]
    return spark.createDataFrame(
        rows, "game_pk int, game_date string, game_year int, at_bat_number int, pitch_number int, pitcher int, batter int, "
              "release_speed string, description string, player_name string, home_team string, away_team string, arrived int")


def test_pitch_loads(spark, store):
    spec = sc.BASEBALL_TABLES["StatcastPitches"]
    raw = _pitches(spark, ["2024-04-01", "2024-04-02", "2023-04-05", "2024-12-01"])
    assert loads.load_pitches(store, raw, "2024-04-01", "2024-04-01", ["arrived"]).inserted == 1
    done = loads.load_pitch_season(store, raw, 2024, ["arrived"])
    assert (done.inserted, done.unchanged) == (1, 1)
    again = loads.load_pitch_season(store, raw, 2024, ["arrived"], only_if_absent=True)
    assert again.inserted == 0 and store.read(spec).count() == 2
    faster = loads.load_pitch_season(store, _pitches(spark, ["2024-04-01", "2024-04-02"], "99.25"), 2024, ["arrived"])
    assert faster.updated == 2
    assert {str(r["release_speed"]) for r in store.read(spec).collect()} == {"99.25"}
    assert loads.load_pitches(store, raw, "2023-01-01", "2023-12-31", ["arrived"], team="LAD").inserted == 0


def test_odds_seasons(spark, store):
    def page(day):
        line = {"total": 8.5, "overOdds": -110, "underOdds": -105}
        row = {"gameView": {"gameId": day, "awayTeam": {"name": "A"}, "homeTeam": {"name": "H"}, "startDate": f"{day}T18:00:00+00:00"},
               "oddsViews": [{"sportsbook": "alpha", "currentLine": line}, None]}
        doc = {"props": {"pageProps": {"oddsTables": [{"gameRows": [None, row]}]}}}
        return (day, "total", f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(doc)}</script>')

    pages = spark.createDataFrame([page("2020-06-01"), page("2020-08-01"), page("2021-05-01")], "date string, bet_type string, html string")
    assert loads.load_odds_seasons(store, pages, [2020]).inserted == 1
    assert loads.load_odds_seasons(store, pages, [2020, 2021]).inserted == 1
    row = store.read(sc.BASEBALL_TABLES["BettingOdds"]).where("game_id = '2020-08-01'").first()
    assert (float(row["total"]), row["over_odds"], row["game_time"]) == (8.5, -110, dt.datetime(2020, 8, 1, 18))


def test_broken_documents_are_set_aside(spark, store, tmp_path):
    landing = tmp_path / "GameLines"
    landing.mkdir()
    good = {"id": 1, "season": 2024, "lines": [{"provider": "P", "spread": -1.5, "overUnder": 140.0}]}
    (landing / "a.json").write_text(json.dumps(good) + "\n{\"id\": 2, \"lines\": [\n\nnot json\n")
    which = loads.BASKETBALL_LOADS["GameLines"]
    result = loads.load_landing(store, which, str(landing))
    assert result.rejected == 2 and result.inserted <= 1
    kept = spark.read.parquet(f"{store.root}/_rejected/{which.spec.name}")
    assert sorted(r["document"] for r in kept.collect()) == ["not json", '{"id": 2, "lines": [']
