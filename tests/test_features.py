"""Hand tables for windows, targets, odds and picks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldhouse.functions import calendar as cal
from fieldhouse.functions import coerce as co
from fieldhouse.functions.names import camel_path, snake
from fieldhouse.functions.odds import edge, implied_probability, payout, pick_side
from fieldhouse.operators import backtest as bt
from fieldhouse.operators import picks as pk
from fieldhouse.operators.longform import shared_stats, to_long
from fieldhouse.operators.rolling import rolling_means
from fieldhouse.operators.sweep import best_cell, grid_steps, threshold_sweep
from fieldhouse.operators.targets import baseball_targets, spread_target, total_target
from fieldhouse.plans import baseball, basketball


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def games(spark, runs, **extra):
    rows = [(i, 2024, dt.datetime(2024, 4, 1 + i // 2), 1, 100 + i, float(r) if r is not None else None, 0.0)
            for i, r in enumerate(runs)]
    return spark.createDataFrame(rows, "gameId long, season int, gameDate timestamp, homeTeamId long, awayTeamId long, "
                                       "homeRuns double, awayRuns double")


def rolled(df, w=3):
    long = rolling_means(to_long(df, ["Runs"]), ["Runs"], [w])
    return {r["gameId"]: r[f"Runs_roll{w}"] for r in long.where("side = 'home'").collect()}


def test_rolling_needs_a_full_window(spark):
    got = rolled(games(spark, [3, 6, 9, 12, 15]))
    assert got == {0: None, 1: None, 2: None, 3: 6.0, 4: 9.0}


def test_null_in_window_gives_null(spark):
    got = rolled(games(spark, [3, None, 9, 12, 15, 18]))
    assert (got[3], got[4], got[5]) == (None, None, 12.0)


def test_no_leakage(spark):
    before, after = rolled(games(spark, [3, 6, 9, 12, 15])), rolled(games(spark, [3, 6, 9, 99, 15]))
    assert before[3] == after[3] and before[4] != after[4]


def test_same_day_games_are_ordered_by_id(spark):
    # games 0 and 1 share a day, as do 2 and 3
    assert rolled(games(spark, [1, 2, 3, 4]), 1) == {0: None, 1: 1.0, 2: 2.0, 3: 3.0}


def test_long_is_twice_wide_and_needs_columns(spark):
    g = games(spark, [1, 2, 3])
    assert to_long(g, ["Runs", "Missing"]).count() == 6
    with pytest.raises(ValueError, match="homeTeamId"):
        to_long(g.drop("homeTeamId"), ["Runs"])
    assert shared_stats(g) == ["Runs"]


def test_difference_flips_with_sides(spark, data):
    from fieldhouse.workload.views import games as view
    g = view(spark, data)
    swap = {"home": "away", "away": "home"}
    flipped = g.select([F.col(c).alias(swap.get(c[:4], c[:4]) + c[4:]) for c in g.columns])
    a = baseball.rolling_differences(g, ["Runs"], [3])
    b = baseball.rolling_differences(flipped, ["Runs"], [3]).withColumnRenamed("runs_diff_l3", "other")
    # ties within a day are broken by game id, which the flip keeps, so values only change sign
    bad = a.join(b, "gameId").where("abs(runs_diff_l3 + other) > 1e-9 OR (runs_diff_l3 IS NULL) <> (other IS NULL)")
    assert bad.count() == 0


def test_pitcher_prefix_is_not_doubled(spark, data):
    from fieldhouse.workload.views import games as view
    df = baseball.add_pitcher_form(view(spark, data), ["SP_MaxVelo"], [1])
    assert "sp_maxvelo_diff_l1" in df.columns
    plain = view(spark, data).drop("homeStartingPitcherId")
    assert baseball.add_pitcher_form(plain, ["SP_MaxVelo"], [1]) is plain


def test_unknown_pitchers_have_no_history(spark):
    rows = [(i, 2024, dt.datetime(2024, 4, 1 + i), None if i % 2 else 7, "home", float(i)) for i in range(6)]
    df = spark.createDataFrame(rows, "gameId long, season int, gameDate timestamp, pitcherId long, side string, v double")
    got = {r["gameId"]: r["v_roll1"] for r in rolling_means(df, ["v"], [1], "pitcherId", sparse=True).collect()}
    assert got == {0: None, 1: None, 2: 0.0, 3: None, 4: 2.0, 5: None}


def test_baseball_targets(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 3.0, -1.5, 8), (2, 3.0, 3.0, 0.0, 6), (3, None, 3.0, 1.0, 7), (4, 4.0, 5.0, None, None)],
        "gameId int, homeRuns double, awayRuns double, homeSpread double, overUnder int")
    got = {r["gameId"]: (r["homeWin"], r["homeCover"], r["wentOver"]) for r in baseball_targets(df).collect()}
    assert got == {1: (1, 1, None), 2: (None, None, None), 3: (None, None, None), 4: (0, None, None)}


def test_basketball_targets_drop_pushes_only(spark):
    df = spark.createDataFrame(
        [(1, 70.0, 60.0, -5.0, 140.0), (2, 70.0, 60.0, -10.0, 130.0), (3, None, None, 2.0, 120.0), (4, 50.0, 60.0, None, None)],
        "gameId int, homePoints double, awayPoints double, homeSpread double, overUnder double")
    assert {r["gameId"]: r["homeCover"] for r in spread_target(df).collect()} == {1: 1, 3: None, 4: None}
    assert {r["gameId"]: r["homeCover"] for r in spread_target(df, True).collect()} == {1: 1, 3: None, 4: 0}
    assert {r["gameId"]: r["wentOver"] for r in total_target(df).collect()} == {1: 0, 3: None, 4: None}


@pytest.mark.parametrize("ml,p", [(150, 0.4), (-150, 0.6), (0, 0.0), (None, None), (100, 0.5)])
def test_implied_probability(spark, ml, p):
    got = one(spark, implied_probability(F.lit(ml).cast("int")))
    assert got == (pytest.approx(p) if p is not None else None)


@pytest.mark.parametrize("odds,win", [(150, 3.0), (-200, 1.0), (0, None), (None, None)])
def test_payout(spark, odds, win):
    assert one(spark, payout(F.lit(odds).cast("int"), 2.0)) == win


def test_pick_side_low_wins_overlap(spark):
    assert one(spark, pick_side(F.lit(0.5), 0.6, 0.4, "HOME", "AWAY")) == "AWAY"
    assert one(spark, pick_side(F.lit(0.5), 0.4, 0.6, "HOME", "AWAY")) is None
    assert one(spark, edge(F.lit(0.3), F.lit("AWAY"), "HOME")) == pytest.approx(0.7 - 0.5238)


def scored(spark, n):
    rows = [(i, dt.date(2024, 1, 1 + i), 0.9 if i % 2 else 0.1, i % 3 % 2, 120, -110) for i in range(n)]
    return spark.createDataFrame(
        rows, "gameId int, gameDate date, proba double, actual int, homeMoneyline int, awayMoneyline int")


def test_backtest_needs_ten_bets(spark):
    assert bt.backtest(scored(spark, 9)).count() == 0
    assert bt.backtest(scored(spark, 10)).count() == 1
    assert bt.rolling_win_rate(bt.place_bets(scored(spark, 20))).count() == 0


def test_backtest_by_hand(spark):
    rows = scored(spark, 12).collect()
    units, cum, top, deepest = [], 0.0, None, 0.0
    for r in sorted(rows, key=lambda r: r["gameDate"]):
        home = r["proba"] >= 0.55
        won = int(home) == r["actual"]
        units.append(((1.2 if home else 100 / 110) if won else -1.0))
        cum += units[-1]
        top = cum if top is None else max(top, cum)
        deepest = min(deepest, cum - top)
    got = bt.backtest(scored(spark, 12)).first()
    assert got["bets"] == 12 and got["total_units"] == round(sum(units), 2)
    assert got["max_drawdown"] == round(deepest, 2) and got["avg_units"] == round(sum(units) / 12, 4)


def test_sweep_cell_equals_backtest(spark, data):
    from fieldhouse.workload.betting import priced
    rows = priced(spark, data).cache()
    cells = {(r["lower_threshold"], r["upper_threshold"]): r for r in threshold_sweep(rows, step=0.15).collect()}
    assert len(cells) == 9
    for (lo, hi), cell in list(cells.items())[::4]:
        single = bt.backtest(rows, lo, hi).first().asDict()
        assert {k: cell[k] for k in single} == single
    best = best_cell(threshold_sweep(rows, step=0.15), "total_units").first()
    assert best["total_units"] == max(r["total_units"] for r in cells.values())


def test_grid_is_made_of_whole_steps():
    assert grid_steps(0.55, 1.0, 0.01)[2] == 0.57 and len(grid_steps(0.55, 1.0, 0.01)) == 45
    assert len(grid_steps(0.0, 0.5, 0.01)) == 50


def test_pick_checks(spark):
    ok = spark.createDataFrame([(1, "HOME"), (2, "AWAY")], "gameId int, pickSide string")
    assert pk.check_picks(ok) is ok
    with pytest.raises(ValueError, match="more than once"):
        pk.check_picks(ok.union(ok))
    with pytest.raises(ValueError, match="sides"):
        pk.check_picks(spark.createDataFrame([(1, None)], "gameId int, pickSide string"))


def test_season_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id as gameId", "cast(2015 + id as int) as season", "double(1) as x").write.parquet(f"{tmp_path}/g")
    plan = basketball.read_games(spark.read.parquet(f"{tmp_path}/g"), 2018, 2019)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(season,2018)" in plan


@pytest.mark.parametrize("text,want", [("1234.0", "1234"), ("1234", "1234"), ("abc", None), (None, None)])
def test_ids(spark, text, want):
    assert one(spark, co.to_id(F.lit(text).cast("string"))) == want


def test_nan_never_survives(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "k int, v double")
    assert {r["k"]: r["v"] for r in co.null_for_nan(df).collect()} == {1: None, 2: 1.0}
    assert one(spark, co.to_number(F.lit("NaN"))) is None


def test_half_even(spark):
    assert one(spark, co.to_whole(F.lit(2.5))) == 2 and one(spark, co.to_scale(F.lit(0.125), 2)) == 0.12


def test_bits(spark):
    assert [one(spark, co.to_bit(F.lit(x))) for x in (True, "false", "1", 0.0, "x")] == [1, 0, 1, 0, None]
    assert one(spark, co.to_bit(F.lit(None).cast("string"), True)) == 0


def test_eastern_days(spark):
    winter = cal.eastern_window(dt.date(2024, 1, 10), dt.date(2024, 1, 10))
    summer = cal.eastern_window(dt.date(2024, 7, 10), dt.date(2024, 7, 11))
    assert winter == (dt.datetime(2024, 1, 10, 5), dt.datetime(2024, 1, 11, 5))
    assert summer == (dt.datetime(2024, 7, 10, 4), dt.datetime(2024, 7, 12, 4))
    spring = cal.eastern_window(dt.date(2024, 3, 10), dt.date(2024, 3, 10))
    assert spring[1] - spring[0] == dt.timedelta(hours=23)
    a, b = cal.eastern_days_in_utc(F.lit("2024-03-10").cast("date"), F.lit("2024-03-10").cast("date"))
    assert (one(spark, a), one(spark, b)) == spring


def test_season_lookup(spark):
    df = spark.createDataFrame([(2020,), (2030,)], "season int")
    got = {r["season"]: (str(r["season_start"]), str(r["season_end"])) for r in cal.with_season_bounds(
        df, "season", cal.ODDS_SEASONS, cal.ODDS_DEFAULT).collect()}
    assert got == {2020: ("2020-07-23", "2020-09-27"), 2030: ("2030-04-01", "2030-10-01")}
    assert cal.season_bounds(2024, cal.PITCH_SEASONS, cal.PITCH_DEFAULT)[0] == "2024-03-28"


@pytest.mark.parametrize("raw,want", [
    ("homeTeamID", "home_team_id"), ("HTMLParser v2", "html_parser_v2"), ("3ptPct", "_3pt_pct"), ("--", "col"),
    ("Team Name (2024)", "team_name_2024"), ("a__b", "a_b")])
def test_names(raw, want):
    assert snake(raw) == want


def test_ascii_and_paths():
    assert snake("Équipe", ascii_only=True) == "equipe"
    assert camel_path("points.byPeriod") == "pointsByPeriod" and camel_path("pace") == "pace"
