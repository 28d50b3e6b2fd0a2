"""Backtest, sweep and pick queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldhouse.functions.odds import valid_prices
from fieldhouse.operators import backtest as bt
from fieldhouse.operators import picks as pk
from fieldhouse.operators.sweep import best_cell, threshold_sweep
from fieldhouse.plans.thresholds import optimise_then_evaluate
from fieldhouse.workload.registry import query, r6
from fieldhouse.workload.views import HOOPS_CTE, SCORED_CTE, hoops, scored

LOWER, UPPER = 0.42, 0.55


def priced(spark, d):
    return scored(spark, d).where(valid_prices(F.col("homeMoneyline"), F.col("awayMoneyline")))


def bets(spark, d):
    return bt.place_bets(priced(spark, d), LOWER, UPPER)


_PRICED = f"{SCORED_CTE}, priced AS (SELECT * FROM scored WHERE homeMoneyline <> 0 AND awayMoneyline <> 0)"
_PAY = "CASE WHEN {o} > 0 THEN {o} / 100.0::DOUBLE ELSE 100.0::DOUBLE / abs({o}) END"
_BETS = f"""{_PRICED},
sided AS (SELECT *, (proba >= {UPPER})::INTEGER AS bet_side FROM priced WHERE proba >= {UPPER} OR proba <= {LOWER}),
won AS (SELECT *, (bet_side = actual)::INTEGER AS win,
  CASE WHEN bet_side = 1 THEN homeMoneyline ELSE awayMoneyline END AS bet_odds FROM sided),
bets AS (SELECT *, {_PAY.format(o='bet_odds')} AS win_payout,
  CASE WHEN win = 1 THEN {_PAY.format(o='bet_odds')} ELSE -1.0::DOUBLE END AS units FROM won),
cum AS (SELECT *, sum(units) OVER (ORDER BY gameDate, gameId ROWS UNBOUNDED PRECEDING) AS cum_units FROM bets),
log AS (SELECT *, max(cum_units) OVER (ORDER BY gameDate, gameId ROWS UNBOUNDED PRECEDING) AS peak FROM cum)"""


def _r(e: str, n: int) -> str:
    """Rounded as a decimal, half up, which doubles on a tie are not."""
    return f"round(TRY_CAST({e} AS DECIMAL(28, 10)), {n})::DOUBLE"


def _summary_sql(drawdown: str) -> str:
    return f"""count(*) AS bets, {_r('avg(win)', 4)} AS win_rate, {_r('avg(units)', 4)} AS avg_units,
  {_r('sum(units)', 2)} AS total_units, {_r('avg(units)', 4)} AS roi_per_bet,
  {_r('avg(units) / stddev_samp(units)', 4)} AS sharpe, {_r(f'min({drawdown})', 2)} AS max_drawdown,
  {_r('avg(proba)', 4)} AS avg_proba"""


@query("valid_odds", f"WITH {_PRICED} SELECT gameId, homeMoneyline, awayMoneyline FROM priced")
def valid_odds(spark, d):
    return priced(spark, d).select("gameId", "homeMoneyline", "awayMoneyline")


@query("placed_bets", f"""
WITH {_BETS} SELECT gameId, bet_side, win, bet_odds, round(win_payout, 6) AS win_payout, round(units, 6) AS units FROM bets""")
def placed_bets(spark, d):
    return bets(spark, d).select("gameId", "bet_side", "win", "bet_odds", r6("win_payout"), r6("units"))


@query("bet_log", f"""
WITH {_BETS} SELECT gameId, round(cum_units, 6) AS cum_units, round(peak, 6) AS peak,
  round(cum_units - peak, 6) AS drawdown FROM log""")
def bet_log(spark, d):
    return bt.bet_log(bets(spark, d)).select("gameId", r6("cum_units"), r6("peak"), r6("drawdown"))


@query("backtest_summary", f"""
WITH {_BETS} SELECT {_summary_sql('cum_units - peak')} FROM log HAVING count(*) >= 10""")
def backtest_summary(spark, d):
    return bt.backtest(priced(spark, d), LOWER, UPPER)


@query("backtest_too_few_bets", f"""
WITH {_PRICED} SELECT count(*) AS bets, avg(proba) AS win_rate FROM priced WHERE proba >= 2.0 HAVING count(*) >= 10""")
def backtest_too_few(spark, d):
    return bt.backtest(priced(spark, d), -1.0, 2.0).select("bets", "win_rate")


@query("bets_by_side", f"""
WITH {_BETS} SELECT bet_side, round(avg(win), 3) AS win_rate, count(*) AS count, round(sum(units), 3) AS total_units
FROM bets GROUP BY bet_side""")
def bets_by_side(spark, d):
    return bt.by_side(bets(spark, d))


@query("class_precision", f"""
WITH {SCORED_CTE} SELECT pred, count(*) AS predicted, count(*) FILTER (pred = actual) AS correct,
  round(count(*) FILTER (pred = actual) / count(*)::DOUBLE, 3) AS precision FROM scored GROUP BY pred""")
def class_precision(spark, d):
    return bt.class_precision(scored(spark, d))


_DAYS = f"""{_BETS},
days AS (SELECT gameDate::DATE AS gameDate, sum(units) AS daily_units, sum(win)::BIGINT AS wins,
  count(*) AS total_bets, sum(bet_side)::BIGINT AS home_bets FROM bets GROUP BY 1)"""


@query("day_log", f"""
WITH {_DAYS} SELECT gameDate, round(daily_units, 6) AS daily_units, wins, total_bets, home_bets,
  total_bets - wins AS losses, total_bets - home_bets AS away_bets, round(wins / total_bets::DOUBLE, 6) AS win_rate,
  round(sum(daily_units) OVER (ORDER BY gameDate), 6) AS cum_units FROM days""")
def day_log(spark, d):
    return bt.day_log(bets(spark, d)).select(
        "gameDate", r6("daily_units"), "wins", "total_bets", "home_bets", "losses", "away_bets", r6("win_rate"),
        r6("cum_units"))


@query("day_summary", f"""
WITH {_DAYS} SELECT count(*) AS days, count(*) FILTER (daily_units > 0) AS profitable_days,
  count(*) FILTER (daily_units < 0) AS losing_days, count(*) FILTER (daily_units = 0) AS break_even_days,
  round(max(daily_units), 6) AS best_day, round(min(daily_units), 6) AS worst_day,
  round(avg(total_bets), 6) AS bets_per_day FROM days""")
def day_summary(spark, d):
    s = bt.day_summary(bt.day_log(bets(spark, d)))
    return s.select("days", "profitable_days", "losing_days", "break_even_days", r6("best_day"), r6("worst_day"),
                    r6("bets_per_day"))


@query("bet_selectivity", f"""
WITH {_BETS} SELECT count(*) AS bets, count(*) FILTER (bet_side = 1) AS home_bets,
  count(*) FILTER (bet_side = 1 AND win = 1) AS home_correct, count(*) FILTER (bet_side = 0) AS away_bets,
  count(*) FILTER (bet_side = 0 AND win = 1) AS away_correct, round(avg(units) FILTER (win = 1), 6) AS avg_win,
  round(avg(units) FILTER (win = 0), 6) AS avg_loss, round(max(cum_units), 6) AS peak_units,
  (SELECT count(*) FROM priced) AS games, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM priced), 6) AS bet_pct,
  round(((SELECT count(*) FROM priced) - count(*)) * 100.0::DOUBLE / (SELECT count(*) FROM priced), 6) AS pass_pct
FROM log""")
def bet_selectivity(spark, d):
    s = bt.selectivity(priced(spark, d), bets(spark, d))
    return s.select("bets", "home_bets", "home_correct", "away_bets", "away_correct", r6("avg_win"), r6("avg_loss"),
                    r6("peak_units"), "games", r6("bet_pct"), r6("pass_pct"))


@query("rolling_win_rate", f"""
WITH {_BETS} SELECT gameId, CASE WHEN count(*) OVER w = 50 THEN round(avg(win) OVER w, 6) END AS rolling_win_rate
FROM bets WINDOW w AS (ORDER BY gameDate, gameId ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)""")
def rolling_win_rate(spark, d):
    return bt.rolling_win_rate(bets(spark, d)).select("gameId", r6("rolling_win_rate"))


_SWEEP = f"""{_PRICED},
cells AS (SELECT round((i * {{step}})::DOUBLE, 10) AS lo, round((0.55 + j * {{step}})::DOUBLE, 10) AS hi
  FROM range({{n}}) a(i), range({{n}}) b(j)),
placed AS (SELECT lo, hi, gameDate, gameId, proba, (proba >= hi)::INTEGER AS side, actual, homeMoneyline, awayMoneyline
  FROM priced JOIN cells ON proba >= hi OR proba <= lo),
paid AS (SELECT *, (side = actual)::INTEGER AS win, CASE WHEN side <> actual THEN -1.0::DOUBLE
  WHEN side = 1 THEN {_PAY.format(o='homeMoneyline')} ELSE {_PAY.format(o='awayMoneyline')} END AS units FROM placed),
running AS (SELECT *, sum(units) OVER (PARTITION BY lo, hi ORDER BY gameDate, gameId ROWS UNBOUNDED PRECEDING) AS cum
  FROM paid),
topped AS (SELECT *, max(cum) OVER (PARTITION BY lo, hi ORDER BY gameDate, gameId ROWS UNBOUNDED PRECEDING) AS top
  FROM running),
sweep AS (SELECT lo AS lower_threshold, hi AS upper_threshold, {_summary_sql('cum - top')} FROM topped GROUP BY lo, hi HAVING count(*) >= 100)"""


@query("threshold_sweep", f"WITH {_SWEEP.format(step=0.01, n=45)} SELECT * FROM sweep")
def sweep(spark, d):
    return threshold_sweep(priced(spark, d), min_bets=100)


@query("best_thresholds", f"""
WITH {_SWEEP.format(step=0.05, n=9)} SELECT * FROM sweep ORDER BY roi_per_bet DESC, lower_threshold, upper_threshold LIMIT 1""")
def best_thresholds(spark, d):
    return best_cell(threshold_sweep(priced(spark, d), step=0.05, min_bets=100))


def _half_sql(name: str, cond: str) -> str:
    return f"""{name} AS (SELECT count(*) AS bets, {_r('avg(win)', 4)} AS win_rate, {_r('avg(units)', 4)} AS roi_per_bet,
  {_r('avg(units) / stddev_samp(units)', 4)} AS sharpe FROM bets WHERE {cond})"""


@query("optimised_vs_evaluated", f"""
WITH {_BETS}, {_half_sql('o', 'season < 1998')}, {_half_sql('e', 'season >= 1998')}
SELECT o.bets AS opt_bets, o.win_rate AS opt_win_rate, o.roi_per_bet AS opt_roi_per_bet, o.sharpe AS opt_sharpe,
  e.bets AS eval_bets, e.win_rate AS eval_win_rate, e.roi_per_bet AS eval_roi_per_bet, e.sharpe AS eval_sharpe,
  e.bets - o.bets AS bets_diff, round(e.win_rate - o.win_rate, 6) AS win_rate_diff,
  round(e.roi_per_bet - o.roi_per_bet, 6) AS roi_per_bet_diff, round(e.sharpe - o.sharpe, 6) AS sharpe_diff,
  e.roi_per_bet - o.roi_per_bet >= -0.05 AS generalises,
  CASE WHEN e.roi_per_bet > 0.05 THEN 'STRONG' WHEN e.roi_per_bet > 0 THEN 'MARGINAL' ELSE 'NEGATIVE' END AS verdict
FROM o, e""")
def optimised_vs_evaluated(spark, d):
    rows = priced(spark, d)
    out = bt.compare_summaries(
        bt.backtest(rows.where("season < 1998"), LOWER, UPPER), bt.backtest(rows.where("season >= 1998"), LOWER, UPPER))
    diffs = [c for c in out.columns if c.endswith("_diff") and c != "bets_diff"]
    return out.select([r6(c) if c in diffs else F.col(c) for c in out.columns])


def _evaluated_sql(name: str, half: str) -> str:
    return f"""{name} AS (SELECT count(*) AS bets, {_r('avg(win)', 4)} AS win_rate, {_r('avg(units)', 4)} AS roi_per_bet,
  {_r('avg(units) / stddev_samp(units)', 4)} AS sharpe FROM chosen WHERE half = '{half}')"""


_OPTIMISED = f"""{_PRICED},
numbered AS (SELECT *, row_number() OVER (ORDER BY gameDate, gameId) AS p, count(*) OVER () AS n FROM priced),
opt AS (SELECT * FROM numbered WHERE p <= n // 2){_SWEEP.format(step=0.05, n=9)[len(_PRICED):].replace(
    'FROM priced JOIN cells', 'FROM opt JOIN cells').replace('count(*) >= 100', 'count(*) >= (SELECT greatest(10, count(*) // 4) FROM opt)')},
best AS (SELECT * FROM sweep ORDER BY roi_per_bet DESC, lower_threshold, upper_threshold LIMIT 1),
sided2 AS (SELECT CASE WHEN p <= n // 2 THEN 'o' ELSE 'e' END AS half, actual, homeMoneyline, awayMoneyline,
  (proba >= upper_threshold)::INTEGER AS side FROM numbered, best WHERE proba >= upper_threshold OR proba <= lower_threshold),
chosen AS (SELECT half, (side = actual)::INTEGER AS win, CASE WHEN side <> actual THEN -1.0::DOUBLE
  WHEN side = 1 THEN {_PAY.format(o='homeMoneyline')} ELSE {_PAY.format(o='awayMoneyline')} END AS units FROM sided2),
{_evaluated_sql('o', 'o')}, {_evaluated_sql('e', 'e')}"""


@query("optimised_then_evaluated", f"""
WITH {_OPTIMISED}
SELECT lower_threshold, upper_threshold, o.bets AS opt_bets, o.win_rate AS opt_win_rate, o.roi_per_bet AS opt_roi_per_bet, o.sharpe AS opt_sharpe,
  e.bets AS eval_bets, e.win_rate AS eval_win_rate, e.roi_per_bet AS eval_roi_per_bet, e.sharpe AS eval_sharpe,
  e.bets - o.bets AS bets_diff, round(e.win_rate - o.win_rate, 6) AS win_rate_diff,
  round(e.roi_per_bet - o.roi_per_bet, 6) AS roi_per_bet_diff, round(e.sharpe - o.sharpe, 6) AS sharpe_diff,
  e.roi_per_bet - o.roi_per_bet >= -0.05 AS generalises,
  CASE WHEN e.roi_per_bet > 0.05 THEN 'STRONG' WHEN e.roi_per_bet > 0 THEN 'MARGINAL' ELSE 'NEGATIVE' END AS verdict
FROM best, o, e""")
def optimised_then_evaluated(spark, d):
    out = optimise_then_evaluate(priced(spark, d), step=0.05)
    diffs = ("win_rate_diff", "roi_per_bet_diff", "sharpe_diff")
    return out.select([r6(c) if c in diffs else F.col(c) for c in out.columns])


def _scored_hoops(spark, d):
    return hoops(spark, d).withColumn("predProb", F.col("proba")).withColumn(
        "predClass", (F.col("proba") >= 0.5).cast("int"))


def _info(spark, d):
    return hoops(spark, d).select(
        "gameId", "startDate", F.concat(F.lit("Team "), "homeTeamId").alias("homeTeam"),
        F.concat(F.lit("Team "), "awayTeamId").alias("awayTeam"), F.concat(F.lit("Hall "), "homeTeamId").alias("venue"))


_AS_OF = "2000-01-01 00:00:00"


def _picks_sql(line: str, high: str, low: str) -> str:
    return f"""WITH {HOOPS_CTE},
p AS (SELECT *, CASE WHEN proba <= 0.423 THEN '{low}' ELSE '{high}' END AS pickSide FROM hoops
  WHERE (proba >= 0.53 OR proba <= 0.423) AND startDate >= TIMESTAMP '{_AS_OF}')
SELECT gameId, 'Team ' || homeTeamId AS homeTeam, 'Team ' || awayTeamId AS awayTeam, startDate,
  'Hall ' || homeTeamId AS venue, {line}, proba AS predProb, (proba >= 0.5)::INTEGER AS predClass, pickSide,
  round(CASE WHEN pickSide = '{high}' THEN proba - 0.5238 ELSE (1 - proba) - 0.5238 END, 6) AS edge FROM p"""


def _picks(spark, d, sides, line):
    as_of = F.lit(_AS_OF).cast("timestamp_ntz")
    p = pk.daily_picks(pk.upcoming(_scored_hoops(spark, d), as_of), _info(spark, d), 0.423, 0.53, as_of, sides, line)
    return p.withColumn("edge", r6("edge"))


@query("spread_picks", _picks_sql("homeSpread", "HOME", "AWAY"))
def spread_picks(spark, d):
    return _picks(spark, d, pk.SPREAD_SIDES, "homeSpread")


@query("total_picks", _picks_sql("overUnder", "OVER", "UNDER"))
def total_picks(spark, d):
    return _picks(spark, d, pk.TOTAL_SIDES, "overUnder")


@query("picks_table", f"""
WITH p AS ({_picks_sql("homeSpread", "HOME", "AWAY")})
SELECT pickSide AS "Pick", homeTeam AS "Home", awayTeam AS "Away", CASE WHEN homeSpread IS NOT NULL THEN printf('%+.1f', homeSpread) END AS "Spread",
  printf('%.1f%%', predProb * 100) AS "Prob", printf('%.2f%%', edge * 100) AS "Edge",
  strftime(startDate, '%m/%d %I:%M %p') AS "Time", venue AS "Venue" FROM p""")
def picks_table(spark, d):
    return pk.display_table(_picks(spark, d, pk.SPREAD_SIDES, "homeSpread"))
