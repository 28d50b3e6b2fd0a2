"""Feature, target and model-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldhouse.functions.odds import implied_probability
from fieldhouse.operators.longform import shared_stats, to_long
from fieldhouse.operators.market import market_features
from fieldhouse.operators.profile import value_counts
from fieldhouse.operators.rolling import fatigue, rolling_means
from fieldhouse.operators.targets import baseball_targets, holdout, labelled, spread_target, total_target
from fieldhouse.plans import baseball, basketball
from fieldhouse.workload.registry import query, r6
from fieldhouse.workload.views import GAMES_CTE, HOOPS_CTE, games, hoops

STATS = ["Runs", "Hits", "OBP", "ERA"]


def _long_sql(cols: dict[str, str], entity: str, entity_as: str, src: str, base: str) -> str:
    sides = []
    for side in ("home", "away"):
        body = ", ".join(f"{side}{c} AS {alias}" for c, alias in cols.items())
        sides.append(f"SELECT {base}, {side}{entity} AS {entity_as}, {body}, '{side}' AS side FROM {src}")
    return " UNION ALL ".join(sides)


def _roll_sql(col: str, n: int, w: str) -> str:
    frame = f"OVER ({w} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({col}) {frame} = {n} THEN avg({col}) {frame} END"


_BASE = "gameId, season, gameDate"
_STATMAP = {s: s for s in STATS}
TEAM_LONG = "long AS (" + _long_sql(_STATMAP, "TeamId", "teamId", "games", _BASE) + ")"
TEAM_W = "PARTITION BY teamId, season ORDER BY gameDate, gameId, side"


@query("team_rolling_diff", f"""
WITH {GAMES_CTE}, {TEAM_LONG},
f AS (SELECT gameId, side, {_roll_sql('Runs', 3, TEAM_W)} AS runs3, {_roll_sql('ERA', 3, TEAM_W)} AS era3 FROM long)
SELECT g.gameId, g.season, round(h.runs3 - a.runs3, 6) AS runs_diff_l3, round(h.era3 - a.era3, 6) AS era_diff_l3
FROM games g JOIN f h ON h.gameId = g.gameId AND h.side = 'home' JOIN f a ON a.gameId = g.gameId AND a.side = 'away'""")
def team_rolling_diff(spark, d):
    g = baseball.add_team_form(games(spark, d), ["Runs", "ERA"], [3])
    return g.select("gameId", "season", r6("runs_diff_l3"), r6("era_diff_l3"))


@query("team_long", f"""
WITH {GAMES_CTE}, {TEAM_LONG} SELECT gameId, season, teamId, Runs, Hits, OBP, ERA, side FROM long""")
def team_long(spark, d):
    return to_long(games(spark, d), STATS).select("gameId", "season", "teamId", *STATS, "side")


@query("pitcher_long", f"""
WITH {GAMES_CTE}, long AS ({_long_sql({"SP_MaxVelo": "SP_MaxVelo"}, "StartingPitcherId", "pitcherId", "games", _BASE)})
SELECT gameId, season, pitcherId, SP_MaxVelo, side FROM long""")
def pitcher_long(spark, d):
    return to_long(games(spark, d), ["SP_MaxVelo"], "StartingPitcherId", "pitcherId").drop("gameDate")


@query("hoops_long", f"""
WITH {HOOPS_CTE}, long AS ({_long_sql({"OrbPct": "OrbPct", "Pace": "Pace", "Points": "Points",
                                       "PointsOffTO": "PointsOffTO", "Rating": "Rating"},
                                      "TeamId", "teamId", "hoops", "gameId, season, startDate")})
SELECT * FROM long""")
def hoops_long(spark, d):
    h = hoops(spark, d)
    return to_long(h, shared_stats(h), base=basketball.BASE)


@query("team_rolling_windows", f"""
WITH {GAMES_CTE}, {TEAM_LONG}
SELECT gameId, teamId, side, round({_roll_sql('Runs', 3, TEAM_W)}, 6) AS Runs_roll3,
  round({_roll_sql('Runs', 5, TEAM_W)}, 6) AS Runs_roll5, round({_roll_sql('Runs', 10, TEAM_W)}, 6) AS Runs_roll10,
  round({_roll_sql('ERA', 3, TEAM_W)}, 6) AS ERA_roll3 FROM long""")
def team_rolling_windows(spark, d):
    long = rolling_means(to_long(games(spark, d), ["Runs", "ERA"]), ["Runs", "ERA"], [3, 5, 10])
    return long.select("gameId", "teamId", "side", r6("Runs_roll3"), r6("Runs_roll5"), r6("Runs_roll10"), r6("ERA_roll3"))


@query("pitcher_rolling_diff", f"""
WITH {GAMES_CTE}, long AS ({_long_sql({"SP_MaxVelo": "v"}, "StartingPitcherId", "pitcherId", "games", _BASE)}),
f AS (SELECT gameId, side, {_roll_sql('v', 1, 'PARTITION BY pitcherId, season ORDER BY gameDate, gameId, side')} AS r1,
  {_roll_sql('v', 3, 'PARTITION BY pitcherId, season ORDER BY gameDate, gameId, side')} AS r3 FROM long)
SELECT g.gameId, round(h.r1 - a.r1, 6) AS sp_maxvelo_diff_l1, round(h.r3 - a.r3, 6) AS sp_maxvelo_diff_l3
FROM games g JOIN f h ON h.gameId = g.gameId AND h.side = 'home' JOIN f a ON a.gameId = g.gameId AND a.side = 'away'""")
def pitcher_rolling_diff(spark, d):
    g = baseball.add_pitcher_form(games(spark, d), ["SP_MaxVelo"], [1, 3])
    return g.select("gameId", r6("sp_maxvelo_diff_l1"), r6("sp_maxvelo_diff_l3"))


_HOOPS_LONG = "long AS (" + _long_sql(
    {"Pace": "Pace", "OrbPct": "OrbPct", "PointsOffTO": "PointsOffTO", "Rating": "Rating"},
    "TeamId", "teamId", "hoops", "gameId, season, startDate") + ")"
_HOOPS_W = "PARTITION BY teamId, season ORDER BY startDate, gameId, side"
_DAY_W = _HOOPS_W  # days follow start times


@query("hoops_fatigue", f"""
WITH {HOOPS_CTE}, {_HOOPS_LONG},
dated AS (SELECT *, (startDate - INTERVAL 5 HOUR)::DATE AS gameDate FROM long)
SELECT gameId, teamId, side, gameDate, datediff('day', lag(gameDate) OVER ({_DAY_W}), gameDate)::INTEGER AS RestDays,
  row_number() OVER ({_DAY_W}) AS GamesPlayed FROM dated""")
def hoops_fatigue(spark, d):
    long = to_long(hoops(spark, d), [], base=basketball.BASE)
    return fatigue(long).select("gameId", "teamId", "side", "gameDate", "RestDays", "GamesPlayed")


_HOOPS_FEATURES = f"""{HOOPS_CTE}, {_HOOPS_LONG},
dated AS (SELECT *, (startDate - INTERVAL 5 HOUR)::DATE AS gameDate FROM long),
f AS (SELECT gameId, side, {_roll_sql('Pace', 3, _HOOPS_W)} AS pace3, {_roll_sql('OrbPct', 3, _HOOPS_W)} AS orb3,
  {_roll_sql('PointsOffTO', 3, _HOOPS_W)} AS pot3, {_roll_sql('Rating', 3, _HOOPS_W)} AS rat3,
  datediff('day', lag(gameDate) OVER ({_DAY_W}), gameDate)::INTEGER AS rest,
  row_number() OVER ({_DAY_W}) AS played FROM dated),
m AS (SELECT g.*, h.pace3 - a.pace3 AS pace_diff, h.orb3 - a.orb3 AS orb_diff, h.pot3 - a.pot3 AS pot_diff,
  h.rat3 - a.rat3 AS rat_diff, h.pace3 + a.pace3 AS pace_sum, h.rat3 + a.rat3 AS rat_sum, h.rest AS homeRestDays,
  a.rest AS awayRestDays, h.played AS homeGamesPlayed, a.played AS awayGamesPlayed
  FROM hoops g JOIN f h ON h.gameId = g.gameId AND h.side = 'home' JOIN f a ON a.gameId = g.gameId AND a.side = 'away')"""


@query("hoops_model_spread", f"""
WITH {_HOOPS_FEATURES}
SELECT gameId, season, startDate, homePoints, awayPoints, round(pace_diff, 6) AS pace_diff_l3,
  round(orb_diff, 6) AS orbpct_diff_l3, round(pot_diff, 6) AS pointsoffto_diff_l3, round(rat_diff, 6) AS rating_diff_l3,
  homeRestDays - awayRestDays AS restDiff, homeGamesPlayed, awayGamesPlayed,
  CASE WHEN homePoints + homeSpread <> awayPoints THEN (homePoints + homeSpread > awayPoints)::INTEGER END AS homeCover
FROM m WHERE NOT coalesce(homePoints + homeSpread = awayPoints, false)""")
def hoops_model_spread(spark, d):
    df = basketball.build_model_table(hoops(spark, d), basketball.SPREAD_STATS, [3], "homeCover")
    return df.select(
        "gameId", "season", "startDate", "homePoints", "awayPoints", r6("pace_diff_l3"), r6("orbpct_diff_l3"),
        r6("pointsoffto_diff_l3"), r6("rating_diff_l3"), "restDiff", "homeGamesPlayed", "awayGamesPlayed", "homeCover")


_PCT_CTE = """
lines AS (SELECT season, overUnder, count(*) AS n FROM {src} WHERE overUnder IS NOT NULL GROUP BY ALL),
pct AS (SELECT season, overUnder, (sum(n) OVER (PARTITION BY season ORDER BY overUnder) - (n - 1) / 2.0)::DOUBLE
  / (sum(n) OVER (PARTITION BY season))::DOUBLE AS p FROM lines)"""


@query("hoops_model_total", f"""
WITH {_HOOPS_FEATURES}, {_PCT_CTE.format(src='hoops')}
SELECT gameId, round(pace_sum, 6) AS pace_sum_l3, round(rat_sum, 6) AS rating_sum_l3,
  round(pace_sum * rat_sum / 100, 6) AS pace_x_rating_l3, round(p, 6) AS line_percentile,
  conferenceGame::INTEGER AS conferenceGame, neutralSite::INTEGER AS neutralSite,
  coalesce(homeRestDays >= 3 AND awayRestDays >= 3, false)::INTEGER AS both_rested,
  (coalesce(homeRestDays <= 1, false) OR coalesce(awayRestDays <= 1, false))::INTEGER AS either_b2b,
  homeRestDays + awayRestDays AS rest_sum, homePoints + awayPoints AS actualTotal,
  CASE WHEN homePoints + awayPoints <> overUnder THEN (homePoints + awayPoints > overUnder)::INTEGER END AS wentOver
FROM m LEFT JOIN pct USING (season, overUnder) WHERE NOT coalesce(homePoints + awayPoints = overUnder, false)""")
def hoops_model_total(spark, d):
    df = basketball.build_model_table(hoops(spark, d), basketball.SPREAD_STATS, [3], "wentOver")
    return df.select(
        "gameId", r6("pace_sum_l3"), r6("rating_sum_l3"), r6("pace_x_rating_l3"), r6("line_percentile"),
        "conferenceGame", "neutralSite", "both_rested", "either_b2b", "rest_sum", "actualTotal", "wentOver")


_IMPLIED = "CASE WHEN {c} > 0 THEN 100.0::DOUBLE / ({c} + 100) ELSE abs({c})::DOUBLE / (abs({c}) + 100) END"
_HP, _AP = _IMPLIED.format(c="homeMoneyline"), _IMPLIED.format(c="awayMoneyline")


@query("implied_probability", f"""
WITH {GAMES_CTE} SELECT gameId, homeMoneyline, round({_HP}, 6) AS homeImpliedProb, round({_AP}, 6) AS awayImpliedProb
FROM games""")
def implied(spark, d):
    return games(spark, d).select(
        "gameId", "homeMoneyline", r6(implied_probability(F.col("homeMoneyline")), "homeImpliedProb"),
        r6(implied_probability(F.col("awayMoneyline")), "awayImpliedProb"))


@query("market_features", f"""
WITH {GAMES_CTE}, {_PCT_CTE.format(src='games')},
rested AS (SELECT *, (gameId % 4)::INTEGER AS homeRestDays, CASE WHEN gameId % 11 <> 0 THEN (gameId % 3)::INTEGER END AS awayRestDays FROM games)
SELECT gameId, round(abs({_HP} - 0.5), 6) AS favoriteDegree, round({_HP} - {_AP}, 6) AS impliedProbDiff,
  round(p, 6) AS line_percentile, round(overUnder - avg(overUnder) OVER (PARTITION BY season), 6) AS line_vs_avg,
  abs(homeSpread) AS spreadMagnitude, homeRestDays - awayRestDays AS restDiff,
  coalesce(homeRestDays >= 2 AND awayRestDays >= 2, false)::INTEGER AS both_rested,
  (coalesce(homeRestDays <= 1, false) OR coalesce(awayRestDays <= 1, false))::INTEGER AS either_b2b
FROM rested LEFT JOIN pct USING (season, overUnder)""")
def market(spark, d):
    g = games(spark, d).withColumns({
        "homeRestDays": (F.col("gameId") % 4).cast("int"),
        "awayRestDays": F.when(F.col("gameId") % 11 != 0, (F.col("gameId") % 3).cast("int"))})
    return market_features(g).select(
        "gameId", r6("favoriteDegree"), r6("impliedProbDiff"), r6("line_percentile"), r6("line_vs_avg"),
        "spreadMagnitude", "restDiff", "both_rested", "either_b2b")


_TARGET = "CASE WHEN {l} <> {r} THEN ({l} > {r})::INTEGER END"
_TARGETS_SQL = ", ".join([
    _TARGET.format(l="homeRuns", r="awayRuns") + " AS homeWin",
    _TARGET.format(l="homeRuns + homeSpread", r="awayRuns") + " AS homeCover",
    _TARGET.format(l="homeRuns + awayRuns", r="overUnder") + " AS wentOver"])


@query("baseball_targets", f"WITH {GAMES_CTE} SELECT gameId, {_TARGETS_SQL} FROM games")
def targets(spark, d):
    return baseball_targets(games(spark, d)).select("gameId", *baseball.TARGETS)


@query("target_distribution", f"""
WITH {GAMES_CTE}, t AS (SELECT {_TARGETS_SQL} FROM games)
SELECT homeWin, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS share FROM t GROUP BY homeWin""")
def target_distribution(spark, d):
    return value_counts(baseball_targets(games(spark, d)), "homeWin").select("homeWin", "n", r6("share"))


@query("spread_target_pushes_removed", f"""
WITH {HOOPS_CTE} SELECT gameId, homeSpread,
  CASE WHEN homePoints + homeSpread <> awayPoints THEN (homePoints + homeSpread > awayPoints)::INTEGER END AS homeCover
FROM hoops WHERE NOT coalesce(homePoints + homeSpread = awayPoints, false)""")
def spread_targets(spark, d):
    return spread_target(hoops(spark, d)).select("gameId", "homeSpread", "homeCover")


@query("spread_target_null_line_zero", f"""
WITH {HOOPS_CTE} SELECT gameId, CASE WHEN homePoints IS NOT NULL AND awayPoints IS NOT NULL THEN
  coalesce((homePoints + homeSpread > awayPoints)::INTEGER, 0) END AS homeCover
FROM hoops WHERE NOT coalesce(homePoints + homeSpread = awayPoints, false)""")
def spread_targets_zero(spark, d):
    return spread_target(hoops(spark, d), null_line_as_zero=True).select("gameId", "homeCover")


@query("total_target", f"""
WITH {HOOPS_CTE} SELECT gameId, homePoints + awayPoints AS actualTotal,
  CASE WHEN homePoints + awayPoints <> overUnder THEN (homePoints + awayPoints > overUnder)::INTEGER END AS wentOver
FROM hoops WHERE NOT coalesce(homePoints + awayPoints = overUnder, false)""")
def total_targets(spark, d):
    return total_target(hoops(spark, d)).select("gameId", "actualTotal", "wentOver")


_MODEL_SQL = f"""{GAMES_CTE}, {TEAM_LONG}, {_PCT_CTE.format(src='games')},
f AS (SELECT gameId, side, {", ".join(f"{_roll_sql(s, 3, TEAM_W)} AS {s}3" for s in STATS)} FROM long),
model AS (SELECT g.gameId, season, g.gameDate, g.homeTeamId, g.awayTeamId, h.ERA3 - a.ERA3 AS era_diff_l3,
  h.Hits3 - a.Hits3 AS hits_diff_l3, h.OBP3 - a.OBP3 AS obp_diff_l3, h.Runs3 - a.Runs3 AS runs_diff_l3,
  g.homeMoneyline, g.awayMoneyline, g.homeSpread, overUnder, {_HP} AS homeImpliedProb, {_AP} AS awayImpliedProb,
  abs({_HP} - 0.5) AS favoriteDegree, {_HP} - {_AP} AS impliedProbDiff, p AS line_percentile,
  overUnder - avg(overUnder) OVER (PARTITION BY season) AS line_vs_avg, abs(g.homeSpread) AS spreadMagnitude,
  {_TARGETS_SQL}
  FROM games g JOIN f h ON h.gameId = g.gameId AND h.side = 'home' JOIN f a ON a.gameId = g.gameId AND a.side = 'away'
  LEFT JOIN pct USING (season, overUnder))"""
_ROUNDED = ["era_diff_l3", "hits_diff_l3", "obp_diff_l3", "runs_diff_l3", "homeImpliedProb", "awayImpliedProb",
            "favoriteDegree", "impliedProbDiff", "line_percentile", "line_vs_avg"]
_REPLACE = ", ".join(f"round({c}, 6) AS {c}" for c in _ROUNDED)


def model_table(spark, d):
    return baseball.build_model_table(games(spark, d), STATS, [3])


def _rounded(df):
    return df.select([r6(c) if c in _ROUNDED else F.col(c) for c in df.columns])


@query("baseball_model_table", f"WITH {_MODEL_SQL} SELECT * REPLACE ({_REPLACE}) FROM model")
def baseball_model_table(spark, d):
    return _rounded(model_table(spark, d))


@query("training_rows", f"""
WITH {_MODEL_SQL} SELECT gameId, gameDate, homeWin, round(runs_diff_l3, 6) AS runs_diff_l3 FROM model
WHERE homeWin IS NOT NULL AND runs_diff_l3 IS NOT NULL AND era_diff_l3 IS NOT NULL AND gameDate IS NOT NULL""")
def training_rows(spark, d):
    rows = labelled(model_table(spark, d), "homeWin", "gameDate", "runs_diff_l3", "era_diff_l3")
    return rows.select("gameId", "gameDate", "homeWin", r6("runs_diff_l3"))


@query("holdout_cut", f"""
WITH {GAMES_CTE} SELECT gameDate >= TIMESTAMP '2000-07-01' AS held_out, count(*) AS games, min(gameDate) AS first_day,
  max(gameDate) AS last_day FROM games GROUP BY 1""")
def holdout_cut(spark, d):
    before, after = holdout(games(spark, d).select("gameId", "gameDate"), "gameDate", "2000-07-01")
    both = before.withColumn("held_out", F.lit(False)).unionByName(after.withColumn("held_out", F.lit(True)))
    return both.groupBy("held_out").agg(
        F.count("*").alias("games"), F.min("gameDate").alias("first_day"), F.max("gameDate").alias("last_day"))


@query("season_range_scan", f"""
WITH {HOOPS_CTE} SELECT season, count(*) AS games, sum(homePoints) AS home_points FROM hoops
WHERE season BETWEEN 1996 AND 1999 GROUP BY season""")
def season_range_scan(spark, d):
    return basketball.read_games(hoops(spark, d), 1996, 1999).groupBy("season").agg(
        F.count("*").alias("games"), F.sum("homePoints").alias("home_points"))
