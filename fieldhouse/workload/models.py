"""Model queries: fitted on the games before a day, applied to the others.

Most use columns of few values, so that a whole fit can be derived in SQL: shares per value for a logistic curve of one flag, a
search over all splits for trees of one split, and normal equations for lines. `scores_linear` and `daily_spread_picks` run over
the whole feature table instead and have no SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldhouse.functions.odds import BREAK_EVEN
from fieldhouse.operators import metrics as mt
from fieldhouse.plans import basketball
from fieldhouse.plans import models as md
from fieldhouse.plans.picks_job import spread_picks
from fieldhouse.session import pinned, stored
from fieldhouse.workload.features import model_table
from fieldhouse.workload.registry import query, r6
from fieldhouse.workload.views import GAMES_CTE, HOOPS_CTE, games, hoops

FEATURES = ["runs_diff_l3", "hits_diff_l3", "obp_diff_l3", "favoriteDegree", "impliedProbDiff"]
TARGET = "homeWin"
START = "1997-01-01"
TREE = ["tensHome", "tensAway", "homeSpread", "overUnder"]
ONE_SPLIT = {"maxDepth": 1, "minInstancesPerNode": 3, "subsamplingRate": 1.0}
ALL_ROWS = {"numTrees": 3, "maxDepth": 1, "minInstancesPerNode": 3, "bootstrap": False, "featureSubsetStrategy": "all"}
TO_THE_END = {"maxIter": 300, "tol": 1e-12}


def fixed(df, target=TARGET, keep=()):
    """Labelled rows written once, as a fit reads them many times."""
    return pinned(df.dropna(subset=[target]).select("gameId", *keep, target, *FEATURES))


@query("scores_linear")
def scores_linear(spark, d):
    df = fixed(model_table(spark, d), keep=["gameDate"])
    m = md.fit(df, TARGET, FEATURES, "logistic", "classification", regParam=0.01)
    return m.score(df).select("gameId", TARGET, "predProb", "predClass")


# ---- games with columns of few values ----------------------------------------------------------------------


def _rows(spark, d):
    """`won` is NULL for even games and those without figures on a side; `strong` is a home side of 50 runs and more."""
    home, away = (F.when(F.col(c).isNotNull(), F.least(F.floor(F.col(c) / 10), F.lit(20))) for c in ("homeRuns", "awayRuns"))
    return games(spark, d).select(
        "gameId", "gameDate", (F.col("gameDate") >= F.lit(START).cast("timestamp_ntz")).alias("late"),
        F.when(F.col("homeRuns") != F.col("awayRuns"), (F.col("homeRuns") > F.col("awayRuns")).cast("int")).alias("won"),
        (F.col("homeHits") / 1000).alias("y"), home.cast("double").alias("tensHome"), away.cast("double").alias("tensAway"),
        "homeSpread", F.col("overUnder").cast("double").alias("overUnder"),
        F.coalesce(F.col("homeRuns") >= 50, F.lit(False)).cast("double").alias("strong"), F.lit(7.0).alias("constant"))


_ROWS = GAMES_CTE + f""",
t AS (SELECT gameId, gameDate, gameDate >= TIMESTAMP '{START}' AS late, CASE WHEN homeRuns <> awayRuns THEN (homeRuns > awayRuns)::INTEGER END AS won,
    homeHits / 1000 AS y, CASE WHEN homeRuns IS NOT NULL THEN least(floor(homeRuns / 10), 20)::DOUBLE END AS "tensHome",
    CASE WHEN awayRuns IS NOT NULL THEN least(floor(awayRuns / 10), 20)::DOUBLE END AS "tensAway", homeSpread, overUnder::DOUBLE AS overUnder,
    coalesce(homeRuns >= 50, false)::INTEGER::DOUBLE AS strong FROM games),
h AS (SELECT avg(won) FILTER (strong = 1) AS above, avg(won) FILTER (strong = 0) AS below FROM t WHERE NOT late AND won IS NOT NULL),
z AS (SELECT gameId, late, won, y, strong, CASE WHEN strong = 1 THEN above ELSE below END AS share FROM t, h),
m AS (SELECT avg("tensHome") AS a, avg("tensAway") AS b, avg(homeSpread) AS c, avg(overUnder) AS e FROM t WHERE NOT late AND won IS NOT NULL),
c0 AS (SELECT gameId, late, won, coalesce("tensHome", a) AS "tensHome", coalesce("tensAway", b) AS "tensAway", coalesce(homeSpread, c) AS homeSpread,
    coalesce(overUnder, e) AS overUnder, 0.0::DOUBLE AS f FROM t, m)"""

_NAMES = ", ".join(f"'{c}'" for c in TREE)
_VALUES = ", ".join(f'"{c}"' for c in TREE)
_PICKED = "CASE feature " + " ".join(f"WHEN '{c}' THEN \"{c}\"" for c in TREE) + " END"


def _split(i: int, rest: str) -> str:
    """`b{i}`: of all splits of all features the one that leaves least squared error of `rest`, and the means beside it."""
    return f""",
u{i} AS (SELECT feature, value, sum(r) AS s, count(*) AS n FROM (SELECT unnest([{_NAMES}]) AS feature, unnest([{_VALUES}]) AS value, {rest} AS r
    FROM c{i - 1} WHERE NOT late AND won IS NOT NULL) GROUP BY ALL),
w{i} AS (SELECT feature, value, sum(s) OVER k AS ls, sum(n) OVER k AS ln, sum(s) OVER g AS ts, sum(n) OVER g AS tn FROM u{i}
    WINDOW k AS (PARTITION BY feature ORDER BY value), g AS (PARTITION BY feature)),
b{i} AS (SELECT feature, value, ls / ln AS low, (ts - ls) / (tn - ln) AS high, ts / tn AS whole, ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn AS gain
    FROM w{i} WHERE ln >= 3 AND tn - ln >= 3 ORDER BY gain DESC, feature, value LIMIT 1)"""


def _boosted(rounds: int, step: float) -> str:
    """Rounds of trees of one split on the gradient of the logistic loss; `c{rounds}` has the margins."""
    sql = _ROWS
    for i in range(1, rounds + 1):
        rest = "2 * won - 1" if i == 1 else "4 * (2 * won - 1) / (1 + exp(2 * (2 * won - 1) * f))"
        sql += _split(i, rest) + f""",
c{i} AS (SELECT c.* REPLACE (f + {1.0 if i == 1 else step} * CASE WHEN {_PICKED} <= value THEN low ELSE high END AS f) FROM c{i - 1} AS c, b{i})"""
    return sql


_FOREST = _ROWS + _split(1, "won") + f""",
v AS (SELECT c.gameId, c.late, CASE WHEN (low > 0.5) = (high > 0.5) THEN whole WHEN {_PICKED} <= value THEN low ELSE high END AS p FROM c0 AS c, b1)"""


def _early(rows, label="won"):
    return pinned(rows.where(~F.col("late")).dropna(subset=[label]).drop("gameDate", "late"))


def _scores(spark, d, name, features, places=6, **params):
    rows = _rows(spark, d)
    m = md.fit(_early(rows), "won", features, name, "classification", **params)
    return m.score(rows.where("late")).select("gameId", "won", F.round("predProb", places).alias("predProb"), "predClass")


@query("scores_logistic", f'WITH {_ROWS} SELECT gameId, won, round(share, 4) AS "predProb", (share > 0.5)::INTEGER AS "predClass" FROM z WHERE late')
def scores_logistic(spark, d):
    """The curve of one flag passes through the shares of both its values."""
    return _scores(spark, d, "logistic", ["strong"], 4, **TO_THE_END)


@query("scores_network", f'WITH {_ROWS} SELECT gameId, won, true AS near, (share > 0.5)::INTEGER AS "predClass" FROM z WHERE late')
def scores_network(spark, d):
    """A network fitted to the end on one flag comes near the same shares; not nearer, as it weighs blocks of rows alike whatever their size."""
    rows = _rows(spark, d)
    seen = _early(rows)
    m = md.fit(seen, "won", ["strong"], "nn", "classification", hidden=4, **TO_THE_END)
    share = seen.groupBy(F.col("strong").alias("_s")).agg(F.avg("won").alias("share"))  # two rows
    scored = m.score(rows.where("late")).join(F.broadcast(share), F.col("strong") == F.col("_s"))
    return scored.select("gameId", "won", (F.abs(F.col("predProb") - F.col("share")) < 0.01).alias("near"), "predClass")


@query("scores_boosted", f"""
WITH {_boosted(3, 0.3)} SELECT gameId, won, round(1 / (1 + exp(-2 * f)), 6) AS "predProb", (f > 0)::INTEGER AS "predClass" FROM c3 WHERE late""")
def scores_boosted(spark, d):
    return _scores(spark, d, "xgb", TREE, maxIter=3, stepSize=0.3, **ONE_SPLIT)


@query("scores_forest", f"""
WITH {_FOREST} SELECT gameId, won, round(p, 6) AS "predProb", (p > 0.5)::INTEGER AS "predClass" FROM v JOIN (SELECT gameId, won FROM t) USING (gameId) WHERE late""")
def scores_forest(spark, d):
    """Trees that see all rows and features are one tree; a split with one class on both sides is taken back."""
    return _scores(spark, d, "rf", TREE, **ALL_ROWS)


@query("ensemble_boosting", f"""
WITH {_boosted(2, 0.1)} SELECT gameId, round(1 / (1 + exp(-2 * f)), 6) AS "predProb", (f > 0)::INTEGER AS "predClass" FROM c2 WHERE late""")
def ensemble_boosting(spark, d):
    rows = _rows(spark, d)
    m = md.boosting_ensemble(_early(rows), "won", TREE, maxIter=2, **ONE_SPLIT)
    return m.score(rows.where("late")).select("gameId", r6("predProb"), "predClass")


@query("importance_boosted", f"""
WITH {_boosted(1, 0.3)} SELECT feature, (feature = b.f)::INTEGER::DOUBLE AS importance, (feature = b.f)::INTEGER * 100.0::DOUBLE AS percent
FROM (SELECT unnest([{_NAMES}]) AS feature), (SELECT feature AS f FROM b1) AS b""")
def importance_boosted(spark, d):
    """The feature of the best of all splits has the whole importance of a tree of one split."""
    m = md.fit(_early(_rows(spark, d)), "won", TREE, "xgb", "classification", maxIter=1, **ONE_SPLIT)
    return md.importance(spark, m)


@query("importance_permuted", f"""
WITH {_ROWS}, x AS (SELECT gameId, won, strong, (CASE WHEN strong = 1 THEN above ELSE below END > 0.5)::INTEGER AS pred FROM t, h WHERE late AND won IS NOT NULL),
p AS (SELECT r, won, pred, row_number() OVER (PARTITION BY r ORDER BY gameId) AS own, row_number() OVER (PARTITION BY r ORDER BY (gameId * 7919 + r * 13) % 10007, gameId) AS other
    FROM x, range(2) k(r)),
v AS (SELECT avg((a.pred = a.won)::INTEGER) - avg((b.pred = a.won)::INTEGER) AS fall FROM p AS a JOIN p AS b ON a.r = b.r AND a.own = b.other)
SELECT 'strong' AS feature, round(fall, 6) AS importance, CASE WHEN fall <> 0 THEN 100.0 ELSE 0.0 END::DOUBLE AS percent FROM v UNION ALL SELECT 'constant', 0.0, 0.0""")
def importance_permuted(spark, d):
    """Drop in accuracy on games that the fit has not seen."""
    rows = _rows(spark, d)
    m = md.fit(_early(rows), "won", ["strong", "constant"], "lr", "classification", **TO_THE_END)
    dealt = md.permutation_importance(m, rows.where("late"), "won", "gameId", 2, shuffle=lambda r: (F.col("gameId") * 7919 + r * 13) % 10007)
    return dealt.select("feature", r6("importance"), r6("percent"))


@query("ensemble_vote", f"""
WITH {_FOREST}, o AS (SELECT v.gameId, share, p, (2 * share + p) / 3 AS mixed FROM v JOIN z USING (gameId) WHERE v.late)
SELECT gameId, round(share, 4) AS lr_score, round(p, 6) AS rf_score, round(mixed, 4) AS "predProb", (mixed > 0.5)::INTEGER AS "predClass" FROM o""")
def ensemble_vote(spark, d):
    rows = _rows(spark, d)
    seen = _early(rows)
    pair = {"lr": md.fit(seen, "won", ["strong"], "lr", "classification", **TO_THE_END),
            "rf": md.fit(seen, "won", TREE, "rf", "classification", **ALL_ROWS)}
    return md.vote(pair, rows.where("late"), {"lr": 2.0, "rf": 1.0}).select(
        "gameId", F.round("lr_score", 4).alias("lr_score"), r6("rf_score"), F.round("predProb", 4).alias("predProb"), "predClass")


# ---- lines -------------------------------------------------------------------------------------------------

_NORMAL = """(y1 * v2 - y2 * c12) / (v1 * v2 - c12 * c12) AS b1, (y2 * v1 - y1 * c12) / (v1 * v2 - c12 * c12) AS b2, my, m1, m2"""
_MOMENTS = """covar_pop(y, x1) AS y1, covar_pop(y, x2) AS y2, covar_pop(x1, x2) AS c12, var_pop(x1) AS v1, var_pop(x2) AS v2, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2"""
_FIGURES = """1 - sum(e * e) / (var_pop(y) * count(y)) AS r2, avg(e * e) AS mse, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, median(abs(e)) AS median_ae,
    avg(CASE WHEN y <> 0 THEN abs(e / y) END) * 100 AS mape"""


def _line_rows(spark, d):
    return pinned(_rows(spark, d).where("y IS NOT NULL").select("gameId", "gameDate", "late", "y", "tensHome", "tensAway"))


@query("scores_regression", f"""
WITH {_ROWS}, k AS (SELECT avg("tensAway") AS a FROM t WHERE NOT late AND y IS NOT NULL),
x AS (SELECT gameId, late, y, "tensHome" AS x1, coalesce("tensAway", a) AS x2 FROM t, k WHERE y IS NOT NULL),
s AS (SELECT {_MOMENTS} FROM x WHERE NOT late), l AS (SELECT {_NORMAL} FROM s)
SELECT gameId, y, round(my + b1 * (x1 - m1) + b2 * (x2 - m2), 6) AS prediction FROM x, l WHERE late""")
def scores_regression(spark, d):
    rows = _line_rows(spark, d)
    m = md.fit(rows.where("NOT late"), "y", ["tensHome", "tensAway"], "linear", "regression")
    return m.score(rows.where("late")).select("gameId", "y", r6("prediction"))


CENTRED_OR_NOT = [{"fitIntercept": False}, {"fitIntercept": True}]


@query("time_split_metrics", f"""
WITH {_ROWS}, x AS (SELECT y, "tensHome" AS x, row_number() OVER (ORDER BY gameDate, gameId) AS p, count(*) OVER () AS n FROM t WHERE y IS NOT NULL),
f AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM x WHERE p <= floor(round(n * 0.8, 6))),
o AS (SELECT y, y - (s * x + i) AS e FROM x, f WHERE p > floor(round(n * 0.8, 6))), g AS (SELECT {_FIGURES} FROM o)
SELECT round(r2, 6) AS r2, round(mse, 4) AS mse, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(median_ae, 6) AS median_ae, round(mape, 4) AS mape FROM g""")
def time_split_metrics(spark, d):
    """Split by time, parameters by folds that follow each other in time, figures on the rows after the cut."""
    t = md.train(_line_rows(spark, d), "y", ["tensHome"], "gameId", "lr", "regression", "rmse", folds=2, split="time",
                 time_col="gameDate", candidates=CENTRED_OR_NOT)
    return t.metrics(t.test, "y").select(r6("r2"), F.round("mse", 4).alias("mse"), r6("rmse"), r6("mae"), r6("median_ae"), F.round("mape", 4).alias("mape"))


@query("cross_validated_search", f"""
WITH {_ROWS}, q AS (SELECT y, "tensHome" AS x, floor((row_number() OVER (ORDER BY gameDate, gameId) - 1) * 4 / count(*) OVER ()) AS fold FROM t WHERE y IS NOT NULL),
k AS (SELECT i, fold = i AS own, y, x FROM q, range(1, 4) r(i) WHERE fold <= i),
f AS (SELECT i, regr_slope(y, x) AS s, avg(y) AS my, avg(x) AS mx FROM k WHERE NOT own GROUP BY 1),
e AS (SELECT i, sqrt(avg((s * (x - mx) - y) ** 2)) AS bare, sqrt(avg((my + s * (x - mx) - y) ** 2)) AS whole FROM k JOIN f USING (i) WHERE own GROUP BY 1),
a AS (SELECT avg(bare) AS bare, avg(whole) AS whole FROM e)
SELECT false AS intercept, round(bare, 6) AS score, bare < whole AS best FROM a UNION ALL SELECT true, round(whole, 6), whole <= bare FROM a""")
def cross_validated_search(spark, d):
    """Two candidates over three folds in time: a line with and one without an intercept."""
    best, scores = md.search(_line_rows(spark, d), "y", ["tensHome"], "gameId", "lr", "regression", "rmse", folds=3, time_col="gameDate",
                             candidates=CENTRED_OR_NOT)
    found = [(p["fitIntercept"], round(s, 6), p == best) for p, s in zip(CENTRED_OR_NOT, scores, strict=True)]
    return spark.createDataFrame(found, "intercept boolean, score double, best boolean")


@query("repeated_training", f"""
WITH {_ROWS}, x AS (SELECT run, gameId % 5 = run AS own, y, "tensHome" AS x FROM t, range(3) r(run) WHERE y IS NOT NULL),
f AS (SELECT run, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM x WHERE NOT own GROUP BY 1),
o AS (SELECT run, y, y - (s * x + i) AS e FROM x JOIN f USING (run) WHERE own), g AS (SELECT run, {_FIGURES} FROM o GROUP BY 1),
l AS (UNPIVOT g ON r2, mse, rmse, mae, median_ae, mape INTO NAME metric VALUE value)
SELECT metric, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std, count(*) AS runs FROM l GROUP BY 1""")
def repeated_training(spark, d):
    """Three runs, each tested on another fifth of the games."""
    scores, _ = md.repeat_training(_line_rows(spark, d), "y", ["tensHome"], "gameId", "lr", runs=3, tests=lambda run: F.col("gameId") % 5 == run)
    return mt.average_over_runs(scores).select("metric", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "runs")


@query("ensemble_stack", f"""
WITH {_ROWS}, q AS (SELECT gameId, gameId % 2 AS fold, y, "tensHome" AS x FROM t WHERE y IS NOT NULL),
k AS (SELECT i, i = 2 OR fold <> i AS seen, i = 2 OR fold = i AS own, gameId, y, x FROM q, range(3) r(i)),
f AS (SELECT i, regr_slope(y, x) AS s, regr_intercept(y, x) AS c FROM k WHERE seen GROUP BY 1),
u AS (SELECT i, x AS value, sum(y) AS s, count(*) AS n FROM k WHERE seen GROUP BY ALL),
w AS (SELECT i, value, sum(s) OVER p AS ls, sum(n) OVER p AS ln, sum(s) OVER g AS ts, sum(n) OVER g AS tn FROM u WINDOW p AS (PARTITION BY i ORDER BY value), g AS (PARTITION BY i)),
b AS (SELECT i, value, ls / ln AS low, (ts - ls) / (tn - ln) AS high FROM w WHERE ln >= 3 AND tn - ln >= 3
    QUALIFY row_number() OVER (PARTITION BY i ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC, value) = 1),
o AS (SELECT i, gameId, y, f.s * x + c AS x1, CASE WHEN x <= value THEN low ELSE high END AS x2 FROM k JOIN f USING (i) JOIN b USING (i) WHERE own),
a AS (SELECT {_MOMENTS} FROM o WHERE i < 2), l AS (SELECT {_NORMAL} FROM a)
SELECT gameId, round(x1, 6) AS lr_score, round(x2, 6) AS rf_score, round(my + b1 * (x1 - m1) + b2 * (x2 - m2), 4) AS prediction FROM o, l WHERE i = 2""")
def ensemble_stack(spark, d):
    """A line over a line and a tree of one split, learned from scores of members that had not seen the row."""
    rows = _line_rows(spark, d).withColumn("half", (F.col("gameId") % 2).cast("int"))
    s = md.stack(rows, "y", ["tensHome"], "gameId", ["lr", "rf"], {"rf": ALL_ROWS}, folds=2, problem="regression", fold="half")
    return s.score(rows).select("gameId", r6("lr_score"), r6("rf_score"), F.round("prediction", 4).alias("prediction"))


AS_OF = "2000-01-01 00:00:00"


def _picks(spark, d, features, name, **params):
    """History before the day trains the model; games from then on are picked."""
    games = stored(hoops(spark, d))  # history, upcoming games and their names all read it
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    table = basketball.build_model_table(games, basketball.SPREAD_STATS, [3], "homeCover")
    history = pinned(table.where(F.col("startDate") < as_of).dropna(subset=["homeCover"]))
    m = md.fit(history, "homeCover", features, name, "classification", **params)
    info = games.select("gameId", "startDate", F.concat(F.lit("Team "), "homeTeamId").alias("homeTeam"),
                        F.concat(F.lit("Team "), "awayTeamId").alias("awayTeam"), F.lit("Hall").alias("venue"))
    return spread_picks(games, info, m.model, as_of, features=features)


@query("daily_spread_picks")
def daily_spread_picks(spark, d):
    return _picks(spark, d, basketball.SPREAD_FEATURES, "lr")


@query("daily_picks_of_one_split", f"""
WITH {HOOPS_CTE}, t AS (SELECT *, CASE WHEN homePoints + homeSpread <> awayPoints THEN (homePoints + homeSpread > awayPoints)::INTEGER END AS cover FROM hoops
    WHERE NOT coalesce(homePoints + homeSpread = awayPoints, false)),
u AS (SELECT homeSpread AS value, sum(2 * cover - 1) AS s, count(*) AS n FROM t WHERE startDate < TIMESTAMP '{AS_OF}' AND cover IS NOT NULL GROUP BY 1),
w AS (SELECT value, sum(s) OVER k AS ls, sum(n) OVER k AS ln, sum(s) OVER () AS ts, sum(n) OVER () AS tn FROM u WINDOW k AS (ORDER BY value)),
b AS (SELECT value, ls / ln AS low, (ts - ls) / (tn - ln) AS high FROM w WHERE ln >= 3 AND tn - ln >= 3
    ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC, value LIMIT 1),
o AS (SELECT *, 1 / (1 + exp(-2 * CASE WHEN homeSpread <= value THEN low ELSE high END)) AS p FROM t, b WHERE startDate >= TIMESTAMP '{AS_OF}' AND homeSpread IS NOT NULL)
SELECT gameId, 'Team ' || homeTeamId AS "homeTeam", 'Team ' || awayTeamId AS "awayTeam", startDate AS "startDate", 'Hall' AS venue, homeSpread, round(p, 6) AS "predProb",
  (p > 0.5)::INTEGER AS "predClass", CASE WHEN p <= {basketball.LOWER_THRESHOLD} THEN 'AWAY' ELSE 'HOME' END AS "pickSide",
  round(CASE WHEN p <= {basketball.LOWER_THRESHOLD} THEN 1 - p ELSE p END - {BREAK_EVEN}, 6) AS edge
FROM o WHERE p <= {basketball.LOWER_THRESHOLD} OR p >= {basketball.UPPER_THRESHOLD}""")
def daily_picks_of_one_split(spark, d):
    picks = _picks(spark, d, ["homeSpread"], "xgb", maxIter=1, **ONE_SPLIT)
    return picks.select("gameId", "homeTeam", "awayTeam", "startDate", "venue", "homeSpread", r6("predProb"), "predClass", "pickSide", r6("edge"))
