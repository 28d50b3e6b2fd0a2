"""Model jobs whose whole results SQL can derive: least squares on one column, ranks, folds and medians of training rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldhouse.plans import comparison as cp
from fieldhouse.plans import models as md
from fieldhouse.session import ensure_checkpoint_dir, pinned
from fieldhouse.workload.registry import query, r6
from fieldhouse.workload.views import GAMES_CTE, games

START = "1997-01-01"


def _late():
    return F.col("gameDate") >= F.lit(START).cast("timestamp_ntz")


def _rows(spark, d):
    """Home hits in thousands beside columns of every kind that a preparation knows."""
    away = F.coalesce("awayRuns", F.lit(0))
    return games(spark, d).select(
        "gameId", "gameDate", (F.col("homeHits") / 1000).alias("y"), "homeRuns", "awayRuns", "homeOBP",
        F.concat(F.lit("s"), F.col("gameId") % 4).alias("slot"), F.when(F.col("gameId") % 2 == 0, "a").otherwise("b").alias("half"),
        F.concat(F.lit("Game "), "gameId").alias("title"),
        F.when(F.col("homeRuns") > away, "home").when(F.col("homeRuns") < away, "away").otherwise("even").alias("outcome"))


_ROWS = GAMES_CTE + f""",
t AS (SELECT gameId, gameDate >= TIMESTAMP '{START}' AS late, homeHits / 1000 AS y, homeRuns, awayRuns, homeOBP, 's' || (gameId % 4) AS slot,
    CASE WHEN gameId % 2 = 0 THEN 'a' ELSE 'b' END AS half,
    CASE WHEN homeRuns > coalesce(awayRuns, 0) THEN 'home' WHEN homeRuns < coalesce(awayRuns, 0) THEN 'away' ELSE 'even' END AS outcome FROM games),
u AS (SELECT * FROM t WHERE y IS NOT NULL)"""


@query("prepared_from_training_rows", f"""
WITH {_ROWS}, m AS (SELECT median(homeRuns) AS a, median(awayRuns) AS b, median(homeOBP) AS c FROM t WHERE NOT late)
SELECT gameId, CAST(coalesce(homeRuns, a) AS DOUBLE) AS "p_homeRuns", CAST(coalesce(awayRuns, b) AS DOUBLE) AS "p_awayRuns", coalesce(homeOBP, c) AS "p_homeOBP",
  (half = 'b')::INT::DOUBLE AS p_half_b, (slot = 's0')::INT::DOUBLE AS p_slot_s0, (slot = 's1')::INT::DOUBLE AS p_slot_s1, (slot = 's2')::INT::DOUBLE AS p_slot_s2,
  list_position(['away', 'even', 'home'], outcome)::DOUBLE - 1 AS actual FROM t, m""")
def prepared_from_training_rows(spark, d):
    """Learned on the games before the start, applied to all; the titles have too many values to be used."""
    rows = _rows(spark, d).drop("y")
    prep = cp.Preparation.fit(pinned(rows.where(~_late())), "outcome", skip=["gameId", "gameDate"])
    out = prep.stage().transform(prep.aligned(rows, ["gameId"]))
    return out.select("gameId", *prep.features, "actual")


LINES = {"by_home_runs": "p_homeRuns", "by_away_runs": "p_awayRuns", "by_on_base": "p_homeOBP"}


def _compared(spark, d):
    rows = _rows(spark, d).select("gameId", "gameDate", "y", "homeRuns", "awayRuns", "homeOBP")
    specs = {name: {"kind": "linear", "features": [c]} for name, c in LINES.items()}
    return cp.compare(rows, "y", "gameId", specs, test=_late(), problem="regression", skip=["gameDate"])


_LINES = f"""{_ROWS}, m AS (SELECT median(homeRuns) AS a, median(awayRuns) AS b, median(homeOBP) AS c FROM u WHERE NOT late),
l AS (SELECT gameId, y, late, unnest(['by_home_runs', 'by_away_runs', 'by_on_base']) AS model,
    unnest([coalesce(homeRuns, a)::DOUBLE, coalesce(awayRuns, b)::DOUBLE, coalesce(homeOBP, c)::DOUBLE]) AS x FROM u, m),
f AS (SELECT model, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM l WHERE NOT late GROUP BY 1),
p AS (SELECT model, gameId, y, s * x + i AS pred, y - (s * x + i) AS e FROM l JOIN f USING (model) WHERE late),
g AS (SELECT model, count(*) AS rows, round(1 - sum(e * e) / (var_pop(y) * count(y)), 6) AS r2, round(avg(e * e), 4) AS mse,
    round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, round(median(abs(e)), 6) AS median_ae, round(avg(abs(e / y)) * 100, 4) AS mape FROM p GROUP BY 1)"""


def _rounded(figures, *keep):
    return figures.select(*keep, "rows", r6("r2"), F.round("mse", 4).alias("mse"), r6("rmse"), r6("mae"), r6("median_ae"), F.round("mape", 4).alias("mape"))


@query("models_compared_unseen", f"WITH {_LINES} SELECT * FROM g")
def models_compared_unseen(spark, d):
    return _rounded(_compared(spark, d).metrics, "model")


@query("saved_model_scores", f"WITH {_LINES} SELECT model, gameId, round(y, 6) AS actual, round(pred, 6) AS pred FROM p WHERE model = 'by_away_runs'")
def saved_model_scores(spark, d):
    """Saved with its preparation, loaded again, and given raw rows."""
    return _reloaded(spark, d)[0].select("model", "gameId", r6("actual"), r6("pred"))


@query("saved_model_figures", f"WITH {_LINES} SELECT * FROM g WHERE model = 'by_away_runs'")
def saved_model_figures(spark, d):
    return _rounded(_reloaded(spark, d)[1], "model")


def _reloaded(spark, d):
    rows = _rows(spark, d).where("y IS NOT NULL")
    early = pinned(rows.where(~_late()).select("y", "homeRuns", "awayRuns", "homeOBP"))
    m = cp.fit(early, cp.Preparation.fit(early, "y", problem="regression"), "by_away_runs", "linear", ["p_awayRuns"])
    path = cp.save(m, f"{ensure_checkpoint_dir(spark)}/fieldhouse-models/{uuid.uuid4().hex}")
    return cp.evaluate(path, rows.where(_late()).drop("homeOBP"), "gameId")


@query("scores_of_three_classes", f"WITH {_ROWS} SELECT gameId, outcome, true AS known, 3 AS classes, 1.0::DOUBLE AS total, true AS largest FROM t")
def scores_of_three_classes(spark, d):
    """Boosted trees, one class against the rest: a label of the target for every game, and chances that add up to one."""
    rows = _rows(spark, d).select("gameId", "outcome", "homeRuns", "awayRuns")
    seen = pinned(rows.select("outcome", "homeRuns", "awayRuns"))
    m = cp.fit(seen, cp.Preparation.fit(seen, "outcome"), "boosted", "xgb", maxIter=3, maxDepth=3)
    out = m.labelled(rows, "gameId").join(rows.select("gameId", "outcome"), "gameId")
    place = F.array_position(F.array(*map(F.lit, m.preparation.labels)), F.col("label"))
    return out.select("gameId", "outcome", F.col("label").isin("away", "even", "home").alias("known"), F.size("probabilities").alias("classes"),
                      r6(F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b), "total"),
                      (F.element_at("probabilities", place.cast("int")) == F.array_max("probabilities")).alias("largest"))


@query("ensembles_compared", f"""
WITH {_ROWS}, n AS (SELECT gameId % 3 AS fold, gameId, y, homeRuns, awayRuns FROM u),
k AS (SELECT i AS own, fold = i AS inside, gameId, y, homeRuns, awayRuns FROM n, range(3) r(i)),
m AS (SELECT own, median(homeRuns) AS a, median(awayRuns) AS b FROM k WHERE NOT inside GROUP BY 1),
l AS (SELECT own, inside, gameId, y, unnest(['away', 'home']) AS model, unnest([coalesce(awayRuns, b)::DOUBLE, coalesce(homeRuns, a)::DOUBLE]) AS x FROM k JOIN m USING (own)),
f AS (SELECT own, model, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM l WHERE NOT inside GROUP BY ALL),
o AS (SELECT own AS fold, model, gameId, y, s * x + i AS score FROM l JOIN f USING (own, model) WHERE inside),
v AS (SELECT i AS fold, model, 1 / sqrt(avg((score - y) ** 2)) AS raw FROM o, range(3) r(i) WHERE fold <> i GROUP BY ALL),
w AS (SELECT o.fold, gameId, any_value(y) AS y, avg(score) AS vote, sum(score * raw) / sum(raw) AS weighted,
    any_value(score) FILTER (model = 'away') AS x1, any_value(score) FILTER (model = 'home') AS x2 FROM o JOIN v USING (fold, model) GROUP BY ALL),
c AS (SELECT i AS fold, covar_pop(y, x1) AS y1, covar_pop(y, x2) AS y2, covar_pop(x1, x2) AS c12, var_pop(x1) AS v1, var_pop(x2) AS v2,
    avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2 FROM w, range(3) r(i) WHERE fold <> i GROUP BY 1),
b AS (SELECT *, (y1 * v2 - y2 * c12) / (v1 * v2 - c12 * c12) AS b1, (y2 * v1 - y1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM c),
e AS (SELECT model, y, score - y AS e FROM o UNION ALL SELECT 'vote', y, vote - y FROM w UNION ALL SELECT 'weighted', y, weighted - y FROM w
    UNION ALL SELECT 'stack', y, my + b1 * (x1 - m1) + b2 * (x2 - m2) - y FROM w JOIN b USING (fold)),
g AS (SELECT model, count(*) AS rows, 1 - sum(e * e) / (var_pop(y) * count(y)) AS r2, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae FROM e GROUP BY 1)
SELECT model, rows, round(r2, 6) AS r2, round(rmse, 6) AS rmse, round(mae, 6) AS mae, rmse = min(rmse) OVER () AS chosen FROM g""")
def ensembles_compared(spark, d):
    rows = _rows(spark, d).select("gameId", "y", "homeRuns", "awayRuns", (F.col("gameId") % 3).cast("int").alias("fold"))
    members = {"away": {"kind": "linear", "features": ["p_awayRuns"]}, "home": {"kind": "linear", "features": ["p_homeRuns"]}}
    _, figures = cp.compare_ensembles(rows, "y", "gameId", "fold", range(3), members, problem="regression")
    return figures.select("model", "rows", r6("r2"), r6("rmse"), r6("mae"), "chosen")


@query("importance_dealt_anew", f"""
WITH {_ROWS}, x AS (SELECT gameId, y, coalesce(awayRuns, avg(awayRuns) OVER ())::DOUBLE AS x FROM u),
f AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM x),
p AS (SELECT r, y, x, row_number() OVER (PARTITION BY r ORDER BY gameId) AS own, row_number() OVER (PARTITION BY r ORDER BY (gameId * 7919 + r * 13) % 10007, gameId) AS other
    FROM x, range(2) t(r)),
q AS (SELECT a.y, a.x, b.x AS dealt FROM p AS a JOIN p AS b ON a.r = b.r AND a.own = b.other),
v AS (SELECT avg((s * dealt + i - y) ** 2) - avg((s * x + i - y) ** 2) AS rise FROM q, f)
SELECT 'awayRuns' AS feature, round(rise, 6) AS importance, 100.0::DOUBLE AS percent FROM v UNION ALL SELECT 'constant', 0.0, 0.0""")
def importance_dealt_anew(spark, d):
    """Rows without away runs count at the mean; a constant column loses nothing."""
    rows = pinned(_rows(spark, d).where("y IS NOT NULL").select("gameId", "y", "awayRuns", F.lit(7.0).alias("constant")))
    m = md.fit(rows, "y", ["awayRuns", "constant"], "linear", "regression")
    dealt = md.permutation_importance(m, rows, "y", "gameId", 2, shuffle=lambda r: (F.col("gameId") * 7919 + r * 13) % 10007)
    return dealt.select("feature", r6("importance"), r6("percent"))


@query("auc_of_both_sides", f"""
WITH {_ROWS}, x AS (SELECT run, CASE WHEN gameId % 5 = run THEN 'test' ELSE 'train' END AS side, y, (homeRuns > awayRuns)::INT AS won
    FROM u, range(3) r(run) WHERE homeRuns > awayRuns IS NOT NULL),
k AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY run, side, y) - 1) / 2 AS place FROM x WINDOW w AS (PARTITION BY run, side ORDER BY y))
SELECT run::INT AS run, side, round((sum(place) FILTER (won = 1) - sum(won) * (sum(won) + 1) / 2) / (sum(won) * sum(1 - won)), 6) AS auc FROM k GROUP BY run, side""")
def auc_of_both_sides(spark, d):
    """A logistic curve of one rising column ranks as the column does."""
    rows = _rows(spark, d).withColumn("won", (F.col("homeRuns") > F.col("awayRuns")).cast("int"))
    tests = {r: F.col("gameId") % 5 == r for r in range(3)}
    found = cp.auc_over_runs(rows.where("y IS NOT NULL"), "won", "gameId", "lr", ["y"], tests)
    return found.select("run", "side", r6("auc"))
