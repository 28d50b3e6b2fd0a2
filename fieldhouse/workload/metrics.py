"""Model-quality queries over scored games and labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldhouse.operators import metrics as mt
from fieldhouse.workload.registry import query, r6
from fieldhouse.workload.views import GAMES_CTE, SCORED_CTE, games, scored, table


def labels(spark, d):
    return table(spark, d, "labels").select(
        "doc_id", F.col("quality").alias("actual"), F.col("toxic").alias("pred"))


_PAIRS = "pairs AS (SELECT quality AS actual, toxic AS pred, count(*) AS n FROM labels GROUP BY ALL)"
_REPORT = f"""{_PAIRS}, classes AS (SELECT actual AS class FROM pairs UNION SELECT pred FROM pairs),
report AS (SELECT class, coalesce(sum(n) FILTER (actual = class AND pred = class), 0)::BIGINT AS tp,
  coalesce(sum(n) FILTER (actual <> class AND pred = class), 0)::BIGINT AS fp,
  coalesce(sum(n) FILTER (actual = class AND pred <> class), 0)::BIGINT AS fn,
  coalesce(sum(n) FILTER (actual <> class AND pred <> class), 0)::BIGINT AS tn
  FROM classes, pairs GROUP BY class),
full_report AS (SELECT class, tp, fp, fn, tn, tp + fn AS support, tp / nullif(tp + fn, 0)::DOUBLE AS recall,
  tp / nullif(tp + fp, 0)::DOUBLE AS precision FROM report)"""


@query("confusion_matrix", f"WITH {_PAIRS} SELECT * FROM pairs")
def confusion_matrix(spark, d):
    return mt.confusion(labels(spark, d))


@query("confusion_wide", """
SELECT quality AS actual, count(*) FILTER (toxic = 0) AS predicted_0, count(*) FILTER (toxic = 1) AS predicted_1
FROM labels GROUP BY quality""")
def confusion_wide(spark, d):
    return mt.confusion_wide(labels(spark, d), [0, 1])


@query("confusion_report", f"""
WITH {_REPORT} SELECT class, tp, fp, fn, tn, support, round(recall, 6) AS recall, round(precision, 6) AS precision
FROM full_report""")
def confusion_report(spark, d):
    r = mt.class_report(mt.confusion(labels(spark, d)))
    return r.select("class", "tp", "fp", "fn", "tn", "support", r6("recall"), r6("precision"))


_RUNS = """pairs AS (SELECT l_linenumber AS actual, (l_quantity % 7)::INTEGER + 1 AS pred, count(*) AS n
  FROM lineitem GROUP BY ALL)"""


@query("common_mistakes", f"WITH {_RUNS} SELECT * FROM pairs WHERE actual <> pred ORDER BY n DESC, actual, pred LIMIT 3")
def common_mistakes(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_linenumber").alias("actual"), ((F.col("l_quantity") % 7).cast("int") + 1).alias("pred"))
    return mt.common_mistakes(mt.confusion(rows), 3)


@query("class_accuracy", """
WITH c AS (SELECT unnest([0, 1, 2])::INTEGER AS class),
s AS (SELECT quality AS class, count(*) AS n, count(*) FILTER (quality = toxic) AS ok FROM labels GROUP BY 1)
SELECT class, coalesce(n, 0)::BIGINT AS rows, coalesce(ok, 0)::BIGINT AS correct, round(ok / n::DOUBLE, 6) AS accuracy
FROM c LEFT JOIN s USING (class)""")
def class_accuracy(spark, d):
    # class 2 exists in training data only, so it has no rows here
    rows = labels(spark, d)
    classes = rows.select(F.col("actual").alias("class")).unionByName(
        rows.limit(1).select(F.lit(2).alias("class")))
    return mt.class_accuracy(rows, classes).select("class", "rows", "correct", r6("accuracy"))


_CLASS_METRICS = """
SELECT round(sum(tp) / max(t)::DOUBLE, 6) AS accuracy, round(sum(coalesce(precision, 0) * w), 6) AS precision,
  round(sum(coalesce(recall, 0) * w), 6) AS recall,
  round(sum(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END * w), 6) AS f1
FROM (SELECT *, sum(support) OVER () AS t, support / sum(support) OVER ()::DOUBLE AS w FROM full_report)"""


@query("classification_metrics", f"WITH {_REPORT} {_CLASS_METRICS}")
def classification_metrics(spark, d):
    m = mt.classification_metrics(mt.confusion(labels(spark, d)))
    return m.select(*[r6(c) for c in m.columns])


def _regression(spark, d):
    return games(spark, d).select("gameId", F.col("homeRuns").alias("actual"), F.col("awayRuns").alias("predicted"))


_REG = f"{GAMES_CTE}, r AS (SELECT gameId, homeRuns AS actual, awayRuns AS predicted, homeRuns - awayRuns AS e FROM games WHERE homeRuns IS NOT NULL AND awayRuns IS NOT NULL)"


@query("regression_metrics", f"""
WITH {_REG} SELECT round(1 - sum(e * e) / (var_pop(actual) * count(*)), 6) AS r2, round(avg(e * e), 6) AS mse,
  round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, round(median(abs(e)), 6) AS median_ae,
  round(avg(abs(e / actual)) FILTER (actual <> 0) * 100, 6) AS mape FROM r""")
def regression_metrics(spark, d):
    m = mt.regression_metrics(_regression(spark, d))
    return m.select(*[r6(c) for c in m.columns])


@query("worst_predictions", f"""
WITH {_REG} SELECT gameId, actual, predicted, predicted - actual AS error, abs(e) AS abs_error FROM r
ORDER BY abs_error DESC, gameId LIMIT 5""")
def worst_predictions(spark, d):
    return mt.worst_predictions(_regression(spark, d))


_AUC = """ranks AS (SELECT {k} actual, rank() OVER ({p} ORDER BY proba) + (count(*) OVER ({p2} proba) - 1) / 2.0::DOUBLE AS r
  FROM scored),
auc AS (SELECT {k} (sum(r) FILTER (actual = 1) - count(*) FILTER (actual = 1) * (count(*) FILTER (actual = 1) + 1) / 2.0::DOUBLE)
  / (count(*) FILTER (actual = 1) * count(*) FILTER (actual = 0))::DOUBLE AS auc FROM ranks {g})"""


@query("auc_exact", f"WITH {SCORED_CTE}, {_AUC.format(k='', p='', p2='PARTITION BY', g='')} SELECT round(auc, 6) AS auc FROM auc")
def auc_exact(spark, d):
    return mt.auc(scored(spark, d)).select(r6("auc"))


_AUC_SEASON = _AUC.format(k="season,", p="PARTITION BY season", p2="PARTITION BY season,", g="GROUP BY season")


@query("auc_by_season", f"WITH {SCORED_CTE}, {_AUC_SEASON} SELECT season, round(auc, 6) AS auc FROM auc")
def auc_by_season(spark, d):
    return mt.auc(scored(spark, d), ["season"]).select("season", r6("auc"))


@query("auc_over_runs", f"""
WITH {SCORED_CTE}, {_AUC_SEASON}
SELECT 'auc' AS metric, round(avg(auc), 6) AS mean, round(stddev_pop(auc), 6) AS std, count(auc) AS runs FROM auc""")
def auc_over_runs(spark, d):
    per_run = mt.melt_metrics(mt.auc(scored(spark, d), ["season"]), ["season"])
    return mt.average_over_runs(per_run).select("metric", r6("mean"), r6("std"), "runs")


_ROC = """cnt AS (SELECT {k} proba AS score, count(*) FILTER (actual = 1) AS pos, count(*) FILTER (actual = 0) AS neg
  FROM scored GROUP BY ALL),
roc AS (SELECT {k} score, (sum(pos) OVER w)::BIGINT AS tp, (sum(neg) OVER w)::BIGINT AS fp,
  (sum(pos) OVER ({p}))::BIGINT AS p_all, (sum(neg) OVER ({p}))::BIGINT AS n_all
  FROM cnt WINDOW w AS ({p} ORDER BY score DESC))"""


@query("roc_points", f"""
WITH {SCORED_CTE}, {_ROC.format(k='', p='')}
SELECT score, tp, fp, round(fp / n_all::DOUBLE, 6) AS fpr, round(tp / p_all::DOUBLE, 6) AS tpr FROM roc""")
def roc_points(spark, d):
    return mt.roc_points(scored(spark, d)).select("score", "tp", "fp", r6("fpr"), r6("tpr"))


_GRID = f"""{SCORED_CTE}, {_ROC.format(k='season,', p='PARTITION BY season')},
pts AS (SELECT season, fp / n_all::DOUBLE AS x, max(tp / p_all::DOUBLE) AS hi, min(tp / p_all::DOUBLE) AS lo FROM roc GROUP BY ALL
  UNION ALL SELECT DISTINCT season, 0.0, 0.0, 0.0 FROM roc),
uniq AS (SELECT season, x, max(hi) AS hi, min(lo) AS lo FROM pts GROUP BY ALL),
seg AS (SELECT season, x, hi, lead(x) OVER w AS x1, lead(lo) OVER w AS y1 FROM uniq WINDOW w AS (PARTITION BY season ORDER BY x)),
grid AS (SELECT season, k, k / 99.0::DOUBLE AS g FROM range(100) t(k), (SELECT DISTINCT season FROM roc)),
curve AS (SELECT grid.season, k, g AS fpr, CASE WHEN k = 0 THEN 0.0 WHEN k = 99 THEN 1.0
  ELSE max(CASE WHEN abs(g - x) < 1e-12 OR x1 IS NULL THEN hi ELSE hi + (g - x) / (x1 - x) * (y1 - hi) END) END::DOUBLE AS tpr
  FROM grid JOIN seg ON seg.season = grid.season AND x <= g + 1e-12 AND (x1 > g + 1e-12 OR x1 IS NULL)
  GROUP BY grid.season, k, g)"""


@query("roc_grid", f"WITH {_GRID} SELECT season, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM curve")
def roc_grid(spark, d):
    return mt.roc_on_grid(mt.roc_points(scored(spark, d), ["season"]), ["season"]).select("season", r6("fpr"), r6("tpr"))


@query("mean_roc", f"""
WITH {_GRID} SELECT round(fpr, 6) AS fpr, round(avg(tpr), 6) AS mean_tpr, round(stddev_pop(tpr), 6) AS std_tpr,
  count(DISTINCT season) AS runs FROM curve GROUP BY fpr""")
def mean_roc(spark, d):
    curves = mt.roc_on_grid(mt.roc_points(scored(spark, d), ["season"]), ["season"])
    return mt.mean_roc(curves, "season").select(r6("fpr"), r6("mean_tpr"), r6("std_tpr"), "runs")


# three scorers of the same games: the given score, its mirror image, and a coin by key
_THREE = {"direct": "proba", "mirror": "round(1 - proba, 3)", "coin": "(gameId % 2)::DOUBLE"}


def _models(spark, d):
    rows = scored(spark, d)
    variants = F.array(*[
        F.struct(F.lit(m).alias("model"), p.alias("proba")) for m, p in (
            ("direct", F.col("proba")), ("mirror", F.round(1 - F.col("proba"), 3)),
            ("coin", (F.col("gameId") % 2).cast("double")))])
    return rows.select("gameId", "actual", F.inline(variants)).withColumn("pred", (F.col("proba") >= 0.5).cast("int"))


_MODELS = f"""{SCORED_CTE}, models AS ({" UNION ALL ".join(
    f"SELECT '{m}' AS model, gameId, actual, {e} AS proba, ({e} >= 0.5)::INTEGER AS pred FROM scored" for m, e in _THREE.items())}),
long AS (SELECT model, 'accuracy' AS metric, round(avg((pred = actual)::INTEGER), 6) AS value FROM models GROUP BY model
  UNION ALL SELECT model, 'mae', round(avg(abs(actual - proba)), 6) FROM models GROUP BY model)"""


def _metric_rows(spark, d):
    wide = _models(spark, d).groupBy("model").agg(
        r6(F.avg((F.col("pred") == F.col("actual")).cast("int")), "accuracy"),
        r6(F.avg(F.abs(F.col("actual") - F.col("proba"))), "mae"))
    return mt.melt_metrics(wide, ["model"])


@query("model_comparison", f"WITH {_MODELS} SELECT model, max(value) FILTER (metric = 'accuracy') AS accuracy, "
                           "max(value) FILTER (metric = 'mae') AS mae FROM long GROUP BY model")
def model_comparison(spark, d):
    return mt.comparison_table(_metric_rows(spark, d), ["accuracy", "mae"])


@query("best_models", f"""
WITH {_MODELS} SELECT metric, model, value FROM long QUALIFY row_number() OVER (PARTITION BY metric
  ORDER BY CASE WHEN metric = 'mae' THEN -value ELSE value END DESC, model) = 1""")
def best_models(spark, d):
    return mt.best_models(_metric_rows(spark, d))


@query("predictions_side_by_side", f"""
WITH {_MODELS} SELECT gameId, max(pred) FILTER (model = 'direct') AS direct_pred,
  max(pred) FILTER (model = 'mirror') AS mirror_pred FROM models GROUP BY gameId""")
def predictions_side_by_side(spark, d):
    rows = scored(spark, d)
    mirror = rows.withColumn("pred", (F.round(1 - F.col("proba"), 3) >= 0.5).cast("int"))
    return mt.side_by_side({"direct": rows, "mirror": mirror}, "gameId", ["pred"])


_FEATURES = ["homeRuns", "awayRuns", "homeHits", "awayHits", "homeOBP", "homeERA"]
_MEANS = f"""{GAMES_CTE}, won AS (SELECT *, (homeRuns > awayRuns)::INTEGER AS class FROM games WHERE homeRuns <> awayRuns),
means AS ({" UNION ALL ".join(
    f"SELECT class, '{f}' AS feature, avg({f}) AS mean, (SELECT avg({f}) FROM won) AS overall FROM won GROUP BY class"
    for f in _FEATURES)})"""


def _class_means(spark, d):
    won = games(spark, d).where("homeRuns <> awayRuns").withColumn(
        "homeWin", (F.col("homeRuns") > F.col("awayRuns")).cast("int"))
    return mt.class_means(won, "homeWin", _FEATURES)


@query("class_means", f"WITH {_MEANS} SELECT class, feature, round(mean, 6) AS mean, round(overall, 6) AS overall FROM means")
def class_means(spark, d):
    return _class_means(spark, d).select("class", "feature", r6("mean"), r6("overall"))


@query("standout_features", f"""
WITH {_MEANS}, p AS (SELECT class, feature, round(mean, 3) AS mean, overall,
  abs(round(mean, 3) - overall) / CASE WHEN overall <> 0 THEN abs(overall) ELSE 1 END * 100 AS pct FROM means)
SELECT class, feature, mean, round(overall, 6) AS overall, round(pct, 6) AS pct,
  CASE WHEN mean > overall THEN 'above' ELSE 'below' END AS direction FROM p
QUALIFY row_number() OVER (PARTITION BY class ORDER BY pct DESC, feature) = 1""")
def standout_features(spark, d):
    return mt.standout_features(_class_means(spark, d)).select(
        "class", "feature", "mean", r6("overall"), r6("pct"), "direction")


@query("run_summary", """
SELECT event_type AS step, count(*) AS attempts, count(*) FILTER (value < 50) AS succeeded, sum(event_id % 100)::BIGINT AS rows,
  arg_max(value < 50, (ts, event_id)) AS last_success FROM events GROUP BY event_type""")
def run_summary(spark, d):
    log = table(spark, d, "events").select(
        F.col("event_type").alias("step"), (F.col("value") < 50).alias("success"),
        (F.col("event_id") % 100).alias("rows"), F.struct("ts", "event_id").alias("finished"))
    return mt.run_summary(log)
