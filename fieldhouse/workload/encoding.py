"""Encoding, filling and splitting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldhouse.operators import encoding as en
from fieldhouse.operators import splits as sp
from fieldhouse.operators.metrics import performance_weights
from fieldhouse.operators.sizing import beside
from fieldhouse.workload.registry import query, r6
from fieldhouse.workload.views import GAMES_CTE, games, table


@query("binary_columns", """
SELECT doc_id, quality = 1 AS quality_1, toxic = 1 AS toxic_1 FROM labels""")
def binary_columns(spark, d):
    return en.encode_binary(table(spark, d, "labels"), skip=["doc_id"])


@query("one_hot_columns", """
SELECT c_custkey, c_mktsegment = 'AUTOMOBILE' AS "c_mktsegment_AUTOMOBILE", c_mktsegment = 'BUILDING' AS "c_mktsegment_BUILDING",
  c_mktsegment = 'FURNITURE' AS "c_mktsegment_FURNITURE", c_mktsegment = 'HOUSEHOLD' AS "c_mktsegment_HOUSEHOLD", c_name FROM customer""")
def one_hot_columns(spark, d):
    # c_name has too many values and stays as it is
    return en.encode_categories(table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_name"))


@query("target_codes", """
SELECT l_orderkey, l_partkey, (dense_rank() OVER (ORDER BY l_linenumber) - 1)::INTEGER AS l_linenumber FROM lineitem""")
def target_codes(spark, d):
    return en.encode_target(table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber"), "l_linenumber")


@query("problem_types", """
SELECT 'l_linenumber' AS target, CASE WHEN count(DISTINCT l_linenumber) < 10 THEN 'classification' ELSE 'regression' END AS problem, count(*) AS rows FROM lineitem
UNION ALL SELECT 'l_quantity', CASE WHEN count(DISTINCT l_quantity) < 10 THEN 'classification' ELSE 'regression' END, count(*) FROM lineitem""")
def problem_types(spark, d):
    li = table(spark, d, "lineitem")
    parts = [li.agg(F.lit(t).alias("target"), F.lit(en.problem_type(li, t)).alias("problem"), F.count("*").alias("rows"))
             for t in ("l_linenumber", "l_quantity")]
    return parts[0].unionByName(parts[1])


@query("standardised", """
WITH s AS (SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, avg(l_tax) AS tm, stddev_pop(l_tax) AS ts FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01')
SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - qm) / qs, 6) AS l_quantity, round((l_tax - tm) / ts, 6) AS l_tax FROM lineitem, s""")
def standardised(spark, d):
    rows = table(spark, d, "lineitem")
    train = rows.where(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    scaled = en.Standardiser.fit(train, ["l_quantity", "l_tax"]).transform(rows)
    return scaled.select("l_orderkey", "l_linenumber", "l_partkey", r6("l_quantity"), r6("l_tax"))


@query("exact_median", f"WITH {GAMES_CTE} SELECT median(homeERA) AS median FROM games")
def exact_median(spark, d):
    return en.exact_median(games(spark, d), "homeERA")


@query("filled_constants", f"""
WITH {GAMES_CTE} SELECT gameId, coalesce(homeERA, 0) AS homeERA, coalesce(overUnder, 45) AS overUnder, '' AS note FROM games""")
def filled_constants(spark, d):
    g = games(spark, d).select("gameId", "homeERA", "overUnder", F.lit(None).cast("string").alias("note"))
    return en.fill(g, {"homeERA": "zero", "overUnder": 45, "note": "empty"}, ["gameId"])


@query("imputed_with_noise", f"""
WITH {GAMES_CTE} SELECT count(*) AS rows, count(*) AS filled, count(homeERA) AS kept, round(sum(homeERA), 6) AS kept_sum FROM games""")
def imputed_with_noise(spark, d):
    """The drawn values are free; that every gap is filled and every given value is kept is not."""
    g = games(spark, d).select("gameId", "homeERA", "homeSpread")
    out = en.impute(g.withColumn("given", F.col("homeERA").isNotNull()), ["gameId"])
    kept = F.when(F.col("given"), F.col("homeERA"))
    return out.agg(F.count("*").alias("rows"), F.count("homeERA").alias("filled"), F.count(kept).alias("kept"),
                   r6(F.sum(kept), "kept_sum"))


@query("imputed_values", f"""WITH {GAMES_CTE} SELECT gameId, homeERA AS "keptERA", homeSpread AS "keptSpread", overUnder::DOUBLE AS "keptLine",
  homeERA IS NULL AS "drawnERA", homeSpread IS NULL AS "drawnSpread", overUnder IS NULL AS "drawnLine", true AS near FROM games""")
def imputed_values(spark, d):
    """Known values stay; drawn ones lie near the middle of the known: within the nine deviations that the noise can reach."""
    g = games(spark, d).select("gameId", "homeERA", "homeSpread", "overUnder")
    out = en.fill(en.impute(g.drop("overUnder"), ["gameId"]).join(g.select("gameId", "overUnder"), "gameId"),
                  {"overUnder": "median"}, ["gameId"])
    names = {"homeERA": "ERA", "homeSpread": "Spread", "overUnder": "Line"}
    known = g.select("gameId", *[F.col(c).alias(f"_{n}") for c, n in names.items()])
    ends = g.agg(*[f(c).alias(f"{p}{n}") for c, n in names.items() for p, f in (("_m", F.avg), ("_d", F.stddev_samp))])
    both = beside(out.join(known, "gameId"), ends)
    near = F.lit(True)
    for c, n in names.items():
        # a median lies within one deviation of the mean
        near = near & F.coalesce(F.abs(F.col(c) - F.col(f"_m{n}")) <= 10 * F.col(f"_d{n}"), F.lit(False))
    return both.select("gameId", *[F.when(F.col(f"_{n}").isNotNull(), F.col(c)).alias(f"kept{n}") for c, n in names.items()],
                       *[F.col(f"_{n}").isNull().alias(f"drawn{n}") for n in names.values()], near.alias("near"))


@query("complete_rows", f"WITH {GAMES_CTE} SELECT gameId, homeERA, homeSpread FROM games WHERE homeERA IS NOT NULL AND homeSpread IS NOT NULL")
def complete_rows(spark, d):
    return games(spark, d).select("gameId", "homeERA", "homeSpread").dropna()


@query("prepared_columns", """
SELECT c_custkey, c_name, c_acctbal, (c_nationkey >= 12) AS "upper_true", c_mktsegment = 'AUTOMOBILE' AS "c_mktsegment_AUTOMOBILE",
  c_mktsegment = 'BUILDING' AS "c_mktsegment_BUILDING", c_mktsegment = 'FURNITURE' AS "c_mktsegment_FURNITURE",
  c_mktsegment = 'HOUSEHOLD' AS "c_mktsegment_HOUSEHOLD", (dense_rank() OVER (ORDER BY c_nationkey % 5) - 1)::INTEGER AS target FROM customer""")
def prepared_columns(spark, d):
    raw = table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_acctbal", (F.col("c_nationkey") >= 12).cast("string").alias("upper"), "c_mktsegment",
        (F.col("c_nationkey") % 5 * 10).alias("target"))
    return en.prepare(raw, "target", keep=["c_custkey"])


@query("time_split", f"""
WITH {GAMES_CTE}, r AS (SELECT gameId, gameDate, row_number() OVER (ORDER BY gameDate, gameId) AS p, count(*) OVER () AS n FROM games)
SELECT gameId, p <= floor(n * 0.8) AS train FROM r""")
def time_split(spark, d):
    train, test = sp.split_by_time(games(spark, d).select("gameId", "gameDate"), "gameDate", "gameId", 0.2)
    return train.select("gameId", F.lit(True).alias("train")).unionByName(test.select("gameId", F.lit(False).alias("train")))


@query("stratified_split", """
SELECT quality, count(*) AS rows, floor(count(*) * 0.25 + 0.5)::BIGINT AS test_rows FROM labels GROUP BY quality""")
def stratified_split(spark, d):
    train, test = sp.split_random(table(spark, d, "labels"), "doc_id", 0.25, 7, "quality")
    both = train.withColumn("test", F.lit(0)).unionByName(test.withColumn("test", F.lit(1)))
    return both.groupBy("quality").agg(F.count("*").alias("rows"), F.sum("test").alias("test_rows"))


@query("row_halves", f"""
WITH {GAMES_CTE}, r AS (SELECT gameId, row_number() OVER (ORDER BY gameDate, gameId) AS p, count(*) OVER () AS n FROM games)
SELECT gameId FROM r WHERE p > n // 2""")
def row_halves(spark, d):
    return sp.halves(games(spark, d).select("gameId", "gameDate"), ["gameDate", "gameId"])[1].select("gameId")


@query("time_folds", f"""
WITH {GAMES_CTE}, r AS (SELECT gameId, row_number() OVER (ORDER BY gameDate, gameId) AS p, count(*) OVER () AS n FROM games)
SELECT gameId, ((p - 1) * 6 // n)::INTEGER AS fold FROM r""")
def time_folds(spark, d):
    return sp.with_time_folds(games(spark, d).select("gameId", "gameDate"), "gameDate", "gameId", 5).select("gameId", "fold")


@query("shuffled_folds", f"WITH {GAMES_CTE} SELECT count(*) AS rows, 5::BIGINT AS folds, true AS balanced FROM games")
def shuffled_folds(spark, d):
    folds = sp.with_folds(games(spark, d).select("gameId"), "gameId", 5).groupBy("fold").agg(F.count("*").alias("n"))
    return folds.agg(F.sum("n").alias("rows"), F.count("*").alias("folds"),
                     (F.max("n") < F.min("n") * 1.5).alias("balanced"))


_SCORES = "SELECT event_type AS model, avg(value) - 49.5 AS value FROM events GROUP BY event_type"


@query("ensemble_weights", f"""
WITH s AS ({_SCORES}), l AS (SELECT *, CASE WHEN min(value) OVER () < 0 THEN value - min(value) OVER () + 0.01 ELSE value END AS raw FROM s)
SELECT model, round(value, 6) AS value, round(raw * count(*) OVER () / sum(raw) OVER (), 6) AS weight FROM l""")
def ensemble_weights(spark, d):
    scores = table(spark, d, "events").groupBy(F.col("event_type").alias("model")).agg((F.avg("value") - 49.5).alias("value"))
    return performance_weights(scores).select("model", r6("value"), r6("weight"))


@query("ensemble_weights_from_losses", """
WITH s AS (SELECT event_type AS model, avg(value) AS value FROM events GROUP BY event_type)
SELECT model, round(value, 6) AS value, round(1 / value * count(*) OVER () / sum(1 / value) OVER (), 6) AS weight FROM s""")
def ensemble_weights_losses(spark, d):
    scores = table(spark, d, "events").groupBy(F.col("event_type").alias("model")).agg(F.avg("value").alias("value"))
    return performance_weights(scores, higher_is_better=False).select("model", r6("value"), r6("weight"))
