"""Game views derived from the order tables, and the same views as SQL for the oracle.

Every order is a game: its lines of odd number are the home side and those of even number the away side. All lines count,
and an order with lines of one kind only has NULL figures on the other side, whose team is -1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _sides(spark: SparkSession, d: str) -> DataFrame:
    """One row per order with both sides' figures, from one aggregation of all lines (combined before the shuffle).

    A side's team and pitcher are its smallest supplier and part, -1 on a side without lines; where both sides have one
    supplier, the away side is that supplier's second team, under the number -2 - supplier. Sums and means are rounded, so that
    their order cannot show.
    """
    cols = []
    for odd, side in ((1, "home"), (0, "away")):
        own = lambda c, odd=odd: F.when(F.col("l_linenumber") % 2 == odd, F.col(c))
        cols += [
            F.coalesce(F.min(own("l_suppkey")), F.lit(-1)).alias(f"{side}TeamId"),
            F.coalesce(F.min(own("l_partkey")), F.lit(-1)).alias(f"{side}StartingPitcherId"),
            F.sum(own("l_quantity")).alias(f"{side}Runs"), F.round(F.sum(own("l_extendedprice")), 2).alias(f"{side}Hits"),
            F.round(F.avg(own("l_discount")), 6).alias(f"{side}OBP"), F.round(F.avg(own("l_tax")), 6).alias(f"{side}ERA"),
            F.count(own("l_linenumber")).alias(f"{side}Lines")]
    sides = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("gameId")).agg(*cols)
    away = F.col("awayTeamId")
    return sides.withColumn("awayTeamId", F.when(away == F.col("homeTeamId"), -2 - away).otherwise(away))


def games(spark: SparkSession, d: str) -> DataFrame:
    """Baseball-shaped game view."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    up, down = 100 + c % 150, -(105 + c % 150)
    even, no_odds = c % 2 == 0, o % 97 == 0
    orders = table(spark, d, "orders").select(
        o.alias("gameId"),
        F.year("o_orderdate").alias("season"),
        F.col("o_orderdate").alias("gameDate"),
        F.when(o % 17 != 0, (o % 21 - 10).cast("double") / F.lit(2.0).cast("double")).alias("homeSpread"),
        F.when(o % 19 != 0, (40 + o % 23).cast("int")).alias("overUnder"),
        F.when(no_odds, 0).otherwise(F.when(even, up).otherwise(down)).cast("int").alias("homeMoneyline"),
        F.when(no_odds, 0).otherwise(F.when(even, down).otherwise(up)).cast("int").alias("awayMoneyline"),
        F.round((o * 37 % 1000).cast("double") / 1000, 3).alias("proba"),
    )
    g = orders.join(_sides(spark, d).drop("homeLines", "awayLines"), "gameId")
    gone = F.col("gameId") % 13 == 0
    return g.withColumns({
        "homeERA": F.when(~gone, F.col("homeERA")),
        "awayERA": F.when(~gone, F.col("awayERA")),
        "homeSP_MaxVelo": F.col("homeRuns") + 50,
        "awaySP_MaxVelo": F.col("awayRuns") + 50,
    })


_SIDE_SQL = """coalesce(min(l_suppkey) FILTER (WHERE l_linenumber % 2 = {odd}), -1) AS {s}_team,
    coalesce(min(l_partkey) FILTER (WHERE l_linenumber % 2 = {odd}), -1) AS {s}_part,
    sum(l_quantity) FILTER (WHERE l_linenumber % 2 = {odd}) AS {s}_quantity, round(sum(l_extendedprice) FILTER (WHERE l_linenumber % 2 = {odd}), 2) AS {s}_price,
    round(avg(l_discount) FILTER (WHERE l_linenumber % 2 = {odd}), 6) AS {s}_discount, round(avg(l_tax) FILTER (WHERE l_linenumber % 2 = {odd}), 6) AS {s}_tax,
    count(*) FILTER (WHERE l_linenumber % 2 = {odd}) AS {s}_lines"""

GAMES_CTE = f"""
sides AS (
  SELECT l_orderkey, {_SIDE_SQL.format(odd=1, s="h")},
    {_SIDE_SQL.format(odd=0, s="a")} FROM lineitem GROUP BY 1),
games AS (
  SELECT o_orderkey AS gameId, year(o_orderdate)::INTEGER AS season, o_orderdate AS gameDate,
    h_team AS homeTeamId, CASE WHEN a_team = h_team THEN -2 - a_team ELSE a_team END AS awayTeamId,
    h_part AS homeStartingPitcherId, a_part AS awayStartingPitcherId,
    h_quantity AS homeRuns, a_quantity AS awayRuns, h_price AS homeHits, a_price AS awayHits,
    h_discount AS homeOBP, a_discount AS awayOBP,
    CASE WHEN o_orderkey % 13 <> 0 THEN h_tax END AS homeERA, CASE WHEN o_orderkey % 13 <> 0 THEN a_tax END AS awayERA,
    h_quantity + 50 AS homeSP_MaxVelo, a_quantity + 50 AS awaySP_MaxVelo,
    CASE WHEN o_orderkey % 17 <> 0 THEN (o_orderkey % 21 - 10)::DOUBLE / 2.0::DOUBLE END AS homeSpread,
    CASE WHEN o_orderkey % 19 <> 0 THEN (40 + o_orderkey % 23)::INTEGER END AS overUnder,
    CASE WHEN o_orderkey % 97 = 0 THEN 0 WHEN o_custkey % 2 = 0 THEN 100 + o_custkey % 150
         ELSE -(105 + o_custkey % 150) END::INTEGER AS homeMoneyline,
    CASE WHEN o_orderkey % 97 = 0 THEN 0 WHEN o_custkey % 2 = 0 THEN -(105 + o_custkey % 150)
         ELSE 100 + o_custkey % 150 END::INTEGER AS awayMoneyline,
    round((o_orderkey * 37 % 1000)::DOUBLE / 1000, 3) AS proba
  FROM orders JOIN sides ON l_orderkey = o_orderkey)"""

SCORED_CTE = GAMES_CTE + """,
scored AS (
  SELECT gameId, season, gameDate, proba, homeMoneyline, awayMoneyline, (homeRuns > awayRuns)::INTEGER AS actual,
    (proba >= 0.5)::INTEGER AS pred
  FROM games WHERE homeRuns <> awayRuns)"""


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Games with a label, a deterministic score and prices; ties have no label and drop out."""
    return games(spark, d).where("homeRuns <> awayRuns").select(
        "gameId", "season", "gameDate", "proba", "homeMoneyline", "awayMoneyline",
        (F.col("homeRuns") > F.col("awayRuns")).cast("int").alias("actual"),
        (F.col("proba") >= 0.5).cast("int").alias("pred"))


def hoops(spark: SparkSession, d: str) -> DataFrame:
    """Basketball-shaped game view; every 23rd game has not been played yet."""
    k = F.col("gameId")
    played = k % 23 != 0
    return games(spark, d).select(
        "gameId", "season",
        F.timestamp_add("HOUR", (k % 24).cast("int"), F.col("gameDate")).alias("startDate"),
        "homeTeamId", "awayTeamId", "homeSpread", F.col("overUnder").cast("double").alias("overUnder"),
        F.when(played, F.col("homeRuns")).alias("homePoints"), F.when(played, F.col("awayRuns")).alias("awayPoints"),
        F.col("homeRuns").alias("homePace"), F.col("awayRuns").alias("awayPace"),
        F.col("homeOBP").alias("homeOrbPct"), F.col("awayOBP").alias("awayOrbPct"),
        F.col("homeHits").alias("homePointsOffTO"), F.col("awayHits").alias("awayPointsOffTO"),
        F.col("homeERA").alias("homeRating"), F.col("awayERA").alias("awayRating"),
        (k % 5 < 2).alias("conferenceGame"), (k % 7 == 0).alias("neutralSite"),
        "proba")


HOOPS_CTE = GAMES_CTE + """,
hoops AS (
  SELECT gameId, season, gameDate + to_hours((gameId % 24)::INTEGER) AS startDate, homeTeamId, awayTeamId, homeSpread,
    overUnder::DOUBLE AS overUnder, CASE WHEN gameId % 23 <> 0 THEN homeRuns END AS homePoints,
    CASE WHEN gameId % 23 <> 0 THEN awayRuns END AS awayPoints, homeRuns AS homePace, awayRuns AS awayPace,
    homeOBP AS homeOrbPct, awayOBP AS awayOrbPct, homeHits AS homePointsOffTO, awayHits AS awayPointsOffTO,
    homeERA AS homeRating, awayERA AS awayRating, gameId % 5 < 2 AS conferenceGame, gameId % 7 = 0 AS neutralSite, proba
  FROM games)"""


def sides(spark: SparkSession, d: str) -> DataFrame:
    """The sides of all orders, with the number of lines that went into each."""
    return _sides(spark, d)
