"""Documents are made and parsed once, games are dealt evenly, and picks are not counted before they are joined."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldhouse.functions.coerce import to_whole
from fieldhouse.operators.picks import daily_picks
from fieldhouse.session import stored
from fieldhouse.workload import QUERIES
from fieldhouse.workload.nested import odds_pages, parsed, spread


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(("name", "documents"), [("team_boxscore_documents", 1), ("college_game_view", 2)])
def test_documents_are_parsed_once(spark, data, name, documents):
    text = plan(QUERIES[name](spark, data))
    assert text.count("from_json(") == documents
    assert text.count("StructsToJsonEvaluator(") == documents


def test_conditions_on_parsed_documents_keep_rows_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (2, None)], "k long, v string")
    got = parsed(df, F.struct("k", F.when(F.col("v").isNotNull(), F.struct("v")).alias("s")), "k long, s struct<v:string>")
    assert got.columns == ["k", "s"]
    assert sorted(got.where("s IS NOT NULL").select("k", "s.v").collect(), key=str) == sorted([(1, "a"), (None, "c")], key=str)
    assert got.where("s IS NULL").count() == 2


def test_whole_numbers_of_integer_columns_are_the_same(spark):
    values = [(v,) for v in (None, 0, -7, 2**53, 2**53 + 1, 2**63 - 1, -2**63)]
    df = spark.createDataFrame(values, "v long").select(to_whole(F.col("v")).alias("a"), to_whole(F.col("v"), True).alias("b"))
    assert df.where("NOT (a <=> b)").count() == 0


def test_games_are_dealt_over_all_tasks(spark, data):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    games = spark.range(2000).select(F.col("id").alias("gameId"), F.lit(dt.datetime(2024, 1, 1)).alias("gameDate")).coalesce(1)
    got = spread(games)
    assert got.rdd.getNumPartitions() == tasks and got.count() == 2000
    assert "RepartitionByExpression" in plan(odds_pages(spark, data))


def test_stored_rows_come_back(spark):
    df = spark.createDataFrame([(1, None, [1.0, None]), (None, dt.datetime(1500, 1, 1), None)], "k int, t timestamp_ntz, v array<double>")
    back = stored(df)
    assert back.schema == df.schema and sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_picks_are_not_made_before_the_join(spark):
    as_of = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    scored = spark.range(40).select(F.col("id").alias("gameId"), as_of.alias("startDate"), F.lit(1.5).alias("homeSpread"),
                                    (F.col("id") / 40).alias("predProb"), F.lit(1).alias("predClass"))
    info = spark.range(40).select(F.col("id").alias("gameId"), as_of.alias("startDate"), *[F.lit("x").alias(c) for c in ("homeTeam", "awayTeam", "venue")])
    spark.conf.set("fieldhouse.broadcast_free_bytes", "0")
    spark.sparkContext.setJobGroup("picks", "picks")
    try:
        picks = daily_picks(scored, info, 0.423, 0.53, as_of)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("picks")) == 0
    finally:
        spark.conf.unset("fieldhouse.broadcast_free_bytes")
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert picks.count() == 35
