"""Games meet prices by start and names: no row is multiplied before it is shuffled, and busy starts go to several tasks."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldhouse.operators.odds_match import PRICES, _with_parts, match_odds
from fieldhouse.operators.sizing import Limits

GAME = "game_id string, game_datetime timestamp, home_name string, away_name string, home_score double, away_score double"
PRICE = "game_time timestamp, home_team string, away_team string, sportsbook string, home_line int"


def day(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def tables(spark, games, prices):
    """`games`: (start, home, away); `prices`: (start, home, away, line)."""
    g = spark.createDataFrame([(str(i), day(t), h, a, float(i), None) for i, (t, h, a) in enumerate(games)], GAME)
    o = spark.createDataFrame([(day(t), h, a, "alpha", line) for t, h, a, line in prices], PRICE)
    return g, o.withColumns({c: F.lit(None).cast("double") for c in PRICES if c not in o.columns})


def expected(games, prices):
    return Counter(
        (str(i), h, a, line) for i, (t, h, a) in enumerate(games) for pt, ph, pa, line in prices
        if None not in (t, h, a, pt, ph, pa) and t == pt and ph and ph in h and pa in a)


def got(df):
    return Counter((r["game_id"], r["full_home_name"], r["full_away_name"], r["home_line"]) for r in df.collect())


@pytest.fixture()
def unbroadcast(spark):
    """No join of unknown size turns into a broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def shuffled_rows(df):
    """Rows that the plan of a collected frame wrote to shuffles."""
    def under(node):
        name, rows = node.getClass().getSimpleName(), 0
        if name == "AdaptiveSparkPlanExec":
            return under(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return under(node.plan())
        if name == "ShuffleExchangeExec":
            rows = node.metrics().apply("shuffleRecordsWritten").value()
        return rows + sum(under(node.children().apply(i)) for i in range(node.children().size()))

    return under(df._jdf.queryExecution().executedPlan())


def test_names_inside_names_do_not_multiply_shuffled_rows(spark, unbroadcast):
    names = ["x" * n for n in range(1, 31)]  # the shortest stands in all 30, the longest has all 30 inside
    games = [(0, n, "City away") for n in names]
    prices = [(0, n, "away", 10 * i + k) for i, n in enumerate(names) for k in range(5)]
    df = match_odds(*tables(spark, games, prices))
    assert got(df) == expected(games, prices)
    assert 0 < shuffled_rows(df) <= len(games) + len(prices)  # 2,325 prices if full names are put beside them first


ODD_GAMES = [(t, f"City Team {h}", f"City Team {a}") for t in (0, 0, 0, 1, 2, None) for h in (1, 11, 112, 7) for a in (1, 12, -1)] + [
    (0, None, "City Team 1"), (0, "City Team 1", None), (1, "", "City Team 1"), (1, "City Team 1", ""), (3, "City Team 1", "City Team 1")]
ODD_PRICES = [(t, h, a, i) for i, (t, h, a) in enumerate(
    (t, h, a) for t in (0, 0, 1, None) for h in ("Team 1", "Team 11", "Team 112", "Team 1121", "City Team 7", "am", "", None)
    for a in ("Team 1", "Team 12", "Team", "", None))]


@pytest.mark.parametrize("split", [False, True])
def test_rows_are_those_of_comparing_every_pair(spark, tight, split):
    games, odds = tables(spark, ODD_GAMES, ODD_PRICES)
    df = match_odds(games, odds, tight if split else None)
    assert df.columns == ["game_id", "game_datetime", "full_home_name", "full_away_name", "home_score", "away_score", *PRICES]
    assert got(df) == expected(ODD_GAMES, ODD_PRICES)


def test_starts_written_in_another_type_still_meet(spark):
    games, odds = tables(spark, ODD_GAMES, ODD_PRICES)
    df = match_odds(games.withColumn("game_datetime", F.to_date("game_datetime")), odds)
    assert got(df) == expected(ODD_GAMES, ODD_PRICES)


def test_only_busy_starts_are_split(spark):
    rows = spark.createDataFrame([(day(0),)] * 95 + [(day(1),)] * 40 + [(None,)] * 3, "_time timestamp")
    parts, more = _with_parts([rows, rows.limit(0)], 4, Limits(group_rows=40))
    assert {r["_time"]: r["_parts"] for r in parts.distinct().collect()} == {day(0): 3, day(1): 1, None: 1}
    assert more.columns == ["_time", "_parts"] and more.count() == 0
    assert _with_parts([rows], 4, Limits())[0].where("_parts <> 1").count() == 0


def test_tables_without_rows_match_nothing(spark):
    games, odds = tables(spark, ODD_GAMES, ODD_PRICES)
    assert match_odds(games.limit(0), odds).count() == 0
    assert match_odds(games, odds.limit(0)).count() == 0
