"""The split plans must give the rows of the plain plans, also when one key holds most rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fieldhouse.operators import ordering as od
from fieldhouse.operators.backtest import bet_log, max_drawdown, place_bets
from fieldhouse.operators.metrics import auc, roc_on_grid, roc_points
from fieldhouse.operators.rolling import fatigue, lagged_mean
from fieldhouse.operators.sizing import Limits, groups_fit, input_bytes, largest_group, lookup
from fieldhouse.operators.splits import split_by_time, split_random
from fieldhouse.operators.encoding import exact_median

WIDE = Limits()


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 else rnd.choice(["a", "b", None, "c"])
        rows.append((key, rnd.randint(0, 60), i, None if rnd.random() < 0.1 else rnd.randint(-9, 9) / 2))
    return spark.createDataFrame(rows, "k string, day int, id int, v double").repartition(5)


def rows(df, *cols):
    def norm(x):
        return round(x, 9) if isinstance(x, float) else x
    return sorted((tuple(norm(x) for x in r) for r in df.select(*cols).collect()), key=str)


def test_probe_sees_the_hot_key(skewed, tight):
    assert largest_group(skewed, ["k"]) == 600
    assert not groups_fit(skewed, ["k"], tight)
    assert groups_fit(skewed, ["k"], WIDE)
    assert largest_group(skewed, []) == 900


def test_input_bytes_of_files(spark, data):
    assert input_bytes(spark.read.parquet(f"{data}/orders.parquet")) > 0


def test_lookup_is_broadcast_only_when_small(spark, tight):
    assert "broadcast" not in lookup(spark.range(50), tight)._jdf.queryExecution().logical().toString().lower()
    assert "hint broadcast" in lookup(spark.range(5), tight)._jdf.queryExecution().logical().toString().lower()


def test_position(skewed, tight):
    args = (["k"], ["day", "id"], "pos")
    assert rows(od.with_position(skewed, *args, tight), "k", "id", "pos") == rows(
        od.with_position(skewed, *args, WIDE), "k", "id", "pos")


def test_position_without_keys(skewed, tight):
    got = rows(od.with_position(skewed, [], ["day", "id"], "pos", tight), "day", "id", "pos")
    assert [p for _, _, p in sorted(got, key=lambda r: r[:2])] == list(range(1, 901))


@pytest.mark.parametrize("depth", [1, 3, 45])
def test_trailing(skewed, tight, depth):
    def cols(w):
        return [lagged_mean("v", depth, w).alias("m"), F.lag("id", depth).over(w).alias("l")]
    a = od.with_trailing(skewed, ["k"], ["day", "id"], depth, cols, tight)
    b = od.with_trailing(skewed, ["k"], ["day", "id"], depth, cols, WIDE)
    assert rows(a, "k", "id", "v", "m", "l") == rows(b, "k", "id", "v", "m", "l")


def test_running(skewed, tight):
    def run(limits):
        return od.with_running(skewed, ["k"], [F.col("day").desc(), "id"], {"s": F.col("v"), "n": F.lit(1)},
                               {"top": F.col("v")}, limits)
    assert rows(run(tight), "k", "id", "s", "n", "top") == rows(run(WIDE), "k", "id", "s", "n", "top")


def test_average_rank_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 10.0), (1, 10.0), (1, 20.0), (1, None), (2, 5.0)], "season int, v double")
    got = od.average_rank(df, ["season"], "v", "p")
    assert rows(got, "season", "v", "p") == rows(spark.createDataFrame(
        [(1, 10.0, 0.5), (1, 10.0, 0.5), (1, 20.0, 1.0), (1, None, None), (2, 5.0, 1.0)],
        "season int, v double, p double"), "season", "v", "p")


def test_average_rank_split(skewed, tight):
    a, b = (od.average_rank(skewed, ["k"], "v", "p", "m", x) for x in (tight, WIDE))
    assert rows(a, "k", "id", "p", "m") == rows(b, "k", "id", "p", "m")


@pytest.fixture(scope="module")
def bets(spark):
    rnd = random.Random(5)
    data = [(i, rnd.randint(0, 20), rnd.random(), rnd.randint(0, 1), rnd.choice([120, -130]), rnd.choice([110, -150]))
            for i in range(400)]
    return spark.createDataFrame(
        data, "gameId int, gameDate int, proba double, actual int, homeMoneyline int, awayMoneyline int").repartition(4)


def test_bet_log_and_drawdown(bets, tight):
    placed = place_bets(bets)
    cols = ("gameId", "cum_units", "peak", "drawdown")
    assert rows(bet_log(placed, limits=tight), *cols) == rows(bet_log(placed, limits=WIDE), *cols)
    deepest = min(r["drawdown"] for r in bet_log(placed, limits=WIDE).collect())
    for limits in (tight, WIDE):
        assert math.isclose(max_drawdown(placed, limits=limits).first()["max_drawdown"], deepest, abs_tol=1e-9)


def test_first_bet_lost_is_no_drawdown(spark):
    df = spark.createDataFrame([(1, 1, -1.0), (2, 2, 2.0), (3, 3, -1.0)], "gameId int, gameDate int, units double")
    assert max_drawdown(df).first()["max_drawdown"] == -1.0
    assert max_drawdown(df.where("gameId = 1")).first()["max_drawdown"] == 0.0


def test_auc_and_roc(bets, tight):
    assert math.isclose(auc(bets, limits=tight).first()["auc"], auc(bets, limits=WIDE).first()["auc"], abs_tol=1e-12)
    a, b = (roc_on_grid(roc_points(bets, limits=x), limits=x) for x in (tight, WIDE))
    assert rows(a, "fpr", "tpr") == rows(b, "fpr", "tpr")


def test_auc_brute_force(bets):
    data = [(r["proba"], r["actual"]) for r in bets.collect()]
    pos, neg = [p for p, y in data if y], [p for p, y in data if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert math.isclose(auc(bets).first()["auc"], wins / (len(pos) * len(neg)), abs_tol=1e-12)


def test_median(skewed, tight):
    values = sorted(r["v"] for r in skewed.collect() if r["v"] is not None)
    n = len(values)
    want = (values[(n - 1) // 2] + values[n // 2]) / 2
    assert exact_median(skewed, "v", tight).first()["median"] == want == exact_median(skewed, "v").first()["median"]


def test_fatigue(spark, tight):
    rnd = random.Random(1)
    df = spark.createDataFrame(
        [("hot" if i % 2 else "x", 2020, i, "home", rnd.randint(1, 28)) for i in range(300)],
        "teamId string, season int, gameId int, side string, day int").withColumn(
        "startDate", F.make_timestamp(F.lit(2020), F.lit(1), "day", F.lit(1), F.lit(30), F.lit(0)))
    cols = ("gameId", "gameDate", "RestDays", "GamesPlayed")
    assert rows(fatigue(df, limits=tight), *cols) == rows(fatigue(df, limits=WIDE), *cols)


def test_splits(bets, tight):
    for limits in (tight, WIDE):
        a, b = split_by_time(bets, "gameDate", "gameId", 0.25, limits)
        assert (a.count(), b.count()) == (300, 100)
        assert a.agg(F.max("gameDate")).first()[0] <= b.agg(F.min("gameDate")).first()[0]
        a, b = split_random(bets, "gameId", 0.2, 9, "actual", limits)
        assert a.count() + b.count() == 400
        got = {r["actual"]: r["n"] for r in b.groupBy("actual").agg(F.count("*").alias("n")).collect()}
        have = {r["actual"]: r["n"] for r in bets.groupBy("actual").agg(F.count("*").alias("n")).collect()}
        assert got == {c: math.floor(n * 0.2 + 0.5) for c, n in have.items()}


def test_random_split_is_repeatable(bets):
    one, two = (sorted(r["gameId"] for r in split_random(bets, "gameId", 0.3, 4)[1].collect()) for _ in range(2))
    assert one == two and len(one) == 120


def test_keep_first_prunes_before_the_shuffle(skewed):
    plan = od.keep_first(skewed, ["k"], ["day", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
