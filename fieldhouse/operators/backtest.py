"""Bets placed on scored games, their profit, and reports over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldhouse.functions.odds import in_tails, payout
from fieldhouse.operators.ordering import with_running, with_trailing
from fieldhouse.operators.sizing import Limits, beside, groups_fit

ORDER = ("gameDate", "gameId")
MIN_BETS = 10


def place_bets(
    scored: DataFrame, lower: float = 0.42, upper: float = 0.55, stake: float = 1.0,
    home_odds: str = "homeMoneyline", away_odds: str = "awayMoneyline",
) -> DataFrame:
    """Rows in the tails with side, price, win flag and units won or lost. Needs `proba` and `actual`."""
    side = (F.col("proba") >= F.lit(upper)).cast("int")
    bets = scored.where(in_tails(F.col("proba"), lower, upper)).select(
        "*", side.alias("bet_side"),
        (side == F.col("actual")).cast("int").alias("win"),
        F.when(side == 1, F.col(home_odds)).otherwise(F.col(away_odds)).alias("bet_odds"))
    won = payout(F.col("bet_odds"), stake)
    return bets.withColumns({
        "win_payout": won, "units": F.when(F.col("win") == 1, won).otherwise(F.lit(-float(stake)))})


def bet_log(bets: DataFrame, order: Sequence[str] = ORDER, limits: Limits | None = None) -> DataFrame:
    """Bets with `cum_units`, its running `peak`, and `drawdown` below that peak, in bet order."""
    summed = with_running(bets, [], order, totals={"cum_units": F.col("units")}, limits=limits)
    peaked = with_running(summed, [], order, peaks={"peak": F.col("cum_units")}, limits=limits)
    return peaked.withColumn("drawdown", F.col("cum_units") - F.col("peak"))


def fold_drawdown(chunks: DataFrame, keys: Sequence[str], chunk: str) -> DataFrame:
    """Deepest drawdown per key from one row per (key, chunk).

    A chunk carries its `s` sum, `p` highest and `m` lowest running total, and `d` deepest drawdown, each taken
    inside the chunk. Chunks follow each other in `chunk` order, so the whole is a fold over a few rows per key.
    """
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    placed = chunks.withColumn("_start", F.coalesce(F.sum("s").over(before), F.lit(0.0)))
    peaked = placed.withColumn("_peak", F.max(F.col("_start") + F.col("p")).over(before))
    deepest = F.least("d", F.col("_start") + F.col("m") - F.col("_peak"))
    return peaked.groupBy(*keys).agg(F.min(deepest).alias("max_drawdown"))


def max_drawdown(bets: DataFrame, order: Sequence[str] = ORDER, limits: Limits | None = None) -> DataFrame:
    """One row with `max_drawdown`. Large bet sets are cut by range of bet order, never sorted in one task."""
    rows = bets.where(F.col("units").isNotNull())
    if groups_fit(rows, [], limits):
        cut = rows.select(*order, "units", F.lit(0).alias("_chunk"))
    else:
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        cut = rows.select(*order, "units").repartitionByRange(parts, *order).withColumn(
            "_chunk", F.spark_partition_id())
    w = Window.partitionBy("_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = cut.withColumn("_cum", F.sum("units").over(w))
    run = run.withColumn("_max", F.max("_cum").over(w))
    chunks = run.groupBy("_chunk").agg(
        F.sum("units").alias("s"), F.max("_cum").alias("p"), F.min("_cum").alias("m"),
        F.min(F.col("_cum") - F.col("_max")).alias("d"))
    return fold_drawdown(chunks, [], "_chunk")


def _rounded(c: str | Column, digits: int) -> Column:
    """Rounded in two steps, so that noise in the last bits of a sum cannot tip a tie either way."""
    return F.round(F.round(c, 10), digits)


def rate_columns(stake: float) -> list[Column]:
    """Rounded summary metrics from `bets`, `mean`, `std`, `total`, `win`, `proba`, `max_drawdown` columns."""
    return [
        _rounded("win", 4).alias("win_rate"), _rounded("mean", 4).alias("avg_units"),
        _rounded("total", 2).alias("total_units"), _rounded(F.col("mean") / stake, 4).alias("roi_per_bet"),
        _rounded(F.when(F.col("std") > 0, F.col("mean") / F.col("std")), 4).alias("sharpe"),
        _rounded("max_drawdown", 2).alias("max_drawdown"), _rounded("proba", 4).alias("avg_proba")]


def summarise(
    bets: DataFrame, stake: float = 1.0, min_bets: int = MIN_BETS, order: Sequence[str] = ORDER,
    limits: Limits | None = None,
) -> DataFrame:
    """One summary row, or none when there are fewer than `min_bets` bets."""
    totals = bets.agg(
        F.count("*").alias("bets"), F.avg("win").alias("win"), F.avg("units").alias("mean"),
        F.sum("units").alias("total"), F.stddev_samp("units").alias("std"), F.avg("proba").alias("proba"))
    both = beside(totals, max_drawdown(bets, order, limits))
    return both.where(F.col("bets") >= min_bets).select("bets", *rate_columns(stake))


def backtest(scored: DataFrame, lower: float = 0.42, upper: float = 0.55, stake: float = 1.0, **kw) -> DataFrame:
    return summarise(place_bets(scored, lower, upper, stake), stake, **kw)


def by_side(bets: DataFrame) -> DataFrame:
    return bets.groupBy("bet_side").agg(
        F.round(F.avg("win"), 3).alias("win_rate"), F.count("*").alias("count"),
        F.round(F.sum("units"), 3).alias("total_units"))


def class_precision(scored: DataFrame) -> DataFrame:
    """Rows predicted per class, how many were right, and the share."""
    return scored.groupBy("pred").agg(
        F.count("*").alias("predicted"), F.count_if(F.col("pred") == F.col("actual")).alias("correct"),
    ).withColumn("precision", F.round(F.col("correct") / F.col("predicted"), 3))


def day_log(bets: DataFrame, day: str = "gameDate", limits: Limits | None = None) -> DataFrame:
    """Units, wins, losses and sides per day with the running total; bets collapse to days before any ordering."""
    days = bets.groupBy(F.to_date(day).alias("gameDate")).agg(
        F.sum("units").alias("daily_units"), F.sum("win").alias("wins"), F.count("*").alias("total_bets"),
        F.sum("bet_side").alias("home_bets"))
    filled = days.withColumns({
        "losses": F.col("total_bets") - F.col("wins"), "away_bets": F.col("total_bets") - F.col("home_bets"),
        "win_rate": F.col("wins") / F.col("total_bets")})
    return with_running(filled, [], ["gameDate"], totals={"cum_units": F.col("daily_units")}, limits=limits)


def day_summary(days: DataFrame) -> DataFrame:
    u = F.col("daily_units")
    return days.agg(
        F.count("*").alias("days"), F.count_if(u > 0).alias("profitable_days"), F.count_if(u < 0).alias("losing_days"),
        F.count_if(u == 0).alias("break_even_days"), F.max(u).alias("best_day"), F.min(u).alias("worst_day"),
        F.avg("total_bets").alias("bets_per_day"))


def selectivity(scored: DataFrame, bets: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Share of games bet, correct calls by side, average win and loss, and the highest running total: one row."""
    games = scored.agg(F.count("*").alias("games"))
    side, win, units = F.col("bet_side"), F.col("win"), F.col("units")
    facts = bets.agg(
        F.count("*").alias("bets"), F.count_if(side == 1).alias("home_bets"),
        F.count_if((side == 1) & (win == 1)).alias("home_correct"), F.count_if(side == 0).alias("away_bets"),
        F.count_if((side == 0) & (win == 1)).alias("away_correct"), F.avg(F.when(win == 1, units)).alias("avg_win"),
        F.avg(F.when(win == 0, units)).alias("avg_loss"))
    peak = bet_log(bets, limits=limits).agg(F.max("cum_units").alias("peak_units"))
    one = beside(beside(facts, peak), games)
    return one.withColumns({
        "bet_pct": F.col("bets") * 100.0 / F.col("games"),
        "pass_pct": (F.col("games") - F.col("bets")) * 100.0 / F.col("games")})


def rolling_win_rate(
    bets: DataFrame, order: Sequence[str] = ORDER, widest: int = 50, least: int = 10, limits: Limits | None = None,
) -> DataFrame:
    """Trailing win rate over a third of the bets, `widest` at most; no rows when that is under `least`."""
    size = min(widest, bets.count() // 3)
    if size < least:
        return bets.withColumn("rolling_win_rate", F.lit(None).cast("double")).limit(0)

    def rate(w):
        back = w.rowsBetween(-(size - 1), 0)
        return [F.when(F.count("win").over(back) == size, F.avg("win").over(back)).alias("rolling_win_rate")]

    return with_trailing(bets, [], order, size, rate, limits)


def compare_summaries(optimised: DataFrame, evaluated: DataFrame, tolerated_drop: float = -0.05) -> DataFrame:
    """Differences between two one-row summaries, whether the edge held up, and a verdict."""
    names = ["bets", "win_rate", "roi_per_bet", "sharpe"]
    a = optimised.select([F.col(c).alias(f"opt_{c}") for c in names])
    b = evaluated.select([F.col(c).alias(f"eval_{c}") for c in names])
    out = beside(a, b).withColumns({f"{c}_diff": F.col(f"eval_{c}") - F.col(f"opt_{c}") for c in names})
    roi = F.col("eval_roi_per_bet")
    return out.withColumns({
        "generalises": F.col("roi_per_bet_diff") >= tolerated_drop,
        "verdict": F.when(roi > 0.05, "STRONG").when(roi > 0, "MARGINAL").otherwise("NEGATIVE")})
