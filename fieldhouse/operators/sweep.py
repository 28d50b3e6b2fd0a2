"""Every (lower, upper) threshold pair backtested at once.

A game is a bet for all lower thresholds at or above its score, or for all upper thresholds at or below it. So
the games are counted once per threshold bucket, the buckets are summed up from the ends, and a cell of the
grid adds one entry of each table: no game meets the grid. Only the drawdown depends on bet order; it is taken
per range of bet order with arrays over the grid, and the ranges are folded together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldhouse.functions.odds import payout
from fieldhouse.operators.backtest import ORDER, fold_drawdown, rate_columns

_FACTS = ("n", "wins", "total", "squares", "proba")


def grid_steps(start: float, stop: float, step: float) -> list[float]:
    """`start`, `start + step`, … below `stop`, built from whole steps so no rounding error accumulates."""
    count = int(np.ceil(round((stop - start) / step, 9)))
    return [round(start + i * step, 10) for i in range(count)]


def _outcomes(scored: DataFrame, stake: float, home_odds: str, away_odds: str) -> DataFrame:
    """Units of each game if bet on the home side and if bet on the away side."""
    won = F.col("actual") == 1
    return scored.withColumns({
        "_home": F.when(won, payout(F.col(home_odds), stake)).otherwise(-float(stake)),
        "_away": F.when(~won, payout(F.col(away_odds), stake)).otherwise(-float(stake))})


def _bucketed(out: DataFrame, lowers: Sequence[float], uppers: Sequence[float]) -> DataFrame:
    """Facts per pair of buckets: one pass, one small shuffle.

    `hi` is the highest upper threshold a game reaches (-1: none), `lo` the lowest lower threshold it does not exceed
    (their number: none).
    """
    p, won = F.col("proba"), F.col("actual") == 1
    reach = F.size(F.filter(F.array(*map(F.lit, uppers)), lambda u: u <= p)) - 1
    under = F.size(F.filter(F.array(*map(F.lit, lowers)), lambda v: v < p))
    edge = (p >= min(uppers)) | (p <= max(lowers))
    sides = [("hi", "_home", won), ("lo", "_away", ~won)]
    return out.where(edge).groupBy(reach.alias("hi"), under.alias("lo")).agg(*[
        e.alias(f"{tag}_{name}") for tag, units, win in sides for name, e in (
            ("n", F.count("*")), ("wins", F.count_if(win)), ("total", F.sum(units)),
            ("squares", F.sum(F.col(units) * F.col(units))), ("proba", F.sum("proba")))])


def _by_side(buckets: DataFrame) -> DataFrame:
    """Both sides' facts under common names, one row per side and bucket.

    Writing both sides from one row keeps a single aggregation below, whichever side is asked for.
    """
    sides = F.array(*[
        F.struct(F.lit(tag).alias("side"), F.col(tag).alias("k"), *[F.col(f"{tag}_{c}").alias(c) for c in _FACTS])
        for tag in ("hi", "lo")])
    return buckets.select(F.inline(sides)).groupBy("side", "k").agg(*[F.sum(c).alias(c) for c in _FACTS])


def _summed(sides: DataFrame, size: int, from_top: bool, tag: str) -> DataFrame:
    """One side accumulated towards the middle: one row per threshold, at most `size` rows."""
    sums = sides.where((F.col("side") == tag) & F.col("k").between(0, size - 1)).drop("side")
    every = sides.sparkSession.range(size).select(F.col("id").cast("int").alias("k"))
    w = Window.orderBy(F.col("k").desc() if from_top else F.col("k")).rowsBetween(Window.unboundedPreceding, 0)
    filled = every.join(F.broadcast(sums), "k", "left").na.fill(0, list(_FACTS))  # one row per threshold
    return filled.select(F.col("k").alias(tag), *[F.sum(c).over(w).alias(f"{tag}_{c}") for c in _FACTS])


def _cells(spark, lowers: Sequence[float], uppers: Sequence[float]) -> DataFrame:
    rows = [(i, j, lo, hi) for i, lo in enumerate(lowers) for j, hi in enumerate(uppers) if lo < hi]
    return spark.createDataFrame(rows, "lo int, hi int, lower_threshold double, upper_threshold double")


def _chunk_drawdowns(lowers: Sequence[float], uppers: Sequence[float], order: Sequence[str]):
    """Per partition of ordered games: running-total extremes of every grid cell, a few arrays the size of the grid."""
    lows, highs = np.array(lowers), np.array(uppers)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shape = (len(lows), len(highs))
        s, p, m, d = np.zeros(shape), np.full(shape, -np.inf), np.full(shape, np.inf), np.full(shape, np.inf)
        chunk = None
        for b in batches:
            if not len(b):
                continue
            chunk = int(b["_chunk"].iloc[0]) if chunk is None else chunk
            proba = b["proba"].to_numpy()[:, None]
            at_high = proba >= highs
            high_units = np.where(at_high, b["_home"].to_numpy()[:, None], 0.0)
            away = b["_away"].to_numpy()[:, None]
            for i, low in enumerate(lows):
                at_low = (proba <= low) & ~at_high
                bet = at_high | at_low
                if not bet.any():
                    continue
                cum = s[i] + np.cumsum(np.where(at_low, away, high_units), axis=0)
                top = np.maximum.accumulate(np.where(bet, cum, -np.inf), axis=0)
                top = np.maximum(top, p[i])
                d[i] = np.minimum(d[i], np.where(bet, cum - top, np.inf).min(axis=0))
                p[i] = np.maximum(p[i], top[-1])
                m[i] = np.minimum(m[i], np.where(bet, cum, np.inf).min(axis=0))
                s[i] = cum[-1]
        if chunk is None:
            return
        ii, jj = np.nonzero(np.isfinite(p))
        yield pd.DataFrame({"lo": ii.astype("int32"), "hi": jj.astype("int32"), "_chunk": np.int32(chunk),
                            "s": s[ii, jj], "p": p[ii, jj], "m": m[ii, jj], "d": d[ii, jj]})

    return fold


def _drawdowns(out: DataFrame, lowers, uppers, order: Sequence[str]) -> DataFrame:
    spark = out.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edge = (F.col("proba") >= min(uppers)) | (F.col("proba") <= max(lowers))
    ordered = (
        out.where(edge & F.col("_home").isNotNull() & F.col("_away").isNotNull())
        .select(*order, "proba", "_home", "_away")
        .repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("_chunk", F.spark_partition_id()))
    chunks = ordered.mapInPandas(
        _chunk_drawdowns(lowers, uppers, order), "lo int, hi int, _chunk int, s double, p double, m double, d double")
    return fold_drawdown(chunks, ["lo", "hi"], "_chunk")


def threshold_sweep(
    scored: DataFrame, lower_range: tuple[float, float] = (0.0, 0.45), upper_range: tuple[float, float] = (0.55, 1.0),
    step: float = 0.01, stake: float = 1.0, min_bets: float = 10, home_odds: str = "homeMoneyline",
    away_odds: str = "awayMoneyline", order: Sequence[str] = ORDER,
) -> DataFrame:
    """Backtest summary of every valid cell of the grid with enough bets. Games need valid prices on both sides."""
    spark = scored.sparkSession
    lowers, uppers = grid_steps(*lower_range, step), grid_steps(*upper_range, step)
    out = _outcomes(scored, stake, home_odds, away_odds).where(F.col("proba").isNotNull())
    sides = _by_side(_bucketed(out, lowers, uppers))
    home, away = _summed(sides, len(uppers), True, "hi"), _summed(sides, len(lowers), False, "lo")
    cells = _cells(spark, lowers, uppers).join(F.broadcast(home), "hi").join(F.broadcast(away), "lo")
    both = {c: F.col(f"hi_{c}") + F.col(f"lo_{c}") for c in _FACTS}
    n, total = both["n"], both["total"]
    spread = F.sqrt(F.greatest(both["squares"] - total * total / n, F.lit(0.0)) / (n - 1))
    summed = cells.where(n >= max(min_bets, 10)).select(
        "lo", "hi", "lower_threshold", "upper_threshold", n.alias("bets"), (both["wins"] / n).alias("win"),
        (total / n).alias("mean"), total.alias("total"), spread.alias("std"), (both["proba"] / n).alias("proba"))
    deepest = _drawdowns(out, lowers, uppers, order)
    return summed.join(F.broadcast(deepest), ["lo", "hi"], "left").select(
        F.round("lower_threshold", 3).alias("lower_threshold"), F.round("upper_threshold", 3).alias("upper_threshold"),
        "bets", *rate_columns(stake))


def ranked_by(results: DataFrame, metric: str = "roi_per_bet") -> DataFrame:
    return results.orderBy(F.col(metric).desc_nulls_last(), "lower_threshold", "upper_threshold")


def best_cell(results: DataFrame, metric: str = "roi_per_bet") -> DataFrame:
    """The first row of the ranking."""
    return ranked_by(results.where(F.col(metric).isNotNull()), metric).limit(1)
