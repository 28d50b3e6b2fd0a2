"""Betting thresholds found on one half of the games and judged on the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldhouse.operators.backtest import ORDER, backtest, compare_summaries
from fieldhouse.operators.splits import halves
from fieldhouse.operators.sweep import best_cell, threshold_sweep
from fieldhouse.session import pinned


def optimise_then_evaluate(
    scored: DataFrame, metric: str = "roi_per_bet", step: float = 0.01, least_share: float = 0.25, order: Sequence[str] = ORDER,
) -> DataFrame:
    """Sweep the first half, apply its best thresholds to both halves, and compare: one row with the thresholds.

    A cell of the sweep needs bets on `least_share` of the first half's games, and ten at least; without such a cell
    there is no row.
    """
    first, second = (pinned(h) for h in halves(scored, order))
    least = max(10, int(first.count() * least_share))
    best = best_cell(threshold_sweep(first, step=step, min_bets=least), metric).first()
    if best is None:
        return scored.sparkSession.createDataFrame([], "lower_threshold double, upper_threshold double")
    lower, upper = best["lower_threshold"], best["upper_threshold"]
    out = compare_summaries(backtest(first, lower, upper), backtest(second, lower, upper))
    return out.select(F.lit(lower).alias("lower_threshold"), F.lit(upper).alias("upper_threshold"), *out.columns)
