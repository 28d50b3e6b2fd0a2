"""American-odds arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: win probability at which a -110 price breaks even.
BREAK_EVEN = 0.5238


def implied_probability(moneyline: Column) -> Column:
    """Win probability priced into American odds; null stays null, odds of zero give zero over a hundred."""
    ml = moneyline.cast("double")
    return F.when(ml > 0, F.lit(100.0) / (ml + 100.0)).otherwise(F.abs(ml) / (F.abs(ml) + 100.0))


def payout(odds: Column, stake: float = 1.0) -> Column:
    """Profit of a winning bet; odds of zero have no price, so the profit is null."""
    o = odds.cast("double")
    return F.when(o > 0, F.lit(stake) * o / 100.0).otherwise(F.try_divide(F.lit(stake * 100.0), F.abs(o)))


def in_tails(proba: Column, lower: float, upper: float) -> Column:
    """A probability far enough from the middle to act on, both ends inclusive."""
    return (proba >= F.lit(upper)) | (proba <= F.lit(lower))


def pick_side(proba: Column, lower: float, upper: float, high: str, low: str) -> Column:
    """Label of the side picked. When both thresholds hold, the low side wins."""
    return F.when(proba <= F.lit(lower), F.lit(low)).when(proba >= F.lit(upper), F.lit(high))


def edge(proba: Column, side: Column, high: str) -> Column:
    """Advantage over the break-even probability, seen from the picked side."""
    return F.when(side == F.lit(high), proba - F.lit(BREAK_EVEN)).otherwise(
        (F.lit(1.0) - proba) - F.lit(BREAK_EVEN))


def valid_prices(home: Column, away: Column) -> Column:
    """Both prices present and non-zero."""
    return (home != 0) & (away != 0)
