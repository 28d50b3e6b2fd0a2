"""Features read off the betting market, and interaction features for totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldhouse.functions.coerce import flag
from fieldhouse.functions.odds import implied_probability
from fieldhouse.operators.ordering import average_rank
from fieldhouse.operators.sizing import Limits


def market_features(df: DataFrame, rested: int = 2, tired: int = 1, limits: Limits | None = None) -> DataFrame:
    """Implied probabilities, line position within the season, spread size, rest flags; each only if its input exists."""
    have = set(df.columns)
    cols = {}
    if {"homeMoneyline", "awayMoneyline"} <= have:
        home, away = implied_probability(F.col("homeMoneyline")), implied_probability(F.col("awayMoneyline"))
        cols |= {
            "homeImpliedProb": home, "awayImpliedProb": away,
            "favoriteDegree": F.abs(home - 0.5), "impliedProbDiff": home - away,
        }
    if "homeSpread" in have:
        cols["spreadMagnitude"] = F.abs("homeSpread")
    if {"homeRestDays", "awayRestDays"} <= have:
        cols["restDiff"] = F.col("homeRestDays") - F.col("awayRestDays")
        cols |= rest_flags(rested, tired)
    out = df.withColumns(cols) if cols else df
    if {"overUnder", "season"} <= have:
        ranked = average_rank(out, ["season"], "overUnder", "line_percentile", mean="_season_line", limits=limits)
        out = ranked.select(
            *out.columns, "line_percentile", (F.col("overUnder") - F.col("_season_line")).alias("line_vs_avg"))
    return out


def rest_flags(rested: int, tired: int) -> dict:
    home, away = F.col("homeRestDays"), F.col("awayRestDays")
    return {
        "both_rested": flag((home >= rested) & (away >= rested)),
        # one short-rested side is enough, even when the other side's rest is unknown
        "either_b2b": F.greatest(flag(home <= tired), flag(away <= tired)),
    }


# Output prefix and the two summed stats it multiplies.
TOTALS_PRODUCTS = {
    "pace_x_rating": ("pace", "rating"),
    "pace_x_ts": ("pace", "trueshooting"),
    "second_chance": ("orbpct", "efg"),
    "paint_tempo": ("paintpoints", "pace"),
    "ft_tempo": ("ftr", "pace"),
}


def totals_interactions(df: DataFrame, windows: Sequence[int], limits: Limits | None = None) -> DataFrame:
    """Tempo products, season percentile of the line, and rest totals for over/under models."""
    have = set(df.columns)
    cols = {}
    for n in windows:
        for name, (a, b) in TOTALS_PRODUCTS.items():
            a, b = f"{a}_sum_l{n}", f"{b}_sum_l{n}"
            if {a, b} <= have:
                cols[f"{name}_l{n}"] = F.col(a) * F.col(b) / 100
    for c in ("conferenceGame", "neutralSite"):
        if c in have:
            cols[c] = F.col(c).cast("int")
    if {"homeRestDays", "awayRestDays"} <= have:
        cols |= rest_flags(rested=3, tired=1)
        cols["rest_sum"] = F.col("homeRestDays") + F.col("awayRestDays")
    out = df.withColumns(cols) if cols else df
    if "overUnder" in have:
        names = out.columns
        out = average_rank(out, ["season"], "overUnder", "line_percentile", limits=limits).select(
            *names, "line_percentile")
    return out
