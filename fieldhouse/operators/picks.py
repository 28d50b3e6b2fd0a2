"""Picks for upcoming games."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldhouse.functions.odds import edge, in_tails, pick_side
from fieldhouse.operators.profile import repeated_keys

SPREAD_SIDES = ("HOME", "AWAY")
TOTAL_SIDES = ("OVER", "UNDER")


def upcoming(df: DataFrame, as_of: Column, start: str = "startDate") -> DataFrame:
    return df.where(F.col(start) >= as_of)


def select_picks(scored: DataFrame, lower: float, upper: float, sides: Sequence[str] = SPREAD_SIDES) -> DataFrame:
    """Games scored in the tails, with `pickSide` and `edge`. Needs `predProb`."""
    high, low = sides
    p = F.col("predProb")
    picked = scored.where(in_tails(p, lower, upper)).withColumn("pickSide", pick_side(p, lower, upper, high, low))
    return picked.withColumn("edge", edge(p, F.col("pickSide"), high))


def daily_picks(
    scored: DataFrame, game_info: DataFrame, lower: float, upper: float, as_of: Column,
    sides: Sequence[str] = SPREAD_SIDES, line: str = "homeSpread", back_hours: int = 10,
) -> DataFrame:
    """Picks joined to names and venue of games that started at most `back_hours` ago or are still to come.

    How to join is left to Spark, which knows the size of the picks once they are made; counting them first would score
    all games a second time.
    """
    recent = game_info.where(F.col("startDate") >= as_of - F.expr(f"INTERVAL {back_hours} HOURS"))
    picks = select_picks(scored, lower, upper, sides)
    joined = recent.select("gameId", "homeTeam", "awayTeam", "venue").join(picks, "gameId")
    return joined.select(
        "gameId", "homeTeam", "awayTeam", "startDate", "venue", line, "predProb", "predClass", "pickSide", "edge")


def check_picks(picks: DataFrame, sides: Sequence[str] = SPREAD_SIDES) -> DataFrame:
    """Fails when a game occurs twice or a side is not one of the two; returns the picks otherwise."""
    if not repeated_keys(picks, ["gameId"]).isEmpty():
        raise ValueError("a game was picked more than once")
    if not picks.where(~F.coalesce(F.col("pickSide").isin(*sides), F.lit(False))).isEmpty():
        raise ValueError(f"pick sides must be one of {tuple(sides)}")
    return picks


def display_table(picks: DataFrame) -> DataFrame:
    """The picks as text columns, best edge first; a value that is missing is NULL, not a word for it."""
    def text(form: str, value: Column, column: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.format_string(form, value))

    return picks.orderBy(F.col("edge").desc(), "gameId").select(
        F.col("pickSide").alias("Pick"), F.col("homeTeam").alias("Home"), F.col("awayTeam").alias("Away"),
        text("%+.1f", F.col("homeSpread"), "homeSpread").alias("Spread"),
        text("%.1f%%", F.col("predProb") * 100, "predProb").alias("Prob"),
        text("%.2f%%", F.col("edge") * 100, "edge").alias("Edge"),
        F.date_format("startDate", "MM/dd hh:mm a").alias("Time"), F.col("venue").alias("Venue"))
