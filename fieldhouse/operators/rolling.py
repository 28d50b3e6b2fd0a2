"""Form features: lagged rolling means, rest days, games played."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from fieldhouse.functions.calendar import eastern_game_day
from fieldhouse.operators.ordering import with_position, with_trailing
from fieldhouse.operators.sizing import Limits


def lagged_mean(c: str, n: int, w: WindowSpec) -> Column:
    """Mean of the `n` rows before this one; NULL unless all `n` carry a value."""
    back = w.rowsBetween(-n, -1)
    return F.when(F.count(c).over(back) == n, F.avg(c).over(back))


def rolling_means(
    long: DataFrame, stats: Sequence[str], windows: Sequence[int], entity: str = "teamId",
    order: Sequence[str] = ("gameDate", "gameId", "side"), suffix: str = "_roll", sparse: bool = False,
    limits: Limits | None = None,
) -> DataFrame:
    """`{stat}{suffix}{n}` for each stat and window; all share one sort per (entity, season).

    `sparse` entities may be unknown: such rows have no history, get NULLs, and are spread by game instead of
    gathering as one NULL group in a single task.
    """
    names = [(s, n) for s in stats if s in long.columns for n in windows]
    keys = [entity, "season"]
    if sparse:
        long = long.withColumn("_solo", F.when(F.col(entity).isNull(), F.concat_ws("|", "gameId", "side")))
        keys.append("_solo")
    rolled = with_trailing(
        long, keys, order, max(windows),
        lambda w: [lagged_mean(s, n, w).alias(f"{s}{suffix}{n}") for s, n in names], limits)
    return rolled.drop("_solo")


def fatigue(
    long: DataFrame, start: str = "startDate", order: Sequence[str] = ("startDate", "gameId", "side"),
    limits: Limits | None = None,
) -> DataFrame:
    """`RestDays` since the team's previous game and `GamesPlayed` so far, by Eastern calendar day.

    The order is that of the rolling means, so both share one shuffle and one sort.
    """
    dated = long.withColumn("gameDate", eastern_game_day(F.col(start)))
    keys = ["teamId", "season"]
    rested = with_trailing(
        dated, keys, order, 1, lambda w: [F.datediff("gameDate", F.lag("gameDate").over(w)).alias("RestDays")], limits)
    return with_position(rested, keys, order, "GamesPlayed", limits)
