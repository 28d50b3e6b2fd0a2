"""College basketball: game table to model table, and the daily spread picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldhouse.functions.coerce import null_for_nan
from fieldhouse.operators.longform import SIDES, by_game, shared_stats, to_long
from fieldhouse.operators.market import totals_interactions
from fieldhouse.operators.rolling import fatigue, rolling_means
from fieldhouse.operators.sizing import Limits
from fieldhouse.operators.targets import spread_target, total_target

BASE = ["gameId", "season", "startDate"]
# Game columns of the model table, and the spread model's stats, window, features and thresholds.
GAME_COLUMNS = [*BASE, "homeTeamId", "awayTeamId", "homeSpread", "overUnder", "homePoints", "awayPoints"]
SPREAD_STATS = ["Pace", "OrbPct", "PointsOffTO", "Rating"]
SPREAD_WINDOWS = [3]
SPREAD_FEATURES = ["restDiff", "orbpct_diff_l3", "pace_diff_l3", "rating_diff_l3", "pointsoffto_diff_l3", "homeSpread"]
LOWER_THRESHOLD, UPPER_THRESHOLD = 0.423, 0.530


def read_games(df: DataFrame, season_start: int | None = None, season_end: int | None = None) -> DataFrame:
    """Game view, optionally limited to an inclusive season range that reaches the scan."""
    if season_start:
        df = df.where(F.col("season") >= season_start)
    if season_end:
        df = df.where(F.col("season") <= season_end)
    return null_for_nan(df)


def team_features(
    games: DataFrame, stats: Sequence[str], windows: Sequence[int], limits: Limits | None = None,
) -> DataFrame:
    """Long rows with rolling means and fatigue; both use the same partitioning by (team, season)."""
    long = to_long(games, [s for s in shared_stats(games) if s in stats], base=BASE, complete=True)
    rolled = rolling_means(long, stats, windows, order=("startDate", "gameId", "side"), suffix="_l", limits=limits)
    return fatigue(rolled, limits=limits)


def merge_to_games(
    games: DataFrame, team: DataFrame, stats: Sequence[str], windows: Sequence[int], extra: Sequence[str] = (),
) -> DataFrame:
    """Home and away feature columns, their differences and sums, and the rest difference, per game."""
    names = [(s, n) for s in stats for n in windows]
    features = [f"{s}_l{n}" for s, n in names] + ["RestDays", "GamesPlayed"]
    base = games.select(*GAME_COLUMNS, *[c for c in extra if c in games.columns])
    df = base.join(by_game(team, features, {side: side for side in SIDES}), "gameId", "left")

    def both(op: str) -> list[Column]:
        word = {"-": "diff", "+": "sum"}[op]
        return [
            (F.col(f"home{s}_l{n}") - F.col(f"away{s}_l{n}") if op == "-"
             else F.col(f"home{s}_l{n}") + F.col(f"away{s}_l{n}")).alias(f"{s.lower()}_{word}_l{n}")
            for s, n in names]

    return df.select(
        "*", *both("-"), *both("+"), (F.col("homeRestDays") - F.col("awayRestDays")).alias("restDiff"))


def build_model_table(
    games: DataFrame, stats: Sequence[str], windows: Sequence[int], target: str | None = None,
    extra: Sequence[str] = ("conferenceGame", "neutralSite"), limits: Limits | None = None,
) -> DataFrame:
    team = team_features(games, stats, windows, limits)
    df = merge_to_games(games, team, stats, windows, extra if target == "wentOver" else ())
    if target == "homeCover":
        return spread_target(df)
    if target == "wentOver":
        return total_target(totals_interactions(df, windows, limits))
    return df
