"""Baseball: game table to model table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldhouse.functions.coerce import null_for_nan, to_time
from fieldhouse.operators.longform import SIDES, by_game, to_long
from fieldhouse.operators.market import market_features
from fieldhouse.operators.rolling import rolling_means
from fieldhouse.operators.shape import select_present
from fieldhouse.operators.sizing import Limits
from fieldhouse.operators.targets import baseball_targets

# Team statistics that get rolling differences.
TEAM_BATTING = [
    "Runs", "Hits", "Doubles", "Triples", "HomeRuns", "RBI", "Walks", "Strikeouts", "StolenBases", "LOB", "HBP",
    "BA", "OBP", "SLG", "OPS",
]
TEAM_PITCHING = ["EarnedRuns", "HitsAllowed", "HRAllowed", "WalksAllowed", "StrikeoutsPitched", "ERA"]
TEAM_STATS = TEAM_BATTING + TEAM_PITCHING

# Columns of the model table around the feature differences.
ID_COLUMNS = [
    "gameId", "season", "gameDate", "gameDateTime", "gameType", "homeTeamId", "homeTeamName", "awayTeamId",
    "awayTeamName", "venueId", "venueName",
]
MARKET_COLUMNS = [
    "homeMoneyline", "awayMoneyline", "homeSpread", "awaySpread", "homeSpreadOdds", "awaySpreadOdds", "overUnder",
    "overOdds", "underOdds", "homeImpliedProb", "awayImpliedProb", "favoriteDegree", "impliedProbDiff",
    "line_percentile", "line_vs_avg", "spreadMagnitude",
]
REST_COLUMNS = ["restDiff", "both_rested", "either_b2b"]
TARGETS = ["homeWin", "homeCover", "wentOver"]


def read_games(df: DataFrame) -> DataFrame:
    """Game view with dates parsed, times in UTC and NaN as NULL."""
    times = {c: to_time(F.col(c)) for c in ("gameDate", "gameDateTime") if c in df.columns}
    return null_for_nan(df.withColumns(times))


def rolling_differences(
    games: DataFrame, stats: Sequence[str], windows: Sequence[int], entity: str = "TeamId",
    entity_as: str = "teamId", label: str = "{stat}_diff_l{n}", limits: Limits | None = None,
) -> DataFrame:
    """`gameId` and home-minus-away differences of the rolling means of each stat."""
    long = to_long(games, stats, entity, entity_as)
    stats = [s for s in stats if s in long.columns]
    rolled = rolling_means(long, stats, windows, entity_as, sparse=True, limits=limits)
    names = [(s, n) for s in stats for n in windows]
    wide = by_game(rolled, [f"{s}_roll{n}" for s, n in names], {side: f"{side}_" for side in SIDES})
    return wide.select("gameId", *[
        (F.col(f"home_{s}_roll{n}") - F.col(f"away_{s}_roll{n}")).alias(label.format(stat=s.lower(), n=n))
        for s, n in names])


def add_team_form(games: DataFrame, stats: Sequence[str], windows: Sequence[int], limits: Limits | None = None) -> DataFrame:
    return games.join(rolling_differences(games, stats, windows, limits=limits), "gameId", "left")


def add_pitcher_form(games: DataFrame, stats: Sequence[str], windows: Sequence[int], limits: Limits | None = None) -> DataFrame:
    """Starting-pitcher differences, `sp_{stat}_diff_l{n}`; a stat's own `SP_` prefix is not repeated.

    Games pass through unchanged when the view has no starting pitchers.
    """
    have = [s for s in stats if all(f"{side}{s}" in games.columns for side in SIDES)]
    if "homeStartingPitcherId" not in games.columns or not have:
        return games
    diffs = rolling_differences(games, have, windows, "StartingPitcherId", "pitcherId", "{stat}_diff_l{n}",
                                limits=limits)
    named = diffs.select("gameId", *[
        F.col(c).alias("sp_" + c.removeprefix("sp_")) for c in diffs.columns if c != "gameId"])
    return games.join(named, "gameId", "left")


def model_columns(df: DataFrame) -> DataFrame:
    diffs = sorted(c for c in df.columns if "_diff_l" in c)
    return select_present(df, ID_COLUMNS + diffs + MARKET_COLUMNS + REST_COLUMNS + TARGETS)


def build_model_table(
    games: DataFrame, team_stats: Sequence[str], windows: Sequence[int], pitcher_stats: Sequence[str] = (),
    limits: Limits | None = None,
) -> DataFrame:
    """Ids, rolling differences, market features and targets, one row per game, as one lazy plan."""
    df = add_team_form(games, team_stats, windows, limits)
    if pitcher_stats:
        df = add_pitcher_form(df, pitcher_stats, windows, limits)
    return model_columns(baseball_targets(market_features(df, limits=limits)))
