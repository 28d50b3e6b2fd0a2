"""Cleaners for the baseball tables: games, rosters, boxscores, pitches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldhouse.functions.coerce import flag, parse_day, to_id, to_number, to_text
from fieldhouse.operators.ordering import keep_first
from fieldhouse.operators.shape import require, select_renamed, with_missing, without_nulls

# Statuses of a game that was played to an end.
COMPLETED = [
    "Final", "Final: Tied", "Completed Early", "Completed Early: Rain", "Final: Tie, decision by tiebreaker",
]
COMPLETED_PATTERN = "Final|Completed"
POSTPONED = "Postponed"


def is_completed(status: Column) -> Column:
    return F.coalesce(status.isin(*COMPLETED), F.lit(False))


def looks_completed(status: Column) -> Column:
    return F.coalesce(status.rlike(COMPLETED_PATTERN), F.lit(False))


def not_postponed(status: Column) -> Column:
    """Games without a status stay."""
    return ~status.eqNullSafe(F.lit(POSTPONED))


def clean_teams(df: DataFrame) -> DataFrame:
    return without_nulls(df, ["team_id", "season", "team_name", "team_abbr"], "teams")


def clean_players(df: DataFrame) -> DataFrame:
    return without_nulls(df, ["player_id", "team_id", "season", "full_name"], "players")


def first_scheduled(df: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per game: postponed entries go, the earliest of the others stays."""
    return keep_first(df.where(not_postponed(F.col("status"))), ["game_id"], ["game_datetime", *tie_break])


def clean_games(df: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    needed = ["game_id", "season", "game_datetime", "home_id", "away_id"]
    return first_scheduled(without_nulls(df, needed, "games"), tie_break)


def _numbers(df: DataFrame, whole: Sequence[str], decimal: Sequence[str]) -> DataFrame:
    kinds = {c: "int" for c in whole} | {c: "double" for c in decimal}
    return df.withColumns({c: to_number(F.col(c), k) for c, k in kinds.items() if c in df.columns})


# Whole-number and decimal columns of the boxscores.
TEAM_WHOLE = [
    "is_home", "runs", "hits", "doubles", "triples", "home_runs", "rbi", "walks", "strikeouts", "stolen_bases",
    "caught_stealing", "left_on_base", "hit_by_pitch", "earned_runs", "hits_allowed", "home_runs_allowed",
    "walks_allowed", "strikeouts_pitched", "pitches_thrown", "strikes",
]
TEAM_DECIMAL = ["avg", "obp", "slg", "ops", "era"]
PLAYER_WHOLE = [
    "is_home", "at_bats", "runs", "hits", "doubles", "triples", "home_runs", "rbi", "walks", "strikeouts",
    "stolen_bases", "caught_stealing", "hit_by_pitch", "hits_allowed", "runs_allowed", "earned_runs",
    "walks_allowed", "strikeouts_pitched", "home_runs_allowed", "pitches_thrown", "strikes", "win", "loss", "save",
    "blown_save", "hold",
]
PLAYER_DECIMAL = ["avg", "obp", "slg", "ops", "innings_pitched", "era"]


def clean_team_boxscores(df: DataFrame) -> DataFrame:
    return _numbers(df, TEAM_WHOLE, TEAM_DECIMAL)


def clean_player_boxscores(df: DataFrame, tie_break: Sequence[str] = ("is_home", "team_id")) -> DataFrame:
    """Numbers coerced; a player listed under both teams keeps the first listing, the away side's."""
    return keep_first(_numbers(df, PLAYER_WHOLE, PLAYER_DECIMAL), ["game_id", "player_id"], list(tie_break))


# Pitch columns kept, in order; `player_name` holds the pitcher's name.
PITCH_COLUMNS = [
    "game_pk", "game_date", "game_year", "at_bat_number", "pitch_number", "pitcher", "batter", "player_name",
    "inning", "inning_topbot", "outs_when_up", "balls", "strikes", "on_1b", "on_2b", "on_3b", "stand", "p_throws",
    "pitch_type", "pitch_name", "release_speed", "release_pos_x", "release_pos_y", "release_pos_z",
    "release_spin_rate", "release_extension", "spin_axis", "pfx_x", "pfx_z", "plate_x", "plate_z", "vx0", "vy0",
    "vz0", "ax", "ay", "az", "zone", "sz_top", "sz_bot", "launch_speed", "launch_angle", "hit_distance_sc", "bb_type",
    "hc_x", "hc_y", "barrel", "estimated_ba_using_speedangle", "estimated_woba_using_speedangle", "woba_value",
    "woba_denom", "babip_value", "iso_value", "type", "description", "events", "des", "home_run", "hit_location",
    "if_fielding_alignment", "of_fielding_alignment",
]
PITCH_RENAMES = {"player_name": "pitcher_name"}
PITCH_WHOLE = [
    "game_year", "pitcher", "batter", "inning", "outs_when_up", "balls", "strikes", "on_1b", "on_2b", "on_3b",
    "release_spin_rate", "spin_axis", "zone", "hit_distance_sc", "woba_denom", "at_bat_number", "pitch_number",
]
PITCH_DECIMAL = [
    "release_speed", "release_pos_x", "release_pos_y", "release_pos_z", "release_extension", "pfx_x", "pfx_z",
    "plate_x", "plate_z", "vx0", "vy0", "vz0", "ax", "ay", "az", "sz_top", "sz_bot", "launch_speed", "launch_angle",
    "hc_x", "hc_y", "estimated_ba_using_speedangle", "estimated_woba_using_speedangle", "woba_value", "babip_value",
    "iso_value",
]
PITCH_TEXT = {
    "pitcher_name": 100, "batter_name": 100, "inning_topbot": 10, "stand": 1, "p_throws": 1, "pitch_type": 10,
    "pitch_name": 50, "bb_type": 20, "type": 2, "description": 100, "events": 50, "des": 500, "hit_location": 10,
    "if_fielding_alignment": 20, "of_fielding_alignment": 20,
}
PITCH_KEY = ["game_pk", "at_bat_number", "pitch_number"]
# Pitch descriptions that are swings, and those that are swings and misses.
SWINGS = [
    "swinging_strike", "foul", "hit_into_play", "swinging_strike_blocked", "foul_tip", "missed_bunt", "foul_bunt",
]
WHIFFS = ["swinging_strike", "swinging_strike_blocked", "missed_bunt"]


def clean_pitches(df: DataFrame, arrival: Sequence[str | Column]) -> DataFrame:
    """Typed, trimmed, deduplicated pitches.

    `arrival` orders deliveries of the same pitch; the last one stays, and then has to carry date, pitcher and
    batter. Rows without a game go before ids are made text, so a missing id cannot survive as a word.
    """
    sent = [f"_arrival{i}" for i in range(len(arrival))]
    arrived = df.select("*", *[(F.col(a) if isinstance(a, str) else a).alias(n) for a, n in zip(arrival, sent, strict=True)])
    names = {c: PITCH_RENAMES.get(c, c) for c in PITCH_COLUMNS}
    kept = select_renamed(arrived, names | {n: n for n in sent})
    typed = _numbers(kept, PITCH_WHOLE, PITCH_DECIMAL)
    have = set(typed.columns)
    cols = {c: to_text(F.col(c), n) for c, n in PITCH_TEXT.items() if c in have}
    if "game_pk" in have:
        cols["game_pk"] = F.coalesce(to_id(F.col("game_pk")), to_text(F.col("game_pk")))
    if "game_date" in have:
        cols["game_date"] = parse_day(F.substring(F.col("game_date").cast("string"), 1, 10))
    if "barrel" in have:
        cols["barrel"] = flag(F.col("barrel").cast("string").try_cast("boolean"))
    if {"home_run", "events"} <= have:
        cols["home_run"] = flag(F.col("events") == "home_run")
    out = with_missing(typed.withColumns(cols), {"batter_name": "string"})
    if "game_pk" in have:
        out = out.dropna(subset=["game_pk"])
    if set(PITCH_KEY) <= have:
        out = keep_first(out, PITCH_KEY, [F.col(n).desc() for n in sent])
    return out.dropna(subset=[c for c in ("game_date", "pitcher", "batter") if c in have]).drop(*sent)


def pitch_flags(df: DataFrame) -> DataFrame:
    """`swing`, `whiff`, `in_zone`, `hard_hit` as 0/1; unknown counts as 0."""
    cols = {}
    if "description" in df.columns:
        cols["swing"] = flag(F.col("description").isin(*SWINGS))
        cols["whiff"] = flag(F.col("description").isin(*WHIFFS))
    if "zone" in df.columns:
        cols["in_zone"] = flag(F.col("zone") <= 9)
    if "launch_speed" in df.columns:
        cols["hard_hit"] = flag(F.col("launch_speed") >= 95)
    return df.withColumns(cols) if cols else df


def completed_only(df: DataFrame, games: DataFrame) -> DataFrame:
    """Rows of `df` whose game was completed."""
    done = games.where(is_completed(F.col("status"))).select("game_id")
    return require(df, ["game_id"]).join(done, "game_id", "left_semi")
