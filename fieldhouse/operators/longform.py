"""Wide game rows <-> long team rows, and the features that come back as home/away pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldhouse.operators.shape import require

SIDES = ("home", "away")


def shared_stats(df: DataFrame, ignore: Sequence[str] = ("TeamId",)) -> list[str]:
    """Suffixes that exist under both prefixes."""
    found = [{c[len(s):] for c in df.columns if c.startswith(s)} for s in SIDES]
    return sorted((found[0] & found[1]) - set(ignore) - {""})


def to_long(
    df: DataFrame, stats: Sequence[str], entity: str = "TeamId", entity_as: str = "teamId",
    base: Sequence[str] = ("gameId", "season", "gameDate"), complete: bool = False,
) -> DataFrame:
    """One row per side per game. The game is scanned once: both sides come out of one generator.

    `complete` states that every side has an entity: a row without one fails the job that comes upon it.
    """
    require(df, [*base, *(f"{s}{entity}" for s in SIDES)], "games")
    stats = [s for s in stats if all(f"{side}{s}" in df.columns for side in SIDES)]

    def named(side: str) -> Column:
        value = F.col(f"{side}{entity}")
        missing = F.raise_error(F.concat(F.lit(f"{side}{entity} is missing in "), F.to_json(F.struct(*base))))
        return F.when(value.isNull(), missing.cast(df.schema[f"{side}{entity}"].dataType)).otherwise(value) if complete else value

    rows = F.array(*[
        F.struct(
            named(side).alias(entity_as),
            *[F.col(f"{side}{s}").alias(s) for s in stats],
            F.lit(side).alias("side"))
        for side in SIDES])
    return df.select(*base, F.explode(rows).alias("r")).select(*base, "r.*")


def by_game(long: DataFrame, columns: Sequence[str], prefix: Mapping[str, str]) -> DataFrame:
    """Long features back to one row per game, `prefix[side] + column`, in one shuffle."""
    return long.groupBy("gameId").agg(*[
        F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{prefix[side]}{c}")
        for side in SIDES for c in columns])


def pair_features(
    games: DataFrame, long: DataFrame, columns: Sequence[str],
    prefix: Mapping[str, str] | None = None,
) -> DataFrame:
    """Games with both sides' feature columns attached; games without features keep NULLs."""
    prefix = prefix or {"home": "home_", "away": "away_"}
    return games.join(by_game(long, columns, prefix), "gameId", "left")


def differences(home: str, away: str, op: str = "-") -> Column:
    return F.col(home) - F.col(away) if op == "-" else F.col(home) + F.col(away)
