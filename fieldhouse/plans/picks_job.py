"""The daily picks job: features, upcoming games, scores, thresholds, stored picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldhouse.operators.picks import SPREAD_SIDES, check_picks, daily_picks, upcoming
from fieldhouse.plans import basketball
from fieldhouse.plans.models import score
from fieldhouse.schemas import BASKETBALL_TABLES
from fieldhouse.sources.tables import LoadResult, TableStore


def spread_picks(
    games: DataFrame, game_info: DataFrame, model: PipelineModel, as_of: Column,
    lower: float = basketball.LOWER_THRESHOLD, upper: float = basketball.UPPER_THRESHOLD,
    features: Sequence[str] = tuple(basketball.SPREAD_FEATURES),
) -> DataFrame:
    """Picks as one lazy plan. Upcoming games are cut out after the windows, which need the history before them."""
    table = basketball.build_model_table(games, basketball.SPREAD_STATS, basketball.SPREAD_WINDOWS, "homeCover")
    ahead = upcoming(table, as_of).dropna(subset=list(features))
    return daily_picks(score(model, ahead), game_info, lower, upper, as_of, SPREAD_SIDES)


def store_picks(picks: DataFrame, store: TableStore, dry_run: bool = False) -> LoadResult:
    """Upsert by game, after the uniqueness and side checks."""
    ids = picks.withColumn("gameId", F.col("gameId").cast("string"))
    return store.upsert(check_picks(ids), BASKETBALL_TABLES["SpreadModelPicks"], dry_run)
