"""Labels: 1, 0, or NULL where a game cannot be labelled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _beats(left: Column, right: Column) -> Column:
    """1 above, 0 below, NULL on equality or when either side is unknown."""
    return F.when(left != right, (left > right).cast("int"))


def baseball_targets(df: DataFrame) -> DataFrame:
    """`homeWin`, `homeCover`, `wentOver`; no row is dropped."""
    home, away = F.col("homeRuns"), F.col("awayRuns")
    nothing = F.lit(None).cast("int")
    return df.withColumns({
        "homeWin": _beats(home, away),
        "homeCover": _beats(home + F.col("homeSpread"), away) if "homeSpread" in df.columns else nothing,
        "wentOver": _beats(home + away, F.col("overUnder")) if "overUnder" in df.columns else nothing,
    })


def _without_pushes(df: DataFrame, left: Column, right: Column) -> DataFrame:
    return df.where(~F.coalesce(left == right, F.lit(False)))


def spread_target(df: DataFrame, null_line_as_zero: bool = False) -> DataFrame:
    """`homeCover` with pushes removed; unscored games stay with NULL.

    `null_line_as_zero` labels a scored game without a line 0, as frames that compare with NaN do.
    """
    left, right = F.col("homePoints") + F.col("homeSpread"), F.col("awayPoints")
    label = _beats(left, right)
    if null_line_as_zero:
        scored = F.col("homePoints").isNotNull() & F.col("awayPoints").isNotNull()
        label = F.when(scored, F.coalesce(label, F.lit(0)))
    return _without_pushes(df, left, right).withColumn("homeCover", label)


def total_target(df: DataFrame, null_line_as_zero: bool = False) -> DataFrame:
    """`actualTotal` and `wentOver` with pushes removed."""
    total = F.col("homePoints") + F.col("awayPoints")
    label = _beats(total, F.col("overUnder"))
    if null_line_as_zero:
        label = F.when(total.isNotNull(), F.coalesce(label, F.lit(0)))
    return _without_pushes(df, total, F.col("overUnder")).withColumns({"actualTotal": total, "wentOver": label})


def labelled(df: DataFrame, target: str, *needed: str) -> DataFrame:
    """Training rows: target and every needed column present."""
    return df.dropna(subset=[target, *needed])


def holdout(df: DataFrame, when: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut-off date, and the rest."""
    cut = F.lit(cutoff).cast(df.schema[when].dataType)  # typed like the column, so the test reaches the scan
    return df.where(F.col(when) < cut), df.where(F.col(when) >= cut)
