"""Size checks that decide between a plain plan and one that splits large groups.

Nothing here pulls rows to the driver: every probe returns one number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """What one task, or one broadcast, is allowed to hold."""

    group_rows: int = 5_000_000
    """Rows of one window group that may be sorted by a single task."""
    broadcast_rows: int = 500_000
    """Rows of a lookup side that may be sent to every executor."""
    probe_free_bytes: int = 64 * 1024 * 1024
    """Inputs whose files total less than this hold no group too large for a task, so no probe runs."""
    broadcast_free_bytes: int = 32 * 1024 * 1024
    """A lookup made from files of less than this in total is broadcast without counting it."""

    @staticmethod
    def of(spark: SparkSession) -> "Limits":
        """Defaults, overridden by `fieldhouse.*` session settings."""
        base = Limits()
        for name in ("group_rows", "broadcast_rows", "probe_free_bytes", "broadcast_free_bytes"):
            value = spark.conf.get(f"fieldhouse.{name}", None)
            if value is not None:
                base = replace(base, **{name: int(value)})
        return base


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of all leaf relations under `df` as Catalyst sees them; None where the plan is not reachable."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except (AttributeError, TypeError):
        return None


def _under(df: DataFrame, bound: int) -> bool:
    size = input_bytes(df)
    return size is not None and size <= bound


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the most frequent key. Counts combine map-side, so a hot key costs nothing extra."""
    if not keys:
        return df.count()
    counted = df.groupBy(*keys).count().agg(F.max("count").alias("n"))
    return counted.first()["n"] or 0


def groups_fit(df: DataFrame, keys: Sequence[str], limits: Limits | None = None) -> bool:
    """True when every key group is small enough for one window task."""
    limits = limits or Limits.of(df.sparkSession)
    return _under(df, limits.probe_free_bytes) or largest_group(df, keys) <= limits.group_rows


def beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """The columns of a one-row frame next to every row of `df`, as a scalar subquery: no join is involved."""
    value = one_row.select(F.struct(*one_row.columns).alias("_one")).scalar()
    return df.withColumn("_one", value).select(*df.columns, "_one.*")


def lookup(df: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Mark a lookup side for broadcast only after its size is known; otherwise leave the join to AQE."""
    limits = limits or Limits.of(df.sparkSession)
    if _under(df, limits.broadcast_free_bytes) or df.limit(limits.broadcast_rows + 1).count() <= limits.broadcast_rows:
        return F.broadcast(df)
    return df
