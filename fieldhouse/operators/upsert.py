"""Keyed merges between a target table and a source, as plain DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldhouse.functions.coerce import null_for_nan
from fieldhouse.schemas import AUDIT

ACTION = "_action"


def stamped(df: DataFrame, stamp: Column) -> DataFrame:
    """NaN as NULL, and the audit columns where they are missing."""
    return null_for_nan(df).withColumns({c: stamp for c in AUDIT if c not in df.columns})


def _resolved(joined: DataFrame, keys: Sequence[str], data: Sequence[str], given: set[str], stamp: Column) -> DataFrame:
    """Merged rows from target columns, `_s_` source columns and the two presence marks."""
    there, fresh = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in data if c in given], F.lit(True))
    action = F.when(~there, "insert").when(~fresh, "keep").when(same, "same").otherwise("update")
    return joined.withColumn(ACTION, action).select(
        *keys,
        *[F.when(fresh, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c) for c in data],
        F.when(there, F.col("insert_date")).otherwise(stamp).alias("insert_date"),
        F.when(F.col(ACTION).isin("insert", "update"), stamp).otherwise(F.col("update_date")).alias("update_date"),
        ACTION)


def merge_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], stamp: Column, source_is_small: bool = False,
) -> DataFrame:
    """All rows of the merged table, with `_action`: insert, update, same, keep.

    A row is updated only when a data column differs, NULLs compared as values. Target rows without a source row
    are kept. Source keys must be unique. With a source small enough to broadcast, the target is not shuffled:
    it meets the source in a broadcast join, and only the source side looks for keys the target lacks.
    """
    keys = list(keys)
    data = [c for c in target.columns if c not in (*keys, *AUDIT)]
    given = set(source.columns)
    s = source.select(
        *keys, *[F.col(c).alias(f"_s_{c}") for c in data if c in given], F.lit(True).alias("_s"))
    t = target.withColumn("_t", F.lit(True))
    if not source_is_small:
        return _resolved(t.join(s, keys, "full_outer"), keys, data, given, stamp)
    known = _resolved(t.join(F.broadcast(s), keys, "left"), keys, data, given, stamp)
    matched = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi")
    new = source.join(matched, keys, "left_anti")
    fresh = new.select(
        *keys, *[F.col(c).cast(target.schema[c].dataType).alias(c) if c in given
                 else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in data],
        stamp.alias("insert_date"), stamp.alias("update_date"), F.lit("insert").alias(ACTION))
    return known.unionByName(fresh)


def new_rows(source: DataFrame, existing: DataFrame, keys: Sequence[str], identity: Sequence[str] = ()) -> DataFrame:
    """Source rows whose key the existing table does not hold, without identity columns."""
    return source.drop(*identity).join(existing.select(*keys), list(keys), "left_anti")


def action_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy(ACTION).agg(F.count("*").alias("n"))
