"""Ordered computations that stay exact and bounded per task when one key holds a large share of the rows.

Two plans give the same rows:

* the plain window, used when a probe shows that every group fits in a task;
* a split plan: the rows are range-partitioned on (keys, order), so a hot key spreads over many partitions;
  the result is pinned once in the checkpoint folder, each (partition, key) chunk is processed on its own,
  and a small table with one row per chunk carries state from chunk to chunk.

`order` must identify rows uniquely inside a key: ties would make either plan non-deterministic.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fieldhouse.operators.sizing import Limits, beside, groups_fit, lookup
from fieldhouse.session import pinned

CHUNK = "_chunk"
BLOCK = "_block"


def _names(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Rows spread by range over (keys, order), tagged with an increasing chunk number, and pinned."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    sort = [F.col(k).asc_nulls_first() for k in keys] + _names(order)
    spread = df.repartitionByRange(parts, *sort).withColumn(CHUNK, F.spark_partition_id())
    return pinned(spread)


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def _attach(rows: DataFrame, carry: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on null-safe keys, keeping one copy of the key columns."""
    renamed = carry.select([F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in carry.columns])
    cond = reduce(lambda a, b: a & b, [rows[n].eqNullSafe(renamed[f"_r_{n}"]) for n in on])
    return rows.join(lookup(renamed), cond, "left").drop(*[f"_r_{n}" for n in on])


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "position",
    limits: Limits | None = None,
) -> DataFrame:
    """1-based row number inside each key."""
    limits = limits or Limits.of(df.sparkSession)
    if groups_fit(df, keys, limits):
        w = Window.partitionBy(*keys).orderBy(*_names(order))
        return df.withColumn(name, F.row_number().over(w).cast("long"))
    rows = _chunks(df, keys, order)
    within = Window.partitionBy(*keys, CHUNK).orderBy(*_names(order))
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy(*keys, CHUNK).agg(F.count("*").alias("_n")).select(
        *keys, CHUNK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_skip"))
    numbered = rows.withColumn("_rn", F.row_number().over(within))
    return _attach(numbered, carry, [*keys, CHUNK]).withColumn(
        name, (F.col("_rn") + F.col("_skip")).cast("long")).drop("_rn", "_skip", CHUNK)


def with_trailing(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], depth: int,
    columns: Callable[[WindowSpec], Sequence[Column]], limits: Limits | None = None,
) -> DataFrame:
    """Add window columns that look at most `depth` rows back (lagged means, lags, trailing rates).

    In the split plan the group is cut into blocks of consecutive rows, and the last `depth` rows of a block
    are repeated as context at the head of the next one.
    """
    limits = limits or Limits.of(df.sparkSession)
    if groups_fit(df, keys, limits):
        w = Window.partitionBy(*keys).orderBy(*_names(order))
        return df.select("*", *columns(w))
    size = max(limits.group_rows, depth, 1)
    placed = with_position(df, keys, order, "_pos", limits)
    own = F.floor((F.col("_pos") - 1) / size)
    in_tail = (F.col("_pos") - 1) % size >= size - depth
    copies = placed.withColumn("_own", own).withColumn(
        BLOCK, F.explode(F.when(in_tail, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array("_own"))))
    w = Window.partitionBy(*keys, BLOCK).orderBy("_pos")
    return copies.select("*", *columns(w)).where(F.col(BLOCK) == F.col("_own")).drop("_pos", "_own", BLOCK)


def with_running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
    totals: Mapping[str, Column] | None = None, peaks: Mapping[str, Column] | None = None,
    limits: Limits | None = None,
) -> DataFrame:
    """Add running sums (`totals`) and running maxima (`peaks`) from the start of each key to the current row."""
    limits = limits or Limits.of(df.sparkSession)
    totals, peaks = dict(totals or {}), dict(peaks or {})
    aggs = [(n, F.sum, e) for n, e in totals.items()] + [(n, F.max, e) for n, e in peaks.items()]
    if groups_fit(df, keys, limits):
        w = Window.partitionBy(*keys).orderBy(*_names(order)).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[f(e).over(w).alias(n) for n, f, e in aggs])
    rows = _chunks(df.select("*", *[e.alias(f"_v_{n}") for n, _, e in aggs]), keys, order)
    within = Window.partitionBy(*keys, CHUNK).orderBy(*_names(order)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy(*keys, CHUNK).agg(*[f(f"_v_{n}").alias(f"_c_{n}") for n, f, _ in aggs]).select(
        *keys, CHUNK, *[f(f"_c_{n}").over(before).alias(f"_p_{n}") for n, f, _ in aggs])
    local = rows.select("*", *[f(f"_v_{n}").over(within).alias(f"_w_{n}") for n, f, _ in aggs])
    merged = _attach(local, carry, [*keys, CHUNK])
    outs = []
    for n, f, _ in aggs:
        inside, carried = F.col(f"_w_{n}"), F.col(f"_p_{n}")
        if f is F.max:
            outs.append(F.greatest(inside, carried).alias(n))
        else:
            outs.append(F.when(inside.isNull() & carried.isNull(), None).otherwise(
                F.coalesce(inside, F.lit(0)) + F.coalesce(carried, F.lit(0))).alias(n))
    return merged.select(*[c for c in df.columns], *outs)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in `order`.

    The rank filter lets Spark cut each key to one row per map task before the shuffle (WindowGroupLimit),
    so a hot key never arrives whole at one task.
    """
    w = Window.partitionBy(*keys).orderBy(*_names(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def average_rank(
    df: DataFrame, keys: Sequence[str], value: str, pct: str, mean: str | None = None,
    limits: Limits | None = None,
) -> DataFrame:
    """Percentile rank of `value` inside `keys` with ties sharing their average rank; nulls stay null.

    Works on the table of distinct values with their counts, so the rows themselves are never sorted per key.
    `mean` optionally adds the key's mean of `value` from the same table.
    """
    limits = limits or Limits.of(df.sparkSession)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    placed = with_running(counts, keys, [value], totals={"_upto": F.col("_n")}, limits=limits)
    totals = counts.groupBy(*keys).agg(
        F.sum("_n").alias("_all"), (F.sum(F.col(value) * F.col("_n")) / F.sum("_n")).alias("_mean"))
    ranked = placed.join(lookup(totals, limits), list(keys)) if keys else beside(placed, totals)
    rank = F.col("_upto") - (F.col("_n") - 1) / F.lit(2.0)
    cols = [(rank / F.col("_all")).alias(pct)] + ([F.col("_mean").alias(mean)] if mean else [])
    table = ranked.select(*keys, value, *cols)
    return df.join(lookup(table, limits), [*keys, value], "left")
