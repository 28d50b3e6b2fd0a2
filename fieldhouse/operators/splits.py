"""Train/test splits and folds with exact sizes.

A split is a cut in an order. The cut is found on counts per bucket of the order and then inside one bucket, so
rows are not sorted as a whole; what remains is a plain filter on the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldhouse.operators.ordering import with_position, with_running
from fieldhouse.operators.sizing import Limits, beside


def row_hash(key: Sequence[str], seed: int) -> Column:
    return F.xxhash64(*[F.col(k) for k in key], F.lit(seed))


def split_by_time(
    df: DataFrame, time: str, key: str, test_size: float = 0.2, limits: Limits | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The first whole number of rows up to `1 - test_size` by (time, key), and the rest."""
    counts = df.groupBy(time).agg(F.count("*").alias("n"))
    moments = with_running(counts, [], [time], totals={"upto": F.col("n")}, limits=limits)
    take = F.round(F.col("total") * F.lit(1.0 - test_size), 6).cast("long")
    sized = beside(moments, counts.agg(F.sum("n").alias("total"))).withColumn("take", take)
    # the moment at which the training part is full: one row
    at = sized.where("take > 0 AND take < total AND upto >= take").orderBy(time).select(
        time, (F.col("take") - (F.col("upto") - F.col("n"))).alias("need")).first()
    if at is None:
        whole = int(round(df.count() * (1.0 - test_size), 6)) > 0
        return (df, df.limit(0)) if whole else (df.limit(0), df)
    same = with_position(df.where(F.col(time) == F.lit(at[time])).select(time, key), [], [key], "_p", limits)
    last = same.where(F.col("_p") == at["need"]).first()[key]
    t, moment = F.col(time), F.lit(at[time])
    train = (t < moment) | ((t == moment) & (F.col(key) <= F.lit(last)))
    return df.where(train), df.where(~train)


def split_random(
    df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42, stratify: str | None = None,
    limits: Limits | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a seeded hash of the key, with exactly the rounded share of each class in test.

    Per class the cut is the k-th smallest hash: located among 65,536 hash ranges, then inside one of them.
    `key` must be unique. Stratify by columns of few values only.
    """
    by = [stratify] if stratify else []
    hashed = df.select(*by, key, row_hash([key], seed).alias("_h")).withColumn("_b", F.shiftright("_h", 48))
    buckets = hashed.groupBy(*by, "_b").agg(F.count("*").alias("n"))
    upto = with_running(buckets, by, ["_b"], totals={"upto": F.col("n")}, limits=limits)
    sizes = buckets.groupBy(*by).agg(F.floor(F.sum("n") * F.lit(test_size) + 0.5).alias("k"))
    located = (upto.join(F.broadcast(sizes), by) if by else beside(upto, sizes)).where(
        (F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("n") < F.col("k")))
    cuts = located.select(
        *[F.col(c).alias(f"_of_{c}") for c in by], F.col("_b").alias("_cut"),
        (F.col("k") - (F.col("upto") - F.col("n"))).alias("_need"))  # one row per class
    on = [F.col("_b") == F.col("_cut"), *[F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]]
    inside = hashed.join(F.broadcast(cuts), on).select(*by, "_h", key, "_need")
    placed = with_position(inside, by, ["_h", key], "_p", limits)
    ends = placed.where(F.col("_p") == F.col("_need")).select(*by, "_h", key).collect()  # one row per class
    h, k = row_hash([key], seed), F.col(key)
    test = F.lit(False)
    for row in ends:
        here = (h < F.lit(row["_h"])) | ((h == F.lit(row["_h"])) & (k <= F.lit(row[key])))
        test = test | (here & F.col(stratify).eqNullSafe(F.lit(row[stratify])) if by else here)
    return df.where(~test), df.where(test)


def halves(df: DataFrame, order: Sequence[str], limits: Limits | None = None) -> tuple[DataFrame, DataFrame]:
    """First and second half of the rows in order; an odd row goes to the second."""
    n = df.count()
    placed = with_position(df, [], order, "_p", limits)
    return placed.where(F.col("_p") <= n // 2).drop("_p"), placed.where(F.col("_p") > n // 2).drop("_p")


def with_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Shuffled folds 0…k-1 by a seeded hash of the key."""
    return df.withColumn(name, F.pmod(row_hash([key], seed), F.lit(k)).cast("int"))


def with_time_folds(df: DataFrame, time: str, key: str, k: int = 5, name: str = "fold", limits: Limits | None = None) -> DataFrame:
    """Blocks 0…k of equal size by time. Fold i trains on blocks before i and tests on block i, for i ≥ 1."""
    n = max(df.count(), 1)
    placed = with_position(df, [], [time, key], "_p", limits)
    return placed.withColumn(name, F.floor((F.col("_p") - 1) * F.lit(k + 1) / F.lit(n)).cast("int")).drop("_p")
