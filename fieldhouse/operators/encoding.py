"""Turning raw columns into model inputs: filling, encoding, scaling.

Fitting reads the data in a few aggregations and keeps only statistics or short category lists on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldhouse.operators.ordering import with_running
from fieldhouse.operators.shape import target_last, text_for_objects
from fieldhouse.operators.sizing import Limits, beside


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# ---- filling -----------------------------------------------------------------------------------------------


def normal_noise(key: Sequence[str], column: str, seed: int) -> Column:
    """A standard normal draw fixed by row key, column and seed: a recomputed task draws the same value."""
    def unit(salt: int) -> Column:
        h = F.xxhash64(*[F.col(k) for k in key], F.lit(column), F.lit(seed), F.lit(salt))
        return (F.pmod(h, F.lit(1 << 52)) + 0.5) / float(1 << 52)

    return F.sqrt(F.log(unit(0)) * -2.0) * F.cos(unit(1) * (2.0 * math.pi))


def exact_median(df: DataFrame, value: str, limits: Limits | None = None) -> DataFrame:
    """One row, `median`. Distinct values are counted first, so no task has to hold the column."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
    placed = with_running(counts, [], [value], totals={"_upto": F.col("_n")}, limits=limits)
    total = counts.agg(F.sum("_n").alias("_all"))
    at = beside(placed, total)
    low, high = F.expr("(_all + 1) div 2"), F.expr("_all div 2 + 1")
    return at.agg(((F.min(F.when(F.col("_upto") >= low, F.col(value)))
                    + F.min(F.when(F.col("_upto") >= high, F.col(value)))) / 2.0).alias("median"))


def impute(
    df: DataFrame, key: Sequence[str], target: str | None = None, nonsense: Mapping[str, object] | None = None, seed: int = 42,
) -> DataFrame:
    """Missing or listed bad values: text becomes empty, numbers become draws around the mean of the good ones.

    A number column without any good value becomes 0. The target and the key stay as they are.
    """
    nonsense = dict(nonsense or {})
    skip = {target, *key}
    numbers = [c for c in numeric_columns(df) if c not in skip]
    texts = [c for c in text_columns(df) if c not in skip]

    def bad(c: str) -> Column:
        missing = F.col(c).isNull()
        return missing | (F.col(c) == F.lit(nonsense[c])) if c in nonsense else missing

    good = {c: F.when(~F.coalesce(bad(c), F.lit(False)), F.col(c).cast("double")) for c in numbers}
    stats = df.agg(*[f(e).alias(f"{p}_{c}") for c, e in good.items() for p, f in (("m", F.avg), ("s", F.stddev_samp))]
                   ).first() if numbers else {}
    filled = {}
    for c in numbers:
        mean, std = stats[f"m_{c}"], stats[f"s_{c}"]
        if mean is None:
            draw = F.lit(0.0)
        else:
            draw = F.lit(mean) + normal_noise(key, c, seed) * F.lit(std if std and std > 0 else 1.0)
        filled[c] = F.when(F.coalesce(bad(c), F.lit(False)), draw).otherwise(F.col(c).cast("double"))
    for c in texts:
        filled[c] = F.when(F.coalesce(bad(c), F.lit(False)), "").otherwise(F.col(c))
    return df.withColumns(filled) if filled else df


def fill(df: DataFrame, strategies: Mapping[str, object], key: Sequence[str], seed: int = 42) -> DataFrame:
    """Fill NULLs per column: `mean` or `median` (with noise), `zero`, `empty`, or a constant."""
    strategies = {c: v for c, v in strategies.items() if c in df.columns}
    numeric = set(numeric_columns(df))
    centred = [c for c, v in strategies.items() if v in ("mean", "median") and c in numeric]
    stats = df.agg(*[f(c).alias(f"{p}_{c}") for c in centred for p, f in (("m", F.avg), ("s", F.stddev_samp))]
                   ).first() if centred else {}
    cols = {}
    for c, how in strategies.items():
        if c in centred:
            middle = stats[f"m_{c}"] if how == "mean" else exact_median(df, c).first()["median"]
            if middle is None:
                continue
            std = stats[f"s_{c}"] or (abs(middle) * 0.1 if middle else 1.0)
            cols[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(middle)) + normal_noise(key, c, seed) * F.lit(float(std)))
        else:
            constant = {"zero": 0, "empty": ""}.get(how, how) if isinstance(how, str) else how
            cols[c] = F.coalesce(F.col(c), F.lit(constant))
    return df.withColumns(cols) if cols else df


# ---- encoding ----------------------------------------------------------------------------------------------


def two_valued(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """Columns with exactly two distinct values, with those values in order.

    Two passes of plain aggregates: the ends of each column, then whether anything lies between them.
    """
    if not columns:
        return {}
    ends = df.agg(*[f(c).alias(f"{p}_{c}") for c in columns for p, f in (("lo", F.min), ("hi", F.max))]).first()
    open_ = [c for c in columns if ends[f"lo_{c}"] is not None and ends[f"lo_{c}"] != ends[f"hi_{c}"]]
    if not open_:
        return {}
    other = df.agg(*[F.count_if(~F.col(c).isin(ends[f"lo_{c}"], ends[f"hi_{c}"])).alias(c) for c in open_]).first()
    return {c: (ends[f"lo_{c}"], ends[f"hi_{c}"]) for c in open_ if other[c] == 0}


def encode_binary(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Each two-valued column becomes one boolean, `{column}_{higher value}`."""
    kinds = (T.NumericType, T.StringType, T.BooleanType)
    candidates = [f.name for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, kinds)]
    found = two_valued(df, candidates)
    rest = [F.col(c) for c in df.columns if c not in found]
    return df.select(*rest, *[
        F.coalesce(F.col(c) == F.lit(hi), F.lit(False)).alias(f"{c}_{hi}") for c, (_, hi) in found.items()])


def categories(df: DataFrame, columns: Sequence[str], most: int = 100) -> dict[str, list[str]]:
    """Sorted values of the text columns that have at most `most` of them.

    A sketch first rules out columns with far too many values, so those are never shuffled. At most `most + 1`
    values of each remaining column leave the cluster, enough to see that there are too many.
    """
    columns = _not_wide(df, columns, most)
    if not columns:
        return {}
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns])))
    w = Window.partitionBy("c").orderBy("v")
    few = pairs.where("v IS NOT NULL").distinct().withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most + 1)
    found: dict[str, list[str]] = {}
    for row in few.collect():
        found.setdefault(row["c"], []).append(row["v"])
    return {c: sorted(v) for c, v in found.items() if len(v) <= most}


def encode_categories(df: DataFrame, columns: Sequence[str] | None = None, skip: Sequence[str] = (), most: int = 100) -> DataFrame:
    """One boolean per value except the last in sort order, which is the reference; wide columns stay as they are."""
    columns = [c for c in (columns if columns is not None else text_columns(df)) if c not in skip]
    found = categories(df, columns, most)
    rest = [F.col(c) for c in df.columns if c not in found]
    return df.select(*rest, *[
        F.coalesce(F.col(c) == F.lit(v), F.lit(False)).alias(f"{c}_{v}") for c in columns if c in found for v in found[c][:-1]])


def _not_wide(df: DataFrame, columns: Sequence[str], most: int) -> list[str]:
    """Columns that may have at most `most` values. The margin is many times the sketch's error."""
    if not columns:
        return []
    row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] <= 2 * most + 50]


def few_values(df: DataFrame, column: str, most: int) -> list | None:
    """Sorted distinct values, or None when there are more than `most`."""
    if not _not_wide(df, [column], most):
        return None
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect()
    return sorted(r[0] for r in rows) if len(rows) <= most else None


def encode_target(df: DataFrame, target: str, most: int = 10) -> DataFrame:
    """Numeric labels 0…k-1 stay; up to `most` other numbers become 0…k-1 in order; more mean a regression target."""
    if not isinstance(df.schema[target].dataType, T.NumericType):
        return df
    values = few_values(df, target, most)
    if values is None or [float(v) for v in values] == [float(i) for i in range(len(values))]:
        return df
    table = F.create_map(*[F.lit(x) for i, v in enumerate(values) for x in (v, i)])
    return df.withColumn(target, F.try_element_at(table, F.col(target)))


def problem_type(df: DataFrame, target: str) -> str:
    """Fewer than ten distinct target values make it a classification."""
    return "classification" if few_values(df, target, 9) is not None else "regression"


# ---- scaling -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Standardiser:
    """Centre and population deviation per column, learned from training rows only."""

    stats: dict[str, tuple[float, float]]

    @staticmethod
    def fit(train: DataFrame, columns: Sequence[str]) -> "Standardiser":
        row = train.agg(*[f(c).alias(f"{p}_{c}") for c in columns for p, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        return Standardiser({c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns if row[f"m_{c}"] is not None})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.stats.items() if c in df.columns})


def prepare(df: DataFrame, target: str, keep: Sequence[str] = (), skip: bool = False) -> DataFrame:
    """Objects as text, target coded, two-valued and category columns as booleans, target last."""
    if skip:
        return target_last(df, target)
    out = encode_target(text_for_objects(df), target)
    out = encode_binary(out, skip=[target, *keep])
    return target_last(encode_categories(out, skip=[target, *keep]), target)
