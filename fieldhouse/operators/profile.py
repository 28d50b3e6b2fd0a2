"""Descriptive aggregates: date-range summaries, duplicates, column profiles, value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldhouse.operators.sizing import beside


def date_range_summary(df: DataFrame, day: str, game: str, start: str, end: str) -> DataFrame:
    """First and last day, rows and distinct games between two days, both inclusive: one row."""
    return df.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))).agg(
        F.min(day).alias("min_date"), F.max(day).alias("max_date"),
        F.count("*").alias("pitch_count"), F.count_distinct(game).alias("game_count"))


def has_data(df: DataFrame, day: str, start: str, end: str) -> bool:
    """Whether any row falls in the range; stops at the first one."""
    return not df.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))).isEmpty()


def extract_summary(df: DataFrame, day: str, distinct: dict[str, str]) -> DataFrame:
    """Rows, date span and distinct counts (`{output: column}`) of an extract: one row."""
    return df.agg(F.count("*").alias("records"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
                  *[F.count_distinct(c).alias(n) for n, c in distinct.items()])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column, one row each, with how often they occur."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that share their key with another row, and the number of such keys: one row."""
    return repeated_keys(df, keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"), F.count("*").alias("repeated_keys"))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key repeats."""
    return df.join(repeated_keys(df, keys).select(*keys), list(keys), "left_semi")


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, nulls, and for numbers min, max, mean, zeros, negatives. One pass over the data."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    none = F.lit(None).cast("double")

    def entry(f: T.StructField) -> Column:
        c, num = F.col(f"`{f.name}`"), f.name in numeric
        return F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count("*").alias("rows"), F.count_if(c.isNull()).alias("nulls"),
            (F.count_if(c.isNull()) * 100.0 / F.count("*")).cast("double").alias("null_pct"),
            (F.min(c).cast("double") if num else none).alias("min_value"),
            (F.max(c).cast("double") if num else none).alias("max_value"),
            (F.avg(c).cast("double") if num else none).alias("mean_value"),
            (F.count_if(c == 0) if num else F.lit(None).cast("long")).alias("zeros"),
            (F.count_if(c < 0) if num else F.lit(None).cast("long")).alias("negatives"))

    return df.agg(F.array(*[entry(f) for f in df.schema.fields]).alias("e")).select(F.inline("e"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value, NULL included. The shares divide by a one-row total of the counts."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_all"))
    return beside(counts, total).select(column, "n", (F.col("n") / F.col("_all")).alias("share"))
