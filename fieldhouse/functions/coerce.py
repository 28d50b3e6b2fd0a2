"""Type coercions that turn bad input into NULL instead of failing, and NaN into NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTIONAL = (T.DoubleType, T.FloatType)


def null_for_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column; the rest is untouched."""
    fixed = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, FRACTIONAL)
    }
    return df.withColumns(fixed) if fixed else df


def to_number(c: Column, kind: str = "double") -> Column:
    """Numeric value, or NULL for text that is not a number."""
    n = c.try_cast("double")
    n = F.when(~F.isnan(n), n)
    return n if kind == "double" else n.try_cast(kind)


def to_whole(c: Column, integral: bool = False) -> Column:
    """Rounded half to even, as a nullable long. An `integral` column has nothing to round and no NaN."""
    return (c.cast("double") if integral else F.bround(to_number(c))).try_cast("long")


def to_scale(c: Column, digits: int) -> Column:
    """Rounded half to even at a fixed number of decimals."""
    return F.bround(to_number(c), digits)


def to_id(c: Column) -> Column:
    """Numeric-looking ids lose a decimal tail and become text: `1234.0` -> `1234`; other text becomes NULL."""
    return c.try_cast("decimal(38,4)").cast("decimal(38,0)").cast("string")


def to_id_or_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """`to_id` per column, but a column in which nothing parses keeps its text. One job for all columns."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    parsed = df.agg(*[F.count(to_id(F.col(c))).alias(c) for c in present]).first()
    return df.withColumns({c: to_id(F.col(c)) if parsed[c] else F.col(c).cast("string") for c in present})


def to_bit(c: Column, null_is_zero: bool = False) -> Column:
    """0/1 from booleans, numbers or their text; optionally with NULL as 0."""
    bit = c.cast("string").try_cast("boolean").cast("int")
    bit = F.coalesce(bit, (c.cast("string").try_cast("double") != 0).cast("int"))
    return F.coalesce(bit, F.lit(0)) if null_is_zero else bit


def to_text(c: Column, limit: int | None = None) -> Column:
    """Text cut to `limit` characters, with the word `nan` read as missing."""
    text = c.cast("string")
    text = F.substring(text, 1, limit) if limit else text
    return F.when(text != F.lit("nan"), text)


def to_time(c: Column, fmt: str | None = None) -> Column:
    """Timestamp in the session zone (UTC), NULL when it does not parse."""
    return F.try_to_timestamp(c.cast("string"), F.lit(fmt)) if fmt else c.cast("string").try_cast("timestamp")


def parse_day(c: Column) -> Column:
    """`yyyy-MM-dd` text to a date."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date")


def parse_iso(c: Column) -> Column:
    """ISO date-times with or without a trailing `Z`, both read as UTC."""
    return F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss")))


def date_named_to_time(df: DataFrame) -> DataFrame:
    """Every column with `date` in its name becomes a timestamp; bad values become NULL."""
    return df.withColumns({c: to_time(F.col(c)) for c in df.columns if "date" in c.lower()})


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or cannot be decided."""
    return F.coalesce(condition, F.lit(False)).cast("int")
