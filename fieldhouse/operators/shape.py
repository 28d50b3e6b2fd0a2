"""Projections driven by column names: require, rename, conform, align, order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require(df: DataFrame, columns: Iterable[str], what: str = "DataFrame") -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
    return df


def without_nulls(df: DataFrame, columns: Sequence[str], what: str = "DataFrame") -> DataFrame:
    """Rows with a value in each of `columns`."""
    return require(df, columns, what).dropna(subset=list(columns))


def select_renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """The mapped columns that exist, under their new names."""
    return df.select([F.col(old).alias(new) for old, new in mapping.items() if old in df.columns])


def select_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select([c for c in columns if c in df.columns])


def with_missing(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Typed NULL columns for names the frame lacks."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def conform(df: DataFrame, schema: T.StructType, extra: bool = False) -> DataFrame:
    """Columns of `schema` in its order and types: bad values and missing columns become NULL."""
    def one(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f.name)
        have = df.schema[f.name].dataType
        if have == f.dataType:
            return c
        if isinstance(f.dataType, T.IntegralType):
            # a fraction or a "5.0" must not turn into NULL on its way to a whole number
            c = c.try_cast("double") if not isinstance(have, T.IntegralType) else c
        return c.try_cast(f.dataType).alias(f.name)

    rest = [F.col(c) for c in df.columns if c not in schema.names] if extra else []
    return df.select(*[one(f) for f in schema.fields], *rest)


def align_features(df: DataFrame, trained: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the columns a model was trained on, in order; absent ones as 0. `keep` rides along in front."""
    features = [F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in trained]
    return df.select(*[k for k in keep if k in df.columns and k not in trained], *features)


def text_for_objects(df: DataFrame) -> DataFrame:
    """Every non-numeric, non-boolean, non-temporal column as text."""
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.StringType)
    odd = [f.name for f in df.schema.fields if not isinstance(f.dataType, plain)]
    return df.withColumns({c: F.to_json(c) for c in odd}) if odd else df


def target_last(df: DataFrame, target: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != target], target)


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The first `n` rows, in `order` when given."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns."""
    return df.limit(0)


def create_table_ddl(name: str, schema: T.StructType, keys: Sequence[str] = (), audit: bool = True) -> str:
    """`CREATE TABLE … USING parquet` for a schema; keys are kept as a table property, as Parquet has none."""
    fields = list(schema.fields)
    if audit:
        fields += [T.StructField(c, T.TimestampType()) for c in ("insert_date", "update_date") if c not in schema.names]
    props = f" TBLPROPERTIES ('keys' = '{','.join(keys)}')" if keys else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({T.StructType(fields).toDDL()}) USING parquet{props}"
