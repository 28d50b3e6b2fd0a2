"""Reading and writing files: tables by extension, landing JSON, pitch data."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet"}


def _format(path: str) -> str:
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext not in FORMATS:
        raise ValueError(f"unsupported file type: {ext or path}")
    return FORMATS[ext]


def read_file(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with header, JSON records (lines or one array), or Parquet, by extension.

    Give a schema for large inputs: without one CSV and JSON are read twice.
    """
    kind = _format(path)
    reader = spark.read.schema(schema) if schema else spark.read
    if kind == "csv":
        return reader.csv(path, header=True, inferSchema=schema is None)
    return reader.json(path, multiLine=schema is None) if kind == "json" else reader.parquet(path)


def processed_name(path: str) -> str:
    base, ext = os.path.splitext(path)
    return f"{base}_processed{ext}"


def write_file(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """A directory of part files in the format of the extension; returns its path."""
    kind = _format(path)
    writer = df.write.mode(mode)
    if kind == "csv":
        writer.csv(path, header=True)
    else:
        getattr(writer, kind)(path)
    return path


def write_by_value(df: DataFrame, column: str, path: str, mode: str = "errorifexists") -> str:
    """One CSV sub-directory per value of `column`, in one job."""
    df.write.mode(mode).partitionBy(column).csv(path, header=True)
    return path


def read_landing(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON documents of a landing directory under a fixed schema: no inference pass, bad documents as NULLs.

    The bad documents themselves are what `broken_documents` returns.
    """
    return spark.read.schema(ddl).json(path)


def broken_documents(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """(document) of a landing directory that do not parse under the schema, as they stand."""
    mark = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.from_json("value", f"{ddl}, _corrupt_record string", mark)
    return spark.read.text(path).where(F.trim("value") != "").select(
        F.col("value").alias("document"), parsed["_corrupt_record"].alias("_bad")).where(F.col("_bad").isNotNull()).select("document")


def season_scan(df: DataFrame, seasons: Sequence[int | str], column: str = "season") -> DataFrame:
    """Rows of the given seasons. On data partitioned by season the others are never read."""
    kind = df.schema[column].dataType
    return df.where(F.col(column).isin(*[F.lit(s).cast(kind) for s in seasons]))


def pitch_scan(df: DataFrame, start: str, end: str, team: str | None = None, day: str = "game_date") -> DataFrame:
    """Pitches of a date range, inclusive, optionally of games a team played in."""
    kind = df.schema[day].dataType
    rows = df.where(F.col(day).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))
    if team:
        rows = rows.where((F.col("home_team") == team) | (F.col("away_team") == team))
    return rows
