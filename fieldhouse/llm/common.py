"""What the corpus operators share: tables in the shared folder, row keys, and a few column expressions."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldhouse.session import ensure_checkpoint_dir

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; only where that is unset (tests), a scratch folder of a local session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or ensure_checkpoint_dir(spark)).rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: lineage ends there, and a lost executor loses nothing.

    The tables of a session are deleted when it ends; `discard` deletes one earlier.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/fieldhouse-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _written:
        atexit.register(_discard_all)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def discard(table: DataFrame) -> None:
    """Delete a table that `saved` wrote and nothing reads any more."""
    _delete(table.sparkSession, table.shared_path)
    _written[:] = [(s, p) for s, p in _written if p != table.shared_path]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _discard_all() -> None:
    for spark, path in _written:
        if getattr(spark.sparkContext, "_jsc", None) is not None:
            _delete(spark, path)


def pieces(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of few rows, as one row can be a very long text; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def text_bytes(text: str | Column) -> Column:
    """UTF-8 bytes of a text, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def row_key(df: DataFrame) -> list[Column]:
    """(k1, k2): rows have the same pair exactly if they have the same doc_id and text, up to 64-bit hashes of the text.

    Equal rows get equal results in every operator, so nothing needs a number per row.
    """
    return [F.coalesce("doc_id", F.lit(0)).cast("long").alias("k1"),
            F.xxhash64(F.col("doc_id").isNull(), F.col("text").isNull(), "text").alias("k2")]
