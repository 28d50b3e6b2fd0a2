"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_stored: list[tuple[SparkSession, str]] = []


def build_session(app: str = "fieldhouse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE, skew-join splitting)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the cluster's `spark.checkpoint.dir`, or a scratch one in local mode."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="fieldhouse-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def pinned(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder, so row order and partition ids stay fixed on retries."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write `df` once as Parquet in the shared checkpoint folder and read it back; readers take only the columns they need.

    For results that several plans read and whose order does not matter; `pinned` keeps order and partitions too. The
    files are deleted when the session ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/fieldhouse-stored/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _stored:
        atexit.register(_delete_stored)
    _stored.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _delete_stored() -> None:
    for spark, path in _stored:
        sc = spark.sparkContext
        if getattr(sc, "_jsc", None) is not None:
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
