"""Keyed Parquet tables under one root folder: append, upsert, insert-only copy, counts.

A table is a folder of versions, each a Parquet table as Spark writes it; readers take the newest one that was written
to its end. Appends go into that one. An upsert whose rows stay in their partitions overwrites only these partitions of
it, with Spark's dynamic partition overwrite: partitions change one after the other, so readers that look meanwhile may
see some of them changed, and an upsert that was cut short is made whole by repeating it. An upsert that moves a row to
another partition, or of a table without partitions, writes a whole new version; the one before stays for its readers
until the next one is written. One upsert of a table runs at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldhouse.operators.profile import has_data, repeated_keys
from fieldhouse.operators.shape import conform, with_missing
from fieldhouse.operators.sizing import Limits
from fieldhouse.operators.upsert import ACTION, action_counts, merge_rows, new_rows, stamped
from fieldhouse.schemas import AUDIT, TableSpec


@dataclass(frozen=True)
class LoadResult:
    table: str
    inserted: int = 0
    updated: int = 0
    unchanged: int = 0
    dry_run: bool = False
    rejected: int = 0


class TableStore:
    """Tables in `root/{name}`, on storage every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _versions(self, spec: TableSpec) -> dict[str, bool]:
        """Names of the versions in order, and whether each was written to its end."""
        fs, folder = self._fs(f"{self.root}/{spec.name}")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        done = lambda n: fs.exists(self._fs(f"{self.root}/{spec.name}/{n}/_SUCCESS")[1])
        return {n: done(n) for n in sorted(names) if n.startswith("v")}

    def path(self, spec: TableSpec) -> str:
        """The newest whole version, or where the first one will be."""
        whole = [n for n, done in self._versions(spec).items() if done]
        return f"{self.root}/{spec.name}/{whole[-1] if whole else 'v000001'}"

    def exists(self, spec: TableSpec) -> bool:
        return any(self._versions(spec).values())

    def _new_version(self, df: DataFrame, spec: TableSpec) -> None:
        """Write the whole table anew; then the version before it is the only other one that stays."""
        known = self._versions(spec)
        number = max((int(n[1:]) for n in known), default=0) + 1
        self._write(df, f"{self.root}/{spec.name}/v{number:06d}", spec, "errorifexists")
        whole = [n for n, done in known.items() if done]
        for name in set(known) - set(whole[-1:]):
            self._drop(f"{self.root}/{spec.name}/{name}")

    def read(self, spec: TableSpec) -> DataFrame:
        """The table, or an empty frame of its schema before the first load."""
        if self.exists(spec):
            # partition columns keep their declared type instead of one guessed from folder names
            stored = self.spark.read.option("mergeSchema", spec.open_columns).parquet(self.path(spec))
            return stored.withColumns({
                f.name: F.col(f.name).cast(f.dataType) for f in spec.schema.fields
                if f.name in spec.partition_by and stored.schema[f.name].dataType != f.dataType})
        audit = [T.StructField(c, T.TimestampType()) for c in AUDIT]
        return self.spark.createDataFrame([], T.StructType(spec.schema.fields + audit))

    def keys(self, spec: TableSpec) -> DataFrame:
        return self.read(spec).select(*spec.keys)

    def _write(self, df: DataFrame, path: str, spec: TableSpec, mode: str) -> None:
        writer = df.write.mode(mode).option("maxRecordsPerFile", 5_000_000)
        if spec.partition_by:
            writer = writer.partitionBy(*spec.partition_by)
            if mode == "overwrite":
                writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)

    def append(self, df: DataFrame, spec: TableSpec) -> None:
        self._write(stamped(df, F.current_timestamp()), self.path(spec), spec, "append")

    def _staged(self, df: DataFrame) -> tuple[DataFrame, str]:
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.parquet(path), path

    def _drop(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def upsert(self, df: DataFrame, spec: TableSpec, dry_run: bool = False, drop_stage: bool = True) -> LoadResult:
        """Merge `df` into the table by key and report what changed.

        The source is written once to a staging folder, so every later step sees the same rows. Only partitions
        that hold a source row, or a target row about to change, are read and rewritten, unless a row moves; see the
        head of this file. Nothing is written where nothing changes.
        """
        limits = Limits.of(self.spark)
        source, stage = self._staged(conform(df, spec.schema, extra=spec.open_columns))
        staged = [stage]
        try:
            if not repeated_keys(source, spec.keys).isEmpty():
                raise ValueError(f"{spec.name}: several source rows share a key {spec.keys}")
            small = source.limit(limits.broadcast_rows + 1).count() <= limits.broadcast_rows
            target = self.read(spec)
            target = with_missing(target, {f.name: f.dataType.simpleString() for f in source.schema.fields})
            here = bool(spec.partition_by) and self.exists(spec) and self._moved(target, source, spec, small).isEmpty()
            if here:
                target = self._touched(target, source, spec, small)
            merged = merge_rows(target, source, spec.keys, F.current_timestamp(), small)
            if here and not dry_run:
                merged, path = self._staged(merged)  # a partition cannot be read and overwritten at once
                staged.append(path)
            n = self._actions(merged)
            if not dry_run and (n.get("insert") or n.get("update")):
                if here:
                    self._write(merged.drop(ACTION), self.path(spec), spec, "overwrite")
                else:
                    self._new_version(merged.drop(ACTION), spec)
            return LoadResult(spec.name, n.get("insert", 0), n.get("update", 0), n.get("same", 0), dry_run)
        finally:
            for path in staged if drop_stage else ():
                self._drop(path)

    @staticmethod
    def _moved(target: DataFrame, source: DataFrame, spec: TableSpec, small: bool) -> DataFrame:
        """Keys that the source has in another partition than the table."""
        parts = list(spec.partition_by)
        there = source.select(*spec.keys, *[F.col(p).alias(f"_n_{p}") for p in parts if p not in spec.keys])
        other = [~F.col(p).eqNullSafe(F.col(f"_n_{p}")) for p in parts if p not in spec.keys]
        held = target.select(*dict.fromkeys([*spec.keys, *parts])).join(F.broadcast(there) if small else there, list(spec.keys))
        return held.where(reduce(lambda a, b: a | b, other, F.lit(False))).select(*spec.keys)

    @staticmethod
    def _actions(merged: DataFrame) -> dict[str, int]:
        return {r[ACTION]: r["n"] for r in action_counts(merged).collect()}  # at most four rows

    def _touched(self, target: DataFrame, source: DataFrame, spec: TableSpec, small: bool) -> DataFrame:
        """Target rows of the partitions an upsert can change. The partition list is small and prunes the scan."""
        parts = list(spec.partition_by)
        keys = source.select(*spec.keys)
        held = target.select(*dict.fromkeys([*spec.keys, *parts])).join(
            F.broadcast(keys) if small else keys, list(spec.keys), "left_semi")
        wanted = source.select(*parts).union(held.select(*parts)).distinct()
        rows = wanted.collect()  # one row per partition: values that prune the scan
        for p in parts:
            known = [r[p] for r in rows if r[p] is not None]
            test = F.col(p).isin(known)
            target = target.where(test | F.col(p).isNull() if any(r[p] is None for r in rows) else test)
        if len(parts) == 1:
            return target
        exact = self.spark.createDataFrame(rows, wanted.schema).select([F.col(p).alias(f"_w_{p}") for p in parts])
        return target.join(F.broadcast(exact), reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_w_{p}")) for p in parts]), "left_semi")

    def reject(self, documents: DataFrame, spec: TableSpec) -> int:
        """Keep documents that could not be read beside the tables; returns how many."""
        n = documents.count()
        if n:
            documents.withColumn("rejected_at", F.current_timestamp()).write.mode("append").parquet(f"{self.root}/_rejected/{spec.name}")
        return n

    def copy_new(self, df: DataFrame, spec: TableSpec) -> int:
        """Append the rows whose key is not there yet; returns how many."""
        seen = Observation()
        fresh = new_rows(df, self.keys(spec), spec.keys, spec.identity)
        counted = stamped(fresh, F.current_timestamp()).observe(seen, F.count(F.lit(1)).alias("n"))
        self._write(counted, self.path(spec), spec, "append")
        return seen.get["n"]

    def copy_all(self, sources: dict[str, DataFrame], specs: Iterable[TableSpec]) -> DataFrame:
        """Copy tables in dependency order; one summary row per table."""
        rows = [(s.name, self.copy_new(sources[s.name], s)) for s in specs if s.name in sources]
        return self.spark.createDataFrame(rows, "table string, inserted long")

    def counts(self, specs: Iterable[TableSpec]) -> DataFrame:
        """Row count per table, in one job."""
        parts = [self.read(s).agg(F.lit(s.name).alias("table"), F.count("*").alias("rows")) for s in specs]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.select("table", "rows")

    def load_unless_present(self, df: DataFrame, spec: TableSpec, day: str, start: str, end: str) -> LoadResult:
        """Upsert only when the table has no rows in the date range."""
        if self.exists(spec) and has_data(self.read(spec), day, start, end):
            return LoadResult(spec.name)
        return self.upsert(df, spec)
