"""New landing files upserted as they arrive, each file once."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldhouse.operators.ordering import keep_first
from fieldhouse.plans.loads import Load
from fieldhouse.sources.tables import TableStore


ARRIVED = "_arrived"
"""When the file of a document arrived; rows that carry it are ordered by it."""


def follow_landing(
    store: TableStore, which: Load, path: str, checkpoint: str, files_per_batch: int | None = None, arrival: bool = False,
    as_of: date | None = None, back: int = 5, ahead: int = 0,
) -> StreamingQuery:
    """Process everything in the landing folder that was not processed before, then stop.

    A batch that is repeated after a failure changes nothing the second time: the upsert is keyed. Documents that come
    late or again count as changes of their keys. With `arrival` they carry ARRIVED; where `which.rows` keeps it, of
    several rows of one key in a batch the last to arrive counts, so that replaying a whole folder at once ends in the
    table that its files made one by one. With `as_of`, rows dated outside the look-back window are not merged but set
    aside beside the tables.
    """
    reader = store.spark.readStream.schema(which.ddl)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        rows = which.rows(batch)
        if ARRIVED in rows.columns:
            rows = keep_first(rows, which.spec.keys, [F.desc(ARRIVED), *which.spec.keys]).drop(ARRIVED)
        if as_of is not None and which.when:
            day = F.col(which.when).cast("date")
            inside = F.coalesce(day.between(F.date_sub(F.lit(as_of), back), F.date_add(F.lit(as_of), ahead)), F.lit(False))
            store.reject(rows.where(~inside).select(F.to_json(F.struct("*")).alias("document")), which.spec)
            rows = rows.where(inside)
        store.upsert(rows, which.spec)

    documents = reader.json(path)
    if arrival:
        documents = documents.select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))
    return (documents.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
