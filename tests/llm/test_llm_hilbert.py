"""Curve, quantiles and places against plain Python."""

import zlib

import pytest
from pyspark.sql import functions as F

from fieldhouse.llm.hilbert import hilbert_index, hilbert_shards, with_place

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string"


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 3), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_differ_by_one_step(spark, n, bits):
    cells = spark.range(1 << (n * bits)).select(*[F.expr(f"(id >> {i * bits}) & {(1 << bits) - 1}").alias(f"c{i}") for i in range(n)])
    rows = cells.withColumn("h", hilbert_index([F.col(f"c{i}") for i in range(n)], bits)).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(1 << (n * bits)))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[f"c{i}"] - b[f"c{i}"]) for i in range(n)) == 1


def test_places_are_gapless_with_a_hot_cell(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 700, 3).otherwise(F.col("id") % 5).cast("long").alias("cell"))
    placed, total = with_place(df, "cell", ["id"], part_rows=50)
    rows = sorted(placed.collect(), key=lambda r: r["place"])
    assert total == 1000 and [r["place"] for r in rows] == list(range(1000))
    assert [r["cell"] for r in rows] == sorted(r["cell"] for r in rows)


def check(rows, docs, shards):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((d[0] is None, d[0] or 0) for d in docs)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for group in by.values():
        assert sorted(r["slot"] for r in group) == list(range(len(group)))
    want = sorted((d[0] if d[0] is not None else -1, len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in rows) == want


def test_nulls_ties_long_and_repeated_rows(spark):
    docs = [(i, "ab é" * (i % 7), "en" if i % 3 else None, f"s{i % 2}", i, 1, "x") for i in range(53)]
    docs += [(None, None, None, None, None, None, None), (5, "", "de", "s0", 0, 1, "x"), (5, "", "de", "s0", 0, 1, "x"), (99, "y" * 200_000, "en", "s0", 1, 1, "x")]
    rows = hilbert_shards(spark.createDataFrame(docs, SCHEMA), shards=8, bits=2).collect()
    check(rows, docs, 8)


def test_empty_table(spark):
    assert hilbert_shards(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    check(hilbert_shards(docs).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()], 8)
