"""Queries of the corpus operators over the whole given tables, each with its DuckDB counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldhouse.llm import hilbert, licenses, merges, minhash, neighbours, packing, pages, phrases, rules, secrets, suffixes, toxicity, whitening

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query("op1_hilbert_shards")
def op1(spark: SparkSession, d: str) -> DataFrame:
    placed = hilbert.hilbert_shards(table(spark, d, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")


@query("op2_suffix_dedup")
def op2(spark: SparkSession, d: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, d, "documents")).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op3_toxicity")
def op3(spark: SparkSession, d: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels"))
    return scored.select(
        "row.doc_id", toxicity.held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_merge_dropout")
def op4(spark: SparkSession, d: str) -> DataFrame:
    """Every text encoded with a tenth of its merges skipped, and decoded again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    back = merges.decode(merges.encode(table(spark, d, "documents"), model, seed=2024, rate=0.1), model)
    crc = lambda c: F.crc32(F.encode(F.coalesce(c, F.lit("")), "UTF-8"))
    return back.select(
        "row.doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        crc(F.col("row.text")).alias("text_crc32"), crc(F.col("decoded")).alias("decoded_crc32"),
        F.col("decoded").eqNullSafe(F.col("row.text")).alias("lossless"))


@query("op6_minhash_near_dedup", """
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
              ELSE list_distinct([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)]) END AS sh FROM w),
    x AS (SELECT doc_id, unnest(sh) AS g FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN s AS sa ON sa.doc_id = a JOIN s AS sb ON sb.doc_id = b
          WHERE 100 * n >= 85 * (len(sa.sh) + len(sb.sh) - n)),
    r(node, other) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.other),
    c AS (SELECT node, min(other) AS component_id FROM r GROUP BY 1)
    SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM s JOIN c ON c.node = s.doc_id""")
def op6(spark: SparkSession, d: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, d, "documents"), width=3, percent=85)


@query("op5_risk_controlled_rules")
def op5(spark: SparkSession, d: str) -> DataFrame:
    return rules.judged(table(spark, d, "documents"), table(spark, d, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


@query("op7_linear_grouping_packing")
def op7(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_randomness_secrets")
def op8(spark: SparkSession, d: str) -> DataFrame:
    return secrets.reported(secrets.with_secrets(table(spark, d, "documents"))).select(
        "row.doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query("op10_cross_polytope_neighbours")
def op10(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op9_recurrent_block_labels")
def op9(spark: SparkSession, d: str) -> DataFrame:
    return pages.extracted(table(spark, d, "pages")).select(
        "row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op11_collocations", phrases.SQL)
def op11(spark: SparkSession, d: str) -> DataFrame:
    return phrases.phrases(table(spark, d, "documents"), least=100, top=2000)


@query("op12_license_diagonals", licenses.sql())
def op12(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scanned(table(spark, d, "documents")).select(
        "row.doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


@query("op13_whitening_by_dqds")
def op13(spark: SparkSession, d: str) -> DataFrame:
    found = whitening.whitened(table(spark, d, "embeddings"), components=8)
    found = found.select("row.vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("_at", "whitened"))
    return found.select("vec_id", (F.col("_at") + 1).alias("component"), "n", "deviation", "whitened",
                        F.element_at("explained", F.col("_at") + 1).alias("explained"), "identity_error")
