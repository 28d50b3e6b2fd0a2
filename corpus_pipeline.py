"""A training-data pipeline over `documents`: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir). Its result is written as Parquet and read again as the next one's docs; all but
the last have the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldhouse.llm.common import saved
from fieldhouse.llm.minhash import near_duplicates
from fieldhouse.llm.packing import packed
from fieldhouse.llm.secrets import masked, with_secrets
from fieldhouse.llm.suffixes import without_repeats
from fieldhouse.llm.toxicity import toxicity


def _with_text(found: DataFrame, text: str, like: DataFrame) -> DataFrame:
    """The columns of `like` from a struct `row`, with another text and its length; a null text keeps its n_chars."""
    length = F.coalesce(F.char_length(text).cast("long"), F.col("row.n_chars"))
    new = {"text": F.col(text), "n_chars": length}
    return found.select(*[new.get(c, F.col(f"row.{c}")).alias(c) for c in like.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    scored = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("score < 0.5").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, 0.8), the one with the smallest id.

    A document is an id with a text: rows that repeat an id with another text are judged by their own text, and of rows
    that repeat both one stays. Rows without id stay.
    """
    node = F.xxhash64("doc_id", F.col("text").isNull(), "text")
    named = docs.where("doc_id IS NOT NULL")
    keys = named.select(node.alias("_node"), F.col("doc_id").alias("_id")).distinct()
    found = near_duplicates(named.select(node.alias("doc_id"), "text"), width=5, percent=80)
    grouped = found.select(F.col("doc_id").alias("_node"), "component_id").distinct().join(keys, "_node")
    kept = grouped.groupBy("component_id").agg(F.min(F.struct("_id", "_node"))["_node"].alias("_node")).select("_node")
    one = F.row_number().over(Window.partitionBy("_node").orderBy(F.xxhash64(*docs.columns)))
    left = named.withColumn("_node", node).join(kept, "_node", "left_semi").withColumn("_rn", one).where("_rn = 1")
    return left.select(docs.columns).unionAll(docs.where("doc_id IS NULL"))


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose every 200-byte string that is elsewhere too; all documents stay."""
    return _with_text(without_repeats(docs), "kept_text", docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; all documents stay."""
    found = with_secrets(docs).withColumn("clean", masked(F.col("row.text"), F.col("spans")))
    return _with_text(found, "clean", docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1,024 tokens."""
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("repeated_strings", drop_repeated_strings),
    ("secrets", mask_secrets), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
