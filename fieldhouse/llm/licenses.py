"""License scans by diagonal voting: which passages of license texts stand in a document, with gaps and changes.

Column expressions only. Every three successive words of every document are hashed and joined with the word triples of
the templates (a constant table); the words themselves are then compared, so that hashes decide nothing. A hit at place p
of a document and q of a template lies on the diagonal p - q. Hits are counted per document, template and diagonal, as
bits of the template's places, so that neither the order of rows nor rows that come twice matter. Diagonals of a template
next to each other, up to a quarter of its words and DRIFT apart, belong to one span: words were put in or left out
between. A span counts if enough of its template is covered and it is not much longer than its template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldhouse.llm.common import row_key
from fieldhouse.llm.license_texts import BASE, TEXTS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
"""Fixed values: letters to lower-case, and what a word is."""
K = 3
COVER, SHORT, STRETCH, DRIFT = 0.8, 8, 1.5, 8
"""Share of a template's triples to be found (all where it has fewer than SHORT words), and how much longer a span may be."""
BITS = 64


def words(text: str) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def triples(df: DataFrame, column: str) -> DataFrame:
    """Rows of `df` for every K successive words: pos, gram (their hash) and g (themselves); the columns of `df` stay."""
    out = df.select("*", F.posexplode_outer(column).alias("pos", "_first")).where(F.col("pos") <= F.size(column) - K)
    return out.withColumns({
        "gram": F.xxhash64("_first", *[F.get(column, F.col("pos") + i) for i in range(1, K)]),
        "g": F.slice(column, F.col("pos") + 1, F.lit(K))}).drop("_first")


def templates(spark: SparkSession, base: list[tuple[str, str]], texts: list[tuple[str, str]]) -> DataFrame:
    """(template, label, base, n): n is the number of word triples of a template."""
    rows = [F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(i < len(base)).alias("base"), F.lit(text).alias("text"))
            for i, (label, text) in enumerate([*base, *texts])]
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("_w", words("text"))


def diagonals(docs: DataFrame, known: DataFrame, slots: int) -> DataFrame:
    """Per document key, template and diagonal with a hit: bit fields of the template's places, first and last place."""
    marks = triples(known.select("template", "label", "base", "_w", (F.size("_w") - K + 1).alias("n")), "_w")
    marks = marks.select("template", "label", "base", "n", F.col("pos").alias("at"), "gram", F.col("g").alias("mark"))
    hits = triples(docs.select(*row_key(docs), words("text").alias("_words")), "_words").join(F.broadcast(marks), "gram").where("g = mark")
    bit = F.expr(f"shiftleft(1L, at % {BITS})")
    fields = [F.bit_or(F.when(F.floor(F.col("at") / BITS) == i, bit).otherwise(F.lit(0))).alias(f"b{i}") for i in range(slots)]
    return hits.groupBy("k1", "k2", "template", "label", "base", "n", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        *fields, F.min("pos").alias("first"), F.max("pos").alias("last"))


def spans_of(found: DataFrame, slots: int) -> DataFrame:
    """Neighbouring diagonals together: (k1, k2, label, start, end, cover, holds); `end` is exclusive, words from 0."""
    near = F.least(F.lit(DRIFT), F.floor((F.col("n") + K - 1) / 4))
    own = Window.partitionBy("k1", "k2", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(own)
    found = found.withColumn("_new", F.coalesce((gap > near).cast("int"), F.lit(1))).withColumn("_span", F.sum("_new").over(own))
    found = found.groupBy("k1", "k2", "template", "label", "n", "_span").agg(
        *[F.bit_or(f"b{i}").alias(f"b{i}") for i in range(slots)], F.min("first").alias("start"), (F.max("last") + K).alias("end"))
    size, covered = F.col("n") + K - 1, sum([F.bit_count(f"b{i}") for i in range(slots)], F.lit(0))
    cover = covered / F.col("n")
    fits = F.when(size < SHORT, covered == F.col("n")).otherwise(cover >= COVER) & (F.col("end") - F.col("start") <= size * STRETCH)
    return found.select("k1", "k2", "label", "start", "end", cover.alias("cover"), fits.alias("holds"))


def scanned(docs: DataFrame, base: list[tuple[str, str]] = BASE, texts: list[tuple[str, str]] = TEXTS) -> DataFrame:
    """Per row of `docs`: row (all its columns, as a struct), n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    `base` phrases count where their words stand consecutively; n_base is the number of such places, also overlapping
    ones, first_word and last_word their smallest and largest start (null without any). `spans` are the places of
    templates that hold, base ones included, as (start, end, label, cover) in order, ends exclusive. labels are those of
    spans and base places, base_labels those of the latter, distinct and sorted. score is the largest cover of any span,
    also of one too small to hold, and 0 without a hit. Templates have at least three words.

    Null and empty texts have no words and no spans. Repeated rows get equal results (their key is id and hash of the
    text, and bits of hits do not add up). An empty table gives an empty result. A very long text is one row until its
    words are rows. Other columns are carried unread, whatever their names.
    """
    spark = docs.sparkSession
    known = templates(spark, base, texts)
    slots = max(len(t.split()) for _, t in [*base, *texts]) * 2 // BITS + 1  # a blank-separated part can hold several words
    found = diagonals(docs, known, slots)
    full = sum([F.bit_count(f"b{i}") for i in range(slots)], F.lit(0)) == F.col("n")
    places = found.where("base").where(full).select(
        "k1", "k2", "label", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("n") + K - 1).alias("end"),
        F.lit(1.0).alias("cover"), F.lit(True).alias("holds"), F.lit(True).alias("base"))
    every = places.unionByName(spans_of(found.where("NOT base"), slots).withColumn("base", F.lit(False)))
    at = F.when(F.col("base"), F.col("start"))
    span = F.when(F.col("holds"), F.struct("start", "end", "label", "cover"))
    per = every.groupBy("k1", "k2").agg(
        F.count(at).alias("n_base"), F.min(at).cast("long").alias("first_word"), F.max(at).cast("long").alias("last_word"),
        F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set(F.when(F.col("holds"), F.col("label")))).alias("labels"),
        F.max("cover").alias("score"), F.sort_array(F.collect_list(span)).alias("spans"))
    rows = docs.select(*row_key(docs), F.size(words("text")).cast("long").alias("n_words"), F.struct(*docs.columns).alias("row"))
    none = F.array().cast("array<string>")
    return rows.join(per, ["k1", "k2"], "left").select(
        "row", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int,label:string,cover:double>>")).alias("spans"))


def sql() -> str:
    """The same for DuckDB, over `documents` with distinct ids: words are compared, and nothing is hashed."""
    text = ", ".join("({}, '{}', {}, '{}')".format(i, label, i < len(BASE), " ".join(t.split()).replace("'", "''"))
                     for i, (label, t) in enumerate([*BASE, *TEXTS]))
    split = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
    WITH t AS (SELECT template, label, base, {split} AS ws FROM (VALUES {text}) v(template, label, base, text)),
    w AS (SELECT doc_id, {split} AS ws FROM documents),
    g AS (SELECT doc_id, unnest(range(0, len(ws) - 2)) AS pos, ws FROM w WHERE len(ws) > 2),
    m AS (SELECT template, label, base, len(ws) AS size, unnest(range(0, len(ws) - 2)) AS q, ws FROM t),
    gw AS (SELECT doc_id, pos, ws[pos + 1] AS a, ws[pos + 2] AS b, ws[pos + 3] AS c FROM g),
    mw AS (SELECT template, label, base, size, q, ws[q + 1] AS a, ws[q + 2] AS b, ws[q + 3] AS c FROM m),
    d AS (SELECT doc_id, template, label, base, size, pos - q AS diagonal, list(DISTINCT q) AS ats, min(pos) AS lo, max(pos) AS hi
          FROM gw JOIN mw USING (a, b, c) GROUP BY ALL),
    b AS (SELECT doc_id, label, diagonal FROM d WHERE base AND len(ats) = size - 2),
    n AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER o > least(8, size // 4), true) AS new FROM d WHERE NOT base
          WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
    s AS (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM n),
    c AS (SELECT doc_id, label, size, len(list_distinct(flatten(list(ats)))) AS n, min(lo) AS lo, max(hi) + 3 AS hi FROM s
          GROUP BY doc_id, template, label, size, span),
    h AS (SELECT doc_id, label, n / (size - 2) AS cover,
                 CASE WHEN size < 8 THEN n = size - 2 ELSE n / (size - 2) >= 0.8 END AND hi - lo <= size * 1.5 AS holds, NULL AS start FROM c
          UNION ALL SELECT doc_id, label, 1.0, true, diagonal FROM b)
    SELECT w.doc_id, CAST(any_value(len(w.ws)) AS BIGINT) AS n_words, count(h.start) AS n_base,
           CAST(min(h.start) AS BIGINT) AS first_word, CAST(max(h.start) AS BIGINT) AS last_word,
           coalesce(string_agg(DISTINCT h.label, ',' ORDER BY h.label) FILTER (h.start IS NOT NULL), '') AS base_labels,
           coalesce(string_agg(DISTINCT h.label, ',' ORDER BY h.label) FILTER (h.holds), '') AS labels,
           CAST(coalesce(max(h.cover), 0) AS DOUBLE) AS score
    FROM w LEFT JOIN h ON h.doc_id = w.doc_id GROUP BY w.doc_id"""
