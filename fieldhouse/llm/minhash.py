"""Near-duplicate documents: many universal hash minima, banding, signature verification, connected components.

A text's set is that of its word shingles. Its signature holds the minima of many universal hash functions over the
set; the minima of a few functions together are a band, and texts that agree in a band share a bucket. The number of
bands is such that a pair at the threshold shares no bucket with a probability of MISS.

Pairs inside a bucket are not written out. Equal sets are one node from the start. Then

1. a bucket's leader is its member with most bucket-mates over all bands, and every text meets the foremost leader of
   its buckets: the pairs that agree in enough of the signature are confirmed on full sets, and the links give first
   components;
2. buckets whose members are all in one component are done. In the others, each member outside the bucket's largest
   component meets one member of it, drawn anew for every bucket, and what is linked joins in;
3. in the buckets that are still open, each member outside the largest component meets all members of the bucket, in
   blocks of BLOCK signatures with their texts, so that no link is lost; what agrees in enough of the signature is
   confirmed on full sets right there, and only links leave the task.

So a group of thousands of near copies costs a few pairs per member, and there is no cap on a bucket. Texts are shuffled
once, compressed, to pick out those that share a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldhouse.llm.common import discard, saved, small_batches
from fieldhouse.llm.components import components
from fieldhouse.llm.kernels import U, chunks, flat, list_column, mix, packed_texts, unpacked, word_hashes

MISS = 1e-6
"""Chance that a pair at the threshold shares no bucket."""
SURE = 5.0
"""Standard deviations by which a signature may agree less than the threshold before the pair is given up."""
BLOCK = 256
TEXT_BITS, CHUNK = 12, 1 << 19


def plan(percent: int) -> tuple[int, int]:
    """(bands, rows of a band) for a threshold."""
    t = percent / 100
    rows = 5 if t > 0.8 else 4
    return math.ceil(math.log(MISS) / math.log(1 - t ** rows)), rows


def functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of `n` universal hash functions x -> (a * x + b) >> 32, from a fixed seed."""
    seeds = mix(np.arange(2 * n, dtype=U) + U(20_240_601))
    return seeds[:n] | U(1), seeds[n:]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of 52 bits in order, offsets of texts) of up to 4,096 texts.

    A text with fewer words than `width`, but any, has one shingle, of them all.
    """
    n = len(offsets) - 1
    words, text = word_hashes(data, offsets, low=True)
    last = len(words) - width + 1
    h = np.zeros(max(last, 0), U)
    for k in range(width):
        h = mix(h + words[k:k + len(h)] * U(2 * k + 3))
    whole = text[:len(h)] == text[width - 1:width - 1 + len(h)]
    h, of = h[whole], text[:len(whole)][whole]
    count = np.bincount(text, minlength=n)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        begin = np.searchsorted(text, short)
        extra = []
        for b, c in zip(begin, count[short]):
            x = np.array([c], U)
            for w in words[b:b + c]:
                x = mix(x + w)
            extra.append(x[0])
        h, of = np.concatenate([h, np.array(extra, U)]), np.concatenate([of, short])
    key = np.unique((of.astype(U) << U(64 - TEXT_BITS)) | (h >> U(TEXT_BITS)))
    ends = np.searchsorted(key, np.arange(n + 1, dtype=U) << U(64 - TEXT_BITS)) if n < 1 << TEXT_BITS else np.append(
        np.searchsorted(key, np.arange(n, dtype=U) << U(64 - TEXT_BITS)), len(key))
    return key & U((1 << (64 - TEXT_BITS)) - 1), ends


def _groups(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for i, j in chunks(offsets, CHUNK):
        for k in range(i, j, 1 << TEXT_BITS):
            yield k, min(j, k + (1 << TEXT_BITS))


def _each_set(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = flat(column)
    for i, j in _groups(offsets):
        x, ends = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], width)
        yield i, j, x, ends


def signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, signature, bands): size and fingerprint of the set, minima, bucket of each band."""
    multiplier, addend = functions(bands * rows)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, x, ends in _each_set(b.column("text"), width):
                n, some = np.diff(ends), np.diff(ends) > 0
                at = ends[:-1][some]
                f = np.zeros((2, j - i), U)
                sig = np.zeros((int(some.sum()), bands * rows), np.uint32)
                if len(x):
                    f[0, some], f[1, some] = np.add.reduceat(mix(x.copy()), at), np.add.reduceat(mix(x * U(0x9E3779B1)), at)
                    for k in range(bands * rows):
                        sig[:, k] = np.minimum.reduceat(x * multiplier[k] + addend[k], at) >> U(32)
                keys = np.zeros((len(sig), bands), U)
                for k in range(bands):
                    h = np.full(len(sig), k + 1, U)
                    for c in range(k * rows, (k + 1) * rows):
                        h = mix(h + sig[:, c])
                    keys[:, k] = h
                raw = iter(np.ascontiguousarray(sig))
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(i, j - i), pa.array(n), pa.array(f[0].view(np.int64)), pa.array(f[1].view(np.int64)),
                    pa.array([next(raw).tobytes() if s else None for s in some], pa.binary()),
                    list_column(keys.view(np.int64).ravel(), some * bands, pa.int64())],
                    ["doc_id", "n_shingles", "f1", "f2", "signature", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        signed, "doc_id long, n_shingles long, f1 long, f2 long, signature binary, bands array<long>")


def _matrix(column: pa.Array) -> np.ndarray:
    data, offsets = flat(column)
    return data.view(np.uint32).reshape(len(offsets) - 1, -1) if len(offsets) > 1 else np.zeros((0, 1), np.uint32)


def agreeing(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose signatures agree in a share of `least` or more."""
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                same = (_matrix(x.column("sa")) == _matrix(x.column("sb"))).mean(axis=1)
                yield x.select(["a", "b"]).filter(pa.array(same >= least))

    one = lambda k: nodes.select(F.col("rep").alias(k), F.col("signature").alias(f"s{k}"))
    return pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "sa", "sb").mapInArrow(compared, "a long, b long")


def candidates(docs: DataFrame, buckets: DataFrame) -> DataFrame:
    """(doc_id, text) of the texts that share a bucket, compressed; a shuffle at every size, as nothing bounds them."""
    wanted = buckets.select(F.col("rep").alias("doc_id")).distinct().hint("merge")
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(packed_texts, "doc_id long, text binary")
    return saved(packed.join(wanted, "doc_id", "left_semi"), "near-texts")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sides = []
            for name in ("ta", "tb"):
                sets: list[np.ndarray] = []
                for _, _, values, ends in _each_set(unpacked(x.column(name)), width):
                    sets += np.split(values, ends[1:-1])
                sides.append(sets)
            keep = [reaches(p, q, percent) for p, q in zip(*sides)]
            yield x.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = lambda k: texts.select(F.col("doc_id").alias(k), F.col("text").alias(f"t{k}"))
    found = pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "ta", "tb").mapInArrow(checked, "a long, b long")
    return saved(found.distinct(), "near-links")


def open_buckets(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, rep, root, main, blocks) of buckets with members of several components; main is the largest in the bucket."""
    placed = buckets.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("root", "rep").alias("root"))
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    several = sizes.groupBy("key").agg(
        F.max(F.struct("n", "root"))["root"].alias("main"), F.sum("n").alias("size"), F.count("*").alias("parts")).where(
        "parts > 1").select("key", "main", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    return placed.join(several, "key")


def draws(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of each member outside its bucket's largest component and one member of that, drawn by a hash."""
    drawn = rows.where("root = main").groupBy("key").agg(F.max(F.struct(F.xxhash64("key", "rep").alias("h"), "rep"))["rep"].alias("lead"))
    met = rows.where("root <> main").join(drawn, "key")
    return met.select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct()


def reaches(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sets (sorted, distinct) reach the threshold."""
    both = len(np.intersect1d(p, q, assume_unique=True))
    return len(p) > 0 and 100 * both >= percent * (len(p) + len(q) - both)


def across(rows: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int, least: float) -> DataFrame:
    """Links (a, b) between members of an open bucket that are in different components."""
    texts = texts.select(F.col("doc_id").alias("rep"), "text")
    rows = saved(rows.join(nodes.select("rep", "signature"), "rep").join(texts, "rep"), "near-open")
    number = F.row_number().over(Window.partitionBy("key").orderBy("root", "rep")) - 1
    fixed = rows.select("key", F.floor(number / BLOCK).cast("int").alias("block"), F.lit(0).alias("role"), "rep", "root", "signature", "text")
    moving = rows.where("root <> main").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), "rep", "root", "signature", "text")
    together = fixed.unionAll(moving).repartition("key", "block").sortWithinPartitions("key", "block", "role")

    def sets_of(column: pa.Array) -> list[np.ndarray]:
        sets: list[np.ndarray] = []
        for _, _, values, ends in _each_set(unpacked(column), width):
            sets += np.split(values, ends[1:-1])
        return sets

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rep, root, sig, full = None, [], [], [], []
        for x in batches:
            if not x.num_rows:
                continue
            key, block, role, r, c = (x.column(n).to_numpy() for n in ("key", "block", "role", "rep", "root"))
            m, sets = _matrix(x.column("signature")), sets_of(x.column("text"))
            turn = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (role[1:] != role[:-1])) + 1
            for s, e in zip(np.concatenate([[0], turn]), np.append(turn, len(key))):
                if (key[s], block[s]) != now:
                    now, rep, root, sig, full = (key[s], block[s]), [], [], [], []
                if role[s] == 0:
                    rep, root, sig, full = [*rep, r[s:e]], [*root, c[s:e]], [*sig, m[s:e]], full + sets[s:e]
                    continue
                if len(rep) > 1:
                    rep, root, sig = [np.concatenate(rep)], [np.concatenate(root)], [np.concatenate(sig)]
                a, b = [], []
                for i in range(s, e):
                    for j in np.flatnonzero((root[0] != c[i]) & ((sig[0] == m[i]).mean(axis=1) >= least)):
                        if reaches(sets[i], full[j], percent):
                            a.append(min(r[i], rep[0][j]))
                            b.append(max(r[i], rep[0][j]))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return saved(together.mapInArrow(met, "a long, b long").distinct(), "near-links")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Words are runs of other bytes than space and 0x09 to 0x0D, with A to Z lower-cased; a set holds the distinct
    shingles of `width` words (fewer words: all of them as one). Documents are linked if 100 * intersection is at least
    percent * union. component_id is the smallest doc_id of the connected documents, and kept is true where it is the
    row's own. Null texts and texts without words have an empty set and no link. Rows with equal ids are one document,
    linked with what any of their texts is linked with. A row without id is linked with nothing: component_id null,
    kept true. An empty table gives an empty result. Only doc_id and text are read.
    """
    small_batches(docs.sparkSession)
    bands, rows = plan(percent)
    t = percent / 100
    least = t - SURE * math.sqrt(t * (1 - t) / (bands * rows))
    signed = saved(signatures(docs, width, bands, rows), "near-signed")
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = saved(named.groupBy("f1", "f2").agg(
        F.min("doc_id").alias("rep"), F.first("signature").alias("signature"), F.first("bands").alias("bands")), "near-nodes")
    every = nodes.select("rep", F.explode("bands").alias("key"))
    shared = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = saved(every.join(shared, "key"), "near-buckets")
    mates = buckets.groupBy("rep").agg(F.sum("n").alias("mates"))
    foremost = F.max(F.struct("mates", (-F.col("rep")).alias("low"))).alias("lead")
    leaders = buckets.join(mates, "rep").groupBy("key").agg(foremost)
    stars = buckets.join(leaders, "key").groupBy("rep").agg(F.max("lead")["low"].alias("low")).select(
        (-F.col("low")).alias("a"), F.col("rep").alias("b")).where("a <> b")
    texts = candidates(docs, buckets)
    links = confirmed(saved(agreeing(stars, nodes, least), "near-stars"), texts, width, percent)
    roots = components(links, "a", "b")
    for last in (False, True):
        rows = saved(open_buckets(buckets, roots), "near-buckets-open")
        if last:
            more = across(rows, nodes, texts, width, percent, least)
        else:
            more = confirmed(saved(agreeing(draws(rows), nodes, least), "near-pairs"), texts, width, percent)
        roots = components(roots.where("node <> root").select("node", "root").unionAll(more.select("a", "b")), "node", "root")
    discard(texts)
    final = nodes.select("f1", "f2", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "f1", "f2", F.coalesce("root", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "f1", "f2").join(final, ["f1", "f2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", component)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
