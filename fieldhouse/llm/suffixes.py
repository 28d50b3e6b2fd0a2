"""Removal of byte strings that occur more than once in a corpus, by bucket-pointer refinement of suffixes.

A suffix is a place in a text, and the buckets hold the suffixes that agree in their first h bytes. The first buckets
are the 8-grams. A bucket at depth 2h is named by the bucket identifiers of the place itself and of the place h further
on, so that each round reuses the identifiers the last one updated: 8, 16, 32, 64, 128, then 200 from two overlapping
128s. Identifiers are 64-bit names made from the pair of identifiers, not ranks: equal strings get equal names on
every executor without any exchange, and only suffixes that are still undecided are sorted into buckets across the
cluster.

Sorting across the cluster, from the shallowest bucket to the full depth:

1. Of each window of 200 bytes the place with the smallest 32-byte bucket identifier is its anchor (equal windows have
   equal anchors). Runs of neighbouring windows share an anchor, about one run per 85 bytes. Runs whose anchor's bucket
   has no other member are decided: none of their windows occurs twice.
2. A run's context (everything its windows cover) is named too. In a bucket, runs with equal contexts are all repeated.
3. What is left are runs at the edges of repeats. One run per distinct context sends the bytes its windows cover to the
   task of its bucket, which refines all places there to the full depth; windows in a bucket with another member are
   repeated. A bucket of more than GROUP contexts is dealt out further by the identifiers of its windows.

A bucket is always met as (32-byte identifier, deeper identifier), 128 bits together. All counts combine before they
are shuffled; joins are plain equi-joins, which Spark splits where a key is hot; nothing is collected. Where texts have
to travel, they do so compressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldhouse.llm.common import discard, row_key, saved, small_batches
from fieldhouse.llm.kernels import U, flat, mix, packed_texts, unpacked

DEPTH = 200
"""Bytes of a string whose repeats are removed."""
GRAM = 32
"""Depth of the buckets whose smallest member anchors a window; places the anchor can take: DEPTH - GRAM + 1."""
GROUP = 8192
"""Contexts of a bucket that one task refines together; there are as many parts of a larger bucket as this goes into it."""
CHUNK = 1 << 19
"""Bytes that are worked on at once; a longer text is cut into pieces whose windows do not overlap."""
PLACE_BITS = 20
LEFT, RIGHT = U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)
"""Odd multipliers for the two halves of a bucket's name."""


def named(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """Name of the bucket whose members have these identifiers at two places."""
    return mix(left * LEFT + right * RIGHT + U(salt))


def identifiers(data: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(identifiers at depth GRAM, identifiers at `depth`) of every place that has so many bytes after it."""
    ids = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view("<u8").ravel()
    h, grams = 8, None
    while h < depth:
        further = min(h, depth - h)
        ids = named(ids[:-further], ids[further:], further)
        h += further
        grams = ids if h == GRAM else grams
    return grams, ids


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:len(values) - (width - span)], values[width - span:]) if width > span else values


def _cut(lengths: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (text, first byte, bytes) of CHUNK bytes or so; each window of DEPTH bytes lies in just one piece."""
    group, size = [], 0
    for i in np.flatnonzero(lengths >= DEPTH):
        left, at = int(lengths[i]), 0
        while left - at >= DEPTH:
            take = min(left - at, CHUNK)
            if size + take > CHUNK and group:
                yield group
                group, size = [], 0
            group.append((int(i), at, take))
            size += take
            at += take - DEPTH + 1
    if group:
        yield group


def runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first window, windows, anchor's bucket, context) of all runs of windows that share an anchor."""
    for group in _cut(np.diff(offsets)):
        text, at, size = (np.array(x, np.int64) for x in zip(*group))
        part = np.concatenate([data[offsets[i] + a:offsets[i] + a + n] for i, a, n in group])
        begin = np.cumsum(size) - size
        grams, full = identifiers(part)
        mask = U((1 << PLACE_BITS) - 1)
        keys = (grams & ~mask) | np.arange(len(grams), dtype=U)
        anchor = (smallest(keys, DEPTH - GRAM + 1) & mask).astype(np.int64)
        # windows that lie inside one piece, and where a run of them starts
        inside = np.zeros(len(anchor) + 1, np.int64)
        np.add.at(inside, begin, 1)
        np.add.at(inside, np.minimum(begin + size - DEPTH + 1, len(anchor)), -1)
        valid = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        fresh = np.ones(len(valid), bool)
        fresh[1:] = (anchor[valid[1:]] != anchor[valid[:-1]]) | (valid[1:] != valid[:-1] + 1)
        piece_start = np.zeros(len(anchor) + 1, bool)
        piece_start[begin] = True
        fresh |= piece_start[valid]
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(valid)) - 1
        lo, hi, x = valid[first], valid[last], anchor[valid[first]]
        shape = ((hi - lo).astype(U) << U(16)) | (x - lo).astype(U)
        context = mix(named(full[lo], full[hi], DEPTH) + shape)
        which = np.searchsorted(begin, lo, side="right") - 1
        yield text[which], lo - begin[which] + at[which], hi - lo + 1, grams[x], context


def _runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        k1, k2 = (b.column(n).to_numpy(zero_copy_only=False) for n in ("k1", "k2"))
        for text, lo, n, gram, context in runs(*flat(b.column("text"))):
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[text]), pa.array(k2[text]), pa.array((lo << 8) | n), pa.array(gram.view(np.int64)), pa.array(context.view(np.int64))],
                ["k1", "k2", "run", "gram", "context"])


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets, flat values) of a list column, nulls as empty lists."""
    count = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(count)]).astype(np.int64), column.flatten()


def _slices_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, k1, k2, lo, alone, piece): the bytes that the windows of a listed run cover.

    In a bucket of several parts a run has a row for each part that some of its windows belong to, with these windows'
    identifiers and places for a piece.
    """
    names = ["bucket", "k1", "k2", "lo", "alone", "split", "piece"]
    for b in batches:
        data, offsets = flat(unpacked(b.column("text")))
        k1, k2 = (b.column(n).to_numpy(zero_copy_only=False) for n in ("k1", "k2"))
        ends, todo = _lists(b.column("todo"))
        run, gram, alone, parts = (todo.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        row = np.repeat(np.arange(len(k1)), np.diff(ends))
        lo, n = run >> 8, run & 255
        size = n + DEPTH - 1
        cut = np.concatenate([[0], np.cumsum(size)])
        source = np.arange(int(cut[-1])) + np.repeat(offsets[row] + lo - cut[:-1], size)
        piece = data[source]
        one = np.flatnonzero(parts == 1)
        raw = piece.tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram[one]), pa.array(k1[row[one]]), pa.array(k2[row[one]]), pa.array(lo[one]), pa.array(alone[one]),
             pa.array(np.zeros(len(one), bool)), pa.array([raw[cut[i]:cut[i + 1]] for i in one], pa.binary())], names)
        out: list[list] = [[], [], [], [], [], [], []]
        for i in np.flatnonzero(parts > 1):
            _, full = identifiers(piece[cut[i]:cut[i + 1]])
            part = full % U(parts[i])
            for t in np.unique(part):
                at = np.flatnonzero(part == t)
                bucket = mix(np.array([gram[i]]).view(U) + t).view(np.int64)[0]
                for column, v in zip(out, (bucket, k1[row[i]], k2[row[i]], lo[i], alone[i], True, full[at].tobytes() + at.astype(U).tobytes())):
                    column.append(v)
        if out[0]:
            kinds = [pa.int64()] * 4 + [pa.bool_()] * 2 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


def _refined(slices: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(identifier, slice, place in it) of the windows that some slices stand for."""
    split = slices.column("split").to_numpy(zero_copy_only=False)
    data, offsets = flat(slices.column("piece"))
    found = []
    for kind in (False, True):
        own = np.flatnonzero(split == kind)
        if not len(own):
            continue
        size = offsets[own + 1] - offsets[own]
        begin = np.cumsum(size) - size
        part = data if len(own) == len(split) else data[np.arange(int(size.sum())) + np.repeat(offsets[own] - begin, size)]
        n = size // 16 if kind else size - DEPTH + 1
        of = np.repeat(np.arange(len(own)), n)
        within = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        if kind:
            both = part.copy().view(U)
            at = begin[of] // 8 + within
            found.append((both[at], own[of], both[at + n[of]].astype(np.int64)))
        else:
            found.append((identifiers(part)[1][begin[of] + within], own[of], within))
    return tuple(np.concatenate(x) for x in zip(*found))


def _met(slices: pa.RecordBatch) -> pa.RecordBatch:
    """Runs of windows that are in another slice of their bucket too; all slices of a bucket are here."""
    full, of, within = _refined(slices)
    bucket = slices.column("bucket").to_numpy(zero_copy_only=False).view(U)
    _, inverse, count = np.unique(mix(full ^ mix(bucket.copy())[of]), return_inverse=True, return_counts=True)
    alone = slices.column("alone").to_numpy(zero_copy_only=False)
    hit = np.flatnonzero((count[inverse] > 1) & alone[of])
    fresh = np.ones(len(hit), bool)
    fresh[1:] = (of[hit[1:]] != of[hit[:-1]]) | (within[hit[1:]] != within[hit[:-1]] + 1)
    first = np.flatnonzero(fresh)
    n = np.diff(np.append(first, len(hit)))
    row = of[hit[first]]
    lo = slices.column("lo").to_numpy(zero_copy_only=False)[row] + within[hit[first]]
    return pa.RecordBatch.from_arrays(
        [slices.column(c).take(pa.array(row)) for c in ("k1", "k2")] + [pa.array((lo << 8) | n)], ["k1", "k2", "run"])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`_met` over batches whose rows are sorted by bucket; a bucket that goes on in the next batch waits for it."""
    waiting: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        bucket = b.column("bucket").to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(bucket, bucket[-1]))
        if waiting and (cut or waiting[0].column("bucket")[0].as_py() != bucket[0]):
            yield from map(_met, pa.Table.from_batches([*waiting, b.slice(0, cut)]).combine_chunks().to_batches())
            waiting = []
        elif cut:
            yield _met(b.slice(0, cut))
        waiting.append(b.slice(cut))
    if waiting:
        yield from map(_met, pa.Table.from_batches(waiting).combine_chunks().to_batches())


def repeated_windows(keyed: DataFrame) -> DataFrame:
    """(k1, k2, runs): runs of windows, `first byte << 8 | windows`, each of whose windows occurs elsewhere too."""
    texts = keyed.select("k1", "k2", "text").where(F.octet_length("text") >= DEPTH)
    longs = "k1 long, k2 long, run long, gram long, context long"
    every = saved(texts.mapInArrow(_runs_of, longs), "suffix-runs")
    # the small sides of joins are written first: Spark splits a hot key only between two plain shuffles
    common = saved(every.groupBy("gram").agg(F.count("*").alias("_n")).where("_n > 1").select("gram"), "suffix-common")
    shared = saved(every.join(common, "gram"), "suffix-shared")
    discard(every)
    classes = saved(shared.groupBy("gram", "context").agg(
        F.count("*").alias("members"), *[F.first(c).alias(c) for c in ("k1", "k2", "run")]), "suffix-classes")
    split = saved(classes.groupBy("gram").agg(F.count("*").alias("_n")).where("_n > 1").select(
        "gram", F.ceil(F.col("_n") / GROUP).alias("parts")), "suffix-split")
    whole = shared.join(classes.where("members > 1").select("gram", "context"), ["gram", "context"]).select("k1", "k2", "run")
    todo = classes.join(split, "gram").groupBy("k1", "k2").agg(F.collect_list(
        F.struct("run", "gram", (F.col("members") == 1).alias("alone"), "parts")).alias("todo"))
    slices = texts.mapInArrow(packed_texts, "k1 long, k2 long, text binary").join(todo, ["k1", "k2"]).select("k1", "k2", "text", "todo").mapInArrow(
        _slices_of, "bucket long, k1 long, k2 long, lo long, alone boolean, split boolean, piece binary")
    edges = slices.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_by_bucket, "k1 long, k2 long, run long")
    found = saved(whole.unionAll(edges).groupBy("k1", "k2").agg(F.collect_set("run").alias("runs")), "suffix-found")
    for t in (common, shared, classes, split):
        discard(t)
    return found


def covered(n_bytes: int, found: np.ndarray) -> np.ndarray:
    """Which bytes of a text lie in a repeated window."""
    change = np.zeros(n_bytes + 1, np.int64)
    np.add.at(change, found >> 8, 1)
    np.add.at(change, (found >> 8) + (found & 255) - 1 + DEPTH, -1)
    return np.cumsum(change[:-1]) > 0


def whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """`gone`, widened to whole UTF-8 characters."""
    start = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(start):
        return gone
    return np.repeat(np.logical_or.reduceat(gone, start), np.diff(np.append(start, len(data))))


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = flat(unpacked(b.column("text")))
        ends, found = _lists(b.column("runs"))
        found = found.to_numpy(zero_copy_only=False).astype(np.int64)
        known = b.column("text").is_valid().to_numpy(zero_copy_only=False)
        n_removed, n_spans, sha, texts = [], [], [], []
        for i in range(len(offsets) - 1):
            text = data[offsets[i]:offsets[i + 1]]
            if ends[i] == ends[i + 1]:
                n_removed.append(0)
                n_spans.append(0)
                sha.append(hashlib.sha256(text).hexdigest())
                texts.append(text.tobytes() if known[i] else None)
                continue
            gone = covered(len(text), found[ends[i]:ends[i + 1]])
            n_removed.append(int(gone.sum()))
            n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            sha.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
            texts.append(text[~whole_characters(text, gone)].tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), pa.array(np.diff(offsets)), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
             pa.array(sha, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())],
            ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: row (its other columns, as a struct), n_bytes, n_removed, n_spans, kept_sha256, kept_text.

    Every byte covered by a 200-byte string that starts anywhere else too, in the same text or another, is removed; all
    strings are judged on the input. kept_sha256 is over the bytes that stay. kept_text also loses the rest of a
    character that was cut (a repeat may begin inside one).

    A null text has no bytes (kept_text stays null); texts under 200 bytes are kept whole; a text of any length is
    worked on in pieces; rows that are there twice remove each other's repeats like any two texts; an empty table gives
    an empty result. Columns besides doc_id and text are carried along unread, whatever their names.
    """
    small_batches(docs.sparkSession)
    keyed = docs.select(*row_key(docs), "text", F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("row"))
    found = repeated_windows(keyed)
    kind = keyed.schema["row"].dataType.simpleString()
    packed = keyed.mapInArrow(packed_texts, f"k1 long, k2 long, text binary, row {kind}")
    rows = packed.join(found, ["k1", "k2"], "left").select("text", "row", "runs")
    return rows.mapInArrow(
        _cleaned, f"row {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
