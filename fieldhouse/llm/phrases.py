"""Collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces at punctuation; nothing is counted across a cut. A first pass counts pairs of neighbouring
words by their hashes, and marks those that come `least` times or more in a bitmap of fixed size. A phrase that comes so
often has only such pairs, so pieces are cut again between all other pairs, and no frequent phrase is lost: what the
bitmap marks by chance only makes longer pieces.

The longest grams (LONGEST words) of what is left are the edges of the graph, its nodes the grams of one word less in
which an edge begins and ends. Edges are aggregated once. A gram of k words is followed by another word of its piece, and
then begins a gram of k + 1 words, or it ends its piece. So its count is the flow out of it, the sum over the counts one
word longer, and a correction, the number of pieces that end in it; all shorter counts follow in turn, down to single
words, without looking at the texts again. Chains of nodes that pass on all that they receive to one neighbour are
compacted into paths of one weight by pointer doubling: a path is a passage whose parts never come without each other,
which is what removes shorter candidates in favour of longer ones.

Words travel as 64-bit hashes: the chance that any two of 10^8 different words of a language share one is 0.0003.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldhouse.llm.common import discard, saved, small_batches
from fieldhouse.llm.kernels import LOWER, PIECE, U, chunks, flat, list_column, mix, span_hashes

LONGEST = 5
"""Words of an edge."""
CLASS = np.zeros(256, np.uint8)
CLASS[[0x20, 0x09]] = 1
CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
"""Fixed values: bytes between words, and bytes that end a piece."""
BITS = 26
"""log2 of the bits that mark frequent pairs (8 MB); with many more pairs than that, pieces are cut less often."""
FLUSH = 1 << 21
"""Words that are aggregated together in a task."""
ROWS = 1 << 17


def slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray, bool]]:
    """(start, end, first text, offsets inside, whether the last text ends there); a long text comes in several, cut between words."""
    for i, j in chunks(offsets, PIECE):
        at, stop = int(offsets[i]), int(offsets[j])
        if stop - at <= PIECE:
            yield at, stop, i, offsets[i:j + 1] - at, True
            continue
        while at < stop:
            size = PIECE
            while at + size < stop and not CLASS[data[at:at + size]].any():
                size *= 2
            end = stop if at + size >= stop else at + int(np.flatnonzero(CLASS[data[at:at + size]])[-1]) + 1
            yield at, end, i, np.array([0, end - at]), end == stop
            at = end


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bytes, start, end, hash, piece, text) of all words of some texts; start and end point into the bytes returned."""
    none = np.zeros(0, np.int64)
    parts, base, piece = [(np.zeros(0, np.uint8), none, none, np.zeros(0, U), none, none)], 0, 0
    for at, end, first, own, closed in slices(data, offsets):
        texts = len(own) - 1
        low = np.full(end - at + texts * closed, 0x0A, np.uint8)  # a line end after every text that ends here
        low[np.arange(end - at) + np.repeat(np.arange(texts), np.diff(own))] = LOWER[data[at:end]]
        kind = CLASS[low]
        edge = np.diff(np.concatenate([[0], (kind == 0).view(np.int8), [0]]))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        number = np.cumsum(kind == 2)
        text = np.searchsorted(own[1:] + np.arange(1, texts + 1), start, side="right") if closed else np.zeros(len(start), np.int64)
        parts.append((low, start + base, stop + base, span_hashes(low, start, stop), number[start] + piece, text + first))
        base, piece = base + len(low), piece + int(number[-1] if len(number) else 0)
    return tuple(np.concatenate(c) for c in zip(*parts))


def language_hashes(column: pa.Array) -> np.ndarray:
    data, offsets = flat(column)
    return span_hashes(data, offsets[:-1], offsets[1:])


def pair_hashes(h: np.ndarray, piece: np.ndarray, language: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the word before and this one in their language, whether both are in one piece), for all words but the first."""
    return mix(mix(h[:-1] + language[:-1]) + h[1:]), piece[1:] == piece[:-1]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (pair, n), the hashes of neighbouring words of (text, lang) rows and their counts in a part of a task."""
    held: list[np.ndarray] = []

    def flush() -> Iterator[pa.RecordBatch]:
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        for k in range(0, len(pair), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(pair[k:k + ROWS].view(np.int64)), pa.array(n[k:k + ROWS], pa.int64())], ["pair", "n"])

    for b in batches:
        _, _, _, h, piece, text = words_of(*flat(b.column("text")))
        if len(h) > 1:
            pair, near = pair_hashes(h, piece, language_hashes(b.column("lang"))[text])
            held.append(pair[near])
        if sum(map(len, held)) >= FLUSH:
            yield from flush()
            held = []
    if held:
        yield from flush()


def frequent_pairs(rows: DataFrame, least: int) -> np.ndarray:
    """Bitmap of the pairs that come `least` times or more: 2^BITS bits, whatever the input."""
    pairs = rows.mapInArrow(rows_of, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    slot = F.shiftrightunsigned("pair", 64 - BITS + 6)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(pair, {64 - BITS}) & 63 AS INT))")
    found = pairs.groupBy(slot.alias("slot")).agg(F.bit_or(bit).alias("bits")).toPandas()  # 2^(BITS - 6) rows at most
    out = np.zeros(1 << (BITS - 6), U)
    out[found["slot"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(U)
    return out


def marked(bitmap: np.ndarray, pair: np.ndarray) -> np.ndarray:
    place = pair >> U(64 - BITS)
    return (bitmap[(place >> U(6)).astype(np.int64)] >> (place & U(63))) & U(1) == 1


GRAMS = "lang string, ws array<bigint>, n long, word string"


def grams_of(h: np.ndarray, on: np.ndarray, code: np.ndarray, languages: list[str]) -> Iterator[pa.RecordBatch]:
    """Edges and the ends of pieces (their last 1 to LONGEST - 1 words), counted. `on`: the word goes on a piece."""
    at = np.arange(len(h))
    place = at - np.maximum.accumulate(np.where(on, 0, at))
    last = np.append(~on[1:], True)
    for k in range(1, LONGEST + 1):
        end = at[(place >= k - 1) & last] if k < LONGEST else at[place >= k - 1]
        if not len(end):
            continue
        key = code[end].astype(U)
        for j in range(k - 1, -1, -1):
            key = mix(key + h[end - j])
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        end = end[first]
        ws = np.stack([h[end - j] for j in range(k - 1, -1, -1)], axis=1)
        lang = pa.DictionaryArray.from_arrays(pa.array(code[end], pa.int32()), pa.array(languages, pa.string())).cast(pa.string())
        for s in range(0, len(end), ROWS):
            own = ws[s:s + ROWS]
            yield pa.RecordBatch.from_arrays(
                [lang[s:s + ROWS], list_column(own.ravel().view(np.int64), np.full(len(own), k), pa.int64()), pa.array(n[s:s + ROWS], pa.int64()),
                 pa.nulls(len(own), pa.string())], ["lang", "ws", "n", "word"])


def graph_parts(rows: DataFrame, bitmap: Broadcast) -> DataFrame:
    """GRAMS: edges and piece ends with their counts, and (n = 0) the spelling of words that have a frequent pair."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, codes, spelled = [], {}, set()

        def flush() -> Iterator[pa.RecordBatch]:
            h, on, code = (np.concatenate(c) for c in zip(*held))
            yield from grams_of(h, on, code, list(codes))

        for b in batches:
            low, start, end, h, piece, text = words_of(*flat(b.column("text")))
            if len(h):
                pair, near = pair_hashes(h, piece, language_hashes(b.column("lang"))[text])
                on = np.concatenate([[False], near & marked(bitmap.value, pair)])
                used = on | np.append(on[1:], False)
                new, first = np.unique(h[used], return_index=True)
                at = np.flatnonzero(used)[first]
                fresh = [(int(w), bytes(low[start[i]:end[i]]).decode()) for w, i in zip(new.view(np.int64), at) if int(w) not in spelled]
                if fresh:
                    spelled.update(w for w, _ in fresh)
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(fresh), pa.string()), list_column(np.array([w for w, _ in fresh]), np.ones(len(fresh), int), pa.int64()),
                         pa.array(np.zeros(len(fresh)), pa.int64()), pa.array([w for _, w in fresh], pa.string())], ["lang", "ws", "n", "word"])
                code = np.array([codes.setdefault(x, len(codes)) for x in b.column("lang").to_pylist()], np.int32)
                held.append((h, on, code[text]))
            if sum(len(x[0]) for x in held) >= FLUSH:
                yield from flush()
                held, codes, spelled = [], {}, set()
        if held:
            yield from flush()

    return rows.mapInArrow(cut, GRAMS)


def head(ws: str = "ws") -> Column:
    return F.slice(ws, F.lit(1), F.size(ws) - 1)


def tail(ws: str = "ws") -> Column:
    return F.slice(ws, F.lit(2), F.size(ws) - 1)


class Graph:
    """Counts of frequent phrases of 1 to LONGEST words: `counts` (lang, ws, f), words per language: `totals` (lang, n), `spelling` (w, word)."""

    def __init__(self, docs: DataFrame, least: int) -> None:
        small_batches(docs.sparkSession)
        rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
        bitmap = docs.sparkSession.sparkContext.broadcast(frequent_pairs(rows, least))
        parts = saved(graph_parts(rows, bitmap), "phrases-parts")
        self.spelling = parts.where("word IS NOT NULL").select(F.col("ws")[0].alias("w"), "word").distinct()
        level, levels = None, []
        for k in range(LONGEST, 0, -1):
            inflow = parts.where("word IS NULL").where(F.size("ws") == k).select("lang", "ws", "n")
            if level is not None:
                inflow = inflow.unionAll(level.select("lang", head().alias("ws"), F.col("f").alias("n")))
            level = saved(inflow.groupBy("lang", "ws").agg(F.sum("n").alias("f")), f"phrases-{k}")
            levels.append(level)
        heavy = [x.where(F.col("f") >= least) for x in levels]
        self.counts = saved(heavy[0].unionAll(heavy[1]).unionAll(heavy[2]).unionAll(heavy[3]).unionAll(heavy[4]), "phrases-counts")
        self.totals = saved(levels[-1].groupBy("lang").agg(F.sum("f").alias("n")), "phrases-totals")
        for x in levels:
            discard(x)

    def paths(self) -> DataFrame:
        """(lang, ws, f): frequent edges compacted, as the words of whole paths; every frequent edge is in one path.

        An edge goes on in the next one if all that comes into the node between comes from it and goes into the next.
        """
        edges = self.counts.where(F.size("ws") == LONGEST)
        nodes = self.counts.where(F.size("ws") == LONGEST - 1).select("lang", F.col("ws").alias("node"), "f")
        ends = edges.select("lang", tail().alias("node"), "f", F.col("ws").alias("before"))
        begins = edges.select("lang", head().alias("node"), "f", "ws")
        links = nodes.join(ends, ["lang", "node", "f"]).join(begins, ["lang", "node", "f"]).select("lang", "ws", "before")
        jumps = edges.join(links, ["lang", "ws"], "left").select(
            "lang", "ws", "f", F.coalesce("before", "ws").alias("first"), F.col("before").isNotNull().cast("long").alias("steps"))
        jumps = saved(jumps, "phrases-jumps")
        while True:
            far = jumps.select("lang", F.col("ws").alias("first"), F.col("first").alias("_first"), F.col("steps").alias("_steps"))
            longer = saved(jumps.join(far, ["lang", "first"]).select(
                "lang", "ws", "f", F.col("_first").alias("first"), (F.col("steps") + F.col("_steps")).alias("steps"), (F.col("_steps") > 0).alias("moved")), "phrases-jumps")
            discard(jumps)
            jumps = longer
            if jumps.where("moved").isEmpty():
                break
        last = F.array_sort(F.collect_list(F.when(F.col("steps") > 0, F.struct("steps", F.element_at("ws", LONGEST).alias("w")))))
        whole = jumps.groupBy("lang", "first", "f").agg(last.alias("_last"))
        return whole.select("lang", F.concat("first", F.transform("_last", lambda x: x["w"])).alias("ws"), "f")

    def spelled(self, found: DataFrame) -> DataFrame:
        """Adds `phrase` to rows with lang and ws that are distinct in these."""
        one = found.select("lang", "ws", F.posexplode("ws").alias("_at", "w")).join(self.spelling, "w")
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "word"))), lambda x: x["word"]), " ")
        return found.join(one.groupBy("lang", "ws").agg(text.alias("phrase")), ["lang", "ws"])


def exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def phrases(docs: DataFrame, least: int = 100, top: int | None = 2000) -> DataFrame:
    """Collocations of every language: lang, rank, phrase, a, l, r, n, score, the first `top` of each (None: all).

    a, l and r are the counts of the phrase, of what stands before and after its weakest cut; score is
    floor(1000 * a * n / (l * r)) there, n the words of the language. Phrases of 2 to 5 words that come `least` times are
    candidates; those inside a longer candidate with the same count are left out. Order: score, then a, both falling,
    then phrase in byte order.

    A null text has no words; a null lang counts as `und`. Rows that repeat count again, whatever their ids. An empty
    table, or one without frequent phrases, gives an empty result. A very long text is worked on in slices. Columns
    besides text and lang are not read.
    """
    return collocations(Graph(docs, least), top)


def collocations(graph: Graph, top: int | None) -> DataFrame:
    counts = graph.counts
    inside = F.transform(F.sequence(F.lit(1), F.size("ws") - (LONGEST - 2)), lambda i: F.slice("ws", i, F.lit(LONGEST - 1)))
    covered = graph.paths().select("lang", F.explode(inside).alias("ws"), F.col("f").alias("a"))
    between = counts.where(F.size("ws").between(3, LONGEST - 1))
    for part in (head(), tail()):
        covered = covered.unionAll(between.select("lang", part.alias("ws"), F.col("f").alias("a")))
    left = counts.where(F.size("ws") > 1).withColumnRenamed("f", "a").join(covered, ["lang", "ws", "a"], "left_anti")
    cuts = left.select("lang", "ws", "a", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)).alias("cut"))
    cuts = cuts.withColumns({"before": F.slice("ws", F.lit(1), F.col("cut")), "after": F.slice("ws", F.col("cut") + 1, F.size("ws") - F.col("cut"))})
    part = lambda ws, f: counts.select("lang", F.col("ws").alias(ws), F.col("f").alias(f))
    cuts = cuts.join(part("before", "l"), ["lang", "before"]).join(part("after", "r"), ["lang", "after"]).join(graph.totals, "lang")
    cuts = cuts.withColumns({"_up": F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n"), "_down": exact("l") * exact("r")})
    cuts = cuts.withColumn("score", F.expr("_up div _down"))
    best = cuts.groupBy("lang", "ws", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("_m"))
    best = best.select("lang", "ws", "a", "n", "_m.score", "_m.l", "_m.r")
    own = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    if top is not None:  # all that can be among the first, whatever their spelling
        best = best.withColumn("_rank", F.rank().over(own)).where(F.col("_rank") <= top).drop("_rank")
    found = graph.spelled(saved(best, "phrases-best"))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long"))
    if top is not None:
        found = found.where(F.col("rank") <= top)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def passages(docs: DataFrame, least: int = 100) -> DataFrame:
    """(lang, passage, f): the compacted paths, passages of LONGEST words or more whose every edge comes `f` times."""
    graph = Graph(docs, least)
    return graph.spelled(saved(graph.paths(), "phrases-paths")).select("lang", F.col("phrase").alias("passage"), "f")


SQL = r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
    g AS (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 6) t(k) WHERE len(ws) >= k),
    c AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
    t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE k = 1 GROUP BY 1),
    a AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM c WHERE k > 1 AND f >= 100),
    d AS (SELECT a.*, unnest(range(1, a.k)) AS cut FROM a WHERE NOT EXISTS (
              SELECT 1 FROM a AS b WHERE b.lang = a.lang AND b.k > a.k AND 100 * b.a >= 100 * a.a
              AND contains(' ' || b.phrase || ' ', ' ' || a.phrase || ' '))),
    s AS (SELECT d.lang, d.phrase, d.a, x.f AS l, y.f AS r, t.n, cut, 1000::HUGEINT * d.a * t.n // (x.f::HUGEINT * y.f) AS score
          FROM d JOIN t USING (lang)
          JOIN c AS x ON x.lang = d.lang AND x.k = cut AND x.phrase = array_to_string(d.ws[1:cut], ' ')
          JOIN c AS y ON y.lang = d.lang AND y.k = d.k - cut AND y.phrase = array_to_string(d.ws[cut + 1:], ' ')),
    m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
    FROM m QUALIFY rank <= 2000"""
