"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

A pseudo-rotation is three rounds of random signs and a fast Hadamard transform. It maps the unit vector to a point
whose nearest signed axis (the vertex of the cross-polytope) is its hash; a table's bucket joins the vertices of `depth`
rotations. Vectors go into one bucket of each table, and queries into the `probes` buckets of each table that lie
nearest to them. Where they meet, Euclidean distances of the original vectors are computed in double precision, and the
nearest of each query are kept per task, then over all tasks.

How many rotations, tables and probes is measured: a pilot of the queries is compared with all vectors, and the cheapest
settings are taken by which TARGET of its true neighbours are reached, whatever the number of vectors and the dimension.
Where looking into buckets would be no less work than looking at every vector, and for queries that found fewer than
were asked for, all vectors are compared, a block of queries at a time.

Equal vectors are one entry of the index with their smallest ids (no more than are asked for can be among the nearest),
so a vector that is there a million times fills no bucket; other buckets with over SPLIT entries are cut by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldhouse.llm.common import pieces, saved, small_batches

SPLIT = 20_000
HELD = 20_000
"""Queries whose nearest so far a task holds before it passes them on."""


PILOT, TARGET = 96, 0.98
"""Queries (of different vectors) that are also compared with all entries, and the share of their nearest that the tables must reach."""
TABLES, PROBES = (12, 24, 48), 512
"""Numbers of tables tried, and the most buckets of a table that a query looks into."""
SHIPPED = 75
"""Distances that cost as much as sending one row to its bucket."""
BLOCK = 1 << 20
"""Numbers in the queries that are compared with all entries in one pass, and in the arrays that hold differences."""
PENDING = 1 << 18
"""Candidates that a task collects before it keeps the nearest of each query."""


@dataclass(frozen=True)
class Settings:
    """Rotations that a bucket joins, tables, and buckets that a query looks into in each."""

    depth: int
    tables: int
    probes: int


def settings(queries: np.ndarray, near: np.ndarray, of: np.ndarray, n: int, n_asked: int, seed: int) -> Settings | None:
    """The cheapest settings by which TARGET of the pilot's neighbours lie in a bucket that their query looks into.

    `near` holds true neighbours of the pilot `queries`, other than equal vectors, and `of` the query of each. The share
    is measured on them for every depth and number of tables, so it does not depend on `n` or on the dimension; these
    decide on the cost only. None where no tables reach it, or where a query would see as many rows as there are: all
    entries are then compared.
    """
    x, y = padded(queries), padded(near)
    sides, best = 2 * x.shape[1], None
    depth = 1
    while depth == 1 or sides ** (depth - 1) < n:
        rank = np.full(len(y), PROBES)
        for table in range(max(TABLES)):
            how = Settings(depth, 1, PROBES)
            same = probes_of(x, how, table, seed)[of] == buckets_of(y, how, table, seed)[:, None]
            rank = np.minimum(rank, np.where(same.any(axis=1), same.argmax(axis=1), PROBES))
            if table + 1 not in TABLES:
                continue
            probes = int(np.sort(rank)[int(np.ceil(TARGET * len(rank))) - 1]) + 1 if len(rank) else 1
            looks = (table + 1) * probes
            seen = looks * n / sides ** depth
            cost = SHIPPED * (table + 1) * n + n_asked * (SHIPPED * looks + seen)
            if probes <= PROBES and looks + seen < n and (best is None or cost < best[0]):
                best = cost, Settings(depth, table + 1, probes)
        depth += 1
    return best and best[1]


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row; the width is a power of two."""
    n, width, h = *x.shape, 1
    while h < width:
        x = x.reshape(n, -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


def rotated(x: np.ndarray, number: int, seed: int) -> np.ndarray:
    """The pseudo-rotation with this number."""
    rng = np.random.default_rng([seed, number])
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1]))
    return x


def padded(x: np.ndarray) -> np.ndarray:
    """Unit vectors, filled up with zeros to a power of two."""
    width = 1 << max(0, (x.shape[1] - 1).bit_length())
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


def buckets_of(x: np.ndarray, how: Settings, table: int, seed: int) -> np.ndarray:
    """Bucket of each vector in a table."""
    out = np.zeros(len(x), np.int64)
    for k in range(how.depth):
        r = rotated(x, table * how.depth + k, seed)
        axis = np.abs(r).argmax(axis=1)
        out = out * 2 * r.shape[1] + axis * 2 + (r[np.arange(len(r)), axis] > 0)
    return out


def probes_of(x: np.ndarray, how: Settings, table: int, seed: int) -> np.ndarray:
    """The nearest buckets of each vector (rows x probes), nearest first: vertices by the sum of their coordinates."""
    code, score = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for k in range(how.depth):
        r = rotated(x, table * how.depth + k, seed)
        both = np.concatenate([r, -r], axis=1)  # the two vertices of each axis
        few = min(both.shape[1], how.probes)
        top = np.argpartition(-both, few - 1, axis=1)[:, :few]
        value = np.take_along_axis(both, top, axis=1)
        vertex = (top % r.shape[1]) * 2 + (top < r.shape[1])
        code = (code[:, :, None] * (2 * r.shape[1]) + vertex[:, None, :]).reshape(len(x), -1)
        score = (score[:, :, None] + value[:, None, :]).reshape(len(x), -1)
        few = min(code.shape[1], how.probes)
        keep = np.argpartition(-score, few - 1, axis=1)[:, :few]
        code, score = np.take_along_axis(code, keep, axis=1), np.take_along_axis(score, keep, axis=1)
    return np.take_along_axis(code, np.argsort(-score, axis=1, kind="stable"), axis=1)


def usable(vector: str) -> Column:
    """Vectors that take part: no null or non-finite component, and not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _placed(kind: int, how: Settings, dim: int, seed: int):
    """Rows (table, bucket, kind, ids, vector) of index entries (kind 1) or queries (kind 0)."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = padded(_rows(b.column("vector"), dim))
            for table in range(how.tables):
                code = probes_of(x, how, table, seed) if kind == 0 else buckets_of(x, how, table, seed)[:, None]
                take = pa.array(np.repeat(np.arange(len(x)), code.shape[1]))
                n = len(take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, table, np.int32)), pa.array(code.ravel()), pa.array(np.full(n, kind, np.int32)),
                     b.column("ids").take(take), b.column("vector").take(take)], ["table", "bucket", "kind", "ids", "vector"])

    return place


class Best:
    """The `k` nearest so far of each query, from candidates (query, id, distance) in any order and number."""

    def __init__(self, k: int) -> None:
        self.k, self.parts, self.waiting, self.queries = k, [], 0, 0

    def add(self, query: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
        own = query != found
        self.parts.append((query[own], found[own], score[own]))
        self.waiting += int(own.sum())
        if self.waiting > PENDING:
            self.keep()

    def keep(self) -> None:
        query, found, score = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((found, score, query))
        query, found, score = query[order], found[order], score[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (found[1:] != found[:-1])  # the same pair has the same distance
        query, found, score = query[new], found[new], score[new]
        first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(query)))
        least = np.arange(len(query)) - np.repeat(first, size) < self.k
        self.parts, self.waiting, self.queries = [(query[least], found[least], score[least])], 0, len(first)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.keep()
            query, found, score = self.parts[0]
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])
        self.parts, self.queries = [], 0


FOUND = "query_id long, vec_id long, score double"
EMPTY = "query_id long, rank int, vec_id long, score double"


def _add_pairs(best: Best, names: np.ndarray, v: np.ndarray, q: np.ndarray, x: np.ndarray, e: np.ndarray, ids: tuple) -> None:
    """Distances of queries `q` and entries `e`, pair by pair; `ids` are all ids of the entries, the first of each and their number."""
    every, first, size = ids
    step = max(1, BLOCK // x.shape[1])
    for s in range(0, len(q), step):
        a, b = q[s:s + step], e[s:s + step]
        score = np.sqrt(((x[b] - v[a]) ** 2).sum(axis=1))
        n = size[b]
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[b], n)
        best.add(np.repeat(names[a], n), every[place], np.repeat(score, n))


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = column.value_lengths().to_numpy()
    return column.flatten().to_numpy(), np.cumsum(size) - size, size


def _nearest(dim: int, k: int):
    """Nearest of each query among the entries it meets; rows are sorted by bucket, queries before entries."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, vectors = None, np.zeros(0, np.int64), np.zeros((0, dim))  # queries of the bucket that goes on
        best = Best(k)
        for b in batches:
            if not b.num_rows:
                continue
            table, bucket, part, kind = (b.column(c).to_numpy() for c in ("table", "bucket", "part", "kind"))
            turn = np.flatnonzero((table[1:] != table[:-1]) | (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])) + 1
            begin, end = np.concatenate([[0], turn]), np.append(turn, len(table))
            x, ids = _rows(b.column("vector"), dim), _ids(b.column("ids"))
            if (table[0], bucket[0], part[0]) != now:
                names, vectors = names[:0], vectors[:0]
            kept = len(names)
            names, v = np.concatenate([names, ids[0][ids[1]]]), np.concatenate([vectors, x])
            asked = np.add.reduceat((kind == 0).astype(np.int64), begin)  # the bucket's queries are its first rows
            low, high = begin + kept, begin + kept + asked
            low[0] = 0
            entry = np.flatnonzero(kind == 1)
            group = np.searchsorted(begin, entry, side="right") - 1
            count = (high - low)[group]
            total = np.concatenate([[0], np.cumsum(count)])
            i = 0
            while i < len(entry):
                j = max(i + 1, int(np.searchsorted(total, total[i] + PENDING, side="right")) - 1)
                n = count[i:j]
                q = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[group[i:j]], n)
                _add_pairs(best, names, v, q, x, np.repeat(entry[i:j], n), ids)
                i = j
            now = (table[-1], bucket[-1], part[-1])
            names, vectors = names[low[-1]:high[-1]], v[low[-1]:high[-1]]
            if best.queries > HELD:
                yield from best.flush()
        yield from best.flush()

    return meet


def _against_all(names: np.ndarray, v: np.ndarray, k: int):
    """Nearest of each of some queries among all entries of a task."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, square = Best(k), (v ** 2).sum(axis=1)
        for b in batches:
            if not b.num_rows:
                continue
            x, ids = _rows(b.column("vector"), v.shape[1]), _ids(b.column("ids"))
            mine = (x ** 2).sum(axis=1)
            slack = 1e-9 * (square + mine.max())
            step = max(1, BLOCK // len(x))
            for s in range(0, len(v), step):
                near = square[s:s + step, None] + mine - 2 * (v[s:s + step] @ x.T)
                limit = np.partition(near, k, axis=1)[:, k] if len(x) > k else np.full(len(near), np.inf)  # k besides the own vector
                q, e = np.nonzero(~(near > (limit + slack[s:s + step])[:, None]))
                _add_pairs(best, names, v, q + s, x, e, ids)
        yield from best.flush()

    return scan


def scanned(entries: DataFrame, asked: DataFrame, dim: int, k: int) -> DataFrame | None:
    """Exact nearest of `asked` (ids, vector) among all `entries`, a block of queries in each pass; None without queries."""
    out, block = None, []
    rows = asked.toLocalIterator()
    while True:
        row = next(rows, None)
        if row is not None:
            block.append(row)
        if block and (row is None or len(block) * dim >= BLOCK):
            names = np.array([r["ids"][0] for r in block], np.int64)
            scan = _against_all(names, np.array([r["vector"] for r in block], np.float64), k)
            part = saved(ranked(entries.mapInArrow(scan, FOUND), k), "ann-scanned")
            out, block = (part if out is None else out.unionAll(part)), []
        if row is None:
            return out


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def fitted(rows: DataFrame, entries: DataFrame, asked: DataFrame, dim: int, k: int, seed: int) -> Settings | None:
    """Settings from a pilot: the queries with the smallest hashes of their vectors, compared with all entries."""
    pilot = asked.groupBy("vector").agg(F.min("ids").alias("ids")).orderBy(F.xxhash64("vector"), "ids").limit(PILOT).collect()
    if not pilot:
        return None
    names, x = np.array([r["ids"][0] for r in pilot], np.int64), np.array([r["vector"] for r in pilot], np.float64)
    found = ranked(entries.mapInArrow(_against_all(names, x, k), FOUND), k).select("query_id", "vec_id").collect()
    known = rows.sparkSession.createDataFrame([(i,) for i in sorted({r["vec_id"] for r in found})], "vec_id long")
    vector = {r["vec_id"]: r["embedding"] for r in rows.join(F.broadcast(known), "vec_id").select("vec_id", "embedding").collect()}
    place = {int(q): i for i, q in enumerate(names)}
    pairs = sorted((place[r["query_id"]], r["vec_id"]) for r in found)
    of = np.array([i for i, _ in pairs], np.int64)
    near = np.array([vector[j] for _, j in pairs], np.float64).reshape(-1, dim)
    other = (near != x[of]).any(axis=1)
    return settings(x, near[other], of[other], entries.count(), asked.count(), seed)


def nearest(vectors: DataFrame, query: Column, k: int = 10, how: Settings | None = None, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of each row of `vectors` (vec_id, embedding) that is a query.

    score is the Euclidean distance, ties go to the smaller vec_id, and a query is no neighbour of its own. Rows without
    vec_id take no part, nor do vectors that are null, all zero, or hold a null or non-finite component; where
    dimensions differ, the most frequent one takes part (of equals, the smallest). Repeated rows count once. An empty
    table, or one without queries, gives an empty result. Columns besides vec_id and embedding are unread. `how` fixes the
    settings that are else measured; jobs run while the result is built.
    """
    spark = vectors.sparkSession
    small_batches(spark, 2048)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", query.alias("asked")).where(
        usable("embedding") & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], EMPTY)
    dim = sizes["dim"]
    rows = rows.where(F.size("embedding") == dim).dropDuplicates()
    least = Window.partitionBy("embedding").orderBy("vec_id")
    entries = rows.withColumn("_rn", F.row_number().over(least)).where(F.col("_rn") <= k + 1).groupBy("embedding").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = saved(entries.select("ids", F.col("embedding").alias("vector")).repartition(pieces(spark)), "ann-vectors")
    asked = rows.where("asked").select(F.array("vec_id").alias("ids"), F.col("embedding").alias("vector"))
    how = how or fitted(rows, entries, asked, dim, k, seed)
    if how is None:
        out = scanned(entries, asked, dim, k)
        return spark.createDataFrame([], EMPTY) if out is None else out
    kind = f"table int, bucket long, kind int, ids array<long>, vector {rows.schema['embedding'].dataType.simpleString()}"
    placed = saved(entries.mapInArrow(_placed(1, how, dim, seed), kind), "ann-entries")
    probes = asked.repartition(pieces(spark)).mapInArrow(_placed(0, how, dim, seed), kind)
    large = saved(placed.groupBy("table", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > SPLIT).select(
        "table", "bucket", F.ceil(F.col("n") / SPLIT).alias("parts")), "ann-large")
    parts = F.coalesce("parts", F.lit(1))
    cut = placed.join(large, ["table", "bucket"], "left").withColumn("part", F.pmod(F.xxhash64("ids"), parts).cast("int"))
    spread = probes.join(large, ["table", "bucket"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    columns = ["table", "bucket", "part", "kind", "ids", "vector"]
    met = cut.select(columns).unionAll(spread.select(columns)).repartition("table", "bucket", "part").sortWithinPartitions(*columns[:4])
    found = saved(ranked(met.mapInArrow(_nearest(dim, k), FOUND).dropDuplicates(["query_id", "vec_id"]), k), "ann-found")
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("_full"))
    few = scanned(entries, asked.join(full, F.col("ids")[0] == F.col("_full"), "left_anti"), dim, k)
    return found if few is None else found.join(full, F.col("query_id") == F.col("_full"), "left_semi").unionAll(few)
