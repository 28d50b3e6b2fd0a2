"""Packing of documents into sequences of fixed capacity by the linear grouping scheme.

1. Executors turn texts into token ids and cut those longer than a sequence. Pieces are kept by length from here on.
2. The driver plans on the counts of lengths, one number per length up to the capacity, whatever the size of the corpus:
   * lengths over SMALL are put in order and cut into GROUPS groups of equal cardinality, and rounded up to the largest
     of their group;
   * how often to use which configuration of these few sizes is a linear program, solved by column generation (each new
     configuration is the best knapsack under the current prices);
   * whole uses of configurations are filled with actual lengths of their groups, which leaves gaps where rounding was;
   * lengths that rounding the program's solution left over, longest first, then the small ones, go where they fit best.
3. The plan is a list of bins alike in their lengths, with a number of uses each. A piece finds its place in it by its
   number among the pieces of its length: a join with a table whose size is bounded by the plan's.
"""

from __future__ import annotations

import bisect
import functools
import json
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fieldhouse.llm.common import discard, saved, small_batches
from fieldhouse.llm.hilbert import with_place

CAPACITY, END = 1024, 2
SMALL, GROUPS = 200, 160
STEPS = 1500
"""Columns that the linear program may generate; it is feasible after each."""


class Words:
    """Ids of texts by a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
        names = {b: chr(b) for b in letters} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(letters)))}
        byte = {c: b for b, c in names.items()}
        special = {t["content"]: t["id"] for t in made["added_tokens"]}
        vocabulary = {bytes(byte[c] for c in t): i for t, i in made["model"]["vocab"].items() if t not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value of the format
        self.coder = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens=special)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids, one after the other."""
        return np.array(self.coder.encode(text, allowed_special="all"), "<u4").tobytes()


@functools.lru_cache(maxsize=2)
def load(path: str) -> Words:
    return Words(path)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of `n` ids: all full but the first."""
    first = n - (n - 1) // capacity * capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces_of(docs: DataFrame, path: str, capacity: int, end: int, keep_ids: bool) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, and ids if wanted) of all texts."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, stop = load(path), np.array([end], "<u4").tobytes()
        for b in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                raw = words.ids(text or "") + stop
                for k, (start, n) in enumerate(cuts(len(raw) // 4, capacity)):
                    own = raw[4 * start:4 * (start + n)]
                    for column, v in zip(out, (doc, k, start, n, zlib.crc32(own), own)):
                        column.append(v)
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in out[5]] if keep_ids else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:5])]
                + ([pa.array(ids, pa.list_(pa.int32()))] if keep_ids else []),
                ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, kind)


def grouped(counts: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(size, [(length, how many)]) of groups of equal cardinality, longest first; the size is a group's longest."""
    total = sum(counts.values())
    if not total:
        return []
    share, out, full = -(-total // groups), [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not full:
                out.append((length, []))
                full = share
            take = min(left, full)
            out[-1][1].append((length, take))
            left, full = left - take, full - take
    return out


def _knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """Uses of each size in the configuration of highest price."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(int(sizes.min()), capacity + 1):
        fit = np.where(sizes <= c, best[np.maximum(c - sizes, 0)] + prices, -1.0)
        k = int(fit.argmax())
        best[c], taken[c] = (fit[k], k) if fit[k] > best[c - 1] + 1e-12 else (best[c - 1], -1)
    use, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if taken[c] < 0:
            c -= 1
        else:
            use[taken[c]] += 1
            c -= int(sizes[taken[c]])
    return use


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """(uses of each size, how often) with the demand met by about as few configurations as can be."""
    s, d = np.array(sizes), np.array(demand, float)
    columns = np.diag(capacity // s).astype(float)
    inverse = np.diag(1 / np.diag(columns))
    level = inverse @ d
    for _ in range(STEPS):
        prices = np.ones(len(s)) @ inverse
        new = _knapsack(s, np.maximum(prices, 0), capacity)
        if new @ prices < 1 + 1e-7:
            break
        step = inverse @ new
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-10, level / step, np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        level = level - ratio[out] * step
        level[out] = ratio[out]
        pivot = inverse[out] / step[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
        columns[:, out] = new
    return [(columns[:, k], float(x)) for k, x in enumerate(level) if x > 1e-9]


def plan(counts: dict[int, int], capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> list[tuple[int, tuple[int, ...]]]:
    """(uses, lengths in their order) of all bins, for so many pieces of each length."""
    left = Counter({n: c for n, c in counts.items() if c})
    demand: Counter = Counter()
    for size, members in grouped({n: c for n, c in left.items() if n > small}, groups):
        demand[size] += sum(n for _, n in members)
    sizes = sorted(demand, reverse=True)
    stock = sorted(n for n in left if n > small)
    bins: Counter = Counter()  # how many bins hold just these lengths
    for use, times in sorted(configurations(sizes, [demand[s] for s in sizes], capacity), key=lambda x: -x[1]) if sizes else []:
        slots, times = [s for s, u in zip(sizes, use.astype(int)) for _ in range(u)], int(times + 1e-6)
        while times:
            lengths = _substitutes(slots, left, stock, capacity)
            if not lengths:
                break
            run = min([times, *(left[n] // lengths.count(n) for n in lengths)])
            bins[lengths] += run
            for n in lengths:
                left[n] -= run
            stock = [n for n in stock if left[n]] if any(not left[n] for n in lengths) else stock
            times -= run
    return _best_fit(bins, left, capacity)


def _substitutes(slots: list[int], left: Counter, stock: list[int], capacity: int) -> tuple[int, ...]:
    """Actual lengths for the slots of a configuration: the longest that are left and fit.

    The last of several slots also takes the room that rounding gave away before it.
    """
    lengths: list[int] = []
    room = capacity
    for k, size in enumerate(slots):
        at = bisect.bisect_right(stock, room if 0 < k == len(slots) - 1 else min(size, room)) - 1
        while at >= 0 and left[stock[at]] <= lengths.count(stock[at]):
            at -= 1
        if at < 0:
            break
        lengths.append(stock[at])
        room -= stock[at]
    return tuple(lengths)


def _best_fit(bins: Counter, left: Counter, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Put what is left, longest first, into the fullest bins that have room; open bins where none has."""
    room: dict[int, Counter] = defaultdict(Counter)
    for lengths, n in bins.items():
        room[capacity - sum(lengths)][lengths] += n
    free = sorted(room)
    for length in sorted((n for n, c in left.items() if c > 0), reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(free, length)
            if at == len(free):
                each = capacity // length  # a new bin takes as many of this length as there are, up to its room
                full, rest = divmod(n, each)
                for uses, k in ((full, each), (1 if rest else 0, rest)):
                    if uses:
                        _put(room, free, capacity - k * length, (length,) * k, uses)
                break
            gap = free[at]
            lengths = next(iter(room[gap]))
            have = room[gap].pop(lengths)
            if not room[gap]:
                del room[gap]
                free.pop(at)
            each = min(gap // length, n)
            uses = min(have, n // each)
            if have > uses:
                _put(room, free, gap, lengths, have - uses)
            _put(room, free, gap - each * length, lengths + (length,) * each, uses)
            n -= each * uses
    return [(n, lengths) for gap in room.values() for lengths, n in gap.items()]


def _put(room: dict[int, Counter], free: list[int], gap: int, lengths: tuple[int, ...], n: int) -> None:
    if gap not in room or not room[gap]:
        bisect.insort(free, gap)
    room[gap][lengths] += n


def slots_of(bins: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first place, last place, sequence of the first, offset): places number all pieces by length."""
    total: Counter = Counter()
    for uses, lengths in bins:
        for n in lengths:
            total[n] += uses
    following, at = {}, 0
    for n in sorted(total):
        following[n], at = at, at + total[n]
    out, sequence = [], 0
    for uses, lengths in bins:
        offset = 0
        for n in lengths:
            out.append((n, following[n], following[n] + uses - 1, sequence, offset))
            following[n] += uses
            offset += n
        sequence += uses
    return out


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, with `keep_ids`).

    A document is the ids of its text by the tokenizer file at `path`, then `end`; a null text counts as empty, so its
    document is `end` alone. Documents longer than `capacity` are cut into full pieces, of which the first may be
    shorter. Sequences hold pieces without gaps from offset 0. Repeated rows are packed each; a null id stays null; an
    empty table gives an empty result. Only doc_id and text are read.
    """
    small_batches(docs.sparkSession)
    pieces = saved(pieces_of(docs, path, capacity, end, keep_ids), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row per length
    placed, _ = with_place(pieces, "length", ["doc_id", "piece", "ids_crc32"])
    kind = StructType([StructField(c, LongType()) for c in ("at_length", "low", "high", "sequence", "offset")])
    slots = docs.sparkSession.createDataFrame(slots_of(plan(counts, capacity)), kind)  # as many rows as the plan, not the corpus
    out = placed.join(F.broadcast(slots), (F.col("length") == F.col("at_length")) & F.col("place").between(F.col("low"), F.col("high")))
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("place") - F.col("low")).alias("sequence_id"),
        "offset", *["ids"] * keep_ids)
