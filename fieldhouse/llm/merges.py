"""SentencePiece merge-type encoding with seeded merge-dropout, and decoding that gives the text back.

The pieces and scores are those of a public model file, whose path is a parameter. Agenda processing takes the best
scored pair of neighbouring symbols (the leftmost of equals) and merges it. With dropout each candidate merge, when its
turn comes, is skipped for good if a keyed hash of its place in the text falls below the rate. The key is a hash of the
seed and the row's id: segmentations vary from place to place and from seed to seed, but a task that runs again, on any
executor, gives the same. A rate of 0 gives the model's own encoding.

No piece goes on after a word has ended, so words are encoded independently: all words of a chunk take their best merge
in the same numpy step, round after round. Words of more than LONG symbols run through a heap instead.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldhouse.llm.common import small_batches
from fieldhouse.llm.kernels import U, chunks, flat, list_column, mix

SPACE_MARK = 0x2581
"""Fixed value of the format: the sign that stands for a space in pieces."""
LONG = 40
CHUNK = 1 << 16
NONE = np.int64(1 << 40)


class Pieces:
    """Tables of one model: symbols of characters and bytes, merges, and the bytes of every piece."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        ids = {names[i]: i for i in plain}
        if any(0 < p.find(chr(SPACE_MARK)) and p.strip(chr(SPACE_MARK)) for p in ids):
            raise ValueError("a piece of this model holds more than one word")
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.byte = np.zeros(256, np.int32)
        for i in range(n):
            if model.is_byte(i):
                self.byte[int(names[i][3:5], 16)] = i
        order = sorted(plain, key=lambda i: -model.get_score(i))
        self.rank = np.zeros(n, np.int64)  # pieces of equal score share a rank: the leftmost pair goes first
        level = 0
        for a, b in zip([None, *order], order):
            level += a is not None and model.get_score(a) != model.get_score(b)
            self.rank[b] = level
        pairs = {(ids[p[:k]] << 20) | ids[p[k:]]: i for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids}
        self.bits = max(8, (4 * len(pairs)).bit_length())
        self.keys, self.merged = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        for key, i in pairs.items():
            at = int(self._slot(np.array([key]))[0])
            while self.keys[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.merged[at] = key, i
        raw = [bytes([int(names[i][3:5], 16)]) if model.is_byte(i) else names[i].replace(chr(SPACE_MARK), " ").encode() for i in range(n)]
        self.length = np.array([len(x) for x in raw])
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(U) * U(0x9E3779B97F4A7C15)) >> U(64 - self.bits)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that each pair of symbols merges to, or -1."""
        key = np.where((left >= 0) & (right >= 0), (left.astype(np.int64) << 20) | right, -2)
        at, out = self._slot(key), np.full(len(key), -1, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            have = self.keys[at[todo]]
            hit = have == key[todo]
            out[todo[hit]] = self.merged[at[todo[hit]]]
            todo = todo[~hit & (have >= 0)]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
        return out


@functools.lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    return Pieces(path)


def dropped(key: np.ndarray, start: np.ndarray, end: np.ndarray, rate: float) -> np.ndarray:
    """Whether the candidate merge of characters start .. end - 1 of the text with this key is skipped."""
    h = mix(key.view(U) ^ mix((start.astype(U) << U(32)) | end.astype(U)))
    return (h >> U(11)).astype(np.float64) < rate * 2.0 ** 53


def _candidates(p: Pieces, left, right, key, start, end, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(piece, rank) of neighbouring symbols; rank NONE where there is no merge or it is skipped."""
    to = p.pair(left, right)
    rank = np.where(to >= 0, p.rank[np.maximum(to, 0)], NONE)
    if rate > 0:
        some = np.flatnonzero(to >= 0)
        rank[some[dropped(key[some], start[some], end[some], rate)]] = NONE
    return to, rank


def _by_heap(p: Pieces, sym: np.ndarray, base: int, key: int, rate: float) -> list[tuple[int, int]]:
    """(first character, symbol) of one word, by agenda."""
    n = len(sym)
    value, begin, end = sym.tolist(), list(range(n)), list(range(1, n + 1))
    before, after, agenda = list(range(-1, n - 1)), [*range(1, n), -1], []
    keys = np.full(1, key, np.int64)

    def offer(lefts: list[int]) -> None:
        rights = [after[i] for i in lefts]
        a, b = np.array([value[i] for i in lefts], np.int64), np.array([value[j] for j in rights], np.int64)
        s, e = np.array([begin[i] for i in lefts]) + base, np.array([end[j] for j in rights]) + base
        to, rank = _candidates(p, a, b, np.repeat(keys, len(lefts)), s, e, rate)
        for i, j, t, r in zip(lefts, rights, to.tolist(), rank.tolist()):
            if r < NONE:
                heapq.heappush(agenda, (r, begin[i], i, j, end[i], end[j], t))

    if n > 1:
        offer(list(range(n - 1)))
    while agenda:
        _, _, i, j, ei, ej, t = heapq.heappop(agenda)
        if value[i] is None or value[j] is None or after[i] != j or end[i] != ei or end[j] != ej:
            continue
        value[i], end[i], value[j] = t, end[j], None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        near = ([before[i]] if before[i] >= 0 else []) + ([i] if after[i] >= 0 else [])
        for k in near:
            offer([k])
    return [(b, v) for b, v in zip(begin, value) if v is not None]


def encode_texts(p: Pieces, data: np.ndarray, offsets: np.ndarray, key: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids, pieces of each text) of texts given as UTF-8 bytes."""
    n = len(offsets) - 1
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    count = upto[offsets[1:]] - upto[offsets[:-1]]
    some = count > 0
    size = count + some  # a space goes before the text
    begin = np.cumsum(size) - size
    cp = np.full(int(size.sum()), SPACE_MARK, np.int64)
    body = np.ones(len(cp), bool)
    body[begin[some]] = False
    cp[body] = chars
    text = np.repeat(np.arange(n), size)
    sym = p.char[cp].astype(np.int64)
    mark = ~body | (cp == 32)
    sym[mark] = p.char[SPACE_MARK]
    foreign = (sym < 0) | (body & (cp == SPACE_MARK))  # spelled in bytes, so that decoding is exact
    sym[foreign] = -2 - cp[foreign]
    fresh = np.ones(len(cp), bool)
    fresh[1:] = (mark[1:] & ~mark[:-1]) | (text[1:] != text[:-1])
    out = np.full(len(cp), -1, np.int64)  # at the first character of a piece, its id
    word = np.flatnonzero(fresh)
    length = np.diff(np.append(word, len(cp)))
    for w, m in zip(word[length > LONG], length[length > LONG]):
        out[w:w + m] = -1
        t = text[w]
        for b, v in _by_heap(p, sym[w:w + m], int(w - begin[t]), int(key[t]), rate):
            out[w + b] = v
    short = np.repeat(length <= LONG, length)
    at = np.flatnonzero(short)  # absolute first character of each symbol still in work
    s, end = sym[at], at + 1
    first = fresh[at]
    doc = text[at]
    to, rank = np.full(len(at), -1, np.int32), np.full(len(at), NONE)
    inner = np.flatnonzero(~first[1:])
    to[inner], rank[inner] = _candidates(
        p, s[inner], s[inner + 1], key[doc[inner]], at[inner] - begin[doc[inner]], end[inner + 1] - begin[doc[inner]], rate)
    while len(at):
        head = np.flatnonzero(first)
        width = np.diff(np.append(head, len(at)))
        place = np.arange(len(at)) - np.repeat(head, width)
        best = np.minimum.reduceat((rank << 8) | place, head)
        live = best < NONE << 8
        if not live.all():
            keep = np.repeat(live, width)
            out[at[~keep]] = s[~keep]
            at, s, end, first, doc, to, rank = (x[keep] for x in (at, s, end, first, doc, to, rank))
            head = np.cumsum(width[live]) - width[live]
            best, width = best[live], width[live]
            if not len(at):
                break
        i = head + (best & 255)
        s[i], end[i] = to[i], end[i + 1]
        rank[i] = np.where(best & 255 == width - 2, NONE, rank[i])
        stay = np.ones(len(at), bool)
        stay[i + 1] = False
        moved = np.cumsum(stay) - 1
        at, s, end, first, doc, to, rank = (x[stay] for x in (at, s, end, first, doc, to, rank))
        i = moved[i]
        near = np.concatenate([i[~first[i]] - 1, i])
        near = near[near + 1 < len(at)]
        near = near[~first[near + 1]]
        to[near], rank[near] = _candidates(
            p, s[near], s[near + 1], key[doc[near]], at[near] - begin[doc[near]], end[near + 1] - begin[doc[near]], rate)
    taken = np.flatnonzero(out != -1)
    ids, of = out[taken], text[taken]
    odd = ids < 0
    if odd.any():
        spelled = np.array([-2 - v for v in ids[odd]], np.uint32).tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        code = -2 - ids
        times = np.where(odd, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
        is_byte = np.repeat(odd, times)
        ids, of = np.repeat(ids, times), np.repeat(of, times)
        ids[is_byte] = p.byte[np.frombuffer(spelled, np.uint8)]
    return ids.astype(np.int32), np.bincount(of, minlength=n)


def decode_texts(p: Pieces, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """UTF-8 bytes of each text, without the space put before it."""
    size = p.length[ids]
    total = np.cumsum(size)
    step = np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - size, size)
    data = p.bytes[np.repeat(p.start[ids], size) + step].tobytes()
    ends = np.concatenate([[0], total])[np.concatenate([[0], np.cumsum(counts)])]
    return [data[a:b][1:] if data[a:a + 1] == b" " else data[a:b] for a, b in zip(ends[:-1], ends[1:])]


def encode(docs: DataFrame, path: str, seed: int = 0, rate: float = 0.1) -> DataFrame:
    """Per row of `docs`: row (all its columns, as a struct) and ids, the pieces of its text.

    A null text has null ids, an empty one none. Signs that the model lacks, and the model's own space sign where a text
    holds it, are spelled in byte pieces. Repeated rows get the same ids, as the key is made from seed and doc_id (null
    is a key of its own). A text of any length is encoded whole. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("text", F.xxhash64(F.lit(seed), "doc_id").alias("key"), F.struct(*docs.columns).alias("row"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = load(path)
        for b in batches:
            data, offsets = flat(b.column("text"))
            key = b.column("key").to_numpy(zero_copy_only=False)
            for i, j in chunks(offsets, CHUNK):
                ids, counts = encode_texts(p, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], key[i:j], rate)
                lists = list_column(ids, counts, pa.int32())
                known = b.column("text").slice(i, j - i).is_valid()
                lists = pa.compute.if_else(known, lists, pa.scalar(None, lists.type)) if not pa.compute.all(known).as_py() else lists
                yield pa.RecordBatch.from_arrays([b.column("row").slice(i, j - i), lists], ["row", "ids"])

    return rows.mapInArrow(encoded, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of an encoding: row, ids, and decoded, the text that the pieces spell (null for null ids)."""
    small_batches(encoded.sparkSession)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = load(path)
        for b in batches:
            ids = b.column("ids")
            counts = pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            texts = decode_texts(p, ids.flatten().to_numpy(), counts)
            column = pa.array([t if k else None for t, k in zip(texts, known)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([b.column("row"), ids, column], ["row", "ids", "decoded"])

    kind = encoded.schema["row"].dataType.simpleString()
    return encoded.select("row", "ids").mapInArrow(decoded, f"row {kind}, ids array<int>, decoded string")
