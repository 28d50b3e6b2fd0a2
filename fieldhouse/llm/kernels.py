"""numpy over Arrow text columns: many texts are worked on as one byte array with offsets, in chunks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

U = np.uint64
GOLD, MULT_1, MULT_2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
"""Fixed values of the public-domain splitmix64 finaliser."""


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on an array of unsigned 64-bit numbers; the argument is overwritten."""
    x += GOLD
    t = x >> U(30)
    x ^= t
    x *= MULT_1
    np.right_shift(x, U(27), out=t)
    x ^= t
    x *= MULT_2
    np.right_shift(x, U(31), out=t)
    x ^= t
    return x


def mixed(value: int) -> int:
    """The same for one Python integer."""
    return int(mix(np.array([value & 0xFFFFFFFFFFFFFFFF], U))[0])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts together, offsets); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose bytes together stay within `limit`, or of one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = j


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and the length of each list."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
"""The bytes between words: the space and 0x09 to 0x0D."""


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of every word of every text."""
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[0] = len(data) > 0 and inside[0]
    edge[-1] = len(data) > 0 and inside[-1]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    joined = cuts[inside[cuts] & inside[cuts - 1]] if len(cuts) else cuts  # two texts that touch without white space
    joined = np.unique(joined)
    where = np.flatnonzero(edge)
    where = np.sort(np.concatenate([where, joined, joined])) if len(joined) else where
    start, end = where[0::2], where[1::2]
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the given byte spans, which are in order and do not overlap: sums of mixed (place, byte)."""
    if not len(start):
        return np.zeros(0, U)
    length = end - start
    total = int(length.sum())
    first = np.cumsum(length) - length
    place = np.arange(total) - np.repeat(first, length)
    taken = data[place + np.repeat(start, length)]
    h = np.zeros(len(start), U)
    some = length > 0
    h[some] = np.add.reduceat(mix((place.astype(U) << U(8)) | taken.astype(U)), first[some])
    return mix(h + length.astype(U))

PIECE = 1 << 19
"""Bytes whose words are hashed together; a longer text is cut between words."""


def word_hashes(data: np.ndarray, offsets: np.ndarray, low: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word, 64 bits, of any number of texts of any length; `low` lower-cases A to Z."""
    hashes, texts = [], []
    for i, j in chunks(offsets, PIECE):
        at, hi = int(offsets[i]), int(offsets[j])
        while at < hi:
            end = hi
            if hi - at > PIECE:
                gap = np.flatnonzero(SPACE[data[at:at + PIECE]])
                if len(gap):
                    end = at + int(gap[-1]) + 1
            part = data[at:end]
            if low:
                part = LOWER[part]
            start, stop, text = words(part, offsets[i:j + 1] - at if j > i + 1 else np.array([0, end - at]))
            hashes.append(span_hashes(part, start, stop))
            texts.append(text + i)
            at = end
    if not hashes:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(texts)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
"""Lower case of the letters A to Z; all other bytes stay."""


def packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: the same rows with column `text` compressed, for texts that have to travel."""
    press = zstandard.ZstdCompressor(level=1)
    for b in batches:
        at = b.schema.get_field_index("text")
        texts = b.column(at).cast(pa.binary()).to_pylist()
        yield b.set_column(at, pa.field("text", pa.binary()), pa.array([None if t is None else press.compress(t) for t in texts], pa.binary()))


def unpacked(column: pa.Array) -> pa.Array:
    """The texts that `packed_texts` compressed, as bytes."""
    open_ = zstandard.ZstdDecompressor()
    return pa.array([None if t is None else open_.decompress(t) for t in column.to_pylist()], pa.binary())
