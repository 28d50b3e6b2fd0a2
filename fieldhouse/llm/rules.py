"""Quality rules whose cutoffs are chosen under a guarantee on how many good documents they reject.

Counts over whole texts give rates, each of them larger for worse texts. A rate's cutoff in a stratum (a language) is
chosen from labelled rows in two halves, told apart by a hash of the id:

* on the first half, the cutoff that rejects most bad rows, each good row rejected counting COST times;
* on the second half, the holdout, cutoffs from the most lenient down to that one are tested in this fixed order. One is
  passed while the exact binomial tail P(at most k of n rejections | true share = limit) is below the error level, and
  testing stops at the first that is not. The last passed is used; if none is, the rate rejects nothing there.

The share of good documents that all rates of a stratum together reject is then at most RISK, in all strata at once
with probability 1 - ERROR: RISK is split evenly over the rates, and ERROR over strata and rates (Bonferroni; the fixed
order needs no correction within a rate).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldhouse.llm.common import saved, small_batches
from fieldhouse.llm.kernels import PIECE, SPACE, U, chunks, flat, mix, span_hashes, word_hashes

RISK, ERROR, COST = 0.05, 0.05, 20.0
BINS = 200
RATES = ("symbols", "upper", "shout", "repeats", "lines")
BROADCAST_STRATA = 10_000
"""Strata whose cutoffs may be broadcast; more are joined by a shuffle."""
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_marks")


def _set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SYMBOL, MARK = _set(b"#*$%&|<>"), _set(b"!?")
UPPER, LETTER = _set(bytes(range(65, 91))), _set(bytes([*range(65, 91), *range(97, 123)]))


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True places in each text."""
    if len(offsets) == 2:
        return np.array([np.count_nonzero(mask)])
    upto = np.concatenate([[0], np.cumsum(mask)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def _repeats(of: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each (text, hash) is there more than once."""
    order = np.lexsort((h, of))
    same = (h[order[1:]] == h[order[:-1]]) & (of[order[1:]] == of[order[:-1]])
    out = np.zeros(len(h), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those among them that equal an earlier one) of each text."""
    n = len(offsets) - 1
    if n == 1 and len(data) > PIECE:
        seen = [hashlib.blake2b(x, digest_size=16).digest() for x in data.tobytes().split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        return np.array([len(seen)]), np.array([len(seen) - len(set(seen))])
    cut = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([offsets[:-1], cut + 1]))
    start = start[start < len(data)]
    stop = np.append(start[1:], len(data))
    stop = stop - ((stop > start) & (data[np.maximum(stop - 1, 0)] == 10))
    solid = np.concatenate([[0], np.cumsum(~SPACE[data])])
    start, stop = (x[solid[stop] > solid[start]] for x in (start, stop))
    of, h = np.searchsorted(offsets, start, side="right") - 1, span_hashes(data, start, stop)
    order = np.lexsort((h, of))
    same = (h[order[1:]] == h[order[:-1]]) & (of[order[1:]] == of[order[:-1]])
    return np.bincount(of, minlength=n), np.bincount(of[order[1:]][same], minlength=n)


def count_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Array of len(COUNTS) x texts."""
    n = len(offsets) - 1
    words, of = word_hashes(data, offsets)
    h = np.zeros(max(len(words) - 2, 0), U)
    for k in range(3):
        h = mix(h + words[k:k + len(h)] * U(2 * k + 3))
    whole = np.flatnonzero(of[:len(h)] == of[2:]) if len(h) else np.zeros(0, np.int64)
    twice = whole[_repeats(of[whole], h[whole])] if len(whole) else whole
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[twice + k] = True
    lines, dup = _lines(data, offsets)
    chars = ~SPACE[data] & ((data & 0xC0) != 0x80)
    return np.stack([
        np.bincount(of, minlength=n), _per_text(chars, offsets), _per_text(SYMBOL[data], offsets), dup, np.bincount(of[covered], minlength=n),
        lines, _per_text(LETTER[data], offsets), _per_text(UPPER[data], offsets), _per_text(MARK[data], offsets)]).astype(np.int64)


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, and COUNTS over the whole text) per row; a null text counts as empty."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = flat(b.column("text"))
            for i, j in chunks(offsets, PIECE):
                values = count_texts(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), b.column("lang").slice(i, j - i), *map(pa.array, values)], ["doc_id", "lang", *COUNTS])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    return columns.mapInArrow(count, "doc_id long, lang string, " + ", ".join(f"{c} long" for c in COUNTS))


def with_bins(rows: DataFrame) -> DataFrame:
    """Adds `bins`, the bin 0 .. BINS - 1 of every rate: rate / (rate + 1/4), so that small rates are told apart."""
    def rate(above: str, below: str):
        r = F.col(above) / F.greatest(F.col(below), F.lit(1))
        return F.least(F.floor(r / (r + 0.25) * BINS), F.lit(BINS - 1)).cast("int")

    return rows.withColumn("bins", F.array(
        rate("n_symbols", "n_words"), rate("n_upper", "n_letters"), rate("n_marks", "n_words"), rate("n_repeat_words", "n_words"),
        rate("n_dup_lines", "n_lines")))


def tail(k: np.ndarray, n: int, share: float) -> np.ndarray:
    """Exact P(X <= k) for X binomial with n draws of this share."""
    if n == 0:
        return np.ones(len(k))
    i = np.arange(n)
    log = n * math.log1p(-share) + np.concatenate([[0.0], np.cumsum(np.log((n - i) / (i + 1)) + math.log(share / (1 - share)))])
    return np.minimum(np.cumsum(np.exp(log)), 1.0)[np.minimum(k, n)]


def cutoff(good: np.ndarray, bad: np.ndarray, good_held: np.ndarray, limit: float, level: float) -> int:
    """First bin that is rejected (BINS: none), from counts per bin on the first half and of good rows on the holdout."""
    above = lambda x: np.append(np.cumsum(x[::-1])[::-1], 0)  # rows at or over each cutoff
    gain = above(bad) / max(bad.sum(), 1) - COST * above(good) / max(good.sum(), 1)
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    if gain.max() <= 0:
        return BINS
    run = best[:np.flatnonzero(np.append(np.diff(best) > 1, True))[0] + 1]  # the first stretch of equally good cutoffs
    target = int(run[len(run) // 2])
    risk = tail(above(good_held), int(good_held.sum()), limit)
    chosen = BINS
    for t in range(BINS, target - 1, -1):
        if risk[t] > level:
            break
        chosen = t
    return chosen


def cutoffs(rows: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """(stratum, cuts) of strata with labelled rows, and the number of strata."""
    marks = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("_most")).where("quality = _most").drop("_most")
    known = rows.select("doc_id", F.coalesce("lang", F.lit("")).alias("stratum"), "bins").join(marks, "doc_id")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")
    cells = saved(known.select("stratum", "quality", half, F.posexplode("bins").alias("rate", "bin")).groupBy(
        "stratum", "rate", "quality", "half", "bin").agg(F.count("*").alias("n")), "rule-cells")
    strata = cells.select("stratum").distinct().count()
    limit, level = RISK / len(RATES), ERROR / (len(RATES) * max(strata, 1))

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((len(RATES), 2, 2, BINS), np.int64)
        np.add.at(table, (group["rate"], group["quality"], group["half"], group["bin"]), group["n"])
        cuts = [cutoff(t[1, 0], t[0, 0], t[1, 1], limit, level) for t in table]
        return pd.DataFrame({"stratum": [group["stratum"].iloc[0]], "cuts": [cuts]})

    return cells.groupBy("stratum").applyInPandas(choose, "stratum string, cuts array<int>"), strata  # few rows a stratum


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, the counts, base_failed, rejected_by (names of rates over their cutoff), kept.

    Base rules: fewer than 50 words, or more than half of them in three-word windows that repeat. Null language is a
    stratum of its own (with the empty one); strata without enough labelled good rows keep what the base rules keep.
    Labels that are null, or contradict each other for one id, are not used. Null texts count as empty and fail the base
    rules. Repeated rows get equal results; an empty table gives an empty result. Other columns are unread.
    """
    small_batches(docs.sparkSession)
    rows = saved(with_bins(counted(docs)), "rule-counts")
    cuts, strata = cutoffs(rows, labels)
    cuts = saved(cuts, "rule-cutoffs")
    rows = rows.withColumn("stratum", F.coalesce("lang", F.lit("")))
    rows = rows.join(F.broadcast(cuts) if strata <= BROADCAST_STRATA else cuts, "stratum", "left")
    over = F.filter(
        F.transform(F.arrays_zip("bins", "cuts", F.array(*map(F.lit, RATES)).alias("name")),
                    lambda x: F.when(x["bins"] >= x["cuts"], x["name"])), lambda name: name.isNotNull())
    rows = rows.withColumn("rejected_by", F.coalesce(over, F.array().cast("array<string>")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).select(
        "doc_id", "lang", *COUNTS, "base_failed", "rejected_by", "kept")
