"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is read in windows of 16 words that overlap by half; all of them are scored and the highest count. A word
enters as the sum of four learned vectors: one of its hashed lower-cased self (word input), and one each of its first
three, first six and last three bytes (character inputs). Two recurrent layers run over a window in either direction,
attention weighs the states, and a logistic unit reads their weighted mean. Texts carry labels but windows do not, so
after a first pass in which windows take the label of their text, only the windows that the network finds most toxic are
trained on (the highest of a text stand for the text). The score of a text is a logistic curve over the logits of its
highest windows: nothing in it adds up over the text, so a long clean text scores like a short one. A text without words
has nothing toxic in it and scores 0.

The network is fitted in one task from a bounded sample of whole texts: FIT_TEXTS labelled ids of each class at most,
in the order of a hash of the id, until a class has FIT_BYTES bytes (a class always has its first text). The task keeps
8 bytes a word of them, and no text gets to the driver, only the weights. The curve is fitted to every CURVE-th text of
the sample, which the network does not see; both classes weigh the same there, so 0.5 is where a text is as much like
the toxic ones as like the others. Rows whose crc32(doc_id) mod 5 is 0 are held out. Scoring runs over whole texts, a
chunk of bytes at a time.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldhouse.llm.common import small_batches, text_bytes
from fieldhouse.llm.kernels import U, chunks, flat, span_hashes

WINDOW, STRIDE = 16, 8
WORDS, ENDS, DIM, HIDDEN, ATTEND = 1 << 15, 1 << 12, 16, 8, 8
"""Buckets of whole words, buckets of word ends (both fit 16 bits), size of an input vector, of a state and of the attention layer."""
FIT_TEXTS, FIT_BYTES, CURVE = 2400, 24_000_000, 6
TOP = 5
"""Highest windows of a text that its score rests on; one harsh word lies in two windows, so the third and fifth tell of more."""
PASSES, SEEN = 8, 3
CHUNK = 1 << 19
BLOCK = 4096
"""Windows that run through the network together."""

LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """The fold that learning never sees; a null id is in none."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def inputs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of word, of first three bytes, of first six, of last three) per word, and the first word's number per text.

    Words are runs of ASCII letters, digits and bytes of other alphabets.
    """
    inside = LETTER[data]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    low = LOWER[data]
    first = np.searchsorted(start, offsets)
    if not len(start):
        return np.zeros((0, 4), np.uint16), first
    out = np.empty((len(start), 4), np.uint16)
    out[:, 0] = span_hashes(low, start, end) % U(WORDS)
    length = end - start
    near = lambda at, ok: np.where(ok, low[np.clip(at, 0, len(low) - 1)], 0).astype(np.int64)
    head = near(start, length > 0) + near(start + 1, length > 1) * 31 + near(start + 2, length > 2) * 1013
    tail = near(end - 1, length > 0) + near(end - 2, length > 1) * 29 + near(end - 3, length > 2) * 1187
    out[:, 1] = head % ENDS
    out[:, 2] = span_hashes(low, start, np.minimum(end, start + 6)) % U(ENDS)
    out[:, 3] = tail % ENDS
    return out, first


def apart(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets with something between texts, so that no word spans two of them."""
    n = len(offsets) - 1
    out = np.full(len(data) + n, 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
    return out, offsets + np.arange(n + 1)


def inputs_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`inputs` of many texts, a chunk of bytes at a time."""
    return joined([inputs(*apart(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])) for i, j in chunks(offsets, CHUNK)])


def joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """`inputs` of the texts of all parts; no part, no text."""
    before = np.cumsum([0] + [len(w) for w, _ in parts])
    return np.concatenate([np.zeros((0, 4), np.uint16), *(w for w, _ in parts)]), np.concatenate([np.zeros(1, np.int64), *(f[1:] + b for (_, f), b in zip(parts, before))])


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, text) of every window; a text without words has none."""
    n = np.diff(first)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(n)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = first[:-1][text] + number * STRIDE
    return start, np.minimum(WINDOW, n[text] - number * STRIDE), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights, forward pass, and the gradients for training."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *s, by=1.0: (rng.standard_normal(s) * by).astype(np.float32)
        h = HIDDEN
        self.p = {
            "word": draw(WORDS, DIM, by=0.1), "head": draw(ENDS, DIM, by=0.1), "stem": draw(ENDS, DIM, by=0.1), "tail": draw(ENDS, DIM, by=0.1),
            "att": draw(2 * h, ATTEND, by=0.4), "att_b": draw(ATTEND, by=0), "att_v": draw(ATTEND, by=0.5),
            "out": draw(2 * h, by=0.5), "out_b": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"w{d}": draw(DIM, 3 * h, by=DIM ** -0.5), f"u{d}": draw(h, 3 * h, by=h ** -0.5), f"b{d}": draw(3 * h, by=0)}
        self.curve = np.array([1.0, 0.0, 0.0, 0.0])
        self.word, self.stem = np.arange(WORDS, dtype=np.int32), np.arange(ENDS, dtype=np.int32)

    def know(self, words: np.ndarray, first: np.ndarray) -> None:
        """From now on, words and stems of fewer than SEEN of these texts share one vector: what is rare can't be learned."""
        for column, table in ((0, self.word), (2, self.stem)):
            texts = np.zeros(len(table), np.int64)
            for i, j in chunks(first, CHUNK):
                text = np.repeat(np.arange(j - i), np.diff(first[i:j + 1]))
                pairs = np.unique(text * np.int64(WORDS) + words[first[i]:first[j], column])
                texts += np.bincount(pairs % WORDS, minlength=len(table))
            table[texts < SEEN] = 0

    def mapped(self, words: np.ndarray) -> np.ndarray:
        words = words.copy()
        words[:, 0], words[:, 2] = self.word[words[:, 0]], self.stem[words[:, 2]]
        return words

    def features(self, top: np.ndarray) -> np.ndarray:
        """The highest logit of a text, its third and its fifth highest; the last one stands for those that are missing."""
        last = np.where(np.isfinite(top), top, np.inf).min(axis=1)
        third, fifth = (np.where(np.isfinite(top[:, k]), top[:, k], last) for k in (2, 4))
        return np.clip(np.column_stack([top[:, 0], third, fifth]), -20, 20)

    def probability(self, top: np.ndarray) -> np.ndarray:
        """0 for a text without windows."""
        some, out = np.isfinite(top[:, 0]), np.zeros(len(top))
        x = self.features(top[some]) @ self.curve[:-1] + self.curve[-1]
        out[some] = 1 / (1 + np.exp(-np.clip(x, -500, 500)))
        return out

    def gates(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input vectors of words and what they add to the gates, forward and backward."""
        p = self.p
        x = p["word"][words[:, 0]] + p["head"][words[:, 1]] + p["stem"][words[:, 2]] + p["tail"][words[:, 3]]
        return x, x @ p["wf"] + p["bf"], x @ p["wb"] + p["bb"]

    def _run(self, gate: np.ndarray, place: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> list[np.ndarray]:
        """States of one direction at every place of the windows."""
        n, h, u = len(place), HIDDEN, self.p[f"u{d}"]
        state, out = np.zeros((n, h), np.float32), [None] * WINDOW
        for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
            g, r = gate[place[:, t]], state @ u
            zr = _sigmoid(g[:, :2 * h] + r[:, :2 * h])
            z, reset = zr[:, :h], zr[:, h:]
            new = np.tanh(g[:, 2 * h:] + reset * r[:, 2 * h:])
            nxt = new + z * (state - new)
            m = mask[:, t]
            if not m.all():
                nxt = np.where(m[:, None], nxt, state)
            if keep is not None:
                keep.append((t, state, z, reset, new, r[:, 2 * h:]))
            state = out[t] = nxt
        return out

    def forward(self, gf: np.ndarray, gb: np.ndarray, place: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of every window."""
        p = self.p
        kf, kb = ([], []) if keep is not None else (None, None)
        f, b = self._run(gf, place, mask, "f", kf), self._run(gb, place, mask, "b", kb)
        states = np.stack([np.concatenate([x, y], axis=1) for x, y in zip(f, b)], axis=1)
        hidden = np.tanh(states @ p["att"] + p["att_b"])
        score = np.where(mask, hidden @ p["att_v"], -30.0)
        weight = np.exp(score - score.max(axis=1, keepdims=True))
        weight *= mask
        weight /= np.maximum(weight.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", weight, states)
        if keep is not None:
            keep |= {"kf": kf, "kb": kb, "states": states, "hidden": hidden, "weight": weight, "pooled": pooled}
        return pooled @ p["out"] + p["out_b"][0]

    def gradients(self, words: np.ndarray, place: np.ndarray, mask: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss of these windows."""
        p, keep, h = self.p, {}, HIDDEN
        x, gf, gb = self.gates(words)
        logit = self.forward(gf, gb, place, mask, keep)
        d = ((_sigmoid(logit) - label) / len(label)).astype(np.float32)
        g = {"out": keep["pooled"].T @ d, "out_b": d.sum(keepdims=True)}
        d_pooled = d[:, None] * p["out"]
        states, weight, hidden = keep["states"], keep["weight"], keep["hidden"]
        d_weight = np.einsum("nh,nth->nt", d_pooled, states)
        d_states = weight[:, :, None] * d_pooled[:, None, :]
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        g["att_v"] = np.einsum("nt,ntk->k", d_score, hidden)
        d_hidden = d_score[:, :, None] * p["att_v"] * (1 - hidden ** 2)
        g["att"] = np.einsum("nth,ntk->hk", states, d_hidden)
        g["att_b"] = d_hidden.sum(axis=(0, 1))
        d_states += d_hidden @ p["att"].T
        d_x = np.zeros_like(x)
        for k, side in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            u, d_gate, d_u, carry = p[f"u{k}"], np.zeros((len(words), 3 * h), np.float32), np.zeros_like(p[f"u{k}"]), np.zeros((len(place), h), np.float32)
            for t, state, z, reset, new, r in reversed(keep[f"k{k}"]):
                d_next = d_states[:, t, side] + carry
                d_next, stay = d_next * mask[:, t, None], d_next * ~mask[:, t, None]
                d_new = d_next * (1 - z) * (1 - new ** 2)
                d_z = d_next * (state - new) * z * (1 - z)
                d_r = d_new * r * reset * (1 - reset)
                pre = np.concatenate([d_z, d_r, d_new], axis=1)
                rec = np.concatenate([d_z, d_r, d_new * reset], axis=1)
                np.add.at(d_gate, place[:, t], pre)
                d_u += state.T @ rec
                carry = d_next * z + rec @ u.T + stay
            g[f"u{k}"], g[f"w{k}"], g[f"b{k}"] = d_u, x.T @ d_gate, d_gate.sum(axis=0)
            d_x += d_gate @ p[f"w{k}"].T
        for i, name in enumerate(("word", "head", "stem", "tail")):
            g[name] = np.zeros_like(p[name])
            np.add.at(g[name], words[:, i], d_x)
        return g

    def logits(self, words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Of all windows, a block at a time."""
        out = np.empty(len(start), np.float32)
        for s in range(0, len(start), BLOCK):
            own = slice(s, s + BLOCK)
            lo, hi = int(start[own].min()), int((start[own] + size[own]).max())
            _, gf, gb = self.gates(self.mapped(words[lo:hi]))
            place, mask = places(start[own] - lo, size[own], len(gf))
            out[own] = self.forward(gf, gb, place, mask)
        return out


def places(start: np.ndarray, size: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (windows x WINDOW), and which of them are there."""
    step = np.arange(WINDOW)
    return np.minimum(start[:, None] + step, n_words - 1), step < size[:, None]


def _train(net: Network, words: np.ndarray, start: np.ndarray, size: np.ndarray, label: np.ndarray, chosen: np.ndarray,
           memory: dict, rate: float, rng: np.random.Generator) -> None:
    """One pass of Adam over the chosen windows."""
    for own in np.array_split(rng.permutation(chosen), max(1, len(chosen) // 256)):
        place, mask = places(start[own], size[own], len(words))
        used, inverse = np.unique(place, return_inverse=True)
        g = net.gradients(net.mapped(words[used]), inverse.reshape(place.shape), mask, label[own])
        memory["t"] = memory.get("t", 0) + 1
        for k, v in g.items():
            m, s = memory.setdefault(k, (np.zeros_like(v), np.zeros_like(v)))
            m += 0.1 * (v - m)
            s += 0.01 * (v * v - s)
            net.p[k] -= rate * (m / (1 - 0.9 ** memory["t"])) / (np.sqrt(s / (1 - 0.99 ** memory["t"])) + 1e-6)


def fit(texts: list[str], toxic: list[int], seed: int = 7) -> Network | None:
    """A network fitted to labelled texts that have words; None unless both labels are there."""
    return fit_words(*inputs_of(*flat(pa.array(texts, pa.string()))), toxic, seed)


def fit_words(words: np.ndarray, first: np.ndarray, toxic: list[int], seed: int = 7) -> Network | None:
    """The same from `inputs_of` the texts."""
    some = np.flatnonzero(np.diff(first))
    label = np.array(toxic, np.float32)
    if len(set(label[some].tolist())) < 2:
        return None
    rng, net = np.random.default_rng(seed), Network(seed)
    start, size, text = windows(first)
    unseen = np.zeros(len(toxic), bool)  # by the network: of either class every CURVE-th, where there are enough
    for side in (0, 1):
        of = some[label[some] == side]
        unseen[of[CURVE - 1::CURVE]] = True
    both = len(set(label[unseen].tolist())) == 2
    learn = ~unseen if both else np.ones(len(toxic), bool)
    net.know(words, first)
    memory: dict = {}
    bound = np.searchsorted(text, np.arange(len(toxic) + 1))
    draw = np.concatenate([rng.choice(np.arange(bound[t], bound[t + 1]), min(bound[t + 1] - bound[t], 12), replace=False) for t in some if learn[t]])
    for _ in range(2):
        _train(net, words, start, size, label[text], draw, memory, 0.01, rng)
    own = learn[text]
    for k in range(PASSES):  # from here on, the highest windows of a text stand for it
        at = np.flatnonzero(own)
        at = at[np.lexsort((-net.logits(words, start[at], size[at]), text[at]))]
        rank = np.arange(len(at)) - np.searchsorted(text[at], text[at])
        _train(net, words, start, size, label[text], at[rank < np.where(label[text[at]] > 0, 3, 6)], memory, 0.006 if k < PASSES - 2 else 0.002, rng)
    judge = unseen if both else np.isin(np.arange(len(toxic)), some)
    at = np.flatnonzero(judge[text])
    x = net.features(highest(net.logits(words, start[at], size[at]), text[at], len(toxic))[judge])
    x, y = np.column_stack([x, np.ones(len(x))]), label[judge]
    side = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    net.curve = np.zeros(x.shape[1])
    ridge = 1e-3 * np.eye(x.shape[1])
    for _ in range(30):  # Newton steps with a small ridge
        q = _sigmoid(x @ net.curve)
        net.curve -= np.linalg.solve((x * (side * q * (1 - q))[:, None]).T @ x + ridge, x.T @ ((q - y) * side) + ridge @ net.curve)
    return net


def highest(logit: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The TOP highest logits of every text, -inf where it has fewer windows."""
    order = np.lexsort((-logit, text))
    rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
    top = np.full((n, TOP), -np.inf)
    first = rank < TOP
    top[text[order][first], rank[first]] = logit[order][first]
    return top


def cut_long(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, text numbers) of chunks; a text over `limit` comes in pieces that end between words.

    A piece starts a window's worth of words before the last one ended, so that no window is lost.
    """
    for i, j in chunks(offsets, limit):
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= limit:
            yield data[lo:hi], offsets[i:j + 1] - lo, np.arange(i, j)
            continue
        at = lo
        while at < hi:
            end = min(hi, at + limit)
            back = np.flatnonzero(~LETTER[data[at:end]])
            if end < hi and len(back):
                end = at + int(back[-1]) + 1
            yield data[at:end], np.array([0, end - at]), np.array([i])
            inside = LETTER[data[at:end]]
            starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
            again = at + int(starts[-WINDOW]) if end < hi and len(starts) > 2 * WINDOW else end
            at = again


def score_texts(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of every text, from all its windows."""
    top = np.full((len(offsets) - 1, TOP), -np.inf)
    for part, ends, text in cut_long(data, offsets, CHUNK):
        words, first = inputs(*apart(part, ends))
        start, size, of = windows(first)
        high = highest(net.logits(words, start, size), of, len(text))
        top[text] = -np.sort(-np.concatenate([top[text], high], axis=1), axis=1)[:, :TOP]
    return net.probability(top)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded sample that a network is fitted on: (doc_id, toxic, text).

    Of different texts with one id, the one with the smallest hash stands for the id. What makes the rest of the bound,
    FIT_BYTES, is a running sum over at most FIT_TEXTS rows of each class.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    one = lambda k: known(labels).where(F.col("toxic") == k).dropDuplicates().orderBy(*order).limit(FIT_TEXTS)
    chosen = F.broadcast(one(1).unionAll(one(0)))  # 2 * FIT_TEXTS rows at most
    texts = docs.select("doc_id", F.struct(F.xxhash64("text").alias("h"), "text").alias("t")).join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "toxic").agg(F.min("t")["text"].alias("text"))
    before = F.sum(text_bytes("text")).over(Window.partitionBy("toxic").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return texts.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < FIT_BYTES).select("doc_id", "toxic", "text")


def known(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from."""
    return labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "toxic")


def fitted(docs: DataFrame, labels: DataFrame) -> Network | None:
    """The network fitted to `training_rows` in the order of their ids, in one task."""

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, toxic = [], []
        for b in batches:
            parts.append(inputs_of(*flat(b.column("text"))))
            toxic += b.column("toxic").to_pylist()
        words, first = joined(parts)
        del parts
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_words(words, first, toxic))], pa.binary())], ["net"])

    rows = training_rows(docs, labels).coalesce(1).sortWithinPartitions("doc_id", "toxic").select("text", "toxic")
    found = rows.mapInArrow(learned, "net binary").collect()
    return pickle.loads(found[0]["net"]) if found else None


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of `docs`: row (all its columns, as a struct) and score, from 0 to 1.

    A text without words, null and empty ones included, scores 0. Without labelled rows of both classes all scores are 0.
    A null id counts as not held out; labels without id or with a label other than 0 and 1 are not learned from; an id
    that has both labels is learned with both. Repeated rows get equal scores; an empty table gives an empty result. A
    text of any length is scored by all its windows. Neither id, language, source nor label is an input of a score.
    Other columns are carried unread.
    """
    small_batches(docs.sparkSession)
    net = fitted(docs, labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = flat(b.column("text"))
            score = score_texts(net, data, offsets) if net else np.zeros(len(offsets) - 1)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(score, pa.float64())], ["row", "score"])

    rows = docs.select("text", F.struct(*docs.columns).alias("row"))
    return rows.mapInArrow(scored, f"row {rows.schema['row'].dataType.simpleString()}, score double")
