"""Counts against plain Python, binomial tails against sums, the guarantee on drawn samples."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from fieldhouse.llm import rules
from fieldhouse.llm.kernels import flat
from fieldhouse.llm.rules import BINS, count_texts, cutoff, judged, tail

SCHEMA = "doc_id long, text string, lang string, n_words int, bins string"
LABELS = "doc_id long, quality int, toxic int"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


TEXTS = ["", None, "a", "a b c a b c", "x\nx\n \nx y\r\nx", "é ü 漢字 #tag* $5 & <b>\n\n\té", "the the the the the", "a b c d\x85 e\x1cf",
         "tail\n", "\n\nline\nline", "| a | b | a | b |"]


def test_counts():
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("ab \n#é") for _ in range(rng.randrange(200))) for _ in range(200)]
    got = count_texts(*flat(pa.array(texts, pa.string())))[:5].T.tolist()
    assert got == [list(plain(t)) for t in texts]


def test_long_text_counts(monkeypatch):
    text = "one two three\nfour é#\n" * 60_000
    assert len(text.encode()) > rules.PIECE
    assert tuple(count_texts(*flat(pa.array([text])))[:5, 0]) == plain(text)


def test_tail_is_exact():
    for n, p in ((1, 0.3), (20, 0.01), (400, 0.01)):
        want = np.cumsum([math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(n + 1)])
        assert np.allclose(tail(np.arange(n + 1), n, p), np.minimum(want, 1), atol=1e-12)
    assert tail(np.array([0]), 0, 0.1)[0] == 1


def test_cutoff_keeps_its_guarantee():
    rng, limit, level, broken = np.random.default_rng(2), 0.02, 0.05, 0
    share = np.exp(-np.arange(BINS) / 12)
    share /= share.sum()
    for _ in range(200):
        good, held = rng.multinomial(1500, share), rng.multinomial(1500, share)
        bad = rng.multinomial(300, share[::-1])
        t = cutoff(good, bad, held, limit, level)
        broken += share[t:].sum() > limit
    assert broken <= 0.1 * 200
    assert cutoff(np.zeros(BINS, int), np.zeros(BINS, int), np.zeros(BINS, int), limit, level) == BINS
    few = np.zeros(BINS, int)
    few[0] = 20
    assert cutoff(few, few[::-1], few, limit, level) == BINS  # twenty rows prove nothing


def test_tables(spark):
    rng = random.Random(5)
    good = lambda: " ".join(f"word{rng.randrange(3000)}" for _ in range(80))
    bad = lambda: " ".join(f"word{rng.randrange(3000)}%%%" for _ in range(80))
    rows = [(i, bad() if i % 10 == 0 else good(), "en" if i % 2 else "de", 1, "x") for i in range(8000)]
    rows += [(None, None, None, None, None), (9001, good(), None, 1, "x"), (9001, good(), None, 1, "x"), (9002, "a b c " * 40, "en", 1, "x"), (9003, bad(), "de", 1, "x")]
    labels = [(i, int(i % 10 != 0), 0) for i in range(7900)] + [(None, 1, 0), (7999, None, 0), (3, 0, 0)]
    out = judged(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert len(out) == len(rows)
    assert [kept[i] for i in (None, 9001, 9002, 9003)] == [False, True, False, False]
    assert all(kept[i] == (i % 10 != 0) for i in range(8000))
    assert {r["doc_id"]: r["base_failed"] for r in out}[9003] is False


def test_without_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "w " * 60, "en", 1, ""), (2, " ".join(map(str, range(60))), "en", 1, "")], SCHEMA)
    none = spark.createDataFrame([], LABELS)
    assert {r["doc_id"]: r["kept"] for r in judged(docs, none).collect()} == {1: False, 2: True}
    assert judged(docs.limit(0), none).collect() == []


def test_whole_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r["doc_id"]: tuple(r[c] for c in rules.COUNTS[:5]) for r in judged(docs, spark.read.parquet(f"{data}/labels.parquet")).collect()}
    assert got == {r["doc_id"]: plain(r["text"]) for r in docs.collect()}
