"""Whole results against DuckDB and plain counting; paths, slices of long texts, nulls and exact arithmetic by hand."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from oracle import compare

from fieldhouse.llm import phrases as P, queries
from fieldhouse.llm.kernels import flat

SCHEMA = "doc_id long, text string, lang string, n long, ws string, f int, word int"


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, folder):
    assert compare(spark, queries.QUERIES["op11_collocations"], queries.ORACLES["op11_collocations"], f"/root/testdata/{folder}") == []


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0A-\x0D]", low)]


def counted(docs, least):
    f = Counter()
    for _, text, lang in docs:
        for ws in pieces(text):
            for k in range(1, 6):
                for i in range(len(ws) - k + 1):
                    f[lang or "und", tuple(ws[i:i + k])] += 1
    return {x: n for x, n in f.items() if n >= least or len(x[1]) == 1}


def plain(docs, least, top):
    f, out = counted(docs, least), {}
    total = Counter()
    for (lang, ws), n in f.items():
        total[lang] += n * (len(ws) == 1)
    for (lang, ws), a in f.items():
        k = len(ws)
        if k == 1 or a < least or any(x == lang and len(v) > k and n >= a and any(v[i:i + k] == ws for i in range(len(v) - k + 1)) for (x, v), n in f.items()):
            continue
        score, cut, lf, r = min((1000 * a * total[lang] // (f[lang, ws[:c]] * f[lang, ws[c:]]), c, f[lang, ws[:c]], f[lang, ws[c:]]) for c in range(1, k))
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), lf, r))
    return {(lang, i + 1, p.decode(), -a, lf, r, total[lang], -s) for lang, rows in out.items() for i, (s, a, p, lf, r) in enumerate(sorted(rows)[:top])}


def made(seed):
    rng = random.Random(seed)
    stock = "a b c d é Ä the of x1 \u00a0 in".split(" ") + ["lo\x00ng"]
    line = " ".join(rng.choice(stock) for _ in range(12))
    docs = []
    for i in range(150):
        words = [rng.choice(stock) + rng.choice(["", "", "", "", ",", ".", "!", "\t", "\n", "\r\n"]) for _ in range(rng.randrange(60))]
        docs.append((i, " ".join(words).upper() if i % 9 == 0 else " ".join(words) + (" . " + line if i % 3 == 0 else ""), [None, "en", "und", "de"][i % 4]))
    return docs + [(7, "a a a a a a a a a a", "en"), (7, "a a a a a a a a a a", "en"), (None, None, "en"), (9, "", None), (1, None, None)]


def rows(spark, docs, **kw):
    df = spark.createDataFrame([(i, t, lang, 1, "w", 2, 3) for i, t, lang in docs], SCHEMA).repartition(4)
    return P.phrases(df, **kw)


@pytest.mark.parametrize("flush", [1 << 22, 300])
@pytest.mark.parametrize("least,top", [(3, 40), (12, 7), (12, 2000)])
def test_against_plain_counting(spark, monkeypatch, least, top, flush):
    monkeypatch.setattr(P, "FLUSH", flush)
    docs = made(least)
    assert {tuple(r) for r in rows(spark, docs, least=least, top=top).collect()} == plain(docs, least, top)


def test_a_bitmap_that_marks_everything_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "frequent_pairs", lambda rows, least: np.full(1 << (P.BITS - 6), 2 ** 64 - 1, np.uint64))
    docs = made(1)
    assert {tuple(r) for r in rows(spark, docs, least=8, top=50).collect()} == plain(docs, 8, 50)


def test_long_texts_come_in_slices(monkeypatch):
    rng = random.Random(2)
    texts = ["", " ".join(rng.choice(["ab", "c,", "d.", "\n", "é"]) for _ in range(900)), "x" * 700, " ", "y" * 300 + " z", "ab c"]
    whole = P.words_of(*flat(pa.array(texts)))
    for size in (1 << 19, 64, 7):
        monkeypatch.setattr(P, "PIECE", size)
        low, start, end, h, piece, text = P.words_of(*flat(pa.array(texts)))
        assert (h == whole[3]).all() and (text == whole[5]).all()
        assert (np.diff(piece) == 0).tolist() == (np.diff(whole[4]) == 0).tolist()
        assert [bytes(low[a:b]).decode() for a, b in zip(start, end)] == [w for t in texts for p in pieces(t) for w in p]
        near = [(t, k) for t, x in enumerate(texts) for k, p in enumerate(pieces(x)) for _ in p]
        assert [a == b for a, b in zip(near, near[1:])] == (np.diff(piece) == 0).tolist()


def test_paths_are_whole_passages(spark):
    line = "one two three four five six seven eight nine"
    docs = [(i, f"{i}x {line} {i}y", "en") for i in range(20)] + [(99, "three four five six seven", "en"), (98, "q q q q q q q q", "en")] * 2
    df = spark.createDataFrame([(i, t, lang, 1, "w", 2, 3) for i, t, lang in docs], SCHEMA)
    got = {(r["passage"], r["f"]) for r in P.passages(df, least=5).collect()}
    assert got == {("one two three four five six", 20), ("three four five six seven", 22), ("four five six seven eight nine", 20), ("q q q q q", 8)}
    found = {r["phrase"]: r["a"] for r in P.phrases(df, least=5).collect()}
    assert found == {"one two three four five": 20, "two three four five six": 20, "three four five six seven": 22, "four five six seven eight": 20,
                     "five six seven eight nine": 20, "q q": 14, "q q q": 12, "q q q q": 10, "q q q q q": 8}


def test_exact_arithmetic_and_empty_tables(spark):
    """Counts whose products need more than 64 bits: 1000 * a * n and l * r of 10^12 words."""
    big = 10 ** 12 + 39
    counts = spark.createDataFrame([("en", [1, 2], big - 7), ("en", [1], big), ("en", [2], big - 3)], "lang string, ws array<bigint>, f long")

    class Made(P.Graph):
        def __init__(self):
            self.counts, self.totals = counts, spark.createDataFrame([("en", 5 * big)], "lang string, n long")
            self.spelling = spark.createDataFrame([(1, "a"), (2, "b")], "w long, word string")

    (row,) = P.collocations(Made(), 10).collect()
    assert row["score"] == 1000 * (big - 7) * 5 * big // (big * (big - 3))
    empty = spark.createDataFrame([], SCHEMA)
    assert P.phrases(empty).collect() == [] and P.passages(empty).collect() == []
