"""Near duplicates against all pairs."""

import random

import pytest
from oracle import compare

from fieldhouse.llm import minhash
from fieldhouse.llm.components import components
from fieldhouse.llm.minhash import near_duplicates
from fieldhouse.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, key long, rep string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    out, word = [], ""
    for c in (text or "").translate(LOWER):
        if c in " \t\n\x0b\x0c\r":
            out, word = (out + [word] if word else out), ""
        else:
            word += c
    return out + [word] if word else out


def brute(docs, width, percent):
    sets = {}
    for i, t in docs:
        w = split(t)
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(rng):
    texts = []
    for size, copies in ((120, 30), (60, 12), (300, 5), (20, 4)):
        base = [f"w{rng.randrange(500)}" for _ in range(size)]
        texts += [edited(rng, base, rng.randrange(0, max(2, size // 30))) for _ in range(copies)] + [" ".join(base)] * 3
        chain = list(base)
        for _ in range(8):  # each near the one before it, but not near the first
            chain = edited(rng, chain, 2).split()
            texts.append(" ".join(chain))
    texts += ["one two", "ONE  two", "one", "", None, "\t \n", "a b c d", "a b c d", "Ünder Straße x", "ünder straße x"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("width,percent,block", [(3, 85, 256), (5, 80, 256), (3, 85, 4)])
def test_against_all_pairs(spark, monkeypatch, width, percent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    docs = corpus(random.Random(width + block))
    df = spark.createDataFrame([(i, t, "en", 1, "x") for i, t in docs], SCHEMA).repartition(5)
    want = brute(docs, width, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, width, percent).collect()}
    assert got == want


def test_nulls_repeats_long_and_empty(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(5, "a b c d", "", 1, ""), (5, "a b c d", "", 1, ""), (None, "a b c d", "", 1, ""), (2, "A b C d", "", 1, ""), (7, None, "", 1, ""), (8, long, "", 1, ""), (9, long + " z", "", 1, "")]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 85)
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got.collect()) == [
        (-1, -1, True), (2, 2, True), (5, 2, False), (5, 2, False), (7, 7, True), (8, 8, True), (9, 8, False)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(300, 299)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, **{200 + i: 100 for i in range(50)}, 299: 299, 300: 299}


def test_matches_sql(spark, data):
    assert compare(spark, QUERIES["op6_minhash_near_dedup"], ORACLES["op6_minhash_near_dedup"], data) == []
