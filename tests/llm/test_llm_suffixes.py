"""Repeated byte strings against a table of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fieldhouse.llm import suffixes
from fieldhouse.llm.suffixes import DEPTH, identifiers, smallest, without_repeats

SCHEMA = "doc_id long, text string, lang string, k1 string, run int"


def brute(texts):
    data = [(t or "").encode() for t in texts]
    n = Counter(t[i:i + DEPTH] for t in data for i in range(len(t) - DEPTH + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - DEPTH + 1):
            if n[t[i:i + DEPTH]] > 1:
                gone[i:i + DEPTH] = b"\1" * DEPTH
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


def run(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "x", i) for i, t in enumerate(texts)], SCHEMA)
    rows = sorted(without_repeats(docs).collect(), key=lambda r: r["row"]["doc_id"])
    assert [r["row"]["run"] for r in rows] == list(range(len(texts)))
    return rows


def same(rows, texts):
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows] == brute(texts)


def prose(rng, n):
    return " ".join(rng.choice(["der", "ßchön", "the", "éau", "thing", "on", "x1", "zebra", "ñ"]) + str(rng.randrange(40)) for _ in range(n))


def test_planted_repeats(spark):
    rng = random.Random(1)
    passage, other = prose(rng, 60), prose(rng, 200)
    texts = [prose(rng, 80) + passage + prose(rng, 50) for _ in range(6)]
    texts += [other, other, other[3:], passage[:199], other[:150] + "!" + other[151:], "", None, "a" * 700, "ab" * 150, "x" * DEPTH, "x" * DEPTH]
    t = prose(rng, 300)
    texts += [t + "|" + t[400:900], t[:DEPTH + 1] + "#"]
    rows = run(spark, texts)
    same(rows, texts)
    assert rows[12]["kept_text"] is None and rows[11]["kept_text"] == ""


@pytest.mark.parametrize("seed,group", [(0, 512), (1, 2), (2, 1), (3, 3)])
def test_random_small_alphabets(spark, monkeypatch, seed, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    rng = random.Random(seed)
    texts = ["".join(rng.choice("abé") * rng.choice([1, 1, 90, 150]) for _ in range(rng.randrange(1, 25))) for _ in range(25)]
    texts += [rng.choice(texts)[rng.randrange(40):] + "q" for _ in range(10)]
    rows = run(spark, texts)
    same(rows, texts)
    for r in rows:
        assert set(r["kept_text"]) <= set("abéq")


def test_long_texts_are_cut_without_effect(spark, monkeypatch):
    rng = random.Random(5)
    t = prose(rng, 3000)
    texts = [t, t[5000:9000], t[:700] + "?" + t[701:], prose(rng, 50)]
    monkeypatch.setattr(suffixes, "CHUNK", 1500)
    pieces = [p for g in suffixes._cut(np.array([len(x.encode()) for x in texts])) for p in g]
    assert max(n for _, _, n in pieces) <= 1500
    monkeypatch.undo()
    same(run(spark, texts), texts)


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = prose(random.Random(2), 100)
    docs = spark.createDataFrame([(None, t), (None, t), (3, "short"), (3, "short"), (None, None)], "doc_id long, text string")
    rows = without_repeats(docs).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, 0, 0, len(t.encode()), len(t.encode())]
    assert without_repeats(docs.limit(0)).collect() == []


def test_whole_table(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    got = {r["row"]["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in without_repeats(rows).collect()}
    ids, texts = zip(*[(r["doc_id"], r["text"]) for r in rows.collect()])
    assert got == dict(zip(ids, brute(texts)))


def test_identifiers_and_minimum():
    data = np.frombuffer((b"abcdefgh" * 60)[:400] + b"z", np.uint8)
    grams, full = identifiers(data)
    assert len(grams) == 401 - suffixes.GRAM + 1 and len(full) == 401 - 199
    assert full[0] == full[8] and full[0] != full[1] and len(set(full[:200].tolist())) == 8
    v = np.random.default_rng(0).integers(0, 1000, 500)
    assert smallest(v, 137).tolist() == [v[i:i + 137].min() for i in range(500 - 136)]
