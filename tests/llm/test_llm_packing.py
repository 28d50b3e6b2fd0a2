"""Ids against the tokenizer library, plans against a plain best fit, sequences read back."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fieldhouse.llm import packing as K

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["", " ", "a", " a", "a ", "a  b", "a \n b", "x\n\n y <|endoftext|> z  <|endoftext|>", "it's we'll 's  'd", "\x1c \x1cq",
          "é漢 😀  z　 q", "tab\t x", "12 345  6", "don't\n", None]


def test_ids():
    ours, theirs = K.load(PATH), Tokenizer.from_file(PATH)
    for t in TRICKY[:-1]:
        assert np.frombuffer(ours.ids(t), "<u4").tolist() == theirs.encode(t, add_special_tokens=False).ids


def test_cuts():
    assert K.cuts(1, 10) == [(0, 1)] and K.cuts(10, 10) == [(0, 10)] and K.cuts(11, 10) == [(0, 1), (1, 10)]
    assert K.cuts(35, 10) == [(0, 5), (5, 10), (15, 10), (25, 10)]


def test_groups_are_of_equal_cardinality():
    parts = K.grouped({10: 5, 9: 1, 7: 6, 3: 2}, 4)
    assert [sum(n for _, n in m) for _, m in parts] == [4, 4, 4, 2] and [s for s, _ in parts] == [10, 10, 7, 3]


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_everything_in_few_bins(seed):
    rng = random.Random(seed)
    counts = Counter(min(1024, max(1, int(rng.lognormvariate([3, 5.2, 6, 6.5][seed], 0.8)))) for _ in range(3000))
    bins = K.plan(counts)
    held = Counter()
    for uses, lengths in bins:
        assert sum(lengths) <= 1024 and uses > 0
        for n in lengths:
            held[n] += uses
    assert held == counts
    plain = sum(u for u, _ in K._best_fit(Counter(), Counter(counts), 1024))
    assert sum(u for u, _ in bins) <= 1.01 * plain + 1


def test_exact_program():
    bins = K.plan({600: 40, 424: 40, 512: 20, 341: 30}, groups=130)
    assert sum(u for u, _ in bins) == 40 + 10 + 10


def read_back(rows, docs):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    want, theirs = Counter(), Tokenizer.from_file(PATH)
    for i, t in docs:
        ids = np.array([*theirs.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for k, (s, n) in enumerate(K.cuts(len(ids), 1024)):
            want[i, k, s, n, zlib.crc32(ids[s:s + n].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want


def test_tables(spark):
    rng = random.Random(3)
    docs = [(i, t) for i, t in enumerate(TRICKY)] + [(100 + i, "some words here " * rng.randrange(1, 700)) for i in range(60)]
    docs += [(None, "no id"), (7, "twice"), (7, "twice"), (500, "long " * 30_000)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, piece int, length string")
    rows = K.packed(df, PATH, keep_ids=True).collect()
    read_back(rows, docs)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    assert K.packed(df.limit(0), PATH).collect() == []


def test_whole_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    read_back(K.packed(docs, PATH).collect(), [tuple(r) for r in docs.collect()])
