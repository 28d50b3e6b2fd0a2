"""Encoding against the library at rate 0, the two agendas against each other, exact round trips."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from fieldhouse.llm import merges as M
from fieldhouse.llm.kernels import flat

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["Hello world", "", " ", "  two  spaces ", "tab\tand\nline\r\n", "naïve façade Straße ¿qué?", "漢字 😀 \x00\x01", "x" * 300,
         "supercalifragilistic" * 9, "a" * 39 + " " + "b" * 41, "The the THE", "1234567890" * 3, "▁", "a▁b ▁ c"]


def run(texts, rate, seed=0):
    data, offsets = flat(pa.array(texts))
    p = M.load(PATH)
    ids, counts = M.encode_texts(p, data, offsets, np.arange(len(texts)) * 7919 + seed, rate)
    return ids, counts, [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_rate_zero_is_the_models_own_encoding():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    plain = [t for t in TEXTS if "▁" not in t]
    assert run(plain, 0.0)[2] == model.encode(plain)


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_round_trip(rate):
    ids, counts, _ = run(TEXTS, rate)
    assert [t.decode() for t in M.decode_texts(M.load(PATH), ids, counts)] == TEXTS


@pytest.mark.parametrize("rate", [0.0, 0.2])
def test_both_agendas_agree(monkeypatch, rate):
    rng = random.Random(4)
    texts = TEXTS + [" ".join("".join(rng.choice("abcdethonéß") for _ in range(rng.randrange(1, 39))) for _ in range(30)) for _ in range(20)]
    want = run(texts, rate)[2]
    monkeypatch.setattr(M, "LONG", 0)
    assert run(texts, rate)[2] == want


def test_dropout_varies_with_seed_and_place_but_not_with_reruns():
    text = ["the quick brown fox jumps over the lazy dog " * 20]
    a, b, c = run(text, 0.3)[2], run(text, 0.3)[2], run(text, 0.3, seed=1)[2]
    assert a == b != c
    assert len(run(text, 0.3)[0]) > len(run(text, 0.0)[0])
    assert all(len(x) == len(t) + 1 for x, t in zip(run(["abc def"], 1.0)[2], ["abc def"]))


def test_tables(spark):
    rows = [(i, t, "en", [1]) for i, t in enumerate(TEXTS)] + [(None, None, None, None), (3, TEXTS[3], "en", [2]), (9000, "long text é " * 20_000, "en", [3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, ids array<int>")
    out = M.decode(M.encode(docs, PATH, 5, 0.2), PATH).collect()
    assert len(out) == len(rows) and all(r["decoded"] == r["row"]["text"] for r in out)
    assert [r["ids"] for r in out if r["row"]["text"] is None] == [None]
    assert len({tuple(r["ids"]) for r in out if r["row"]["doc_id"] == 3}) == 1
    assert M.encode(docs.limit(0), PATH).collect() == []
