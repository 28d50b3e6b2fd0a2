"""Whole results against DuckDB, base places against plain loops, gaps and changes by hand."""

import random
import re

import pytest
from oracle import compare

from fieldhouse.llm import licenses as L, queries
from fieldhouse.llm.license_texts import BASE, TEXTS

SCHEMA = "doc_id long, text string, lang string, label int, n int, start string, words int, k1 int, pos int"


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, folder):
    name = "op12_license_diagonals"
    assert compare(spark, queries.QUERIES[name], queries.ORACLES[name], f"/root/testdata/{folder}") == []


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", 1, 2, "s", 3, 4, 5) for i, t in enumerate(texts)], SCHEMA)


def scan(spark, texts):
    return {r["row"]["doc_id"]: r for r in L.scanned(table(spark, texts).repartition(5)).collect()}


def test_base_places_against_plain_loops(spark):
    rng = random.Random(4)
    stock = "under the MIT license apache License version 2 cc by nc 4 é Ñu k K cc".split()
    texts = [rng.choice(["", " ", "-", ". "]).join(rng.choices(stock, k=rng.randrange(60))) for _ in range(200)]
    texts += [" ".join(rng.choices(stock[:4] + stock[9:12], k=300)) for _ in range(50)]
    got = scan(spark, texts)
    for i, t in enumerate(texts):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        ws = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(k, label) for label, p in BASE for k in range(len(ws)) if ws[k:k + len(p.split())] == p.split()]
        r = got[i]
        assert r["n_words"] == len(ws) and r["n_base"] == len(at)
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r["base_labels"] == sorted({label for _, label in at}) and set(r["base_labels"]) <= set(r["labels"])
        assert r["score"] == 1 if at else r["score"] < 1 or r["labels"]


def test_every_template_is_found_whole_and_with_changes(spark):
    rng = random.Random(1)
    whole, broken, kept = [], [], []
    for label, text in [*BASE, *TEXTS]:
        whole.append("vorn " * rng.randrange(1, 70) + text.upper() + " hinten" * 9)
        ws = text.split()
        if len(ws) >= 20:  # a word changed, one put in and one left out
            at = sorted(rng.sample(range(3, len(ws) - 3), 1))[0]
            kept.append(label)
            broken.append("so " + " ".join([*ws[:at], "neu", "mehr", *ws[at + 1:]]))
    got = scan(spark, whole)
    assert all(label in got[i]["labels"] and got[i]["score"] == 1 for i, (label, _) in enumerate([*BASE, *TEXTS]))
    got = scan(spark, broken)
    for i, label in enumerate(kept):
        assert label in got[i]["labels"] and 0.8 <= got[i]["score"]
        assert any(s["label"] == label and s["start"] <= 1 and 0.8 <= s["cover"] < 1 for s in got[i]["spans"])


def test_other_texts_get_no_label(spark):
    half = " ".join(TEXTS[4][1].split()[:25])
    loose = " sonst ".join(TEXTS[4][1].split())
    got = scan(spark, ["", "the rights to use", half, loose, "all rights are reserved", "under the terms of the"])
    assert all(not r["labels"] and not r["spans"] and r["n_base"] == 0 for r in got.values())
    assert got[0]["score"] == got[3]["score"] == 0 and 0.2 < got[2]["score"] < 0.8


def test_nulls_repeated_rows_and_long_texts(spark):
    text = "Released under the MIT License. All rights reserved."
    long = "wort " * 60_000 + TEXTS[4][1] + " wort" * 60_000 + " cc by nc" * 1000
    rows = [(1, text), (1, text), (None, text), (None, text), (1, None), (2, None), (3, ""), (4, long)]
    df = spark.createDataFrame([(i, t, None, None, None, None, None, None, None) for i, t in rows], SCHEMA).repartition(3)
    got = L.scanned(df).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {
        "row", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"}
    for r in got:
        if r["row"]["text"] == text:
            assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (8, 1, 1, 1)
            assert r["labels"] == ["all-rights-reserved", "mit"] and [tuple(s)[:3] for s in r["spans"]] == [(0, 5, "mit"), (1, 5, "mit"), (5, 8, "all-rights-reserved")]
        elif not r["row"]["text"]:
            assert (r["n_words"], r["n_base"], r["first_word"], r["score"], r["spans"]) == (0, 0, None, 0, [])
        else:
            assert r["n_base"] == 1000 and "bsd" in r["labels"] and (r["first_word"], r["last_word"]) == (120_000 + len(re.findall("[A-Za-z0-9]+", TEXTS[4][1])), r["n_words"] - 3)
    assert L.scanned(df.limit(0)).collect() == []
    assert {r["n_words"] for r in L.scanned(df.select("text", "doc_id").where("doc_id = 1")).collect()} == {0, 8}


def test_only_column_expressions(spark, data):
    plan = queries.QUERIES["op12_license_diagonals"](spark, data)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
