"""Each stage against a plain version on its own input, over a small copy of the tables with odd rows added."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_minhash import brute as near_groups
from test_llm_packing import read_back
from test_llm_secrets import brute as base_secrets
from test_llm_suffixes import brute as repeats

import corpus_pipeline
from __spark_entry__ import queries
from fieldhouse.llm import toxicity as T
from fieldhouse.llm.kernels import flat
from fieldhouse.llm.secrets import MASK


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("pipeline"))
    source = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{source}/documents.parquet").where("doc_id < 220")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "no id", "en", "s", 5), (9000, "", "en", "s", 0), (9001, "twice told", "en", "s", 10),
                                 (9001, "twice told", "en", "s", 10), (9002, "token = abcdefghijklmnop", "en", "s", 24)], docs.schema)
    docs.unionAll(odd).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{source}/labels.parquet").write.parquet(f"{d}/labels.parquet")
    at, out = spark.read.parquet(f"{d}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(at)
        stage(spark, at, d).write.parquet(f"{d}/{name}")
        at = spark.read.parquet(f"{d}/{name}")
    return d, [*out, at]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_toxicity(spark, stages):
    d, (docs, kept, *_) = stages
    assert kept.columns == docs.columns
    sample = sorted((r["doc_id"], r["toxic"], r["text"] or "") for r in T.training_rows(docs, spark.read.parquet(f"{d}/labels.parquet")).collect())
    net = T.fit([t for _, _, t in sample], [y for _, y, _ in sample])
    rows = rows_of(docs)
    score = T.score_texts(net, *flat(pa.array([r[1] for r in rows], pa.string())))
    assert rows_of(kept) == [r for r, s in zip(rows, score) if s < 0.5]
    assert 0 < len(rows) - kept.count() < len(rows) / 2 and np.isfinite(score).all()


def test_near_duplicates(stages):
    _, (_, docs, kept, *_) = stages
    rows = sorted(set(map(tuple, docs.where("doc_id IS NOT NULL").collect())), key=repr)
    groups = near_groups([(r[0], r[1]) for r in rows], 5, 80)
    want = [r for r in rows if groups[r[0]][1] == r[0]] + [tuple(r) for r in docs.where("doc_id IS NULL").collect()]
    assert rows_of(kept) == sorted(want, key=repr) and kept.columns == docs.columns


def test_repeated_strings(stages):
    _, (_, _, docs, clean, *_) = stages
    rows = docs.collect()
    want = {(r["doc_id"], r["n_chars"]): n for r, (_, n, _, _) in zip(rows, repeats([r["text"] for r in rows]))}
    after = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == docs.columns and clean.count() == len(rows)
    for r in rows:
        if r["doc_id"] is not None:
            removed = len((r["text"] or "").encode()) - len((after[r["doc_id"]]["text"] or "").encode())
            assert 0 <= removed - want[r["doc_id"], r["n_chars"]] <= 3 * removed and (removed == 0) == (want[r["doc_id"], r["n_chars"]] == 0)
            assert after[r["doc_id"]]["n_chars"] == len(after[r["doc_id"]]["text"])


def test_secrets(stages):
    _, (_, _, _, docs, clean, _) = stages
    after = {r["doc_id"]: r["text"] for r in clean.collect()}
    hit = 0
    for r in docs.where("doc_id IS NOT NULL").collect():
        found = base_secrets(r["text"])[2]
        hit += bool(found)
        text = after[r["doc_id"]]
        assert text == r["text"] or MASK in text
        for s, _, e in found:
            assert r["text"][s:e] not in text
    assert hit and after[9002] == MASK and clean.count() == docs.count() and clean.columns == docs.columns


def test_packing_and_run(spark, stages):
    d, (*_, docs, pieces) = stages
    read_back(pieces.collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    whole = queries()["pipeline"](spark, d)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(whole.select(columns)) == rows_of(pieces.select(columns))


def test_empty_tables(spark, stages, tmp_path):
    d, (docs, *_) = stages
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, d)
        assert out.count() == 0
    assert docs.where(F.lit(False)).count() == 0


def test_rows_that_share_an_id_keep_their_different_texts(spark):
    import corpus_pipeline as C

    say = lambda word: " ".join(f"{word}{i}" for i in range(60))
    rows = [(1, say("a"), "en", "s", 1), (1, say("b"), "en", "s", 1), (1, say("b"), "en", "s", 1), (2, say("c"), "en", "s", 1), (3, say("b") + " end", "en", "s", 1),
            (5, say("c"), "en", "s", 1), (6, None, "en", "s", 1), (6, "", "en", "s", 1), (None, say("a"), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in C.drop_near_duplicates(spark, docs, "").collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    assert sorted(got, key=order) == sorted([(1, say("a")), (1, say("b")), (2, say("c")), (6, ""), (6, None), (None, say("a"))], key=order)
