"""Rotations and probes by hand, results against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldhouse.llm import neighbours as A
from fieldhouse.llm.neighbours import Settings, buckets_of, nearest, padded, probes_of, rotated

SCHEMA = "vec_id long, embedding array<float>, label int, bucket string"


def brute(rows, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), d[j]) for j in order]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items()])


def test_rotations_keep_lengths_and_probes_start_at_the_own_bucket():
    x = padded(np.random.default_rng(0).standard_normal((50, 48)))
    assert np.allclose(np.linalg.norm(rotated(x, 3, 1), axis=1), 1)
    for how in (Settings(1, 2, 5), Settings(2, 2, 30)):
        own, probed = buckets_of(x, how, 1, 7), probes_of(x, how, 1, 7)
        assert probed.shape == (50, how.probes) and all(own[i] in probed[i] and len(set(probed[i])) == how.probes for i in range(50))
    assert set(probes_of(x, Settings(1, 1, 128), 0, 7)[0]) == set(range(128))


def test_small_sets_are_exact_with_ties_nulls_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(5).round(1).tolist(), 0, "x") for i in range(300)]
    rows += [(1000 + i, rows[100][1], 0, "x") for i in range(60)] + [(200, rows[200][1], 0, "x")]
    odd = [(None, [1.0] * 5, 0, ""), (500, None, 0, ""), (600, [0.0] * 5, 0, ""), (700, [float("nan")] + [1.0] * 4, 0, ""), (800, [1.0, None, 1.0, 1.0, 1.0], 0, ""),
           (900, [float("inf")] * 5, 0, ""), (400, [1.0, 2.0], 0, "")]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    got, want = results(nearest(df, F.col("vec_id") % 100 == 0)), brute(rows[:-1], 10)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-14) for q in want)


def test_few_rows_and_empty(spark):
    rows = [(0, [1.0, 0.0], 0, ""), (3, [0.5, 1.0], 0, ""), (4, [2.0, 0.0], 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [i for i, _ in results(nearest(df, F.col("vec_id") % 100 == 0))[0]] == [4, 3]
    assert nearest(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert nearest(df.where("vec_id > 0"), F.col("vec_id") % 100 == 0).collect() == []


@pytest.mark.parametrize("split", [20_000, 7])
def test_buckets_may_be_split(spark, monkeypatch, split):
    monkeypatch.setattr(A, "SPLIT", split)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(16) + 3 * (i % 4 == 0)).tolist(), 0, "") for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = results(nearest(df, F.col("vec_id") % 100 == 0, how=Settings(1, 6, 6)))
    assert recall(got, brute(rows, 10)) > 0.9


@pytest.mark.parametrize("how", [None, Settings(1, 12, 8), Settings(2, 24, 250)])
def test_recall_on_the_given_table(spark, how):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = results(nearest(df, F.col("vec_id") % 100 == 0, how=how))
    assert recall(got, brute(rows, 10)) >= 0.9


@pytest.mark.parametrize("n, dim", [(5_000, 64), (12_000, 128)])
def test_recall_does_not_hang_on_size_or_dimension(spark, n, dim):
    x = np.random.default_rng(3).standard_normal((n, dim))
    rows = [(i, (v / np.linalg.norm(v)).tolist(), 0, "") for i, v in enumerate(x)]
    assert recall(results(nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0)), brute(rows, 10)) >= 0.95


def test_settings_reach_the_target_on_other_queries():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((20_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)

    def true(q):
        return np.concatenate([np.argsort(((x - x[i]) ** 2).sum(axis=1))[1:11] for i in q]), np.repeat(np.arange(len(q)), 10)

    near, of = true(range(96))
    how = A.settings(x[:96], x[near], of, len(x), 200, 11)
    near, of = true(range(100, 200))
    q, y, hit = padded(x[100:200]), padded(x[near]), np.zeros(len(near), bool)
    for t in range(how.tables):
        hit |= (probes_of(q, how, t, 11)[of] == buckets_of(y, how, t, 11)[:, None]).any(axis=1)
    assert hit.mean() > 0.95


def test_queries_with_few_candidates_are_compared_with_all(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(16).tolist(), 0, "") for i in range(1000)]
    got, want = results(nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, how=Settings(3, 1, 1))), brute(rows, 10)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
