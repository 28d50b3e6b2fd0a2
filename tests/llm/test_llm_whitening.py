"""The solver against numpy's, whole results against exact sums and plain eigenvectors."""

import math

import numpy as np
import pytest

from fieldhouse.llm import queries, whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, n int, row string, _v int"


@pytest.mark.parametrize("make", [
    lambda g: g.standard_normal((40, 40)),
    lambda g: g.standard_normal((30, 30)) * 10.0 ** -np.arange(30),
    lambda g: g.standard_normal((30, 30)) * 10.0 ** np.arange(-15, 15),
    lambda g: np.diag(np.full(12, 3.0)),
    lambda g: np.diag(np.repeat([5.0, 3.0, 1.0], 4)) @ np.linalg.qr(g.standard_normal((12, 12)))[0],
    lambda g: g.standard_normal((3, 9)),
    lambda g: np.outer(np.ones(6), g.standard_normal(6)),
    lambda g: np.diag(np.abs(np.arange(21) - 10.0) + 1) + np.diag(np.ones(20), 1),
    lambda g: g.standard_normal((1, 1)),
])
def test_singular_values_and_directions(make):
    r = np.linalg.qr(make(np.random.default_rng(5)), mode="r")
    size, v = W.leading(r, 8)
    u = np.linalg.svd(r, compute_uv=False)
    u = u[u > 1e-12 * u[0]][:8]
    assert len(size) == len(u) and np.allclose(size, u, rtol=1e-12)
    assert np.allclose(v.T @ v, np.eye(len(u)), atol=1e-11)
    assert np.abs(r.T @ (r @ v) - v * size ** 2).max() <= 1e-12 * u[0] ** 2


def test_small_singular_values_keep_their_digits():
    """Of a bidiagonal matrix with entries from 1 to 1e-120, against the determinant."""
    a, b = 10.0 ** -np.linspace(0, 120, 13), np.full(12, 1e-7) * 10.0 ** -np.linspace(0, 119, 12)
    got = W.squares(a, b)
    assert math.isclose(sum(map(math.log, got)), 2 * np.log(a).sum(), rel_tol=1e-14)
    assert np.allclose(got, a ** 2, rtol=1e-6)


def brute(vectors, k=8):
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    d = [[n * c - t for c, t in zip(row, s)] for row in x]
    m = np.array(d, float) / n
    e, v = np.linalg.eigh(m.T @ m / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, {i: (sum(c * c for c in row), p) for (i, _), row, p in zip(vectors, d, m @ v / np.sqrt(e))}, e / np.trace(m.T @ m / n)


def test_the_given_table(spark, data):
    rows = queries.QUERIES["op13_whitening_by_dqds"](spark, data).collect()
    good = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()
            if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    n, want, share = brute(good)
    assert len(rows) == 8 * n and {r["n"] for r in rows} == {n}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-10
    got = np.zeros((n, 8))
    at = {i: k for k, (i, _) in enumerate(good)}
    for r in rows:
        assert r["deviation"] == want[r["vec_id"]][0] and math.isclose(r["explained"], share[r["component"] - 1], rel_tol=1e-10)
        got[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    plain = np.array([want[i][1] for i, _ in good])
    assert np.allclose(got, plain * np.sign((got * plain).sum(axis=0)), atol=1e-9)


def test_nulls_ties_lengths_and_clashing_names(spark):
    g = np.random.default_rng(1)
    rows = [(i, [float(np.float32(c)) for c in g.standard_normal(5)], 1, 2, "x", 3) for i in range(50)]
    rows += [(7, rows[7][1], 1, 2, "again", 3), (None, rows[3][1], None, None, None, None)]
    odd = [(60, None), (61, [1.0, None, 1.0, 1.0, 1.0]), (62, [float("nan")] * 5), (63, [float("inf")] + [0.0] * 4), (64, [1.0, 2.0]), (65, []), (66, [1e30] * 5)]
    df = spark.createDataFrame(rows + [(i, v, 0, 0, "", 0) for i, v in odd], SCHEMA).repartition(7)
    got = W.whitened(df, components=3).collect()
    assert len(got) == 52 and all(len(r["whitened"]) == 3 and r["n"] == 52 and r["row"]["_v"] in (3, None) for r in got)
    assert len({tuple(r["whitened"]) for r in got if r["row"]["vec_id"] == 7}) == 1
    plain = brute([(k, r[1]) for k, r in enumerate(rows)], 3)
    assert {r["deviation"] for r in got} == {d for d, _ in plain[1].values()}
    assert W.whitened(df.limit(0)).collect() == []
    assert W.whitened(df.where("embedding IS NULL")).collect() == []
    same = W.whitened(df.where("vec_id = 7")).collect()
    assert len(same) == 2 and all(r["whitened"] == [] and r["deviation"] == 0 and r["identity_error"] == 0 for r in same)
    flat = df.where("vec_id < 60").selectExpr("vec_id", "array(get(embedding, 0), get(embedding, 0), 1F) AS embedding")
    assert {len(r["whitened"]) for r in W.whitened(flat).collect()} == {1}
    huge = W.whitened(df.where("vec_id < 60").selectExpr("vec_id", "array(get(embedding, 0) * 1e12D, 4e15D, double(vec_id)) AS embedding")).collect()
    assert {r["deviation"] for r in huge} == {None} and huge[0]["identity_error"] < 1e-6


def test_a_tree_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN", 3)
    g = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in g.standard_normal(6) + 50]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(23)
    got = W.whitened(df, components=6).collect()
    n, want, _ = brute(rows, 6)
    assert n == 400 and all(r["deviation"] == want[r["row"]["vec_id"]][0] for r in got)
    a, b = np.array([r["whitened"] for r in got]), np.array([want[r["row"]["vec_id"]][1] for r in got])
    assert np.allclose(a, b * np.sign((a * b).sum(axis=0)), atol=1e-9) and got[0]["identity_error"] < 1e-10
