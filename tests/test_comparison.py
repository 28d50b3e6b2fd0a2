"""Preparation, comparison, saved models, classes, ensembles and importance by hand tables and plain Python."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldhouse.plans import comparison as cp
from fieldhouse.plans import models as md

KINDS = {"xgb": {"kind": "xgb", "maxIter": 4, "maxDepth": 3}, "rf": {"kind": "rf", "numTrees": 5}, "lr": {"kind": "lr"}}


@pytest.fixture(scope="module")
def rows(spark):
    g = np.random.default_rng(3)
    x, z = g.normal(size=300), g.normal(size=300)
    out = []
    for i in range(300):
        out.append((i, None if i % 11 == 0 else float(x[i]), int(z[i] * 10), None if i % 13 == 0 else "abc"[i % 3], i % 2 == 0, f"t{i}",
                    "won" if x[i] + 0.3 * z[i] > 0 else "lost", i % 3, float(2 * x[i] + z[i])))
    schema = "id long, x double, z int, `a kind` string, flag boolean, title string, result string, fold int, margin double"
    return spark.createDataFrame(out, schema).withColumn("text", F.lit("o'neil \\ x")).cache()


def test_preparation_sees_training_rows_only(spark, rows):
    train, test = rows.where("id < 200"), rows.where("id >= 200").withColumns({"x": F.lit(None).cast("double"), "a kind": F.lit("new")})
    prep = cp.Preparation.fit(train, "result", skip=["id", "fold", "margin"])
    assert prep.labels == ["lost", "won"] and prep.values == {"a kind": ["a", "b", "c"], "text": ["o'neil \\ x"]} and prep.unused == ["title"]
    known = sorted(r["x"] for r in train.collect() if r["x"] is not None)
    want = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
    assert prep.medians["x"] == want
    out = prep.stage().transform(prep.aligned(test.drop("z"), ["id"])).collect()
    assert {(r["p_x"], r["p_a_kind_a"], r["p_a_kind_b"]) for r in out} == {(want, 0.0, 0.0)}
    assert {r["p_z"] for r in out} == {prep.medians["z"]} and {r["p_flag_True"] for r in out} == {0.0, 1.0}
    assert cp.Preparation.fit(train.withColumn("result", F.lit(3.5)), "result").labels == [3.5]


def test_several_kinds_in_one_table(rows):
    got = cp.compare(rows, "result", "id", KINDS, skip=["fold", "margin"])
    figures = {r["model"]: r for r in got.metrics.collect()}
    scored = got.scored.collect()
    assert set(figures) == set(KINDS) and got.preparation.problem == "classification"
    held = {r["id"] for r in scored}
    assert len(held) == 60 and len(scored) == 180
    for name in KINDS:
        own = [r for r in scored if r["model"] == name]
        tp = sum(r["actual"] == r["pred"] == 1 for r in own)
        p, a = sum(r["pred"] for r in own), sum(r["actual"] for r in own)
        wins = sum((i["proba"] > j["proba"]) + 0.5 * (i["proba"] == j["proba"]) for i in own for j in own if i["actual"] > j["actual"])
        f = figures[name]
        assert f["rows"] == 60 and np.isclose(f["accuracy"], sum(r["actual"] == r["pred"] for r in own) / 60)
        assert np.isclose(f["precision"], tp / p) and np.isclose(f["recall"], tp / a) and np.isclose(f["f1"], 2 * tp / (p + a))
        assert np.isclose(f["auc"], wins / (a * (60 - a))) and f["accuracy"] > 0.7
    seen = rows.where(~F.col("id").isin(list(held)))
    assert cp.Preparation.fit(seen, "result", ["id", "fold", "margin"]) == got.preparation


def test_saved_reloaded_and_direct_figures_are_equal(rows, tmp_path):
    train, test = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    prep = cp.Preparation.fit(train, "result", skip=["id", "fold", "margin"])
    for name, spec in KINDS.items():
        m = cp.fit(train, prep, name, **spec)
        path = cp.save(m, str(tmp_path))
        direct = m.scores(test, "id")
        scored, figures = cp.evaluate(path, test.withColumn("features", F.lit(1)), "id")
        assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, direct.collect()))
        assert figures.collect() == cp.judged(direct, "classification").collect()
        blind, none = cp.evaluate(path, test.drop("result", "z"), "id")
        assert none is None and blind.count() == test.count() and "actual" not in blind.columns
    again = cp.save(cp.fit(train, prep, "lr", "lr"), str(tmp_path))
    assert again != path and cp.load(again).preparation.labels == ["lost", "won"]


@pytest.mark.parametrize("kind,params", [("xgb", {"maxIter": 3}), ("rf", {"numTrees": 5}), ("lr", {}), ("nn", {"hidden": 4, "maxIter": 20})])
def test_four_classes(rows, kind, params):
    df = rows.withColumn("place", F.when(F.col("margin") < -2, 40).when(F.col("margin") < 0, 10).when(F.col("margin") < 2, 20).otherwise(30))
    prep = cp.Preparation.fit(df, "place", skip=["id", "fold", "result", "margin"])
    assert prep.labels == [10, 20, 30, 40]
    m = cp.fit(df, prep, kind, kind, **params)
    out = m.labelled(df, "id").collect()
    assert all(len(r["probabilities"]) == 4 and abs(sum(r["probabilities"]) - 1) < 1e-9 for r in out)
    assert all(r["label"] == [10, 20, 30, 40][int(np.argmax(r["probabilities"]))] for r in out)
    figures = cp.judged(m.scores(df, "id"), "classification", classes=4).first()
    pairs = [(r["actual"], r["pred"]) for r in m.scores(df, "id").collect()]
    share = [sum(a == c for a, _ in pairs) / len(pairs) for c in range(4)]
    recall = [sum(a == p == c for a, p in pairs) / max(sum(a == c for a, _ in pairs), 1) for c in range(4)]
    assert np.isclose(figures["recall"], np.dot(share, recall)) and figures["auc"] is None and figures["accuracy"] > 0.5


def test_search_over_classes(rows):
    df = rows.withColumn("place", F.pmod(F.col("id"), F.lit(3)).cast("int")).withColumn("x", F.col("fold") + F.coalesce("x", F.lit(0.0)) / 9)
    for kind, tried in (("xgb", [{"maxIter": 1, "maxDepth": 1}, {"maxIter": 4, "maxDepth": 3}]), ("nn", [{"hidden": 2}, {"hidden": 5}])):
        best, scores = md.search(df, "place", ["x", "z"], "id", kind, folds=2, candidates=tried, classes=3)
        assert best in tried and len(scores) == 2 and max(scores) > 0.8
    m = md.fit(df, "place", ["x", "z"], "xgb", "classification", classes=3, maxIter=3)
    out = m.score(df).collect()
    assert all(abs(sum(r["probabilities"]) - 1) < 1e-9 and r["predProb"] == max(r["probabilities"]) for r in out)
    assert m.metrics(df, "place").first()["accuracy"] > 0.9


def test_ensembles_re_derived_by_sql(rows):
    every, figures = cp.compare_ensembles(rows, "result", "id", "fold", range(3), {k: KINDS[k] for k in ("lr", "rf")}, boosting={"maxIter": 3}, skip=["margin"])
    table, found = every.toPandas(), figures.toPandas()
    assert set(found["model"]) == {"lr", "rf", "boosting", "vote", "weighted", "stack"} and (found["rows"] == 300).all()
    con = duckdb.connect()
    con.register("o", table)
    plain = con.execute("""
        WITH m AS (SELECT * FROM o WHERE model IN ('lr', 'rf')),
        v AS (SELECT i AS fold, model, avg(((score > 0.5) = (actual = 1))::INT) AS value FROM m, range(3) r(i) WHERE fold <> i GROUP BY ALL)
        SELECT id, avg(score) AS vote, sum(score * value) / sum(value) AS weighted FROM m JOIN v USING (fold, model) GROUP BY 1 ORDER BY 1""").df()
    for k in ("vote", "weighted"):
        got = table[table["model"] == k].sort_values("id")["score"].to_numpy()
        assert k == "vote" and np.allclose(got, plain[k]) or np.allclose(got, plain[k], atol=0.02)
    chosen = con.execute("SELECT model FROM (SELECT model, avg(((score > 0.5) = (actual = 1))::INT) AS a FROM o GROUP BY 1) ORDER BY a DESC, model LIMIT 1").fetchone()[0]
    assert found[found["chosen"]]["model"].tolist() == [chosen]


def jobs(spark, action):
    spark.sparkContext.setJobGroup("counted", "counted")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    action()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before


def test_importance_needs_no_more_jobs_for_more_features(spark, rows):
    df = rows.select("id", "x", "z", F.lit(4.0).alias("same"), (F.col("result") == "won").cast("int").alias("y"), *[(F.col("z") % k).alias(f"m{k}") for k in range(2, 9)])
    few, many = ["x", "same"], ["x", "same", "z", *[f"m{k}" for k in range(2, 9)]]
    models = [md.fit(df, "y", f, "lr", "classification") for f in (few, many)]
    count = [jobs(spark, lambda m=m, r=r: md.permutation_importance(m, df, "y", "id", r)) for m, r in zip(models, (1, 4))]
    assert count[0] == count[1]
    got = {r["feature"]: r["importance"] for r in md.permutation_importance(models[1], df, "y", "id", 4).collect()}
    assert got["same"] == 0 and got["x"] > 0.2 and len(got) == 10


def test_auc_of_runs_on_both_sides(rows):
    df = rows.withColumn("y", F.when(F.col("result") == "won", 1).otherwise(0))
    got = cp.auc_over_runs(df, "y", "id", "rf", ["x", "z"], {k: F.col("fold") == k for k in range(3)}, numTrees=5).collect()
    assert {(r["run"], r["side"]) for r in got} == {(k, s) for k in range(3) for s in ("train", "test")}
    assert all(0.8 < r["auc"] <= 1 for r in got)


def test_empty_tables_and_null_targets(rows):
    none = rows.withColumn("result", F.lit(None).cast("string"))
    prep = cp.Preparation.fit(rows, "result", skip=["id", "fold", "margin"])
    m = cp.fit(rows, prep, "lr", "lr")
    assert cp.judged(m.scores(none, "id"), "classification").collect() == []
    assert m.scores(none, "id").count() == 300 and m.scores(rows.limit(0), "id").count() == 0
    with pytest.raises(ValueError):
        cp.Preparation.fit(rows, "title", problem="classification")
