"""Models on a planted signal, persistence, and the daily picks job."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from fieldhouse.operators import encoding as en
from fieldhouse.operators import metrics as mt
from fieldhouse.plans import models as md
from fieldhouse.plans.picks_job import store_picks
from fieldhouse.sources.tables import TableStore
from fieldhouse.workload import QUERIES

FEATURES = ["x", "noise"]


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        x = rnd.gauss(0, 1)
        rows.append((i, x, rnd.gauss(0, 1), int(x + rnd.gauss(0, 0.5) > 0), 3 * x + rnd.gauss(0, 0.1), i // 6))
    return spark.createDataFrame(rows, "gameId int, x double, noise double, y int, z double, day int").cache()


@pytest.mark.parametrize("name", ["lr", "rf"])
def test_models_score_in_a_session_that_has_observed_a_write(spark, planted, name):
    seen = Observation()
    planted.observe(seen, F.count(F.lit(1)).alias("n")).count()
    assert seen.get["n"] == 600
    m = md.fit(planted, "y", FEATURES, name, "classification")
    assert m.score(planted).where("predProb IS NOT NULL").count() == 600
    assert m.model.stages[-1].hasSummary


@pytest.mark.parametrize("name,params", [("lr", {}), ("xgb", {"maxIter": 5}), ("rf", {"numTrees": 10}), ("nn", {"hidden": 4, "maxIter": 60})])
def test_signal_is_found(planted, name, params):
    m = md.fit(planted, "y", FEATURES, name, "classification", **params)
    assert m.metrics(planted, "y").first()["auc"] > 0.8


def test_regression(planted):
    m = md.fit(planted, "z", FEATURES, "linear")
    assert m.problem == "regression"
    assert m.metrics(planted, "z").first()["r2"] > 0.95


def test_time_train(planted):
    t = md.train(planted, "y", FEATURES, "gameId", "lr", split="time", time_col="day", folds=2, candidates=[{"regParam": 0.01}])
    assert t.train.agg(F.max("day")).first()[0] <= t.test.agg(F.min("day")).first()[0]
    assert t.train.count() == 480
    with pytest.raises(ValueError, match="time_col"):
        md.train(planted, "y", FEATURES, "gameId", "lr", split="time")
    with pytest.raises(ValueError, match="feature"):
        md.train(planted, "y", ["x", "day"], "gameId", "lr", split="time", time_col="day")


def test_search_prefers_the_weaker_penalty(planted):
    best, scores = md.search(planted, "y", FEATURES, "gameId", "lr", folds=2, candidates=[{"regParam": 50.0}, {"regParam": 0.001}])
    assert best == {"regParam": 0.001} and len(scores) == 2


def test_parameter_draws_are_seeded():
    draw = [md.draw_parameters("boosted", 10, random.Random(1)) for _ in range(2)]
    assert draw[0] == draw[1] and 0.01 <= draw[0]["stepSize"] <= 0.05


def test_names():
    assert md.kind_of(" XGBoost ") == "boosted"
    with pytest.raises(ValueError, match="unknown model"):
        md.kind_of("svm")


def test_importance(spark, planted):
    m = md.fit(planted, "y", FEATURES, "lr", "classification")
    assert md.importance(spark, m).first()["feature"] == "x"
    assert md.permutation_importance(m, planted, "y", "gameId", repeats=1).first()["feature"] == "x"
    placeholder = md.ensemble_importance(spark, "voting").first()
    assert (placeholder["feature"], placeholder["percent"]) == ("Ensemble_Method", 100.0)


def test_vote_and_stack(spark, planted):
    pair = {n: md.fit(planted, "y", FEATURES, n, "classification", **p) for n, p in (("lr", {}), ("rf", {"numTrees": 5}))}
    row = md.vote(pair, planted, mt.position_weights(["lr", "rf"])).first()
    assert row["predProb"] == pytest.approx((2 * row["lr_score"] + row["rf_score"]) / 3)
    s = md.stack(planted, "y", FEATURES, "gameId", ["lr", "rf"], {"rf": {"numTrees": 5}}, folds=2)
    assert s.score(planted).agg(F.avg((F.col("predClass") == F.col("y")).cast("int"))).first()[0] > 0.8
    assert s.weights(spark).count() == 2


def test_repeat(planted):
    scores, weights = md.repeat_training(planted, "y", FEATURES, "gameId", "lr", runs=2)
    avg = {r["metric"]: r for r in mt.average_over_runs(scores).collect()}
    assert avg["accuracy"]["runs"] == 2 and avg["auc"]["mean"] > 0.8
    assert weights.count() == 4


def test_save_load_evaluate(planted, tmp_path):
    m = md.fit(planted, "y", FEATURES, "lr", "classification")
    first = md.save_model(m.model, "m", str(tmp_path))
    second = md.save_model(m.model, "m", str(tmp_path))
    assert first != second and md.save_model(m.model, "m", str(tmp_path), overwrite=True) == first
    out = md.evaluate_saved(first, planted.drop("noise"), "y")  # the missing feature counts as 0
    assert out.count() == 600 and set(out.columns) == {"gameId", "actual", "predicted", "predProb"}
    r = md.fit(planted, "z", FEATURES, "linear", "regression")
    errors = md.evaluate_saved(md.save_model(r.model, "r", str(tmp_path)), planted, "z", output=str(tmp_path / "out.json"))
    assert errors.where("abs_error < 1").count() == 600 and (tmp_path / "out.json").exists()


def test_picks_are_stored_once(spark, data, tmp_path):
    picks = QUERIES["daily_spread_picks"](spark, data)
    store = TableStore(spark, str(tmp_path))
    n = picks.count()
    assert store_picks(picks, store, dry_run=True).inserted == n
    assert store_picks(picks, store).inserted == n
    again = store_picks(picks, store)
    assert (again.inserted, again.updated) == (0, 0)


def test_fill_and_impute(spark):
    df = spark.createDataFrame([(1, 1.0, "a", None), (2, None, None, None), (3, -999.0, "b", None), (4, 3.0, "c", None)],
                               "k int, v double, t string, e double")
    got = {r["k"]: r for r in en.impute(df, ["k"], nonsense={"v": -999.0}).collect()}
    assert got[1]["v"] == 1.0 and got[2]["v"] is not None and got[3]["v"] != -999.0
    assert got[2]["t"] == "" and got[2]["e"] == 0.0
    again = {r["k"]: r for r in en.impute(df.repartition(3), ["k"], nonsense={"v": -999.0}).collect()}
    assert got == again  # draws depend on the row's key only
    filled = en.fill(df, {"v": "zero", "t": "none"}, ["k"]).where("k = 2").first()
    assert (filled["v"], filled["t"]) == (0.0, "none")


def test_noise_is_standard_normal(spark):
    row = spark.range(20000).select(en.normal_noise(["id"], "c", 1).alias("z")).agg(F.avg("z").alias("m"), F.stddev("z").alias("s")).first()
    assert abs(row["m"]) < 0.05 and abs(row["s"] - 1) < 0.05


def test_encoders(spark):
    df = spark.createDataFrame([("a", "x", 10), ("b", "x", 20), ("c", "y", 30), (None, "y", 10)], "c string, two string, y int")
    out = en.prepare(df, "y")
    assert out.columns == ["two_y", "c_a", "c_b", "y"]
    assert [r["y"] for r in out.orderBy("y").collect()] == [0, 0, 1, 2]
    assert en.categories(df, ["c"], most=2) == {}
    assert en.problem_type(spark.range(9).toDF("y"), "y") == "classification"
    assert en.problem_type(spark.range(10).toDF("y"), "y") == "regression"
    assert en.encode_target(spark.range(30).toDF("y"), "y").agg(F.max("y")).first()[0] == 29


def test_confusion_with_an_absent_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (2, 0)], "actual int, pred int")
    got = {r["class"]: r for r in mt.class_report(mt.confusion(df)).collect()}
    assert got[2]["precision"] is None and got[2]["recall"] == 0.0
    assert (got[0]["tp"], got[0]["fp"], got[0]["fn"], got[0]["tn"]) == (1, 2, 1, 0)
    assert mt.confusion(df).agg(F.sum("n")).first()[0] == 4
