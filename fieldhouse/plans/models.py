"""Training, scoring and comparing Spark ML models on feature tables.

Every model is a chain of Spark ML stages (fill, assemble, standardise, estimate), fitted and applied by Spark. Rows keep their
key through scoring, so predictions never have to be matched back by position.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldhouse.operators import metrics as mt
from fieldhouse.operators.encoding import problem_type
from fieldhouse.operators.ordering import with_position
from fieldhouse.operators.shape import align_features
from fieldhouse.operators.sizing import beside
from fieldhouse.operators.splits import row_hash, split_by_time, split_random, with_folds, with_time_folds
from fieldhouse.session import pinned

LABEL = "label"
# Names a model may be asked for by.
ALIASES = {
    "xgb": "boosted", "xgboost": "boosted", "rf": "forest", "randomforest": "forest", "nn": "network",
    "neuralnet": "network", "neuralnetwork": "network", "lr": "linear", "linear": "linear", "logistic": "linear",
}
# Classification metrics a search can optimise, by evaluator name.
CLASS_METRICS = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}
REGRESSION_METRICS = {"mae": "mae", "mse": "mse", "rmse": "rmse", "r2": "r2"}


def kind_of(name: str) -> str:
    kind = ALIASES.get(str(name).lower().strip())
    if kind is None:
        raise ValueError(f"unknown model type {name!r}; known: {sorted(ALIASES)}")
    return kind


def draw_parameters(kind: str, rows: int, rng: random.Random) -> dict:
    """One random point of a model's search space."""
    if kind == "boosted":
        return {"maxIter": rng.randint(100, 300), "maxDepth": rng.randint(2, 4),
                "stepSize": 0.01 * 5 ** rng.random(), "subsamplingRate": rng.uniform(0.5, 0.8),
                "minInstancesPerNode": rng.randint(5, 10)}
    if kind == "forest":
        return {"numTrees": rng.randint(30, 120), "maxDepth": rng.randint(2, 5), "minInstancesPerNode": rng.randint(4, 8),
                "featureSubsetStrategy": f"{rng.uniform(0.4, 0.8):.2f}"}
    if kind == "network":
        return {"hidden": rng.randint(5, 20)}
    return {"regParam": 1.0 / (10 ** rng.uniform(-3, 2) * max(rows, 1))}


def estimator(kind: str, problem: str, features: int, classes: int = 2, seed: int = 42, **params) -> Estimator | list[Estimator]:
    """One stage; a list of stages for boosted trees of more than two classes, one for every class against the rest."""
    if kind == "boosted" and problem == "classification" and classes > 2:
        return [GBTClassifier(seed=seed, featuresCol="features", labelCol=f"{LABEL}_{i}", predictionCol=f"prediction_{i}", **params)
                .setRawPredictionCol(f"raw_{i}").setProbabilityCol(f"probability_{i}") for i in range(classes)]
    common = {"featuresCol": "features", "labelCol": LABEL}
    classify = problem == "classification"
    if kind == "boosted":
        return (GBTClassifier if classify else GBTRegressor)(seed=seed, **common, **params)
    if kind == "forest":
        return (RandomForestClassifier if classify else RandomForestRegressor)(seed=seed, **common, **params)
    if kind == "network":
        if not classify:
            raise ValueError("neural networks are available for classification only")
        params = dict(params)
        layers = [features, params.pop("hidden", 10), classes]
        return MultilayerPerceptronClassifier(seed=seed, layers=layers, **common, **params)
    return (LogisticRegression if classify else LinearRegression)(**common, **params)


def chain(features: Sequence[str], final: Estimator | list[Estimator]) -> Pipeline:
    """Missing features take the training mean, so that every row is fitted and scored."""
    filled = [f"_filled_{f}" for f in features]
    return Pipeline(stages=[
        Imputer(inputCols=list(features), outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=filled, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
        *(final if isinstance(final, list) else [final])])


def with_class_labels(rows: DataFrame, classes: int) -> DataFrame:
    """`label_0`, `label_1` …: whether a row is of that class, for models of one class against the rest."""
    return rows.withColumns({f"{LABEL}_{i}": (F.col(LABEL) == i).cast("double") for i in range(classes)})


def _without_summaries(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The same stages without training summaries: those hold the session, which no task can take once it has observed a write."""
    def bare(stage):
        if not getattr(stage, "hasSummary", False):
            return stage
        out = stage.copy()
        out._java_obj.setSummary(spark._jvm.scala.Option.empty())
        return out

    return PipelineModel([bare(s) for s in model.stages])


def predicted(model: PipelineModel, df: DataFrame, classify: bool = True) -> DataFrame:
    """`df` with `prediction`, for classes also `probabilities`, one per class with sum 1.

    One-against-rest chances are divided by their sum, and the largest decides; of equal ones the first class.
    """
    out = _without_summaries(model, df.sparkSession).transform(df)
    if not classify:
        return out.select(*df.columns, "prediction")
    parts = [m for m in model.stages if isinstance(m, GBTClassificationModel) and m.getProbabilityCol() != "probability"]
    if not parts:
        return out.select(*df.columns, "prediction", vector_to_array("probability").alias("probabilities"))
    raw = F.array(*[vector_to_array(m.getProbabilityCol())[1] for m in parts])
    total = F.aggregate(raw, F.lit(0.0), lambda a, b: a + b)
    out = out.select(*df.columns, F.transform(raw, lambda v: F.coalesce(F.try_divide(v, total), F.lit(1.0 / len(parts)))).alias("probabilities"))
    place = F.array_position("probabilities", F.array_max("probabilities")) - 1
    return out.select(*df.columns, place.cast("double").alias("prediction"), "probabilities")


def score(model: PipelineModel, df: DataFrame, classify: bool = True, classes: int = 2) -> DataFrame:
    """Rows with `predProb` and `predClass`, or with `prediction`; a missing feature counts as its training mean.

    predProb is the chance of class 1 of two; with more classes it is that of the predicted one, beside `probabilities`.
    """
    out = predicted(model, df, classify)
    if not classify:
        return out
    one = F.col("probabilities")[1] if classes == 2 else F.array_max("probabilities")
    return out.select(*df.columns, one.alias("predProb"), F.col("prediction").cast("int").alias("predClass"),
                      *(["probabilities"] if classes > 2 else []))


@dataclass
class Trained:
    name: str
    model: PipelineModel
    features: list[str]
    problem: str
    params: dict = field(default_factory=dict)
    train: DataFrame | None = None
    test: DataFrame | None = None
    classes: int = 2

    def score(self, df: DataFrame) -> DataFrame:
        return score(self.model, df, self.problem == "classification", self.classes)

    def metrics(self, df: DataFrame, target: str) -> DataFrame:
        """One row of metrics on labelled rows. AUC is taken from probabilities."""
        scored = self.score(df)
        if self.problem != "classification":
            return mt.regression_metrics(scored, target, "prediction")
        named = scored.select(F.col(target).cast("int").alias("actual"), F.col("predClass").alias("pred"),
                              F.col("predProb").alias("proba"))
        if self.classes > 2:
            return mt.classification_metrics(mt.confusion(named))
        return beside(mt.classification_metrics(mt.confusion(named)), mt.auc(named))


def fit(
    df: DataFrame, target: str, features: Sequence[str], name: str = "xgb", problem: str | None = None, seed: int = 42,
    classes: int = 2, **params,
) -> Trained:
    """Fit one model with given parameters on all rows of `df`. Labels of `classes` classes are 0, 1, … in order."""
    kind, problem = kind_of(name), problem or problem_type(df, target)
    final = estimator(kind, problem, len(features), classes, seed, **params)
    rows = df.select(*features, F.col(target).cast("double").alias(LABEL))
    rows = with_class_labels(rows, classes) if isinstance(final, list) else rows
    return Trained(name, chain(features, final).fit(rows), list(features), problem, params, classes=classes)


def _evaluator(problem: str, metric: str):
    if problem == "classification":
        return MulticlassClassificationEvaluator(labelCol=LABEL, metricName=CLASS_METRICS.get(metric, "accuracy"))
    return RegressionEvaluator(labelCol=LABEL, metricName=REGRESSION_METRICS.get(metric, "mae"))


def search(
    df: DataFrame, target: str, features: Sequence[str], key: str, name: str = "xgb", problem: str = "classification",
    metric: str = "auto", trials: int = 10, folds: int = 5, time_col: str | None = None, seed: int = 42,
    candidates: Sequence[dict] | None = None, parallelism: int = 4, classes: int = 2,
) -> tuple[dict, list[float]]:
    """Best parameters out of random candidates by cross-validation, and every candidate's mean score.

    With a time column the folds expand forward in time; otherwise they are hashed by key.
    """
    kind = kind_of(name)
    metric = ("f1" if problem == "classification" else "mae") if metric == "auto" else metric
    ev = _evaluator(problem, metric)
    rng = random.Random(seed)
    size = df.count()
    tried = list(candidates or [draw_parameters(kind, size, rng) for _ in range(trials)])
    rows = df.select(*dict.fromkeys([key, *([time_col] if time_col else []), *features]), F.col(target).cast("double").alias(LABEL))
    better = max if ev.isLargerBetter() else min
    several = kind == "boosted" and problem == "classification" and classes > 2
    if time_col or several:
        folded = pinned(with_time_folds(rows, time_col, key, folds) if time_col else with_folds(rows, key, folds, seed))
        parts = [(F.col("fold") < i if time_col else F.col("fold") != i, F.col("fold") == i)
                 for i in (range(1, folds + 1) if time_col else range(folds))]
        scores = []
        for p in tried:
            line = chain(features, estimator(kind, problem, len(features), classes, seed, **p))
            got = []
            for before, own in parts:
                seen = folded.where(before)
                model = line.fit(with_class_labels(seen, classes) if several else seen)
                got.append(ev.evaluate(predicted(model, folded.where(own), problem == "classification")))
            scores.append(sum(got) / len(got))
    else:
        folded = with_folds(rows, key, folds, seed)
        base = chain(features, estimator(kind, problem, len(features), classes, seed=seed))
        grid = [_as_param_map(base.getStages()[-1], kind, len(features), p, classes) for p in tried]
        scores = CrossValidator(
            estimator=base, estimatorParamMaps=grid, evaluator=ev, foldCol="fold", numFolds=folds, parallelism=parallelism,
            seed=seed).fit(folded).avgMetrics
    scores = [float(s) for s in scores]
    best = scores.index(better(scores))
    return tried[best], scores


def _as_param_map(stage, kind: str, features: int, params: dict, classes: int = 2) -> dict:
    values = dict(params)
    if kind == "network" and "hidden" in values:
        values["layers"] = [features, values.pop("hidden"), classes]
    return {stage.getParam(n): v for n, v in values.items()}


def train(
    df: DataFrame, target: str, features: Sequence[str], key: str, name: str = "xgb", problem: str | None = None,
    metric: str = "auto", trials: int = 10, folds: int = 5, test_size: float = 0.2, split: str = "random",
    time_col: str | None = None, seed: int = 42, candidates: Sequence[dict] | None = None,
) -> Trained:
    """Split, search, and fit the best parameters on the training rows; the split rides along for evaluation."""
    problem = problem or problem_type(df, target)
    if split == "time":
        if time_col is None:
            raise ValueError("a time split needs time_col")
        if time_col in features:
            raise ValueError("the time column cannot be a feature")
        train_rows, test_rows = split_by_time(df, time_col, key, test_size)
    else:
        train_rows, test_rows = split_random(df, key, test_size, seed, target if problem == "classification" else None)
    best, _ = search(train_rows, target, features, key, name, problem, metric, trials, folds,
                     time_col if split == "time" else None, seed, candidates)
    out = fit(train_rows, target, features, name, problem, seed, **best)
    out.train, out.test = train_rows, test_rows
    return out


def train_several(names: Sequence[str], df: DataFrame, target: str, features: Sequence[str], key: str, **kw) -> dict[str, Trained]:
    return {n: train(df, target, features, key, n, **kw) for n in names}


# ---- importance --------------------------------------------------------------------------------------------


def importance(spark: SparkSession, trained: Trained) -> DataFrame:
    """`feature`, `importance` (signed for linear models) and its `percent` of the total, largest first."""
    last = trained.model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray().tolist()
    elif hasattr(last, "coefficients"):
        values = last.coefficients.toArray().tolist()
    else:
        raise ValueError("this model has no built-in importance; use permutation_importance")
    return importance_table(spark, dict(zip(trained.features, values, strict=True)))


def importance_table(spark: SparkSession, values: Mapping[str, float]) -> DataFrame:
    total = sum(abs(v) for v in values.values())
    rows = [(f, float(v), abs(v) / total * 100 if total else 0.0) for f, v in values.items()]
    return spark.createDataFrame(rows, "feature string, importance double, percent double").orderBy(
        F.abs("importance").desc(), "feature")


def permutation_importance(
    trained: Trained, df: DataFrame, target: str, key: str, repeats: int = 5, seed: int = 42,
    shuffle: Callable[[int], Column] | None = None,
) -> DataFrame:
    """(feature, importance, percent): mean drop in accuracy, or rise in squared error, when a feature is dealt anew.

    Every repeat pairs a row with the one at its place in another order, `shuffle(repeat)` and then the key (a hash of the
    key by default). A row is then scored once per feature with that feature taken from its partner, and once as it is;
    one aggregation by feature gives all figures, so jobs grow neither with features nor with repeats. Missing features
    count as in the model; rows without target are not judged.
    """
    spark, features = df.sparkSession, trained.features
    known = df.where(F.col(target).isNotNull()).select(key, F.col(target).alias("_y"), *features)
    rows = pinned(known.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))))
    order = F.coalesce(*[F.when(F.col("_r") == r, shuffle(r) if shuffle else row_hash([key], seed + r)) for r in range(repeats)])
    placed = with_position(rows, ["_r"], [key], "_p")
    other = with_position(rows.withColumn("_h", order), ["_r"], ["_h", key], "_p")
    other = other.select("_r", "_p", F.struct(*features).alias("_o"))
    taken = placed.join(other, ["_r", "_p"]).withColumn("_f", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))))
    dealt = taken.select("_f", "_y", *[F.when(F.col("_f") == i, F.col("_o")[c]).otherwise(F.col(c)).alias(c) for i, c in enumerate(features)])
    right = (F.col("predClass") == F.col("_y")).cast("double") if trained.problem == "classification" else -((F.col("prediction") - F.col("_y")) ** 2)
    quality = {r["_f"]: r["q"] for r in trained.score(dealt).groupBy("_f").agg(F.avg(right).alias("q")).collect()}  # one row per feature
    return importance_table(spark, {c: (quality[-1] - quality[i]) if quality else 0.0 for i, c in enumerate(features)})


# ---- ensembles ---------------------------------------------------------------------------------------------


def score_all(models: Mapping[str, Trained], df: DataFrame) -> DataFrame:
    """`df` with `{name}_score` of every model, one narrow pass each."""
    out = df
    for name, m in models.items():
        column = "predProb" if m.problem == "classification" else "prediction"
        out = m.score(out).withColumnRenamed(column, f"{name}_score").drop("predClass")
    return out


def vote(models: Mapping[str, Trained], df: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Weighted mean of the models' probabilities (`predProb`, `predClass`) or predictions."""
    weights = weights or {n: 1.0 for n in models}
    total = sum(weights[n] for n in models)
    scored = score_all(models, df)
    mean = sum((F.col(f"{n}_score") * F.lit(weights[n] / total) for n in models), F.lit(0.0))
    classify = next(iter(models.values())).problem == "classification"
    if not classify:
        return scored.withColumn("prediction", mean)
    return scored.withColumn("predProb", mean).withColumn("predClass", (F.col("predProb") > 0.5).cast("int"))


@dataclass
class Stack:
    """Base models fitted on all rows, and a linear model over their scores."""

    base: dict[str, Trained]
    meta: Trained

    def score(self, df: DataFrame) -> DataFrame:
        return self.meta.score(score_all(self.base, df))

    def weights(self, spark: SparkSession) -> DataFrame:
        return importance(spark, self.meta)


def stack(
    df: DataFrame, target: str, features: Sequence[str], key: str, names: Sequence[str], params: Mapping[str, dict] | None = None,
    folds: int = 5, seed: int = 42, problem: str = "classification", fold: str | None = None,
) -> Stack:
    """The meta-model learns from scores of models that had not seen the row: one fit per model and fold.

    Folds are hashed by key, or read from the column `fold` (0 … folds - 1).
    """
    params = params or {}
    folded = df.withColumn("fold", F.col(fold)) if fold else with_folds(df, key, folds, seed)
    unseen = None
    for i in range(folds):
        inside = {n: fit(folded.where(F.col("fold") != i), target, features, n, problem, seed, **params.get(n, {})) for n in names}
        part = score_all(inside, folded.where(F.col("fold") == i))
        unseen = part if unseen is None else unseen.unionByName(part)
    meta = fit(unseen, target, [f"{n}_score" for n in names], "lr", problem, seed)
    return Stack({n: fit(df, target, features, n, problem, seed, **params.get(n, {})) for n in names}, meta)


# Settings of the boosting ensemble.
BOOSTING = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 4, "minInstancesPerNode": 3, "subsamplingRate": 0.8}


def boosting_ensemble(df: DataFrame, target: str, features: Sequence[str], problem: str = "classification", seed: int = 42, **params) -> Trained:
    return fit(df, target, features, "xgb", problem, seed, **(BOOSTING | params))


def ensemble_importance(spark: SparkSession, kind: str, models: Sequence[str] = (), weights: Mapping[str, float] | None = None,
                        fitted: Trained | Stack | None = None) -> DataFrame:
    """Meta coefficients, tree importances or weights; a single placeholder row for plain voting."""
    if isinstance(fitted, Stack):
        return fitted.weights(spark)
    if isinstance(fitted, Trained):
        return importance(spark, fitted)
    return importance_table(spark, dict(weights) if weights else {"Ensemble_Method": 1.0})


def repeat_training(
    df: DataFrame, target: str, features: Sequence[str], key: str, name: str, runs: int = 5, seed: int = 42,
    test_size: float = 0.2, tests: Callable[[int], Column] | None = None, **params,
) -> tuple[DataFrame, DataFrame]:
    """Metric rows (`run`, `metric`, `value`) and importance rows over seeds; average them with `average_over_runs`.

    A run is tested on a seeded share of the rows, or on those for which `tests(run)` holds.
    """
    spark, problem = df.sparkSession, problem_type(df, target)
    scores, weights = None, None
    for run in range(runs):
        if tests:
            own = F.coalesce(tests(run), F.lit(False))
            a, b = df.where(~own), df.where(own)
        else:
            a, b = split_random(df, key, test_size, seed + run, target if problem == "classification" else None)
        m = fit(a, target, features, name, problem, seed + run, **params)
        part = mt.melt_metrics(m.metrics(b, target).withColumn("run", F.lit(run)), ["run"])
        scores = part if scores is None else scores.unionByName(part)
        if kind_of(name) != "network":
            w = importance(spark, m).select(F.lit(run).alias("run"), F.col("feature").alias("metric"), F.col("importance").alias("value"))
            weights = w if weights is None else weights.unionByName(w)
    return scores, weights


# ---- persistence -------------------------------------------------------------------------------------------


def save_model(model: PipelineModel, name: str, directory: str, overwrite: bool = False) -> str:
    """Save under `directory/name`; an existing model is kept and a time suffix is added unless told to overwrite."""
    spark = SparkSession.active()
    path = f"{directory.rstrip('/')}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not overwrite and target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        path = f"{path}_{time.strftime('%Y%m%d_%H%M%S')}"
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_models(models: Mapping[str, Trained], directory: str, overwrite: bool = False) -> dict[str, str]:
    return {n: save_model(m.model, n, directory, overwrite) for n, m in models.items()}


def evaluate_saved(path: str, df: DataFrame, target: str | None = None, key: str = "gameId", output: str | None = None) -> DataFrame:
    """Score new rows with a saved model: align features, predict, and set beside the actual values when given."""
    model = load_model(path)
    features = model.stages[0].getInputCols()
    classify = hasattr(model.stages[-1], "numClasses")
    keep = [key] + ([target] if target else [])
    scored = score(model, align_features(df, features, keep), classify)
    pred = F.col("predClass" if classify else "prediction")
    cols = [F.col(key), *([F.col(target).alias("actual")] if target else []), pred.alias("predicted")]
    if classify:
        cols.append(F.col("predProb"))
    elif target:
        e = pred - F.col(target)
        cols += [e.alias("error"), F.abs(e).alias("abs_error"), (e * e).alias("squared_error"),
                 F.coalesce(F.try_divide(F.abs(e), F.abs(F.col(target))) * 100, F.lit(0.0)).alias("abs_percent_error")]
    out = scored.select(*cols)
    if output:
        from fieldhouse.sources.files import write_file
        write_file(out, output)
    return out
