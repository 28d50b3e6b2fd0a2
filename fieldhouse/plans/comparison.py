"""Models prepared, fitted, compared and saved as one job, and judged on rows that none of it has seen.

A `Preparation` learns medians, categories and target codes from training rows alone. It becomes a stage of the saved model (plain
SQL, so it runs inside the plan), and whoever loads the model scores raw rows. All scores of a job go into one long table
(model, key, actual, pred, proba), and every figure of every model comes from one aggregation of that table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldhouse.operators import metrics as mt
from fieldhouse.operators.encoding import categories, few_values, numeric_columns, text_columns, two_valued
from fieldhouse.operators.ordering import with_running
from fieldhouse.operators.sizing import Limits, lookup
from fieldhouse.operators.splits import split_by_time, split_random
from fieldhouse.plans import models as md
from fieldhouse.session import pinned


def medians(df: DataFrame, keys: Sequence[str], value: str, limits: Limits | None = None) -> DataFrame:
    """Exact median of `value` per key (`median`), from distinct values with their counts; keys without a value are left out."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    placed = with_running(counts, list(keys), [value], totals={"_upto": F.col("_n")}, limits=limits)
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    at = placed.join(lookup(totals, limits), list(keys))
    low, high = F.expr("(_all + 1) div 2"), F.expr("_all div 2 + 1")
    return at.groupBy(*keys).agg(((F.min(F.when(F.col("_upto") >= low, F.col(value)))
                                   + F.min(F.when(F.col("_upto") >= high, F.col(value)))) / 2.0).alias("median"))


# ---- preparation -------------------------------------------------------------------------------------------


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).upper() if isinstance(value, bool) else f"CAST('{value}' AS DOUBLE)" if isinstance(value, float) else str(value)


@dataclass(frozen=True)
class Preparation:
    """What training rows say about raw columns; nothing is learned again when it is applied.

    Numbers take the median where they are missing (0 without any value), columns of two values become one 0/1 column, text
    columns of up to 100 values one per value except the last; a missing or unknown value is 0 in all of these. Text
    columns with more values, and columns of other kinds, are not used.
    """

    target: str
    problem: str
    labels: list | None
    medians: dict[str, float]
    flags: dict[str, object]
    values: dict[str, list]
    unused: list[str]

    @staticmethod
    def fit(train: DataFrame, target: str, skip: Sequence[str] = (), problem: str | None = None) -> "Preparation":
        raw = train.select([F.col(c) for c in train.columns if c not in (target, *skip)])
        plain = (T.NumericType, T.StringType, T.BooleanType)
        kinds = [f.name for f in raw.schema.fields if isinstance(f.dataType, plain)]
        flags = {c: hi for c, (_, hi) in two_valued(raw, kinds).items()}
        values = categories(raw, [c for c in text_columns(raw) if c not in flags])
        numbers = [c for c in numeric_columns(raw) if c not in flags]
        found: dict[str, float] = {}
        if numbers:
            pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(numbers)])
            found = {numbers[r["c"]]: r["median"] for r in medians(raw.select(F.inline(pairs)), ["c"], "v").collect()}  # one row per column
        labels = few_values(train, target, 9) if problem != "regression" else None
        if problem == "classification" and labels is None:
            raise ValueError(f"{target} has more than nine classes")
        unused = [c for c in raw.columns if c not in flags and c not in values and c not in numbers]
        return Preparation(target, "regression" if labels is None else "classification", labels,
                           {c: found.get(c, 0.0) for c in numbers}, flags, values, unused)

    @property
    def raw(self) -> list[str]:
        return [*self.medians, *self.flags, *self.values]

    def expressions(self) -> dict[str, str]:
        """SQL of every prepared column by its name, `p_` and letters, digits and underscores."""
        out: dict[str, str] = {}

        def add(name: str, sql: str) -> None:
            name = "p_" + re.sub(r"\W+", "_", name)
            while name in out:
                name += "_"
            out[name] = sql

        for c, m in self.medians.items():
            add(c, f"COALESCE(CAST({_quoted(c)} AS DOUBLE), {_literal(float(m))})")
        for c, hi in self.flags.items():
            add(f"{c}_{hi}", f"CAST(COALESCE({_quoted(c)} = {_literal(hi)}, FALSE) AS DOUBLE)")
        for c, several in self.values.items():
            for v in several[:-1]:
                add(f"{c}_{v}", f"CAST(COALESCE({_quoted(c)} = {_literal(v)}, FALSE) AS DOUBLE)")
        return out

    @property
    def features(self) -> list[str]:
        return list(self.expressions())

    def stage(self) -> SQLTransformer:
        columns = ", ".join(f"{sql} AS {_quoted(name)}" for name, sql in self.expressions().items())
        return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")

    def label(self) -> Column:
        """The target as a number: its place among the classes seen in training, null for others."""
        if self.labels is None:
            return F.col(self.target).cast("double")
        return F.coalesce(*[F.when(F.col(self.target) == F.lit(v), float(i)) for i, v in enumerate(self.labels)]) if self.labels else F.lit(None).cast("double")

    def aligned(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """`keep`, the raw columns (NULL where `df` has none) and, where `df` has the target, `actual`."""
        have = set(df.columns)
        columns = [F.col(c) for c in dict.fromkeys(keep)]
        columns += [(F.col(c) if c in have else F.lit(None)).alias(c) for c in self.raw if c not in keep]
        return df.select(*columns, *([self.label().alias("actual")] if self.target in have else []))


# ---- fitting and scoring -----------------------------------------------------------------------------------


@dataclass
class Fitted:
    """One model with its preparation; `model` scores raw rows."""

    name: str
    preparation: Preparation
    model: PipelineModel

    @property
    def classes(self) -> int:
        return len(self.preparation.labels or ())

    def scores(self, df: DataFrame, key: str) -> DataFrame:
        """(model, key, actual where known, pred, proba): proba is the chance of the last of two classes; null otherwise."""
        rows = self.preparation.aligned(df, [key])
        out = md.predicted(self.model, rows, self.preparation.problem == "classification")
        proba = F.col("probabilities")[1] if self.classes == 2 else F.lit(None).cast("double")
        known = [F.col("actual")] if "actual" in rows.columns else []
        return out.select(F.lit(self.name).alias("model"), key, *known, F.col("prediction").cast("double").alias("pred"), proba.alias("proba"))


    def labelled(self, df: DataFrame, key: str) -> DataFrame:
        """(key, label, probabilities): the predicted class as it is in the target, and the chance of every class in order."""
        out = md.predicted(self.model, self.preparation.aligned(df, [key]))
        names = F.array(*[F.lit(v) for v in self.preparation.labels])
        return out.select(key, F.element_at(names, F.col("prediction").cast("int") + 1).alias("label"), "probabilities")


def fit(train: DataFrame, preparation: Preparation, name: str, kind: str, features: Sequence[str] | None = None, seed: int = 42, **params) -> Fitted:
    """Fit one kind of model on prepared rows with a known target; `features` narrows the prepared columns to some."""
    stage = preparation.stage()
    used = list(features or preparation.features)
    rows = preparation.aligned(train, []).where("actual IS NOT NULL").withColumnRenamed("actual", md.LABEL)
    classes = max(len(preparation.labels or ()), 2)
    final = md.estimator(md.kind_of(kind), preparation.problem, len(used), classes, seed, **params)
    rows = md.with_class_labels(rows, classes) if isinstance(final, list) else rows
    fitted = md.chain(used, final).fit(stage.transform(rows))
    return Fitted(name, preparation, PipelineModel([stage, *fitted.stages]))


def judged(scored: DataFrame, problem: str, keys: Sequence[str] = ("model",), classes: int = 2) -> DataFrame:
    """All figures of all models from one long table, over rows with a known target.

    Classes: rows, accuracy, precision, recall, f1 and auc; with two classes precision, recall and f1 are those of the
    last one, with more they are weighted by support, and auc is null. Numbers: rows, r2, mse, rmse, mae, median_ae, mape.
    """
    keys, known = list(keys), scored.where("actual IS NOT NULL AND pred IS NOT NULL")
    if problem == "regression":
        y, e = F.col("actual"), F.col("actual") - F.col("pred")
        sums = known.groupBy(*keys).agg(
            F.count("*").alias("rows"), (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"), F.avg(e * e).alias("mse"),
            F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), (F.avg(F.when(y != 0, F.abs(e / y))) * 100).alias("mape"))
        middle = medians(known.select(*keys, F.abs(e).alias("_ae")), keys, "_ae").withColumnRenamed("median", "median_ae")
        return sums.join(middle, keys)
    pairs = known.groupBy(*keys, "actual", "pred").agg(F.count("*").alias("n"))
    hit = F.col("actual") == F.col("pred")
    sides = pairs.select(*keys, F.inline(F.array(
        F.struct(F.col("actual").alias("class"), F.when(hit, F.col("n")).otherwise(0).alias("tp"), F.when(~hit, F.col("n")).otherwise(0).alias("fn"), F.lit(0).alias("fp")),
        F.struct(F.col("pred").alias("class"), F.lit(0).alias("tp"), F.lit(0).alias("fn"), F.when(~hit, F.col("n")).otherwise(0).alias("fp")))))
    each = sides.groupBy(*keys, "class").agg(*[F.sum(c).cast("double").alias(c) for c in ("tp", "fn", "fp")])
    tp, fn, fp, support = F.col("tp"), F.col("fn"), F.col("fp"), F.col("tp") + F.col("fn")
    part = {"precision": F.try_divide(tp, tp + fp), "recall": F.try_divide(tp, support), "f1": F.try_divide(2 * tp, 2 * tp + fp + fn)}
    if classes == 2:
        figures = [F.coalesce(F.max(F.when(F.col("class") == 1, v)), F.lit(0.0)).alias(n) for n, v in part.items()]
    else:
        figures = [F.try_divide(F.sum(F.coalesce(v, F.lit(0.0)) * support), F.sum(support)).alias(n) for n, v in part.items()]
    found = each.groupBy(*keys).agg(F.sum(support).cast("long").alias("rows"), F.try_divide(F.sum("tp"), F.sum(support)).alias("accuracy"), *figures)
    area = mt.auc(known, keys, actual="actual")
    return found.join(area, keys, "left") if classes == 2 else found.withColumn("auc", F.lit(None).cast("double"))


@dataclass
class Comparison:
    preparation: Preparation
    models: dict[str, Fitted]
    scored: DataFrame
    metrics: DataFrame
    test: DataFrame = field(repr=False, default=None)


def compare(
    df: DataFrame, target: str, key: str, models: Mapping[str, Mapping], test: Column | None = None, test_size: float = 0.2,
    time_col: str | None = None, seed: int = 42, problem: str | None = None, skip: Sequence[str] = (),
) -> Comparison:
    """Split, prepare on the training rows, fit every model on them, and judge all on the test rows in one table.

    `models`: name -> `kind`, optionally `features` (prepared columns), and parameters. Rows without target are in neither
    part. The split is by `test` (a condition), by time, or by a hash of the key within classes.
    """
    known = df.where(F.col(target).isNotNull())
    if test is not None:
        held = F.coalesce(test, F.lit(False))
        train_rows, test_rows = known.where(~held), known.where(held)
    elif time_col:
        train_rows, test_rows = split_by_time(known, time_col, key, test_size)
    else:
        by = target if problem != "regression" and few_values(known, target, 9) is not None else None
        train_rows, test_rows = split_random(known, key, test_size, seed, by)
    train_rows = pinned(train_rows)  # every fit reads them several times
    preparation = Preparation.fit(train_rows, target, [key, *skip, *([time_col] if time_col else [])], problem)
    fitted = {}
    for name, spec in models.items():
        params = dict(spec)
        fitted[name] = fit(train_rows, preparation, name, params.pop("kind"), params.pop("features", None), params.pop("seed", seed), **params)
    scored = None
    for m in fitted.values():
        one = m.scores(test_rows, key)
        scored = one if scored is None else scored.unionByName(one)
    scored = pinned(scored)
    return Comparison(preparation, fitted, scored, judged(scored, preparation.problem, classes=max(len(preparation.labels or ()), 2)), test_rows)


# ---- saved models ------------------------------------------------------------------------------------------


def save(fitted: Fitted, directory: str, overwrite: bool = False) -> str:
    """The model with its preparation in one folder; returns its path."""
    path = md.save_model(fitted.model, fitted.name, directory, overwrite)
    p = fitted.preparation
    spark = SparkSession.active()
    kind = "string" if p.labels and isinstance(p.labels[0], str) else "boolean" if p.labels and isinstance(p.labels[0], bool) else "double"
    labels = None if p.labels is None else [v if kind != "double" else float(v) for v in p.labels]
    about = spark.createDataFrame(
        [(fitted.name, p.target, p.problem, labels, list(p.medians.items()), p.raw, p.unused)],
        f"name string, target string, problem string, labels array<{kind}>, medians array<struct<c:string,m:double>>, raw array<string>, unused array<string>")
    about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    return path


@dataclass(frozen=True)
class _Loaded(Preparation):
    """A preparation whose work is done by the loaded model's first stage."""

    columns: tuple = ()

    @property
    def raw(self) -> list[str]:
        return list(self.columns)


def load(path: str) -> Fitted:
    row = SparkSession.active().read.parquet(f"{path}/about").first()
    labels = None if row["labels"] is None else list(row["labels"])
    prep = _Loaded(row["target"], row["problem"], labels, {x["c"]: x["m"] for x in row["medians"]}, {}, {}, list(row["unused"]), tuple(row["raw"]))
    return Fitted(row["name"], prep, PipelineModel.load(path))


def evaluate(path: str, df: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """A saved model on new raw rows: their scores, and its figures where the rows have the target (None otherwise).

    Columns that the model knows and the rows lack count as missing; others are not read.
    """
    fitted = load(path)
    scored = fitted.scores(df, key)
    if "actual" not in scored.columns:
        return scored, None
    return scored, judged(scored, fitted.preparation.problem, classes=max(fitted.classes, 2))


# ---- ensembles judged on rows their members have not seen --------------------------------------------------


def out_of_fold(df: DataFrame, target: str, key: str, fold: str, folds: Sequence[int], models: Mapping[str, Mapping],
                problem: str | None = None, seed: int = 42, skip: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """(model, key, fold, actual, score) of every row by models fitted, preparation included, on the other folds; and the problem.

    score is the chance of the last of two classes, or the predicted number.
    """
    table, kind = None, problem
    rows = pinned(df.where(F.col(target).isNotNull()))
    for i in folds:
        train_rows, own = rows.where(F.col(fold) != i), rows.where(F.col(fold) == i)
        preparation = Preparation.fit(train_rows, target, [key, fold, *skip], kind)
        kind = preparation.problem
        if kind == "classification" and len(preparation.labels) != 2:
            raise ValueError("ensembles of classifiers need two classes")
        for name, spec in models.items():
            params = dict(spec)
            m = fit(train_rows, preparation, name, params.pop("kind"), params.pop("features", None), seed, **params)
            one = m.scores(own, key).select("model", key, F.lit(i).alias("fold"), "actual", F.coalesce("proba", "pred").alias("score"))
            table = one if table is None else table.unionByName(one)
    return pinned(table), kind


def weights_by_fold(table: DataFrame, problem: str, folds: Sequence[int]) -> DataFrame:
    """(fold, model, value, weight): for rows of a fold, weights come from the models' accuracy or RMSE on the other folds."""
    right = ((F.col("score") > 0.5) == (F.col("actual") == 1)).cast("double")
    good = F.avg(right) if problem == "classification" else F.sqrt(F.avg((F.col("score") - F.col("actual")) ** 2))
    out = None
    values = table.select("*", F.explode(F.array(*[F.lit(i) for i in folds])).alias("_for")).where("_for <> fold")
    values = pinned(values.groupBy("_for", "model").agg(good.alias("value")))  # folds times models
    for i in folds:
        one = mt.performance_weights(values.where(F.col("_for") == i).select("model", "value"), problem == "classification")
        one = one.select(F.lit(i).alias("fold"), "model", "value", "weight")
        out = one if out is None else out.unionByName(one)
    return out


def ensembles(table: DataFrame, key: str, names: Sequence[str], problem: str, folds: Sequence[int], seed: int = 42) -> DataFrame:
    """(model, key, fold, actual, score) of `vote`, `weighted` and `stack` over the members' out-of-fold scores.

    For every fold the weights and the stack's linear model come from the other folds.
    """
    weights = weights_by_fold(table, problem, folds)
    members = table.where(F.col("model").isin(list(names)))
    weighted = members.join(F.broadcast(weights.select("fold", "model", "weight")), ["fold", "model"])  # folds times models rows
    flat = weighted.groupBy("fold", key).agg(
        F.max("actual").alias("actual"), F.avg("score").alias("vote"), F.try_divide(F.sum(F.col("score") * F.col("weight")), F.sum("weight")).alias("weighted"),
        *[F.max(F.when(F.col("model") == n, F.col("score"))).alias(f"m_{n}") for n in names])
    flat = pinned(flat)
    out = flat.select(F.explode(F.array(*[F.struct(F.lit(k).alias("model"), F.col(k).alias("score")) for k in ("vote", "weighted")])).alias("x"), key, "fold", "actual")
    out = out.select("x.model", key, "fold", "actual", "x.score")
    inputs = [f"m_{n}" for n in names]
    for i in folds:
        meta = md.fit(flat.where(F.col("fold") != i), "actual", inputs, "linear", problem, seed)
        part = meta.score(flat.where(F.col("fold") == i))
        score = F.col("predProb" if problem == "classification" else "prediction")
        out = out.unionByName(part.select(F.lit("stack").alias("model"), key, "fold", "actual", score.alias("score")))
    return out


def compare_ensembles(
    df: DataFrame, target: str, key: str, fold: str, folds: Sequence[int], models: Mapping[str, Mapping],
    boosting: Mapping | None = None, problem: str | None = None, seed: int = 42, skip: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold scores of members and ensembles, and their figures with `chosen`, the best by accuracy or RMSE.

    `boosting` adds boosted trees on the features as one more candidate. Ties go to the first name.
    """
    asked = dict(models) | ({"boosting": {"kind": "xgb", **(md.BOOSTING | dict(boosting))}} if boosting is not None else {})
    table, kind = out_of_fold(df, target, key, fold, folds, asked, problem, seed, skip)
    every = table.unionByName(ensembles(table, key, list(models), kind, folds, seed))
    classify = kind == "classification"
    long = every.select("model", key, "actual", (F.col("score") > 0.5).cast("double").alias("pred") if classify else F.col("score").alias("pred"),
                        (F.col("score") if classify else F.lit(None).cast("double")).alias("proba"))
    figures = pinned(judged(long, kind))
    order = [F.desc("accuracy") if classify else F.asc("rmse"), "model"]
    best = figures.orderBy(*order).select("model").first()
    return every, figures.withColumn("chosen", F.col("model") == F.lit(best["model"] if best else None))


# ---- AUC over runs -----------------------------------------------------------------------------------------


def auc_over_runs(df: DataFrame, target: str, key: str, kind: str, features: Sequence[str], tests: Mapping[int, Column], seed: int = 42, **params) -> DataFrame:
    """(run, side, auc): one fit per run on the rows outside its test condition; AUC of both sides of all runs from one grouping."""
    held_of = [F.coalesce(test, F.lit(False)).alias(f"_held_{run}") for run, test in tests.items()]
    rows = pinned(df.where(F.col(target).isNotNull()).select(key, F.col(target).cast("int").alias(target), *features, *held_of))
    scored = None
    for run in tests:
        held = F.col(f"_held_{run}")
        m = md.fit(rows.where(~held), target, features, kind, "classification", seed + run, **params)
        one = m.score(rows).select(F.lit(run).alias("run"), F.when(held, "test").otherwise("train").alias("side"),
                                   F.col(target).alias("actual"), F.col("predProb").alias("proba"))
        scored = one if scored is None else scored.unionByName(one)
    return mt.auc(scored, ["run", "side"])
