"""Model quality: confusion counts, class and regression metrics, AUC, ROC, comparisons between models and runs.

Scored rows carry `actual`, `pred` and `proba`. Everything starts from an aggregation that combines map-side,
so the ordered steps work on distinct scores or on class pairs, not on rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldhouse.operators.encoding import exact_median
from fieldhouse.operators.ordering import with_running, with_trailing
from fieldhouse.operators.sizing import Limits, beside, lookup

# Metrics where a lower value is better.
MINIMISED = ("mse", "rmse", "mae")


def confusion(scored: DataFrame, actual: str = "actual", pred: str = "pred") -> DataFrame:
    return scored.groupBy(F.col(actual).alias("actual"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def confusion_wide(scored: DataFrame, classes: Sequence, actual: str = "actual", pred: str = "pred") -> DataFrame:
    """`actual` by `predicted_{class}` counts; absent pairs as 0."""
    wide = scored.groupBy(F.col(actual).alias("actual")).agg(*[
        F.count_if(F.col(pred) == F.lit(c)).alias(f"predicted_{c}") for c in classes])
    return wide


def class_report(pairs: DataFrame) -> DataFrame:
    """Per class: tp, fp, fn, tn, support, recall and precision, from confusion counts.

    Classes seen on either side are reported, also those that were never predicted.
    """
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("actual").alias("class"), (F.col("actual") == F.col("pred")).alias("hit"),
                 F.lit(True).alias("as_actual"), "n"),
        F.struct(F.col("pred").alias("class"), (F.col("actual") == F.col("pred")).alias("hit"),
                 F.lit(False).alias("as_actual"), "n"))).alias("x")).select("x.*")

    def part(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    by_class = sides.groupBy("class").agg(
        part(F.col("hit") & F.col("as_actual")).alias("tp"), part(~F.col("hit") & ~F.col("as_actual")).alias("fp"),
        part(~F.col("hit") & F.col("as_actual")).alias("fn"))
    total = pairs.agg(F.sum("n").alias("total"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return beside(by_class, total).select(
        "class", "tp", "fp", "fn", (F.col("total") - tp - fp - fn).alias("tn"), (tp + fn).alias("support"),
        F.try_divide(tp.cast("double"), (tp + fn).cast("double")).alias("recall"),
        F.try_divide(tp.cast("double"), (tp + fp).cast("double")).alias("precision"))


def common_mistakes(pairs: DataFrame, k: int = 3) -> DataFrame:
    return pairs.where("actual <> pred").orderBy(F.col("n").desc(), "actual", "pred").limit(k)


def class_accuracy(scored: DataFrame, classes: DataFrame, actual: str = "actual", pred: str = "pred") -> DataFrame:
    """Accuracy of every class in `classes` (one column `class`); those absent from the rows get 0 rows and NULL."""
    seen = scored.groupBy(F.col(actual).alias("class")).agg(
        F.count("*").alias("rows"), F.count_if(F.col(actual) == F.col(pred)).alias("correct"))
    return classes.distinct().join(lookup(seen), "class", "left").select(
        "class", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("correct", F.lit(0)).alias("correct"),
        (F.col("correct") / F.col("rows")).alias("accuracy"))


def classification_metrics(pairs: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 from confusion counts: one row."""
    r = class_report(pairs)
    zero = F.lit(0.0)
    precision, recall = F.coalesce("precision", zero), F.coalesce("recall", zero)
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), zero)
    weight = F.col("support") / F.col("all")
    total = r.agg(F.sum("support").alias("all"))
    return beside(r, total).agg(
        (F.sum("tp") / F.max("all")).alias("accuracy"), F.sum(precision * weight).alias("precision"),
        F.sum(recall * weight).alias("recall"), F.sum(f1 * weight).alias("f1"))


def regression_metrics(df: DataFrame, actual: str = "actual", pred: str = "predicted", limits: Limits | None = None) -> DataFrame:
    """R², MSE, RMSE, MAE, median absolute error, and MAPE over non-zero actuals: one row, over rows with both values."""
    df = df.where(F.col(actual).isNotNull() & F.col(pred).isNotNull())
    y, e = F.col(actual), F.col(actual) - F.col(pred)
    mse = F.avg(e * e)
    sums = df.agg(
        (1 - F.sum(e * e) / (F.var_pop(y) * F.count(y))).alias("r2"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"), (F.avg(F.when(y != 0, F.abs(e / y))) * 100).alias("mape"))
    middle = exact_median(df.select(F.abs(e).alias("_ae")), "_ae", limits).withColumnRenamed("median", "median_ae")
    return beside(sums, middle).select("r2", "mse", "rmse", "mae", "median_ae", "mape")


def worst_predictions(df: DataFrame, k: int = 5, actual: str = "actual", pred: str = "predicted", key: str = "gameId") -> DataFrame:
    """The `k` rows with the largest absolute error (a top-k report)."""
    e = F.col(pred) - F.col(actual)
    return df.select(key, actual, pred, e.alias("error"), F.abs(e).alias("abs_error")).orderBy(
        F.col("abs_error").desc(), key).limit(k)


# ---- ranking quality ---------------------------------------------------------------------------------------


def score_counts(scored: DataFrame, keys: Sequence[str] = (), proba: str = "proba", actual: str = "actual") -> DataFrame:
    """Positives and negatives per distinct score."""
    return scored.where(F.col(proba).isNotNull() & F.col(actual).isNotNull()).groupBy(
        *keys, F.col(proba).alias("score")).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) != 1).alias("neg"))


def auc(scored: DataFrame, keys: Sequence[str] = (), proba: str = "proba", actual: str = "actual",
        limits: Limits | None = None) -> DataFrame:
    """Exact area under the ROC curve per key, ties counted half; NULL when a class is missing."""
    counts = score_counts(scored, keys, proba, actual)
    placed = with_running(counts, list(keys), ["score"], totals={"neg_upto": F.col("neg")}, limits=limits)
    below = F.col("neg_upto") - F.col("neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    return placed.groupBy(*keys).agg(F.try_divide(
        wins.cast("double"), (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"))


def roc_points(scored: DataFrame, keys: Sequence[str] = (), proba: str = "proba", actual: str = "actual",
               limits: Limits | None = None) -> DataFrame:
    """Counts and rates of positives and negatives at or above each distinct score."""
    counts = score_counts(scored, keys, proba, actual)
    totals = counts.groupBy(*keys).agg(F.sum("pos").alias("p_all"), F.sum("neg").alias("n_all"))
    placed = with_running(counts, list(keys), [F.col("score").desc()],
                          totals={"tp": F.col("pos"), "fp": F.col("neg")}, limits=limits)
    joined = placed.join(lookup(totals), list(keys)) if keys else beside(placed, totals)
    return joined.select(
        *keys, "score", "tp", "fp", "p_all", "n_all", (F.col("fp") / F.col("n_all")).alias("fpr"),
        (F.col("tp") / F.col("p_all")).alias("tpr"))


def roc_on_grid(points: DataFrame, keys: Sequence[str] = (), steps: int = 100, limits: Limits | None = None) -> DataFrame:
    """TPR at `steps` evenly spaced FPR values from 0 to 1 by linear interpolation.

    A segment between two neighbouring points writes out the grid values it covers itself, so the curve is never
    joined with the grid. The curve starts at (0, 0) and is forced through the corners.
    """
    last = steps - 1
    order = [F.col("score").desc()]
    seg = with_trailing(points, list(keys), order, 1, lambda w: [
        F.coalesce(F.lag("fp").over(w), F.lit(0)).alias("fp0"),
        F.coalesce(F.lag("tp").over(w), F.lit(0)).alias("tp0")], limits)
    # grid value k/last lies on the segment when fp0/n < k/last <= fp/n; whole-number division keeps that exact
    first, stop = F.expr(f"fp0 * {last} div n_all + 1"), F.expr(f"fp * {last} div n_all")
    inside = seg.where((F.col("fp") > F.col("fp0")) & (first <= stop)).withColumn("k", F.explode(F.sequence(first, stop)))
    share = (F.col("k") * F.col("n_all") / F.lit(float(last)) - F.col("fp0")) / (F.col("fp") - F.col("fp0"))
    linear = inside.select(*keys, "k", ((F.col("tp0") + share * (F.col("tp") - F.col("tp0"))) / F.col("p_all")).alias("tpr"))
    # where points stand above each other the highest one counts
    on_point = points.where(F.col("fp") * last % F.col("n_all") == 0).select(
        *keys, (F.col("fp") * last / F.col("n_all")).cast("long").alias("k"), "tpr")
    best = linear.unionByName(on_point).groupBy(*keys, "k").agg(F.max("tpr").alias("tpr"))
    ends = points.select(*keys).distinct() if keys else points.limit(1).select(F.lit(0).alias("_o"))
    corners = ends.select(*keys, F.explode(F.array(
        F.struct(F.lit(0).cast("long").alias("k"), F.lit(0.0).alias("tpr")),
        F.struct(F.lit(last).cast("long").alias("k"), F.lit(1.0).alias("tpr")))).alias("c")).select(*keys, "c.*")
    return best.where(~F.col("k").isin(0, last)).unionByName(corners).select(
        *keys, (F.col("k") / F.lit(float(last))).alias("fpr"), "tpr")


def performance_weights(metrics: DataFrame, higher_is_better: bool = True, floor: float = 0.01) -> DataFrame:
    """Ensemble weights that sum to the number of models, from (`model`, `value`) rows.

    Scores below zero are lifted so that the worst becomes `floor`; losses count by their inverse, and a loss that
    is not positive counts as 1.
    """
    facts = metrics.agg(F.min("value").alias("low"))
    raw = beside(metrics, facts)
    v = F.col("value")
    if higher_is_better:
        raw = raw.withColumn("raw", F.when(F.col("low") < 0, v - F.col("low") + floor).otherwise(v))
    else:
        raw = raw.withColumn("raw", F.when(v > 0, 1.0 / v).otherwise(F.lit(1.0)))
    total = raw.agg(F.sum("raw").alias("total"), F.count("*").alias("models"))
    weight = F.when(F.col("total") > 0, F.col("raw") * F.col("models") / F.col("total")).otherwise(1.0)
    return beside(raw, total).select("model", "value", weight.alias("weight"))


def position_weights(models: Sequence[str]) -> dict[str, float]:
    """The first model weighs as many as there are models, the last one 1."""
    return {m: float(len(models) - i) for i, m in enumerate(models)}


def mean_roc(curves: DataFrame, run: str = "run") -> DataFrame:
    """Mean and population deviation of TPR over runs, per FPR grid value."""
    return curves.groupBy("fpr").agg(F.avg("tpr").alias("mean_tpr"), F.stddev_pop("tpr").alias("std_tpr"),
                                     F.count_distinct(run).alias("runs"))


# ---- comparisons -------------------------------------------------------------------------------------------


def melt_metrics(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Wide metric columns to (`metric`, `value`) rows."""
    values = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), values, "metric", "value")


def average_over_runs(metrics: DataFrame, keys: Sequence[str] = ("metric",)) -> DataFrame:
    """Mean and population deviation of each metric over repeated runs."""
    return metrics.groupBy(*keys).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("runs"))


def comparison_table(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """`model` rows by metric columns."""
    return metrics.groupBy("model").pivot("metric", list(names)).agg(F.first("value"))


def best_models(metrics: DataFrame) -> DataFrame:
    """Best model per metric: lowest for error metrics, highest otherwise; the first name wins a tie."""
    goodness = F.when(F.col("metric").isin(*MINIMISED), -F.col("value")).otherwise(F.col("value"))
    ranked = metrics.where(F.col("value").isNotNull()).withColumn("_g", goodness)
    w = Window.partitionBy("metric").orderBy(F.col("_g").desc(), "model")
    return ranked.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("metric", "model", "value")


def class_means(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Mean of each feature within each class, one row per (class, feature), with the overall mean."""
    sums = [F.sum(c).alias(f"{c}__s") for c in features] + [F.count(c).alias(f"{c}__n") for c in features]
    per_class = df.groupBy(F.col(target).alias("class")).agg(*sums)
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__s").cast("double").alias("s"), F.col(f"{c}__n").alias("n"))
        for c in features])
    long = per_class.select("class", F.inline(rows))
    overall = long.groupBy("feature").agg((F.sum("s") / F.sum("n")).alias("overall"))
    return long.join(F.broadcast(overall), "feature").select(  # one row per feature
        "class", "feature", (F.col("s") / F.col("n")).alias("mean"), "overall")


def standout_features(means: DataFrame) -> DataFrame:
    """Per class, the feature whose mean (to 3 decimals) is furthest from the overall mean in percent."""
    mean = F.round("mean", 3)
    gap = F.abs(mean - F.col("overall"))
    pct = F.when(F.col("overall") != 0, gap / F.abs("overall") * 100).otherwise(gap * 100)
    w = Window.partitionBy("class").orderBy(F.col("pct").desc_nulls_last(), "feature")
    return means.select("class", "feature", mean.alias("mean"), "overall", pct.alias("pct"), F.when(
        mean > F.col("overall"), "above").otherwise("below").alias("direction")).withColumn(
        "_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def side_by_side(frames: dict[str, DataFrame], key: str, columns: Sequence[str]) -> DataFrame:
    """Predictions of several models for the same rows, `{model}_{column}`, joined on the key."""
    parts = [df.select(key, *[F.col(c).alias(f"{m}_{c}") for c in columns]) for m, df in frames.items()]
    return reduce(lambda a, b: a.join(b, key), parts)


def run_summary(log: DataFrame) -> DataFrame:
    """Per step of a run log: attempts, successes, rows and the last status."""
    return log.groupBy("step").agg(
        F.count("*").alias("attempts"), F.count_if("success").alias("succeeded"), F.sum("rows").alias("rows"),
        F.max_by("success", "finished").alias("last_success"))
