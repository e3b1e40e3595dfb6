"""Classification and clustering metrics by aggregation; comparison tables."""

from __future__ import annotations

import math

from pyspark.ml.evaluation import ClusteringEvaluator, Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F



def pair_counts(df: DataFrame, truth: str, prediction: str, by=()) -> DataFrame:
    return df.groupBy(*by, F.col(truth).cast("string").alias("truth"), F.col(prediction).cast("string").alias("prediction")).agg(
        F.count(F.lit(1)).alias("count")
    )


def confusion(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """``truth, prediction, count`` for every pair of labels seen on either side.

    The label set comes from the counted pairs, so it is as small as the class list.
    """
    counts = pair_counts(df, truth, prediction)
    labels = counts.agg(F.array_sort(F.array_union(F.collect_set("truth"), F.collect_set("prediction"))).alias("labels"))
    grid = labels.select(F.explode("labels").alias("truth"), "labels").select("truth", F.explode("labels").alias("prediction"))
    return grid.join(counts, ["truth", "prediction"], "left").fillna(0, ["count"])


def class_report(df: DataFrame, truth: str, prediction: str, by=()) -> DataFrame:
    """``label, precision, recall, f1, support`` for each value of ``by``; an empty denominator gives 0."""
    counts = pair_counts(df, truth, prediction, by)
    right = F.when(F.col("truth") == F.col("prediction"), F.col("count")).otherwise(0)
    sides = counts.select(*by, F.inline(F.array(
        F.struct(F.col("truth").alias("label"), right.alias("hits"), F.col("count").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("label"), F.lit(0).cast("long").alias("hits"), F.lit(0).cast("long").alias("support"), F.col("count").alias("predicted")),
    )))
    totals = sides.groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("hits", "support", "predicted")])
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    scored = totals.select(*by, "label", ratio(F.col("hits"), F.col("predicted")).alias("precision"), ratio(F.col("hits"), F.col("support")).alias("recall"), "support")
    both = F.col("precision") + F.col("recall")
    return scored.select(*by, "label", "precision", "recall", ratio(2 * F.col("precision") * F.col("recall"), both).alias("f1"), "support")


def report_averages(report: DataFrame) -> DataFrame:
    """``average, precision, recall, f1, support``: the macro and weighted rows."""
    weight = F.col("support")
    macro = report.agg(F.lit("macro avg").alias("average"), *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")], F.sum("support").alias("support"))
    weighted = report.agg(
        F.lit("weighted avg").alias("average"), *[(F.sum(F.col(c) * weight) / F.sum(weight)).alias(c) for c in ("precision", "recall", "f1")], F.sum("support").alias("support")
    )
    return macro.unionByName(weighted)


def metric_summary(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """One row: ``accuracy, balanced_accuracy, macro_f1, weighted_f1``."""
    report, support = class_report(df, truth, prediction), F.col("support")
    return report.agg(
        (F.sum(F.col("recall") * support) / F.sum(support)).alias("accuracy"),
        F.avg(F.when(support > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * support) / F.sum(support)).alias("weighted_f1"),
    )


def prediction_table(df: DataFrame, truth: str, prediction: str, probability: str | None = None, keep=()) -> DataFrame:
    """Truth, prediction, whether they agree and how sure the model was."""
    sure = F.array_max(vector_to_array(probability)) if probability else F.lit(None).cast("double")
    return df.select(
        *keep, F.col(truth).alias("true_label"), F.col(prediction).alias("predicted_label"),
        (F.col(truth) == F.col(prediction)).cast("int").alias("is_correct"), sure.alias("confidence"),
    )


class MacroF1(Evaluator):
    """Mean per-class F1, for use in cross validation."""

    def __init__(self, label: str = "label", prediction: str = "prediction"):
        super().__init__()
        self.names = (label, prediction)

    def _evaluate(self, df: DataFrame) -> float:
        return metric_summary(df, *self.names).first()["macro_f1"] or 0.0

    def isLargerBetter(self) -> bool:
        return True


def fold_summary(folds: DataFrame, metrics, by=()) -> DataFrame:
    """``metric, mean, std, min, max`` over fold rows (population deviation), for each value of ``by``."""
    long = folds.unpivot(list(by), list(metrics), "metric", "value")
    return long.groupBy(*by, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``label, count, weight`` with weight = rows / (classes * count)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("k")).first()
    return counts.withColumn("weight", F.lit(float(total["n"] or 0)) / (F.lit(total["k"]) * F.col("count")))


def add_class_weights(df: DataFrame, label: str, into: str = "weight") -> DataFrame:
    """Rows with their class weight."""
    weights = class_weights(df, label).select(F.col("label").alias("__label"), F.col("weight").alias(into))
    return df.join(weights, F.col(label) == F.col("__label")).drop("__label")


def crosstab_share(df: DataFrame, row: str, column: str) -> DataFrame:
    """``row, column, count, share`` within the row value, for the pairs that occur."""
    counts = df.groupBy(F.col(row).alias("row"), F.col(column).alias("column")).agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("row").agg(F.sum("count").alias("t"))
    return counts.join(totals, "row").select("row", "column", "count", (F.col("count") / F.col("t")).alias("share"))


def cluster_profile(df: DataFrame, cluster: str, label: str, top: int = 5) -> DataFrame:
    """``cluster, size, place, label, count, ratio`` of the most frequent labels per cluster.

    The rank filter sits right on the ranking, so every task passes on no more
    than ``top`` labels of a cluster, however many the cluster has.
    """
    counts = df.groupBy(F.col(cluster).alias("cluster"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    sizes = df.groupBy(F.col(cluster).alias("__cluster")).agg(F.count(F.lit(1)).alias("size"))
    place = F.row_number().over(W.partitionBy("cluster").orderBy(F.col("count").desc(), "label"))
    ranked = counts.withColumn("place", place).filter(F.col("place") <= top)
    joined = ranked.join(sizes, F.col("cluster").eqNullSafe(F.col("__cluster")))
    return joined.select("cluster", "size", "place", "label", "count", (F.col("count") / F.col("size")).alias("ratio"))


def external_scores(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """One row ``ari, nmi`` (arithmetic normalisation) from the contingency counts."""
    pairs = pair_counts(df, truth, cluster)
    def choose(c):
        return c * (c - 1) / 2.0
    both = pairs.agg(F.sum("count").alias("n"), F.sum(choose(F.col("count"))).alias("index"), F.sum(F.col("count") * F.log("count")).alias("h"))
    def side(name):
        t = pairs.groupBy(name).agg(F.sum("count").alias("c"))
        return t.agg(F.sum(choose(F.col("c"))).alias("pairs"), F.sum(F.col("c") * F.log("c")).alias("h")).first()
    a, b, j = side("truth"), side("prediction"), both.first()
    n = float(j["n"])
    expected = a["pairs"] * b["pairs"] / choose(n) if n > 1 else 0.0
    largest = (a["pairs"] + b["pairs"]) / 2
    ari = 1.0 if largest == expected else (j["index"] - expected) / (largest - expected)
    h_a, h_b = math.log(n) - a["h"] / n, math.log(n) - b["h"] / n
    mutual = h_a + h_b - (math.log(n) - j["h"] / n)
    nmi = 1.0 if h_a + h_b == 0 else 2 * mutual / (h_a + h_b)
    return df.sparkSession.createDataFrame([(float(ari), float(nmi))], "ari double, nmi double")


def squared_distance(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def internal_scores(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """One row: ``inertia, calinski_harabasz, davies_bouldin`` from cluster means.

    Only the centroids, one per cluster, reach the driver.
    """
    means = df.groupBy(F.col(cluster).alias("c")).agg(Summarizer.mean(F.col(vector)).alias("m"), F.count(F.lit(1)).alias("n"))
    centroids = means.select("c", vector_to_array("m").alias("m"), "n").collect()
    spark = df.sparkSession
    table = spark.createDataFrame([(r["c"], r["m"]) for r in centroids], means.select("c", vector_to_array("m").alias("centre")).schema)
    far = df.select(F.col(cluster).alias("c"), vector_to_array(vector).alias("v")).join(F.broadcast(table), "c")
    square = squared_distance(F.col("v"), F.col("centre"))
    spread = {r["c"]: r for r in far.withColumn("d", square).groupBy("c").agg(F.sum("d").alias("w"), F.avg(F.sqrt("d")).alias("s")).collect()}
    n, k = sum(r["n"] for r in centroids), len(centroids)
    overall = [sum(r["m"][i] * r["n"] for r in centroids) / n for i in range(len(centroids[0]["m"]))]
    between = sum(r["n"] * math.dist(r["m"], overall) ** 2 for r in centroids)
    within = sum(s["w"] for s in spread.values())
    worst = [
        # Coinciding centroids have no ratio and are passed over.
        max(((spread[p["c"]]["s"] + spread[q["c"]]["s"]) / math.dist(p["m"], q["m"]) for q in centroids if math.dist(p["m"], q["m"]) > 0), default=0.0)
        for p in centroids
    ] if k > 1 else [0.0]
    ch = (between / (k - 1)) / (within / (n - k)) if k > 1 and within else float(k > 1)
    return spark.createDataFrame([(float(within), float(ch), float(sum(worst) / len(worst)))], "inertia double, calinski_harabasz double, davies_bouldin double")


def silhouette_sq(df: DataFrame, vector: str, cluster: str) -> float:
    """Mean silhouette on squared Euclidean distance."""
    typed = df.withColumn("__cluster", F.col(cluster).cast("int"))
    return ClusteringEvaluator(featuresCol=vector, predictionCol="__cluster", metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(typed)


def compare_models(metrics: DataFrame, names) -> DataFrame:
    """``model`` and one column per metric from ``model, metric, value``."""
    return metrics.groupBy("model").agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in names])


def supervision_table(metrics: DataFrame, unsupervised) -> DataFrame:
    """Adds ``kind``, telling label-free baselines from trained models."""
    return metrics.withColumn("kind", F.when(F.col("model").isin(list(unsupervised)), "unsupervised").otherwise("supervised"))


def per_class_f1(reports: DataFrame) -> DataFrame:
    """``label, model, f1`` with 0 where a model has no such class.

    ``reports`` holds ``model, label, f1``; labels and models are small lists.
    """
    models = sorted(r["model"] for r in reports.select("model").distinct().collect())
    grid = reports.select("label").distinct().select("label", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    return grid.join(reports, ["label", "model"], "left").select("label", "model", F.coalesce("f1", F.lit(0.0)).alias("f1"))


def uplift(before: DataFrame, after: DataFrame) -> DataFrame:
    """``model, metric, before, after, points``: change in percentage points of two runs."""
    b = before.select("model", "metric", F.col("value").alias("before"))
    a = after.select("model", "metric", F.col("value").alias("after"))
    return b.join(a, ["model", "metric"]).withColumn("points", (F.col("after") - F.col("before")) * 100.0)


def feature_shrinkage(before: DataFrame, after: DataFrame) -> DataFrame:
    """``model, before, after, removed``: features that each model uses in two runs, given as ``model, feature``.

    A model without features left has 0 after; one that only the later run has is not compared.
    """
    count = lambda df, name: df.groupBy("model").agg(F.count_distinct("feature").alias(name))
    both = count(before, "before").join(count(after, "after"), "model", "left").withColumn("after", F.coalesce("after", F.lit(0).cast("long")))
    return both.withColumn("removed", F.col("before") - F.col("after"))


def search_trace(log: DataFrame, by=(), trial: str = "trial", score: str = "score") -> DataFrame:
    """Adds ``best_so_far`` and the ``baseline`` (first trial) to a search log.

    A log has one row per trial, so its windows are small.
    """
    order = W.partitionBy(*by).orderBy(trial)
    return log.withColumns({
        "best_so_far": F.max(score).over(order.rowsBetween(W.unboundedPreceding, 0)), "baseline": F.first(score).over(order),
    })


def best_trial(log: DataFrame, by=(), trial: str = "trial", score: str = "score") -> DataFrame:
    """Arg-max of the score per group, the baseline taking part, ties to the first trial."""
    return log.groupBy(*by).agg(F.max_by(F.struct(trial, score), F.struct(F.col(score), -F.col(trial))).alias("b")).select(*by, f"b.{trial}", f"b.{score}")
