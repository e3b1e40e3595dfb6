"""Training, cross validation and search on MLlib pipelines."""

from __future__ import annotations

import json
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.models.evaluate import add_class_weights, metric_summary
from ledgerloom.models.features import feature_names, matrix_stages, slot_columns
from ledgerloom.models.network import WeightedNetwork
from ledgerloom.models.target_stats import OrderedTargetEncoder
from ledgerloom.operators.knn import knn_join, knn_vote
from ledgerloom.operators.split import stratified_folds, train_test
from ledgerloom.session import cut_lineage, spread
from ledgerloom.sources.columns import prune_features

METRICS = ["accuracy", "balanced_accuracy", "macro_f1", "weighted_f1"]


@dataclass(frozen=True)
class Columns:
    """What a classifier trains on."""

    label: str
    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    min_frequency: int = 5


def label_index(df: DataFrame, label: str):
    """Alphabetical label indexer fitted on the training rows."""
    return StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="error").fit(df)


def _decoder(indexer) -> IndexToString:
    return IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)


@dataclass(frozen=True)
class Shape:
    """What a classifier may depend on: slots, classes and the sum of all weights of the rows it is fitted on."""

    inputs: int
    classes: int
    weight: float


def logistic(c: float = 1.0, l1: float = 0.0, iterations: int = 120, weight: str = "weight"):
    """``c`` is the inverse penalty over a loss summed across the weight of the rows fitted on."""
    return lambda shape: LogisticRegression(
        family="multinomial", regParam=1.0 / (c * shape.weight), elasticNetParam=l1, maxIter=iterations, weightCol=weight, standardization=False
    )


def perceptron(hidden=(64, 32), iterations: int = 100, seed: int = 42, **options):
    """A network over the weighted rows; ``options`` are those of ``WeightedNetwork``."""
    return lambda shape: WeightedNetwork(shape.inputs, shape.classes, tuple(hidden), iterations, seed=seed, **options)


@dataclass
class Fitted:
    """A fitted pipeline with the label order it predicts in."""

    model: PipelineModel
    labels: list[str]

    def score(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def least_digests(df: DataFrame, key, rows: int | None, seed: int = 42) -> DataFrame:
    """The ``rows`` rows with the least digest of their key, in one partition: a repeatable sample of bounded size (None: all)."""
    if rows is None:
        return df
    return df.orderBy(F.xxhash64(F.lit(seed), *key), *key).limit(rows)


@dataclass
class Prepared:
    """Preprocessing fitted on some rows, and those rows ready for classifiers."""

    before: list
    indexer: object
    ready: DataFrame

    def apply(self, df: DataFrame) -> DataFrame:
        return self.indexer.transform(PipelineModel(stages=self.before).transform(df))

    def train(self, classifier):
        """The classifier, or what it builds for the ``Shape`` of the rows, fitted on them."""
        labels = len(self.indexer.labels)
        if callable(classifier):
            weight = self.ready.agg(F.sum("weight")).first()[0] or 1.0
            classifier = classifier(Shape(len(feature_names(self.ready)), labels, float(weight)))
        return classifier.fit(self.ready)


def prepare(df: DataFrame, cols: Columns, scale: bool = True, ordinal: bool = False, balance: bool = True, targets: bool = False, seed: int = 42) -> Prepared:
    """Preprocessing fitted on ``df``; everything learnt, categories and medians included, comes from it alone.

    ``targets`` codes categories as ordered target statistics. The ready rows have ``features``,
    ``label``, the class weight ``weight``, a weight of one ``equal`` and the ``digest`` of the key.
    """
    key = cols.key or (cols.label, *cols.categorical, *cols.numeric)
    df = df.withColumns({"digest": F.xxhash64(F.lit(seed), *key), "equal": F.lit(1.0)})
    indexer = label_index(df, cols.label)
    weighted = add_class_weights(df, cols.label) if balance else df.withColumn("weight", F.lit(1.0))
    if targets and cols.categorical:
        coded = indexer.transform(weighted)
        encoder = OrderedTargetEncoder(inputCols=list(cols.categorical)).fit(coded)
        coded = cut_lineage(encoder.encode_training(coded))
        rest = Pipeline(stages=matrix_stages((), (*encoder.output_columns(), *cols.numeric), scale=scale)).fit(coded)
        before, ready = [encoder, *rest.stages], rest.transform(coded)
    else:
        fitted = Pipeline(stages=matrix_stages(cols.categorical, cols.numeric, cols.min_frequency, scale, ordinal)).fit(weighted)
        before, ready = list(fitted.stages), indexer.transform(fitted.transform(weighted))
    return Prepared(before, indexer, ready.select("features", "label", "weight", "equal", "digest"))


def fit(df: DataFrame, cols: Columns, classifier, cut: bool = True, rows: int | None = None, **options) -> Fitted:
    """Preprocessing and classifier fitted together on one frame.

    ``classifier`` has a ``fit``, or is a function from a ``Shape`` to one that has; ``options`` are
    those of ``prepare``. With ``rows`` the fit sees that many rows at most, those of least digest of the key.
    Fitting passes over the rows several times, so the needed columns are cut from their lineage
    first unless the caller has done so.
    """
    df = df.select(*dict.fromkeys([*cols.key, *cols.categorical, *cols.numeric, cols.label]))
    if rows is not None:
        df = least_digests(df, cols.key, rows)
    if cut:
        df = cut_lineage(spread(df) if rows is None else df)
    prepared = prepare(df, cols, **options)
    if rows is not None:
        prepared.ready = cut_lineage(prepared.ready.coalesce(1))
    trained = prepared.train(classifier)
    return Fitted(PipelineModel(stages=[*prepared.before, trained, _decoder(prepared.indexer)]), list(prepared.indexer.labels))


def folded(df: DataFrame, cols: Columns, k: int, seed: int = 42, rows: int | None = None, **options) -> list[tuple[Prepared, DataFrame]]:
    """Of each fold: preprocessing fitted once on the other folds, and the fold's own rows ready to score.

    ``rows`` bounds the rows of all folds together.
    """
    df = df.select(*dict.fromkeys([*cols.key, *cols.categorical, *cols.numeric, cols.label]))
    cut = stratified_folds(least_digests(df, cols.key, rows, seed), cols.key, cols.label, k, seed)
    cut = cut_lineage(spread(cut) if rows is None else cut.coalesce(1))

    def prepared(fold: int):
        found = prepare(cut.filter(F.col("fold") != fold), cols, seed=seed, **options)
        # Each classifier of a search reads these again.
        found.ready = cut_lineage(found.ready if rows is None else found.ready.coalesce(1))
        return found, cut_lineage(found.apply(cut.filter(F.col("fold") == fold)).select("features", "label"))

    with ThreadPoolExecutor(k) as pool:
        return list(pool.map(prepared, range(k)))


def _scores(prepared: Prepared, held: DataFrame, classifier) -> list[float]:
    row = metric_summary(prepared.train(classifier).transform(held), "label", "prediction").first()
    return [float(row[m] or 0.0) for m in METRICS]


def cross_validate(df: DataFrame, cols: Columns, classifier, k: int = 5, seed: int = 42, rows: int | None = None, parallelism: int = 5, **options) -> DataFrame:
    """``fold`` and the four metrics, preprocessing fitted anew in every fold; folds are fitted side by side."""
    folds = folded(df, cols, k, seed, rows, **options)
    with ThreadPoolExecutor(parallelism) as pool:
        scores = list(pool.map(lambda fold: _scores(*fold, classifier), folds))
    return df.sparkSession.createDataFrame([(i, *s) for i, s in enumerate(scores, start=1)], "fold int, " + ", ".join(f"{m} double" for m in METRICS))


def refit(learn: DataFrame, held_out: DataFrame, cols: Columns, classifier, share: float = 0.15, seed: int = 42, **options):
    """(fitted on everything, table of ``fit, part, metrics``).

    First fitted on the larger share and measured on validation and test rows,
    then refitted on all training rows and measured on the test rows.
    """
    learn = cut_lineage(spread(learn))
    most, validation = train_test(learn, cols.key, share, seed, by=[cols.label])
    partial, whole = fit(most, cols, classifier, **options), fit(learn, cols, classifier, cut=False, **options)
    parts = [("share", "validation", partial, validation), ("share", "test", partial, held_out), ("all", "test", whole, held_out)]
    table = None
    for name, part, fitted, rows in parts:
        scores = metric_summary(fitted.score(rows), cols.label, "predicted")
        scores = scores.select(F.lit(name).alias("fit"), F.lit(part).alias("part"), *METRICS)
        table = scores if table is None else table.unionByName(scores)
    return whole, table


def search(
    df: DataFrame, cols: Columns, build: Callable[[dict], object], configs: list[dict], k: int = 3, seed: int = 42,
    rows: int | None = None, log: str | None = None, parallelism: int = 8, **options
) -> DataFrame:
    """``trial, params, score``: mean cross-validated macro F1 of each configuration.

    The first configuration is the baseline, trial 0, and competes with the rest. Folds are cut
    and preprocessed once; all fits of (trial, fold) run ``parallelism`` at a time. With ``log``,
    each fit's metrics are written to that folder as it ends, and a rerun with the same settings
    fits only what is not there yet.
    """
    spark = df.sparkSession
    settings = [json.dumps({"params": c, "k": k, "seed": seed, "rows": rows, **options}, sort_keys=True, default=str) for c in configs]
    known = {} if log is None else {(r["trial"], r["fold"]): (r["settings"], r["macro_f1"]) for r in trial_log(spark, log).collect()}
    wanted = [(trial, fold) for trial in range(len(configs)) for fold in range(k)]
    scores = {t: known[t][1] for t in wanted if t in known and known[t][0] == settings[t[0]]}
    todo = [t for t in wanted if t not in scores]
    folds = folded(df, cols, k, seed, rows, **options) if todo else []

    def run(trial: int, fold: int) -> float:
        found = _scores(*folds[fold], build(configs[trial]))
        if log is not None:
            row = spark.createDataFrame([(settings[trial], *found)], LOGGED).coalesce(1)
            row.write.mode("overwrite").parquet(f"{log}/trial={trial}/fold={fold}")
        return found[METRICS.index("macro_f1")]

    with ThreadPoolExecutor(parallelism) as pool:
        scores |= dict(zip(todo, pool.map(lambda t: run(*t), todo)))
    table = [(trial, json.dumps(c, sort_keys=True), sum(scores[trial, f] for f in range(k)) / k) for trial, c in enumerate(configs)]
    return spark.createDataFrame(table, "trial int, params string, score double")


LOGGED = "settings string, " + ", ".join(f"{m} double" for m in METRICS)


def trial_log(spark, log: str) -> DataFrame:
    """The fits that a search has logged in a folder: ``trial, fold``, settings and metrics; empty where there is none."""
    schema = f"{LOGGED}, trial int, fold int"
    try:
        return spark.read.schema(schema).parquet(log)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def random_configs(space: dict[str, list], count: int, seed: int = 42) -> list[dict]:
    """Seeded draws from a space of choices."""
    rng = random.Random(seed)
    return [{name: rng.choice(choices) for name, choices in space.items()} for _ in range(count)]


def importance_frame(spark, fitted: Fitted, sample: DataFrame, by_column: bool = False) -> DataFrame:
    """``feature, importance, largest``, one row per slot or, ``by_column``, per input column.

    Trees: slots add up to their column, and ``largest`` is that of the greatest class model. Linear
    models: the mean and the greatest absolute weight of a slot, or of all slots of a column.
    """
    ready = fitted.model.transform(sample.limit(1))
    names, columns = feature_names(ready), slot_columns(fitted.model.stages, ready)
    trained = fitted.model.stages[-2]
    linear = hasattr(trained, "coefficientMatrix")
    if linear:
        parts = abs(trained.coefficientMatrix.toArray())
    else:
        models = trained.models if hasattr(trained, "models") else [trained]
        parts = [m.featureImportances.toArray() for m in models]
    slots = [[float(p[i]) for p in parts] for i in range(len(names))]
    if by_column:
        held = {c: [slots[i] for i, own in enumerate(columns) if own == c] for c in dict.fromkeys(columns)}
        if linear:
            rows = [(c, sum(map(sum, s)) / (len(s) * len(parts)), max(map(max, s))) for c, s in held.items()]
        else:
            rows = [(c, sum(map(sum, s)) / len(parts), max(map(sum, zip(*s)))) for c, s in held.items()]
    else:
        rows = [(n, sum(s) / len(s), max(s)) for n, s in zip(names, slots)]
    return spark.createDataFrame(rows, "feature string, importance double, largest double")


def prune(cols: Columns, importance: DataFrame, threshold: float = 0.0) -> Columns:
    """The columns whose importance, counted by input column, exceeds the threshold."""
    kept = set(prune_features([*cols.categorical, *cols.numeric], importance, threshold))
    return replace(cols, categorical=tuple(c for c in cols.categorical if c in kept), numeric=tuple(c for c in cols.numeric if c in kept))


def knn_classify(train: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``id, prediction`` by distance-weighted vote of the k nearest."""
    return knn_vote(knn_join(train, queries, k))
