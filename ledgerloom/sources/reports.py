"""Reports as long tables, metric artefacts with schema fallback, model folders."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = "section string, column string, metric string, value string"

# Names a test block goes by, and the compared metrics.
TEST_BLOCKS = ["test", "test_metrics", "holdout"]
METRICS = ["accuracy", "balanced_accuracy", "macro_f1", "weighted_f1"]


class StepReport:
    """Collects (section, column, metric, value) facts of a run, one small row each."""

    def __init__(self):
        self.rows: list[tuple[str, str | None, str, str | None]] = []

    def add(self, section: str, metric: str, value, column: str | None = None) -> None:
        text = value if value is None or isinstance(value, str) else json.dumps(value, sort_keys=True, default=str)
        self.rows.append((section, column, metric, text))

    def value(self, section: str, metric: str, column: str | None = None):
        for s, c, m, v in self.rows:
            if (s, c, m) == (section, column, metric):
                return v
        return None

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, REPORT_SCHEMA)


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)


def _fields(schema, *path):
    for name in path:
        if not isinstance(schema, T.StructType) or name not in schema.names:
            return None
        schema = schema[name].dataType
    return schema


def _metric(schema: T.StructType, path: list[str]) -> Column | None:
    """Number at the path; a nested struct stands for its ``mean``."""
    kind = _fields(schema, *path)
    if kind is None:
        return None
    if isinstance(kind, T.StructType):
        return F.col(".".join([*path, "mean"])).cast("double") if "mean" in kind.names else None
    return F.col(".".join(path)).cast("double")


def read_metrics(spark: SparkSession, paths: dict[str, str], cv_paths: dict[str, str] | None = None) -> DataFrame:
    """``model, scope, metric, value`` from metric artefacts of several layouts.

    The test block is the first present of the known names, else the root. The
    cross-validation block is ``cv_summary``, else ``summary`` of the sibling
    file. A weighted F1 absent from the test block falls back to its CV mean;
    any other absent test metric counts as 0.
    """
    frames = []
    for model, path in paths.items():
        doc = spark.read.option("multiLine", True).json(path)
        block = next(([b] for b in TEST_BLOCKS if isinstance(_fields(doc.schema, b), T.StructType)), [])
        cv_doc, cv_root = doc, ["cv_summary"]
        if _fields(doc.schema, "cv_summary") is None and cv_paths and model in cv_paths:
            cv_doc, cv_root = spark.read.option("multiLine", True).json(cv_paths[model]), ["summary"]
        cv = {m: _metric(cv_doc.schema, [*cv_root, m]) for m in METRICS}
        cv_row = cv_doc.select(*[(c if c is not None else F.lit(None).cast("double")).alias(m) for m, c in cv.items()])
        test = {m: _metric(doc.schema, [*block, m]) for m in METRICS}
        test_row = doc.select(*[(c if c is not None else F.lit(None).cast("double")).alias(m) for m, c in test.items()])
        for scope, frame in (("cv", cv_row), ("test", test_row)):
            frames.append(
                frame.unpivot([], METRICS, "metric", "value").select(F.lit(model).alias("model"), F.lit(scope).alias("scope"), "metric", "value")
            )
    long = frames[0]
    for frame in frames[1:]:
        long = long.unionByName(frame)
    cv_mean = F.max(F.when(F.col("scope") == "cv", F.col("value")))
    wide = long.groupBy("model", "metric").agg(F.max(F.when(F.col("scope") == "test", F.col("value"))).alias("t"), cv_mean.alias("c"))
    fallback = F.when(F.col("metric") == "weighted_f1", F.coalesce("t", "c", F.lit(0.0))).otherwise(F.coalesce("t", F.lit(0.0)))
    test_rows = wide.select("model", F.lit("test").alias("scope"), "metric", fallback.alias("value"))
    cv_rows = wide.filter(F.col("c").isNotNull()).select("model", F.lit("cv").alias("scope"), "metric", F.col("c").alias("value"))
    return test_rows.unionByName(cv_rows)


def _cv_parts(schema: T.StructType, root: str, metric: str) -> tuple[Column, Column] | None:
    """Mean and deviation of a metric: a block of both, two fields with suffixes, or a bare mean."""
    nothing = F.lit(None).cast("double")
    block = _fields(schema, root, metric)
    if isinstance(block, T.StructType):
        mean, std = ([root, metric, part] if part in block.names else None for part in ("mean", "std"))
    else:
        mean, std = ([root, f"{metric}_{part}"] if _fields(schema, root, f"{metric}_{part}") is not None else None for part in ("mean", "std"))
    number = lambda path: nothing if path is None else F.col(".".join(path)).cast("double")
    bare = nothing if block is None or isinstance(block, T.StructType) else F.col(f"{root}.{metric}").cast("double")
    return None if mean is None and block is None else (F.coalesce(number(mean), bare), number(std))


def read_cv(spark: SparkSession, paths: dict[str, str], cv_paths: dict[str, str] | None = None) -> DataFrame:
    """``model, metric, mean, std`` of the cross-validation block of metric artefacts.

    The block is ``cv_summary`` if it is one, else ``summary`` of the sibling file. A metric is a block of
    ``mean`` and ``std``, fields ``<metric>_mean`` and ``<metric>_std``, or a bare mean; an absent deviation
    counts as 0, a metric without a mean has no row.
    """
    empty = spark.createDataFrame([], "model string, metric string, mean double, std double")
    for model, path in paths.items():
        doc, root = spark.read.option("multiLine", True).json(path), "cv_summary"
        if not isinstance(_fields(doc.schema, root), T.StructType):
            if not cv_paths or model not in cv_paths:
                continue
            doc, root = spark.read.option("multiLine", True).json(cv_paths[model]), "summary"
        for metric in METRICS:
            parts = _cv_parts(doc.schema, root, metric)
            if parts is not None:
                empty = empty.unionByName(doc.select(F.lit(model).alias("model"), F.lit(metric).alias("metric"), parts[0].alias("mean"), F.coalesce(parts[1], F.lit(0.0)).alias("std")))
    return empty.filter("mean IS NOT NULL")


def save_model(model, path: str, metadata: dict | None = None) -> None:
    """Model folder plus its metadata as one JSON row next to it."""
    model.write().overwrite().save(path)
    if metadata is not None:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(metadata, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(path.rstrip("/") + "_metadata")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
