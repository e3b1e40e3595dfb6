"""Sinks for what a fitted model says: predictions, cluster assignments, importances, latent vectors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.tables import write_table


def _plain(df: DataFrame) -> DataFrame:
    """Columns that a delimited file can hold; nested ones as JSON, vectors left out."""
    kept = [f for f in df.schema.fields if f.dataType.simpleString() != "vector"]
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in kept])


def write_predictions(scored: DataFrame, path: str, truth: str, predicted: str = "predicted", probability: str | None = None, into: str = "predicted_label", kind: str = "csv") -> None:
    """Inputs with truth, ``into``, ``is_correct`` and, given probabilities, ``prediction_confidence``."""
    out = {into: F.col(predicted), "is_correct": F.col(truth).eqNullSafe(F.col(predicted))}
    if probability is not None:
        out["prediction_confidence"] = F.array_max(vector_to_array(probability))
    found = scored.withColumns(out)
    made = {predicted, "prediction", "rawPrediction", "probability", "features", "label"} - {into, truth}
    write_table(_plain(found.drop(*[c for c in made if c in found.columns])), path, kind)


def write_assignments(clustered: DataFrame, path: str, cluster: str = "cluster", kind: str = "csv") -> None:
    """Inputs with their ``cluster_id``."""
    write_table(_plain(clustered.withColumnRenamed(cluster, "cluster_id")), path, kind)


def write_importance(importance: DataFrame, path: str, kind: str = "csv") -> None:
    """One row for each feature, the greatest importance first; there are as many rows as columns, so one file."""
    write_table(importance.orderBy(F.col("importance").desc(), "feature").coalesce(1), path, kind)


def write_latent(table: DataFrame, path: str, vector: str = "z", split: str = "split") -> None:
    """Latent vectors as arrays, a folder for each split."""
    plain = table.withColumn(vector, vector_to_array(vector)) if table.schema[vector].dataType.simpleString() == "vector" else table
    write_table(plain, path, partition_by=(split,))
