"""Table sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.ranking import BLOCK_ROWS
from ledgerloom.sources.columns import normalize_columns


def read_table(spark: SparkSession, path: str, kind: str = "parquet", schema=None, normalize: bool = False) -> DataFrame:
    """Headed table; a missing path raises ``AnalysisException`` here, not later."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind == "csv":
        reader = reader.option("header", True)
    df = reader.format(kind).load(path)
    return normalize_columns(df) if normalize else df


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_grid(spark: SparkSession, path: str, columns, multiline: bool = False) -> DataFrame:
    """Headerless all-text grid with the file order kept.

    Adds ``source`` (file), ``block`` and ``pos`` (order within the file). A
    block is a file split, which has a bounded size and is the unit of ordered
    work. Cells with line breaks need ``multiline``; such files are not split,
    so their blocks are runs of rows.
    """
    reader = spark.read.schema(text_schema(columns)).option("header", False).option("multiLine", multiline).option("escape", '"')
    rows = F.monotonically_increasing_id()
    return reader.csv(path).select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns],
        F.col("_metadata.file_path").alias("source"),
        (F.floor(rows / BLOCK_ROWS) if multiline else F.col("_metadata.file_block_start")).cast("long").alias("block"),
        rows.alias("pos"),
    )


def write_table(df: DataFrame, path: str, kind: str = "parquet", partition_by=()) -> None:
    writer = df.write.mode("overwrite").format(kind)
    if kind == "csv":
        writer = writer.option("header", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
