"""Column profiles: missing cells, cardinality, frequencies, histograms, boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.order_stats import exact_quantiles, to_long, value_counts_long


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """``column, non_nulls, nulls, null_percent`` in one pass over the table."""
    columns = columns or df.columns
    total = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in columns])
    long = total.unpivot(["__rows"], [F.col(f"`{c}`") for c in columns], "column", "non_nulls")
    nulls = F.col("__rows") - F.col("non_nulls")
    return long.select("column", "non_nulls", nulls.alias("nulls"), (nulls * 100.0 / F.col("__rows")).alias("null_percent"))


def cardinality_profile(df: DataFrame, columns) -> DataFrame:
    """``column, distinct_values, distinct_percent`` (NULL not a value, percent of all rows)."""
    counted = value_counts_long(df, columns, with_null=True).groupBy("column").agg(
        F.count("value").alias("distinct_values"), F.sum("count").alias("rows")
    )
    return counted.select("column", "distinct_values", (F.col("distinct_values") * 100.0 / F.col("rows")).alias("distinct_percent"))


def value_frequency(df: DataFrame, column: str, with_null: bool = False) -> DataFrame:
    """``value, count, share`` of one column, shares over the counted rows."""
    counted = value_counts_long(df, [column], with_null)
    total = counted.agg(F.sum("count").alias("t")).first()["t"] or 1
    return counted.select("value", "count", (F.col("count") / F.lit(float(total))).alias("share"))


def top_n(df: DataFrame, by: str, n: int, ties) -> DataFrame:
    """Ordered top-n list; ``ties`` settles equal values."""
    return df.orderBy(F.col(by).desc(), *ties).limit(n)


def match_rate(df: DataFrame, column: str) -> DataFrame:
    """Share of rows whose enrichment column holds something."""
    hit = F.coalesce(F.trim(F.col(column).cast("string")) != "", F.lit(False))
    matched, total = F.count_if(hit), F.count(F.lit(1))
    return df.agg(total.alias("rows"), matched.alias("matched"), (matched * 100.0 / total).alias("match_percent"))


def type_categories(df: DataFrame) -> dict[str, int]:
    """Column counts per kind, from the schema."""
    found = {"Numeric": 0, "Date/Time": 0, "Text/Object": 0}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.NumericType):
            found["Numeric"] += 1
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            found["Date/Time"] += 1
        else:
            found["Text/Object"] += 1
    return found


def histogram(df: DataFrame, columns, bins: int = 50) -> DataFrame:
    """Equal-width bins, the last one closed: ``column, bin, low, high, count``; empty bins are kept."""
    limits = to_long(df, columns).groupBy("column").agg(F.min("value").alias("least"), F.max("value").alias("most"))
    # One row per requested column, so both joins below broadcast a bounded side.
    limits = F.broadcast(limits)
    width = (F.col("most") - F.col("least")) / F.lit(bins)
    place = F.floor((F.col("value") - F.col("least")) / width)
    filled = (
        to_long(df, columns)
        .join(limits, "column")
        .groupBy("column", F.when(width > 0, F.least(place, F.lit(bins - 1))).otherwise(0).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    edges = limits.select(
        "column", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "least", width.alias("width")
    ).select("column", "bin", (F.col("least") + F.col("bin") * F.col("width")).alias("low"), (F.col("least") + (F.col("bin") + 1) * F.col("width")).alias("high"))
    return edges.join(filled, ["column", "bin"], "left").fillna(0, ["count"])


def box_summary(df: DataFrame, columns) -> DataFrame:
    """``column, q1, median, q3, low_whisker, high_whisker``; whiskers are the last values within 1.5 IQR."""
    marks = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    wide = marks.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]]
    )
    iqr = F.col("q3") - F.col("q1")
    fenced = to_long(df, columns).join(F.broadcast(wide), "column").filter(
        F.col("value").between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr)
    )
    return fenced.groupBy("column", "q1", "median", "q3").agg(F.min("value").alias("low_whisker"), F.max("value").alias("high_whisker"))
