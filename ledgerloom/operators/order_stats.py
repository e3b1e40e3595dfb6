"""Exact quantiles and modes that no single task has to hold.

The built-in exact percentile keeps a value-to-count map of a whole group in one
task. Here a mergeable sketch first brackets each wanted rank; a second pass
counts what lies below the bracket and lists only the values inside it. Both
passes combine map-side, so a group with a third of all rows costs no more
memory than any other and the result is still the exact order statistic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.dates import epoch_micros
from ledgerloom.session import null_safe_on

SKETCH_ACCURACY = 100_000
SMALL_GROUP = 50_000
# The sketch errs by at most 1/accuracy of the rows; the bracket is wider.
SLACK = 4


def _as_double(df: DataFrame, name: str):
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return epoch_micros(F.col(f"`{name}`")).cast("double")
    return F.col(f"`{name}`").cast("double")


def to_long(df: DataFrame, cols, by=()) -> DataFrame:
    """One row per (row, column): ``by`` columns, ``column``, ``value``; NULL and NaN left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _as_double(df, c).alias("value")) for c in cols])
    long = df.select(*[F.col(f"`{b}`") for b in by], F.inline(cells))
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def exact_quantiles(
    df: DataFrame, cols, probs, by=(), accuracy: int = SKETCH_ACCURACY, small_group: int = SMALL_GROUP
) -> DataFrame:
    """Linearly interpolated quantiles, one row per group, column and probability.

    Result: ``by`` columns, ``column``, ``prob``, ``n`` (non-NULL count), ``value``.
    Groups match NULL with NULL. A column without any value gives no row.
    """
    by, probs = list(by), [float(p) for p in probs]
    long = to_long(df, cols, by)
    slack = SLACK / accuracy
    grid = sorted({g for p in probs for g in (max(p - slack, 0.0), min(p + slack, 1.0))})
    sketch = long.groupBy(*by, "column").agg(
        F.count("value").alias("n"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.percentile_approx("value", grid, accuracy).alias("marks"),
    )

    def bracket(i, p):
        low, high = max(p - slack, 0.0), min(p + slack, 1.0)
        whole = F.col("n") <= small_group
        at_low = F.col("least") if low == 0.0 else F.when(whole, F.col("least")).otherwise(F.col("marks")[grid.index(low)])
        at_high = F.col("most") if high == 1.0 else F.when(whole, F.col("most")).otherwise(F.col("marks")[grid.index(high)])
        return F.struct(F.lit(i).alias("place"), at_low.alias("low"), at_high.alias("high"))

    brackets = sketch.select(*by, "column", "n", F.inline(F.array(*[bracket(i, p) for i, p in enumerate(probs)])))
    brackets = brackets.select(
        *[F.col(f"`{b}`").alias(f"__{b}") for b in by], F.col("column").alias("__column"), "n", "place", "low", "high"
    )
    # Without groups there is one bracket per column and probability; with groups it is a plain join.
    brackets = brackets if by else F.broadcast(brackets)
    on = null_safe_on(long, brackets, [(c, f"__{c}") for c in [*by, "column"]])
    inside = long.join(brackets, on & (long["value"] <= brackets["high"]))
    # The integer place stands in for the probability, so that the window and the
    # pick after it share one partitioning.
    key = [*by, "column", "place", "n"]
    counted = inside.groupBy(*key, F.when(F.col("value") >= F.col("low"), F.col("value")).alias("at")).agg(
        F.count(F.lit(1)).alias("c")
    )
    upto = W.partitionBy(*key).orderBy(F.col("at").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    prob = F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("place") + 1)
    spot = prob * (F.col("n") - 1)
    ranked = counted.withColumn("upto", F.sum("c").over(upto))
    picked = ranked.groupBy(*key).agg(
        F.max(F.when(F.col("at").isNull(), F.col("upto")).otherwise(0)).alias("below"),
        F.min(F.when(F.col("upto") > F.floor(spot), F.col("at"))).alias("a"),
        F.min(F.when(F.col("upto") > F.ceil(spot), F.col("at"))).alias("b"),
    )
    sound = (F.col("below") <= F.floor(spot)) & F.col("b").isNotNull()
    value = F.when(sound, F.col("a") + (F.col("b") - F.col("a")) * (spot - F.floor(spot))).otherwise(
        F.raise_error(F.lit("quantile bracket missed its rank; raise accuracy")).cast("double")
    )
    return picked.select(*by, "column", prob.alias("prob"), "n", value.alias("value"))


def exact_medians(df: DataFrame, cols, by=()) -> DataFrame:
    """``by`` columns, ``column``, ``n``, ``median``."""
    return exact_quantiles(df, cols, [0.5], by).select(*by, "column", "n", F.col("value").alias("median"))


def medians_of(df: DataFrame, cols) -> dict[str, float]:
    """Global medians on the driver: one number per column."""
    found = {c: None for c in cols}
    if cols:
        found.update({r["column"]: r["median"] for r in exact_medians(df, cols).collect()})
    return found


def quantiles_of(df: DataFrame, cols, probs) -> dict[str, dict[float, float]]:
    """Global quantiles on the driver: one number per column and probability."""
    found: dict[str, dict[float, float]] = {}
    for row in exact_quantiles(df, cols, probs).collect():
        found.setdefault(row["column"], {})[row["prob"]] = row["value"]
    return found


def value_counts_long(df: DataFrame, cols, with_null: bool = False) -> DataFrame:
    """``column``, ``value`` (text), ``count`` over several columns in one job."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    long = df.select(F.inline(cells))
    if not with_null:
        long = long.filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def modes(df: DataFrame, cols) -> DataFrame:
    """``column``, ``mode``, ``count``: most frequent non-NULL value, ties to the smallest."""
    return value_counts_long(df, cols).groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("mode"), F.max("count").alias("count")
    )


def modes_of(df: DataFrame, cols) -> dict[str, str]:
    return {r["column"]: r["mode"] for r in modes(df, cols).collect()} if cols else {}
