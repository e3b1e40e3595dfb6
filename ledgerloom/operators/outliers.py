"""Inter-quartile outlier statistics and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.order_stats import quantiles_of

REACH = 1.5
LEAST_DISTINCT = 5


def iqr_bounds(q1: float, q3: float, non_negative: bool) -> tuple[float, float]:
    low, high = q1 - REACH * (q3 - q1), q3 + REACH * (q3 - q1)
    return (max(low, 0.0) if non_negative else low), high


def _few_distinct(df: DataFrame, columns) -> set[str]:
    """Columns with fewer than the least number of distinct values.

    ``collect_set`` would grow without bound; instead rows are reduced to the
    distinct count by a sketch and only the near-empty ones are counted exactly.
    """
    rough = df.agg(*[F.approx_count_distinct(f"`{c}`").alias(c) for c in columns]).first().asDict()
    doubtful = [c for c, n in rough.items() if n < 4 * LEAST_DISTINCT]
    if not doubtful:
        return set()
    exact = df.agg(*[F.count_distinct(f"`{c}`").alias(c) for c in doubtful]).first().asDict()
    return {c for c, n in exact.items() if n < LEAST_DISTINCT}


def iqr_stats(df: DataFrame, columns, non_negative_tokens=(), exclude=()) -> dict[str, dict]:
    """Per column: q1, q3, iqr, lower, upper, outlier_count, outlier_ratio (over all rows).

    Columns with few distinct values or no spread are left out. Three numbers per
    column come to the driver.
    """
    columns = [c for c in columns if c not in set(exclude)]
    if not columns:
        return {}
    few = _few_distinct(df, columns)
    columns = [c for c in columns if c not in few]
    marks = quantiles_of(df, columns, [0.25, 0.75]) if columns else {}
    stats = {}
    for c in columns:
        if c in marks and marks[c][0.75] != marks[c][0.25]:
            q1, q3 = marks[c][0.25], marks[c][0.75]
            low, high = iqr_bounds(q1, q3, any(t in c for t in non_negative_tokens))
            stats[c] = {"q1": q1, "q3": q3, "iqr": q3 - q1, "lower": low, "upper": high}
    if stats:
        counts = df.agg(
            F.count(F.lit(1)).alias("__rows"), *[F.count_if(_outside(c, s)).alias(c) for c, s in stats.items()]
        ).first()
        for c, s in stats.items():
            s["outlier_count"] = counts[c]
            s["outlier_ratio"] = counts[c] / counts["__rows"] if counts["__rows"] else 0.0
    return stats


def _outside(column: str, s: dict):
    value = F.col(f"`{column}`")
    return (value < F.lit(s["lower"])) | (value > F.lit(s["upper"]))


def iqr_flags(df: DataFrame, stats: dict[str, dict]) -> DataFrame:
    """0/1 ``<c>_is_outlier_iqr`` for columns that have outliers; NULL is no outlier."""
    flagged = {c: s for c, s in stats.items() if s["outlier_count"] > 0}
    return df.withColumns({f"{c}_is_outlier_iqr": F.coalesce(_outside(c, s), F.lit(False)).cast("int") for c, s in flagged.items()})


def stats_frame(spark, stats: dict[str, dict]) -> DataFrame:
    """The statistics as a frame, one row per column of the table."""
    fields = ["q1", "q3", "iqr", "lower", "upper"]
    rows = [(c, *[float(s[f]) for f in fields], int(s["outlier_count"]), float(s["outlier_ratio"])) for c, s in stats.items()]
    schema = "column string, " + ", ".join(f"{f} double" for f in fields) + ", outlier_count long, outlier_ratio double"
    return spark.createDataFrame(rows, schema)


