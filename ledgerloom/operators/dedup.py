"""Duplicate removal and listing by aggregation.

"First" always means the least row order. ``min_by`` combines map-side, so a key
with a third of all rows reaches its reducer as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import null_safe_on


def keep_first(df: DataFrame, keys, order: str) -> DataFrame:
    """First row of each key; NULL keys equal each other. Keys that do not exist are ignored."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df
    rest = [c for c in df.columns if c not in present]
    whole = F.struct(*[F.col(f"`{c}`") for c in rest])
    first = df.groupBy(*[F.col(f"`{k}`") for k in present]).agg(F.min_by(whole, F.col(order)).alias("__row"))
    return first.select(*[F.col(f"`{c}`") if c in present else F.col(f"__row.`{c}`").alias(c) for c in df.columns])


def drop_full_duplicates(df: DataFrame, order: str) -> DataFrame:
    """First of the rows equal in everything but their order."""
    business = [c for c in df.columns if c != order]
    return df.groupBy(*[F.col(f"`{c}`") for c in business]).agg(F.min(order).alias(order)).select(*df.columns)


def list_duplicates(df: DataFrame, keys) -> DataFrame:
    """Every copy of each repeated key, with ``copies``."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    repeated = repeated.select(*[F.col(k).alias(f"__{k}") for k in keys], "copies")
    on = null_safe_on(df, repeated, [(k, f"__{k}") for k in keys])
    return df.join(repeated, on).drop(*[f"__{k}" for k in keys])


def duplicate_summary(df: DataFrame, keys) -> DataFrame:
    """``rows, duplicates, percent``: copies beyond the first of each key."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    total, extra = F.sum("c"), F.sum(F.col("c") - 1)
    return groups.agg(total.alias("rows"), extra.alias("duplicates"), (extra * 100.0 / total).alias("percent"))
