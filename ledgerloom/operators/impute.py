"""Filling missing cells: rules, defaults, grouped medians, medians of dates, modes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.dates import from_epoch_micros
from ledgerloom.operators.order_stats import exact_medians, medians_of, modes_of
from ledgerloom.session import cut_lineage, null_safe_on


def fill_where(df: DataFrame, column: str, mask: Column, value) -> DataFrame:
    """Fill NULL cells of the masked rows."""
    return df.withColumn(column, F.when(mask & F.col(column).isNull(), F.lit(value)).otherwise(F.col(column)))


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """``{column: value}`` for columns that exist."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items() if c in df.columns})


def fill_matching(df: DataFrame, token: str, value: str) -> DataFrame:
    """Fill every text column whose name holds the token."""
    return fill_constant(df, {f.name: value for f in df.schema.fields if token in f.name and isinstance(f.dataType, T.StringType)})


def group_median_fill(df: DataFrame, column: str, groups, min_size: int, mask: Column | None = None) -> DataFrame:
    """Fill NULL cells with the exact median of their group.

    Groups need ``min_size`` non-NULL values; NULL group keys form a group of
    their own. Group columns that do not exist are ignored.
    """
    keys = [g for g in groups if g in df.columns]
    if column not in df.columns or not keys:
        return df
    return _fill_from(df, _group_medians(df, column, keys, min_size), column, keys, mask)


def _group_medians(df: DataFrame, column: str, keys, min_size: int) -> DataFrame:
    """``__<key>`` per key and ``__median``, for groups of ``min_size`` values at least."""
    stats = exact_medians(df, [column], keys).filter(F.col("n") >= min_size)
    return stats.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("median").alias("__median"))


def _fill_from(df: DataFrame, stats: DataFrame, column: str, keys, mask: Column | None) -> DataFrame:
    joined = df.join(stats, null_safe_on(df, stats, [(k, f"__{k}") for k in keys]), "left")
    target = F.col(column).isNull() & (F.coalesce(mask, F.lit(False)) if mask is not None else F.lit(True))
    filled = F.when(target, F.col("__median").cast(df.schema[column].dataType)).otherwise(F.col(column))
    return joined.withColumn(column, filled).drop("__median", *[f"__{k}" for k in keys])


def hierarchical_median_fill(df: DataFrame, columns, levels, min_size: int, mask: Column | None = None) -> DataFrame:
    """Apply the group levels in order; each level sees what the one before filled.

    Only the keys and the columns to fill are written, and one row per group and
    level; the whole frame joins the medians of all levels when the result is read.
    """
    df = df.withColumn("__mask", F.coalesce(mask, F.lit(False)) if mask is not None else F.lit(True))
    columns = [c for c in columns if c in df.columns]
    levels = [[g for g in level if g in df.columns] for level in levels]
    keys = [g for level in levels for g in level]
    narrow = cut_lineage(df.select(*dict.fromkeys([*keys, *columns, "__mask"])))
    for level in filter(None, levels):
        for column in columns:
            stats = cut_lineage(_group_medians(narrow, column, level, min_size))
            narrow = _fill_from(narrow, stats, column, level, F.col("__mask"))
            df = _fill_from(df, stats, column, level, F.col("__mask"))
    return df.drop("__mask")


def _from_micros(value: float | None, kind: T.DataType) -> Column:
    return F.lit(None).cast(kind) if value is None else from_epoch_micros(F.lit(int(value))).cast(kind)


def fill_dates(df: DataFrame, column: str, other: str | None = None, offset_days: int = 365, constant: str = "2000-01-01") -> DataFrame:
    """Fill with the column's own median, else another date's median less an offset, else a constant."""
    kind = df.schema[column].dataType
    wanted = [column] + ([other] if other and other in df.columns else [])
    found = medians_of(df, wanted)
    value = found[column]
    if value is None and other in found and found[other] is not None:
        value = found[other] - offset_days * 86_400_000_000
    filler = F.lit(constant).cast(kind) if value is None else _from_micros(value, kind)
    return df.withColumn(column, F.coalesce(F.col(column), filler))


def fill_fallback(df: DataFrame, text_default, date_constant: str = "2000-01-01", columns=None) -> DataFrame:
    """Fill whatever is left by type: numbers 0, dates their median, text its mode or a default.

    ``text_default`` maps a column name to its default. Only columns that still
    hold NULL enter the mode and median jobs.
    """
    columns = columns or df.columns
    present = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns]).first().asDict()
    open_columns = [c for c, n in present.items() if n]
    kinds = {c: df.schema[c].dataType for c in open_columns}
    numbers = [c for c in open_columns if isinstance(kinds[c], T.NumericType)]
    dates = [c for c in open_columns if isinstance(kinds[c], (T.DateType, T.TimestampType, T.TimestampNTZType))]
    texts = [c for c in open_columns if isinstance(kinds[c], T.StringType)]
    medians, common = medians_of(df, dates), modes_of(df, texts)
    fills = {c: F.lit(0).cast(kinds[c]) for c in numbers}
    fills |= {c: F.lit(date_constant).cast(kinds[c]) if medians[c] is None else _from_micros(medians[c], kinds[c]) for c in dates}
    fills |= {c: F.lit(common.get(c) if common.get(c) is not None else text_default(c)) for c in texts}
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), filler) for c, filler in fills.items()})


def infer_areas(
    df: DataFrame, object_area: str, land_area: str, masks: dict[str, Column], levels, min_size: int
) -> DataFrame:
    """Zero by asset kind, grouped medians for mixed assets, then zero; flags tell what was missing."""
    df = df.withColumns({k: v for k, v in masks.items()} | {
        f"{object_area}_was_missing": F.col(object_area).isNull().cast("int"),
        f"{land_area}_was_missing": F.col(land_area).isNull().cast("int"),
        "raw_has_object_area": F.col(object_area).isNotNull().cast("int"),
        "raw_has_land_area": F.col(land_area).isNotNull().cast("int"),
    })
    df = fill_where(df, object_area, F.col("land_only"), 0.0)
    df = fill_where(df, land_area, F.col("object_only"), 0.0)
    df = hierarchical_median_fill(df, [object_area, land_area], levels, min_size, F.col("mixed"))
    return df.fillna(0.0, [object_area, land_area])
