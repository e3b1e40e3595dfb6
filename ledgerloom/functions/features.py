"""Numeric feature expressions with the missing-value rules spelled out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_if_null(c) -> Column:
    return F.coalesce(_col(c).cast("double"), F.lit(0.0))


def guarded_ratio(a, b, floor: float | None = None) -> Column:
    """a / b where b > 0, else 0; ``floor`` keeps the divisor away from 0.

    A NULL numerator over a positive divisor stays NULL.
    """
    divisor = F.greatest(_col(b), F.lit(floor)) if floor is not None else _col(b)
    return F.when(_col(b) > 0, F.try_divide(_col(a), divisor)).otherwise(F.lit(0.0))


def row_sum(cols) -> Column:
    total = F.lit(0.0)
    for c in cols:
        total = total + zero_if_null(c)
    return total


def log_amount(c) -> Column:
    """log(1 + x) with negatives and NULL as 0."""
    return F.log1p(F.greatest(zero_if_null(c), F.lit(0.0)))


def above(c, threshold) -> Column:
    """1 when the value (NULL as 0) exceeds the threshold; 0 when there is no threshold."""
    limit = F.lit(threshold).cast("double") if not isinstance(threshold, Column) else threshold
    return F.coalesce(zero_if_null(c) > limit, F.lit(False)).cast("int")


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def missing_flag(c) -> Column:
    return _col(c).isNull().cast("int")


def missing_flags(columns, existing) -> dict[str, Column]:
    """``<c>_was_missing`` for each column that exists and has no such flag yet."""
    return {
        f"{c}_was_missing": missing_flag(c)
        for c in columns
        if c in existing and f"{c}_was_missing" not in existing
    }


def presence_score(cols) -> Column:
    """How many of the columns are present."""
    score = F.lit(0)
    for c in cols:
        score = score + _col(c).isNotNull().cast("int")
    return score


def area_flags(object_area: Column, land_area: Column, suffix: str) -> dict[str, Column]:
    has_object, has_land = object_area > 0, land_area > 0
    return {
        f"has_object{suffix}": flag(has_object),
        f"has_land{suffix}": flag(has_land),
        f"is_land_only{suffix}": flag(has_land & (object_area <= 0)),
        f"is_object_only{suffix}": flag(has_object & (land_area <= 0)),
        f"is_mixed_asset{suffix}": flag(has_object & has_land),
    }
