"""Reproducible splits and folds by keyed digests instead of a random generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ranking import shuffled_rank
from ledgerloom.session import cut_lineage


def _share(total: Column, share: float) -> Column:
    return F.ceil(F.round(total * F.lit(share), 9))


def split_flag(df: DataFrame, keys, share: float, seed: int = 42, by=()) -> DataFrame:
    """Adds ``is_test``: ceil(share * rows) rows, per class when ``by`` is given."""
    ranked = shuffled_rank(df, keys, seed, by)
    return ranked.withColumn("is_test", (F.col("rank") <= _share(F.col("group_rows"), share)).cast("int")).drop("rank", "group_rows")


def train_test(df: DataFrame, keys, share: float, seed: int = 42, by=()) -> tuple[DataFrame, DataFrame]:
    """Both parts of one flagged frame, cut once so that the ranks are worked out once."""
    flagged = cut_lineage(split_flag(df, keys, share, seed, by))
    return flagged.filter("is_test = 0").drop("is_test"), flagged.filter("is_test = 1").drop("is_test")


def stratified_folds(df: DataFrame, keys, label: str, k: int, seed: int = 42) -> DataFrame:
    """Adds ``fold`` in 0..k-1; the folds of a class differ by one row at most."""
    ranked = shuffled_rank(df, keys, seed, [label])
    return ranked.withColumn("fold", F.pmod(F.col("rank") - 1, F.lit(k)).cast("int")).drop("rank", "group_rows")


def tail_validation(df: DataFrame, keys, share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Shuffle, then take the leading share as validation."""
    return train_test(df, keys, share, seed)
