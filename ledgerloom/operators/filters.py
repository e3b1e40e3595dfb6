"""Row filters and data-dependent column filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.order_stats import value_counts_long


def drop_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def keep_allowed(df: DataFrame, column: str, allowed) -> DataFrame:
    """Allow-list given as values or as a one-column frame (semi join)."""
    if isinstance(allowed, DataFrame):
        return df.join(allowed.toDF(column).distinct(), column, "left_semi")
    return df.filter(F.col(column).isin(list(allowed)))


def frequent_values(df: DataFrame, column: str, at_least: int) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("c"))
    return counts.filter(F.col("c") >= at_least).select(column)


def drop_rare(df: DataFrame, column: str, at_least: int) -> DataFrame:
    """Keep rows whose value occurs at least so often; NULL goes."""
    return df.join(frequent_values(df, column, at_least), column, "left_semi")


def drop_rare_learned(train: DataFrame, others, column: str, at_least: int) -> list[DataFrame]:
    """Rare values counted on ``train`` and removed everywhere."""
    keep = frequent_values(train, column, at_least)
    return [df.join(keep, column, "left_semi") for df in (train, *others)]


def column_facts(df: DataFrame, columns, at_most: int = 64) -> DataFrame:
    """``column, rows, nulls, distinct_values, top_count, counted_to``; NULL counts as a value.

    A first pass takes null counts and a distinct-value sketch of every column.
    Only columns that may have ``at_most`` values (``counted_to``) are then counted
    value by value; for the others ``distinct_values`` and ``top_count`` stay NULL. So no column of
    many values is ever shuffled, and values of the rest combine map-side.
    """
    columns = list(columns)
    rough = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"n_{c}") for c in columns],
        *[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d_{c}") for c in columns],
    ).first()
    # The sketch is off by 5 % as a rule; five times that is allowed for.
    narrow = [c for c in columns if rough[f"d_{c}"] <= 1.25 * at_most + 8]
    wide = [(c, rough["__rows"], rough["__rows"] - rough[f"n_{c}"], None, None) for c in columns if c not in narrow]
    facts = df.sparkSession.createDataFrame(
        wide, "column string, rows long, nulls long, distinct_values long, top_count long"
    )
    reach = F.lit(at_most).cast("long").alias("counted_to")
    if not narrow:
        return facts.select("*", reach)
    counted = value_counts_long(df, narrow, with_null=True).groupBy("column").agg(
        F.sum("count").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0)).alias("nulls"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.max("count").alias("top_count"),
    )
    return counted.unionByName(facts).select("*", reach)


def sparse_columns(facts: DataFrame, above: float, exempt=()) -> DataFrame:
    ratio = F.col("nulls") / F.col("rows")
    return facts.filter((ratio > above) & ~F.col("column").isin(list(exempt))).select("column", ratio.alias("null_ratio"))


def constant_columns(facts: DataFrame, exempt=()) -> DataFrame:
    return facts.filter((F.col("distinct_values") <= 1) & ~F.col("column").isin(list(exempt))).select("column", "distinct_values")


def dominant_columns(facts: DataFrame, share: float, at_most: int, exempt=()) -> DataFrame:
    """Columns of up to ``at_most`` values of which one has at least ``share`` of the rows.

    Fails where the facts were not counted that far.
    """
    short = F.raise_error(F.lit(f"take column_facts with at_most={at_most}")).cast("long")
    # Coalesced on both sides, so that no row is dropped for its NULL before the check.
    distinct = F.coalesce(F.col("distinct_values"), F.when(F.col("counted_to") < at_most, short), F.lit(at_most + 1).cast("long"))
    ratio = F.coalesce(F.col("top_count") / F.col("rows"), F.lit(share))
    return facts.filter(
        (distinct <= at_most) & (ratio >= share) & ~F.col("column").isin(list(exempt))
    ).select("column", ratio.alias("dominant_ratio"), "distinct_values")


def names_in(found: DataFrame) -> list[str]:
    """Column names on the driver, as many as the table has columns at most."""
    return sorted(r["column"] for r in found.select("column").collect())


def null_counts(df: DataFrame) -> dict[str, int]:
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    return row.asDict()


def assert_no_null(df: DataFrame) -> DataFrame:
    left = {c: n for c, n in null_counts(df).items() if n}
    if left:
        raise ValueError(f"missing values remain: {left}")
    return df
