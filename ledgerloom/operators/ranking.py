"""Global numbering, ranking and carry-forward without a one-task window.

Rows are cut into blocks of bounded size. Work inside a block is a window over
that block; only one small row per block takes part in the step across blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536


def block_of(order: str, rows: int = BLOCK_ROWS) -> Column:
    """Block number of an integer row order."""
    return F.floor(F.col(order) / F.lit(rows)).cast("long")


def number_within(df: DataFrame, block: str, place: Column, into: str, start: int = 1) -> DataFrame:
    """Consecutive numbers by (block, place); blocks are of bounded size."""
    sizes = df.groupBy(block).agg(F.count(F.lit(1)).alias("__c"))
    before = sizes.select(
        F.col(block).alias("__at"), F.sum("__c").over(W.orderBy(block).rowsBetween(W.unboundedPreceding, -1)).alias("__before")
    )
    joined = df.join(before, F.col(block) == F.col("__at"))
    position = F.row_number().over(W.partitionBy(block).orderBy(place))
    return joined.withColumn(into, (position + F.coalesce("__before", F.lit(0)) + F.lit(start - 1)).cast("long")).drop("__at", "__before")


def number_rows(df: DataFrame, order: str, into: str, start: int = 1, pieces: int | None = None) -> DataFrame:
    """Consecutive numbers in the order of a unique column without NULL.

    The order column alone is dealt by range first; one row per range, its least value
    and its count, comes to the driver. Rows then find their range by binary search,
    so gaps between keys do not matter and every window covers one range.
    """
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.select(F.col(order).alias("o")).repartitionByRange(pieces, "o").groupBy(F.spark_partition_id().alias("p"))
    found = ranges.agg(F.min("o").alias("least"), F.count(F.lit(1)).alias("c")).orderBy("least").collect()
    if not found:
        return df.withColumn(into, F.lit(None).cast("long"))
    bounds, before, total = [r["least"] for r in found], [], start - 1
    for r in found:
        before.append(total)
        total += r["c"]
    least = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    # How many ranges begin at or before the row: the steps that stay below are added up.
    met = F.aggregate(steps, F.lit(0), lambda at, s: at + F.when(F.get(least, at + s - 1) <= F.col(order), s).otherwise(0))
    place = F.row_number().over(W.partitionBy("__piece").orderBy(order))
    dealt = df.withColumn("__piece", met)
    offset = F.get(F.array(*[F.lit(b).cast("long") for b in before]), F.col("__piece") - 1)
    return dealt.withColumn(into, (place + offset).cast("long")).drop("__piece")


def carry_forward(df: DataFrame, value: str, into: str, source: str, block: str, order: str) -> DataFrame:
    """Last non-NULL ``value`` at or before each row of the same source."""
    inside = W.partitionBy(source, block).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    local = df.withColumn("__local", F.last(value, ignorenulls=True).over(inside))
    ends = df.filter(F.col(value).isNotNull()).groupBy(source, block).agg(F.max_by(value, order).alias("__end"))
    blocks = df.groupBy(source, block).agg(F.lit(1).alias("__one")).join(ends, [source, block], "left")
    across = W.partitionBy(source).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    carried = blocks.select(source, block, F.last("__end", ignorenulls=True).over(across).alias("__carried"))
    return (
        local.join(carried, [source, block], "left")
        .withColumn(into, F.coalesce("__local", "__carried"))
        .drop("__local", "__carried")
    )


def seeded_digest(keys, seed: int) -> Column:
    """Reproducible pseudo-random order of unique row keys."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def shuffled_rank(df: DataFrame, keys, seed: int, by=(), prefix: int = 4) -> DataFrame:
    """Adds ``rank`` (1-based, in digest order within the group) and ``group_rows``.

    ``keys`` must identify a row. Digests spread evenly over their leading hex
    digits, so a group of any size is ranked in ``16 ** prefix`` even pieces.
    """
    by = list(by)
    dealt = df.withColumn("__digest", seeded_digest(keys, seed)).withColumn("__piece", F.substring("__digest", 1, prefix))
    pieces = dealt.groupBy(*by, "__piece").agg(F.count(F.lit(1)).alias("c"))
    ordered = W.partitionBy(*by).orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = pieces.select(
        *[F.col(b).alias(f"__{b}") for b in by],
        F.col("__piece").alias("__at"),
        F.coalesce(F.sum("c").over(ordered), F.lit(0)).alias("__before"),
        F.sum("c").over(W.partitionBy(*by)).alias("group_rows"),
    )
    on = dealt["__piece"] == offsets["__at"]
    for b in by:
        on = on & dealt[b].eqNullSafe(offsets[f"__{b}"])
    place = F.row_number().over(W.partitionBy(*by, "__piece").orderBy("__digest", *keys))
    return (
        dealt.join(offsets, on)
        .withColumn("rank", (place + F.col("__before")).cast("long"))
        .drop("__digest", "__piece", "__at", "__before", *[f"__{b}" for b in by])
    )
