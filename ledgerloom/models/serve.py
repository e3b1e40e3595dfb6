"""Top-k candidates from class probabilities, ranked inside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_candidates(
    df: DataFrame, keys, probabilities: Column, labels, k: int = 10, min_probability: float = 0.0,
    catch_all: str | None = None, exclude_catch_all: bool = False,
) -> DataFrame:
    """``keys, rank, candidate, probability, catch_all_probability``.

    Highest probability first, ties to the label; candidates below the minimum
    and, on request, the catch-all class are left out. The catch-all probability
    is always told. Classes are ranked in the row's own array, so nothing is
    shuffled.
    """
    names = F.array(*[F.lit(x) for x in labels]) if not isinstance(labels, Column) else labels
    scored = F.transform(
        F.arrays_zip(names.alias("label"), probabilities.alias("p")), lambda x: F.struct((-x["p"]).alias("neg"), x["label"].alias("label"))
    )
    wanted = F.filter(scored, lambda x: -x["neg"] >= F.lit(min_probability))
    if catch_all is not None and exclude_catch_all:
        wanted = F.filter(wanted, lambda x: x["label"] != F.lit(catch_all))
    other = F.lit(0.0)
    if catch_all is not None:
        other = F.coalesce(-F.try_element_at(F.filter(scored, lambda x: x["label"] == F.lit(catch_all)), F.lit(1))["neg"], F.lit(0.0))
    ranked = df.select(*keys, other.alias("catch_all_probability"), F.posexplode(F.slice(F.array_sort(wanted), 1, k)).alias("place", "c"))
    return ranked.select(
        *keys, (F.col("place") + 1).alias("rank"), F.col("c.label").alias("candidate"), (-F.col("c.neg")).alias("probability"), "catch_all_probability"
    )
