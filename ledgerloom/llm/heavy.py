"""Finding the values that hold a large share of all, with a proven bound on how many there are."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import slices
from ledgerloom.session import cut_lineage


def heavy_values(texts: DataFrame, values: Callable[[pa.Array], np.ndarray], share: int) -> np.ndarray:
    """Sorted 64-bit values that make up at least one in ``share`` of all values of the column ``text``.

    A slice reports values with at least half that share of its own. What a value with the
    full share loses by that is under half its count, so it is found; and as the reported
    counts add up to no more than all values, at most ``2 * share`` pass.
    """
    def local(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = values(part.column("text"))
                value, count = np.unique(found, return_counts=True)
                often = (count * 2 * share >= len(found)) & (count > 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.append(value[often].view(np.int64), 0)), pa.array(np.append(count[often], len(found)), pa.int64()),
                    pa.array(np.append(np.zeros(often.sum(), bool), True)),
                ], names=["value", "n", "total"])

    counts = texts.select("text").mapInArrow(local, "value long, n long, total boolean").groupBy("value", "total").agg(F.sum("n").alias("n"))
    counts = cut_lineage(counts)
    everything = counts.agg(F.sum(F.when(F.col("total"), F.col("n"))).alias("n")).first()["n"] or 0
    heavy = counts.filter(~F.col("total") & (F.col("n") * 2 * share >= F.lit(everything))).select("value")
    return np.sort(np.array([r["value"] for r in heavy.collect()], np.int64).view(np.uint64))
