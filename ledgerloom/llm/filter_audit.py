"""Interaction audit of document filters under every order they could run in.

Each document fails a set of filters, a bit mask. Under an order it goes at the least position
of a filter that it fails: the minimum over filters of mask and position (0 or infinity, plus
the position). So masks as rows and the inverse permutations of all orders as columns, combined
by that minimum, give the step that removes each mask under each order; counts of documents by
mask are scattered over the steps with it. Only counts by part and mask reach that step, at most
128 rows a part; the documents are measured once, whatever the number of orders.

Identical texts are found by two 64-bit hashes. Rows are counted by id first, then by text, so
a text or an id that holds a third of all rows is a handful of rows in any one task.

Defined results: NULL text is empty; NULL part is the empty string; a document with several
rows in ``labels`` is good (or toxic) if one of them says so; rows repeated with one id are
copies of nothing smaller and count one by one; a NULL id is compared with none, so it never
fails as a copy, nor has labels. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_WORDS = r"[\x20\x09-\x0D]+"


def failures(text) -> dict:
    """Whether a text fails each filter that it can be judged by alone."""
    found = F.filter(F.split(text, _WORDS), lambda w: w != "")
    return {
        "A": F.size(found) < 100,
        "B": 100 * F.size(F.array_distinct(found)) < 80 * F.size(found),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def removal_steps(count: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of ``count`` filters, and the position at which each mask goes under each order (``count``: never).

    The product of a mask matrix and the matrix of inverse permutations in the algebra of
    minimum and plus.
    """
    orders = list(permutations(range(count)))
    positions = np.argsort(np.array(orders), axis=1).T
    masks = np.arange(1 << count)
    cost = np.where(masks[:, None] >> np.arange(count) & 1, 0, count)
    return orders, np.minimum((cost[:, :, None] + positions[None]).min(axis=1), count)


def audit(patterns: np.ndarray, weights: np.ndarray, count: int = len(FILTERS)) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders, and an array (order, step, measure) of counts.

    ``weights`` has the rows, the good rows and the toxic rows of each mask in ``patterns``.
    """
    orders, steps = removal_steps(count)
    step = steps[patterns]
    column = np.broadcast_to(np.arange(len(orders)), step.shape)
    gone = np.zeros((3, len(orders), count + 1), np.int64)
    for total, weight in zip(gone, weights):
        np.add.at(total, (column, step), np.broadcast_to(weight[:, None], step.shape))
    filters = np.array(orders)
    failing = np.array([weights[0][patterns >> f & 1 == 1].sum() for f in range(count)], np.int64)
    alone = np.array([weights[0][patterns == 1 << f].sum() for f in range(count)], np.int64)
    removed = gone[0, :, :count]
    shapley = np.zeros(count, np.int64)
    np.add.at(shapley, filters, removed)
    kept = gone[0].sum(axis=1, keepdims=True) - np.cumsum(removed, axis=1)
    # What fails a filter and is not removed by it went at an earlier step.
    return orders, np.stack([kept, removed, failing[filters] - removed, alone[filters], gone[1, :, :count], gone[2, :, :count], shapley[filters]], axis=2)


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "lang", id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(part, mask, n, good, toxic)``: rows of each set of failed filters."""
    body = F.coalesce(docs[f"`{text}`"], F.lit(""))
    alone = sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(failures(F.col("body")).values())), F.lit(0))
    rows = docs.select(docs[f"`{id_column}`"].alias("id"), F.coalesce(docs[f"`{part}`"], F.lit("")).alias("part"), body.alias("body"))
    rows = rows.select("id", "part", alone.alias("mask"), F.xxhash64("body").alias("h1"), F.xxhash64(F.lit(1), F.col("body")).alias("h2"))
    by_id = rows.groupBy("id", "part", "mask", "h1", "h2").agg(F.count("*").alias("n"))
    marked = lambda c: F.max((F.col(c) == 1).cast("int"))
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(marked("quality").alias("good"), marked("toxic").alias("toxic"))
    judged = by_id.join(marks, "id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    same = ["h1", "h2", "mask", "part", "good", "toxic"]
    by_text = judged.groupBy(*same, F.col("id").isNull().alias("unknown")).agg(F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"))
    by_text = by_text.join(by_text.groupBy("h1", "h2").agg(F.min("least").alias("first")), ["h1", "h2"])
    own = F.when(F.col("unknown"), F.col("n")).when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    copy = 1 << FILTERS.index("E")
    split = F.explode(F.array(F.struct(F.col("mask").alias("mask"), own.alias("n")), F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - own).alias("n"))))
    return by_text.select("part", "good", "toxic", split.alias("x")).groupBy("part", "x.mask").agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


def interactions(docs: DataFrame, labels: DataFrame, part: str = "lang", id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of counts per part, order of the filters and step."""
    def work(batches):
        for batch in batches:
            for given in batch.to_pylist():
                masks = given["masks"]
                weights = np.array([[m[c] for m in masks] for c in ("n", "good", "toxic")], np.int64)
                orders, counts = audit(np.array([m["mask"] for m in masks]), weights)
                rows, steps = len(orders) * len(FILTERS), np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders))
                names = np.repeat(["".join(FILTERS[f] for f in order) for order in orders], len(FILTERS))
                columns = [pa.array([given["part"]] * rows), pa.array(names), pa.array(steps), *[pa.array(c) for c in counts.reshape(rows, -1).T]]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *MEASURES])

    counts = failure_counts(docs, labels, part, id_column, text).filter("n > 0")
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return by_part.mapInArrow(work, "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES))
