"""Exact k-nearest-neighbour join over a slab grid, and the distance-weighted vote.

Every vector has a short prefix: its coordinates along a few directions of great spread
and its distance from the plane they span. Distances between prefixes never exceed those
between vectors. Training vectors are dealt into slabs by halving the prefix space, and a
slab's box of prefixes gives a lower bound for all of its rows.

A query is first compared with its own slab, which bounds the distance of its k-th
neighbour, then with the slabs whose box is not farther than that. Slabs and their
visitors are cut into parts and lots of bounded size; each (slab, lot, part) is one
cogrouped piece of matrix arithmetic that gives back k rows a query.

Defined results: ids are unique on either side; rows whose vector is NULL have no
neighbours and are none; equal distances are settled by the lesser id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

#: Rows wanted in a slab, and at most held of a slab in one task.
SLAB, PART = 1024, 16384
#: Visitors of a slab in one task.
LOT = 8192
#: Slabs are halved from so many rows at most (least digest of the id), so often at most.
SAMPLE_ROWS, HALVINGS = 16384, 12
DIRECTIONS = 4
# Queries compared at once, and pairs measured at once.
_QUERIES, _PAIRS = 128, 1 << 16
_SLACK = 1e-9


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column, which must be of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), -1) if len(column) else np.empty((0, 0))


@dataclass
class Slabs:
    """Directions of the prefix and the tree that halves the prefix space, node by node."""

    directions: np.ndarray
    axis: np.ndarray
    edge: np.ndarray

    def prefixes(self, vectors: np.ndarray) -> np.ndarray:
        along = vectors @ self.directions.T
        return np.column_stack([along, np.linalg.norm(vectors - along @ self.directions, axis=1)])

    def place(self, prefixes: np.ndarray) -> np.ndarray:
        node = np.zeros(len(prefixes), np.int64)
        inner = len(self.axis)
        for _ in range(inner.bit_length()):
            node = 2 * node + 1 + (prefixes[np.arange(len(node)), self.axis[node]] > self.edge[node])
        return node - inner


def _halved(sample: np.ndarray, halvings: int) -> Slabs:
    """Slabs that share the sample about evenly; ties with an edge go to its lower side."""
    spread = np.linalg.svd(sample - sample.mean(axis=0), full_matrices=False)[2]
    slabs = Slabs(spread[:DIRECTIONS], np.zeros(2**halvings - 1, np.int64), np.zeros(2**halvings - 1))
    held = {0: slabs.prefixes(sample)}
    for node in range(len(slabs.axis)):
        points = held.pop(node)
        if len(points):
            axis = int(np.ptp(points, axis=0).argmax())
            slabs.axis[node], slabs.edge[node] = axis, np.median(points[:, axis])
        above = points[:, slabs.axis[node]] > slabs.edge[node]
        held[2 * node + 1], held[2 * node + 2] = points[~above], points[above]
    return slabs


def _placed(df: DataFrame, slabs: Slabs, *others: str) -> DataFrame:
    """``slab, id, vector`` and the other columns, with the ``prefix`` of the vector."""
    def work(batches):
        for batch in batches:
            if batch.num_rows:
                prefix = slabs.prefixes(_matrix(batch.column("vector")))
                lists = pa.ListArray.from_arrays(np.arange(0, prefix.size + 1, prefix.shape[1], dtype="int32"), prefix.ravel())
                yield pa.RecordBatch.from_arrays([pa.array(slabs.place(prefix), pa.int64()), lists, *batch.columns], names=["slab", "prefix", *batch.schema.names])

    rows = df.filter(F.col("vector").isNotNull()).select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"), *others)
    return rows.mapInArrow(work, "slab long, prefix array<double>, id long, vector array<double>" + "".join(f", {c} string" for c in others))


def _boxes(train: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, least and greatest prefixes of the slabs that hold rows; one small row for each slab."""
    size = DIRECTIONS + 1
    ends = [end(F.get("prefix", F.lit(i))) for end in (F.min, F.max) for i in range(size)]
    rows = train.groupBy("slab").agg(*ends).orderBy("slab").collect()
    table = np.array([[np.nan if x is None else x for x in r[1:]] for r in rows])
    given = ~np.isnan(table[0, :size])
    return np.array([r["slab"] for r in rows]), table[:, :size][:, given], table[:, size:][:, given]


def _visits(queries: DataFrame, boxes) -> DataFrame:
    """``slab, id, vector`` for each other slab that could hold something within the query's ``bound``."""
    number, low, high = boxes
    size = np.abs(np.stack([low, high])).max()

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _QUERIES):
                part = batch.slice(at, _QUERIES)
                prefix = _matrix(part.column("prefix"))
                own = part.column("slab").to_numpy()
                bound = part.column("bound").fill_null(np.inf).to_numpy()
                gap = np.maximum(np.maximum(low[None] - prefix[:, None], prefix[:, None] - high[None]), 0)
                slack = _SLACK * (size + np.abs(prefix).max(axis=1))
                row, slab = np.nonzero((np.sqrt((gap**2).sum(axis=2)) <= bound[:, None] + slack[:, None]) & (number[None] != own[:, None]))
                for cut in range(0, len(row), _PAIRS):
                    some = pa.array(row[cut : cut + _PAIRS])
                    yield pa.RecordBatch.from_arrays([pa.array(number[slab[cut : cut + _PAIRS]], pa.int64()), part.column("id").take(some), part.column("vector").take(some)], names=["slab", "id", "vector"])

    return queries.mapInArrow(work, "slab long, id long, vector array<double>")


def _best(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """(query, row, distance) of the k nearest rows of each query, the lesser id first among equals."""
    lengths = np.einsum("ij,ij->i", vectors, vectors)
    for at in range(0, len(queries), _QUERIES):
        some = queries[at : at + _QUERIES]
        own = np.einsum("ij,ij->i", some, some)
        # The expanded square is fast but not exact; it only chooses what is measured.
        rough = own[:, None] + lengths[None] - 2 * some @ vectors.T
        limit = np.partition(rough, k - 1, axis=1)[:, k - 1] if k < len(vectors) else np.full(len(some), np.inf)
        slack = _SLACK * (own + lengths.max())
        row, col = np.nonzero(rough <= (limit + slack)[:, None])
        far = np.empty(len(row))
        for cut in range(0, len(row), _PAIRS):
            diff = vectors[col[cut : cut + _PAIRS]] - some[row[cut : cut + _PAIRS]]
            far[cut : cut + _PAIRS] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        order = np.lexsort((ids[col], far, row))
        row, col, far = row[order], col[order], far[order]
        first = np.searchsorted(row, np.arange(len(some)))
        near = np.arange(len(row)) - first[row] < k
        yield at + row[near], col[near], far[near]


def _search(train: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """k best of each piece of the grid: ``id, train_id, label, distance``."""
    pieces = lambda rows, size, name: rows.groupBy("slab").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias(name))
    # One row a slab, 2 ** HALVINGS at most.
    grid = F.broadcast(pieces(train, PART, "parts").join(pieces(visits, LOT, "lots"), "slab"))
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    dealt = lambda count: F.pmod(F.xxhash64("id"), F.col(count))
    left = visits.join(grid, "slab").select("slab", dealt("lots").alias("lot"), each("parts").alias("part"), "id", "vector")
    right = train.join(grid, "slab").select("slab", each("lots").alias("lot"), dealt("parts").alias("part"), "id", "vector", "label")

    def work(visitors: pa.Table, rows: pa.Table) -> pa.Table:
        columns = ([], [], [], [])
        if visitors.num_rows and rows.num_rows:
            ids = rows.column("id").to_numpy()
            for query, row, far in _best(_matrix(visitors.column("vector")), _matrix(rows.column("vector")), ids, k):
                found = (visitors.column("id").take(pa.array(query)), rows.column("id").take(pa.array(row)), rows.column("label").take(pa.array(row)), pa.chunked_array([far]))
                for column, part in zip(columns, found):
                    column.extend(part.chunks)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64())
        return pa.Table.from_arrays([pa.chunked_array(c, t) for c, t in zip(columns, kinds)], names=["id", "train_id", "label", "distance"])

    key = ["slab", "lot", "part"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(work, "id long, train_id long, label string, distance double")


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """Least k by (distance, id) per query, limited in every task before the shuffle."""
    place = F.row_number().over(W.partitionBy("id").orderBy("distance", "train_id"))
    return found.select("id", place.alias("place"), "distance", "train_id", "label").filter(F.col("place") <= k)


def knn_join(train: DataFrame, queries: DataFrame, k: int, seed: int = 42, slab_rows: int = SLAB) -> DataFrame:
    """``id, place, distance, train_id, label`` of the k nearest training vectors.

    ``train(id, vector, label)``, ``queries(id, vector)``; slabs hold about ``slab_rows`` rows.
    """
    train = train.withColumn("label", F.col("label").cast("string"))
    count = train.count()
    halvings = min(HALVINGS, max(0, (count // slab_rows).bit_length() - 1))
    digest = F.xxhash64(F.col("id"), F.lit(seed))
    sample = train.filter(F.col("vector").isNotNull()).select(digest.alias("digest"), "id", F.col("vector").cast("array<double>").alias("vector"))
    sample = sample.orderBy("digest", "id").limit(min(SAMPLE_ROWS, max(64, 16 * 2**halvings))).collect()
    if not sample:
        return train.sparkSession.createDataFrame([], "id long, place int, distance double, train_id long, label string")
    slabs = _halved(np.array([r["vector"] for r in sample], "float64"), halvings)
    train = cut_lineage(_placed(train, slabs, "label"))
    queries = _placed(queries, slabs)
    boxes = _boxes(train)
    rows = train.select("slab", "id", "vector", "label")
    if len(boxes[0]) == 1:
        return _nearest(_search(rows, queries.withColumn("slab", F.lit(int(boxes[0][0])).cast("long")).select("slab", "id", "vector"), k), k)
    queries = cut_lineage(queries)
    first = cut_lineage(_nearest(_search(rows, queries.select("slab", "id", "vector"), k), k))
    # A query whose slab holds fewer than k rows has no bound yet.
    bound = first.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("bound"))
    second = _search(rows, _visits(queries.join(bound, "id", "left").select("slab", "prefix", "id", "vector", "bound"), boxes), k)
    return _nearest(first.select("id", "train_id", "label", "distance").unionByName(second), k)


def knn_vote(neighbours: DataFrame) -> DataFrame:
    """``id, prediction``: votes weigh 1 / distance; exact hits, if any, outvote the rest.

    Ties go to the least label.
    """
    exact = F.col("distance") == 0
    votes = neighbours.groupBy("id", "label").agg(
        F.sum(exact.cast("double")).alias("hits"), F.sum(F.when(exact, 0.0).otherwise(F.try_divide(F.lit(1.0), F.col("distance")))).alias("weight")
    )
    rank = F.struct(-F.col("hits"), -F.col("weight"), F.col("label"))
    return votes.groupBy("id").agg(F.min_by("label", rank).alias("prediction"))
