"""Forests over all rows, counted by cell, whose trees are grown and asked by tasks.

A tree tells a value only by its bin, so rows that lie in the same bins, with the same label and
weight, are one entry with a count; a bootstrap draws a Poisson number for each of its rows, and the
sum over them is a Poisson number too. Every task grows whole trees over the entries. Trees stay in a
written table: answers are added up by the tasks that hold them, once for each cell of the rows asked.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

# Bins of a feature, as in MLlib's trees; ranks of bins are told this exactly from a sketch of all rows.
BINS, RANKS = 32, 10_000
# Entries that are sent to all tasks at most, and answered cells that a join sends.
ENTRIES, SENT_CELLS = 2_000_000, 400_000
# Nodes whose histograms a task holds at once, trees of a task and cells of a block.
_NODES, _TREES, _BLOCK = 8192, 8, 65_536
# Gains up to this are rounding.
_GAIN = 1e-12


def bin_edges(df: DataFrame, size: int, features: str = "features", bins: int = BINS) -> list[np.ndarray]:
    """Ascending edges of each feature: between all values where these are few, else at even ranks of all rows."""
    def work(batches: Iterable[pa.RecordBatch]):
        found = [np.zeros(0)] * size
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            # Over ``bins`` values are as good as any more.
            found = [np.unique(np.append(f, c[~np.isnan(c)]))[: bins + 1] for f, c in zip(found, rows.T)]
        yield pa.RecordBatch.from_pydict({"slot": pa.array(range(size), pa.int32()), "seen": pa.array([f.tolist() for f in found], pa.list_(pa.float64()))})

    values = df.select(vector_to_array(features).alias("v"))
    seen = values.mapInArrow(work, "slot int, seen array<double>").select("slot", F.explode("seen").alias("x")).distinct()
    seen = {r["slot"]: sorted(r["x"]) for r in seen.groupBy("slot").agg(F.collect_list("x").alias("x")).collect()}
    many = [i for i in range(size) if len(seen.get(i, ())) > bins]
    edges = [(np.array(seen.get(i, [0.0]))[:-1] + np.array(seen.get(i, [0.0]))[1:]) / 2 for i in range(size)]
    if many:
        ranks = [i / bins for i in range(1, bins)]
        slots = [F.get("v", F.lit(i)) for i in many]
        told = values.agg(*[F.percentile_approx(F.when(~F.isnan(x), x), ranks, RANKS) for x in slots], *[F.max(F.when(~F.isnan(x), x)) for x in slots]).first()
        for at, i in enumerate(many):
            marks = np.unique(told[at])
            edges[i] = marks[marks < told[len(many) + at]]
    return edges


def binned(df: DataFrame, edges: list[np.ndarray], features: str = "features") -> DataFrame:
    """``df`` with ``cell``: the bin of each feature as one byte; not a number is above all edges."""
    @F.pandas_udf("binary")
    def cell(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        rows = np.stack(vectors.to_list())
        found = np.column_stack([np.searchsorted(e, rows[:, i], "left") for i, e in enumerate(edges)]).astype(np.uint8)
        return pd.Series([r.tobytes() for r in found])

    return df.withColumn("cell", cell(vector_to_array(features)))


def _gini(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Weight times impurity of each row of class weights."""
    return total - (counts * counts).sum(axis=-1) / np.maximum(total, 1e-300)


def _best_splits(bins: np.ndarray, node: np.ndarray, weight: np.ndarray, nodes: int, chosen: np.ndarray, widths: np.ndarray):
    """``(feature, bin)`` of the best split of each node over its ``chosen`` features; rows are sorted by node."""
    gain, feature, place = np.zeros(nodes), np.full(nodes, -1), np.zeros(nodes, np.int64)
    classes = weight.shape[1]
    for start in range(0, nodes, _NODES):
        a, b = np.searchsorted(node, [start, start + _NODES])
        some, x, w, here = node[a:b] - start, bins[a:b], weight[a:b], min(_NODES, nodes - start)
        whole = np.column_stack([np.bincount(some, w[:, c], here) for c in range(classes)])
        impure = _gini(whole, whole.sum(axis=1))
        for turn in range(chosen.shape[1]):
            mine = chosen[start : start + here, turn]
            # Features of two bins have histograms of two.
            for own in (np.flatnonzero(widths[mine] == 2), np.flatnonzero(widths[mine] > 2)):
                if not len(own):
                    continue
                wide = int(widths[mine[own]].max())
                to = np.full(here, -1)
                to[own] = np.arange(len(own))
                rows = np.flatnonzero(to[some] >= 0)
                keys = to[some[rows]] * wide + x[rows, mine[some[rows]]]
                left = np.stack([np.bincount(keys, w[rows, c], len(own) * wide) for c in range(classes)], axis=1).reshape(len(own), wide, classes)
                left = left.cumsum(axis=1)[:, :-1]
                right = whole[own, None] - left
                l, r = left.sum(axis=2), right.sum(axis=2)
                # What rounding leaves beside an empty side.
                least = _GAIN * (l + r)
                told = np.where((l > least) & (r > least), impure[own, None] - _gini(left, l) - _gini(right, r), 0.0)
                at = told.argmax(axis=1)
                best = told[np.arange(len(own)), at]
                better = best > np.maximum(gain[start + own], _GAIN * impure[own])
                where = start + own[better]
                gain[where], feature[where], place[where] = best[better], mine[own[better]], at[better]
    return feature, place


def grow(bins: np.ndarray, weight: np.ndarray, depth: int, share: int, rng) -> tuple[np.ndarray, ...]:
    """``feature`` (-1: a leaf), ``bin`` (at most that: left), ``left`` (right is the next) and ``chance`` of the nodes of a tree.

    ``weight`` has a column for each class. Leaves of one parent that predict the same class are joined, as in MLlib.
    """
    size, widths = bins.shape[1], bins.max(axis=0, initial=0).astype(int) + 1
    node, levels, whole = np.zeros(len(bins), np.int64), [], weight.sum(axis=0)[None]
    for level in range(depth + 1):
        nodes = len(whole)
        feature, place = np.full(nodes, -1), np.zeros(nodes, np.int64)
        if level < depth and len(bins):
            chosen = rng.random((nodes, size)).argpartition(share - 1, axis=1)[:, :share] if share < size else np.tile(np.arange(size), (nodes, 1))
            feature, place = _best_splits(bins, node, weight, nodes, chosen, widths)
        split = np.flatnonzero(feature >= 0)
        left = np.full(nodes, -1)
        left[split] = 2 * np.arange(len(split))
        levels.append([feature, place, left, whole])
        if not len(split):
            break
        stay = feature[node] >= 0
        bins, weight, node = bins[stay], weight[stay], node[stay]
        node = left[node] + (bins[np.arange(len(bins)), feature[node]] > place[node])
        order = node.argsort(kind="stable")
        bins, weight, node = bins[order], weight[order], node[order]
        whole = np.column_stack([np.bincount(node, weight[:, c], 2 * len(split)) for c in range(weight.shape[1])])
    for (feature, _, left, _), (below, _, _, stats) in zip(levels[-2::-1], levels[:0:-1]):
        split = np.flatnonzero(feature >= 0)
        a, b = left[split], left[split] + 1
        told = stats.argmax(axis=1)
        same = (below[a] < 0) & (below[b] < 0) & (told[a] == told[b])
        feature[split[same]] = -1
    out, kept, first = [], np.zeros(1, np.int64), 0
    for feature, place, left, stats in levels:
        f = feature[kept]
        some = f >= 0
        first += len(kept)
        to = np.where(some, first + 2 * (np.cumsum(some) - 1), -1)
        out.append((f.astype("int32"), place[kept].astype("uint8"), to.astype("int32"), stats[kept] / np.maximum(stats[kept].sum(axis=1, keepdims=True), 1e-300)))
        kept = (left[kept[some]][:, None] + [0, 1]).ravel()
        if not len(kept):
            break
    return tuple(np.concatenate(x) for x in zip(*out))


def asked(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """Class chances of each row of bins."""
    feature, place, left, chance = tree
    at, open_rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while True:
        open_rows = open_rows[feature[at[open_rows]] >= 0]
        if not len(open_rows):
            return chance[at]
        here = at[open_rows]
        at[open_rows] = left[here] + (bins[open_rows, feature[here]] > place[here])


class CountedForestModel(Model):
    """Adds ``rawPrediction`` (chances summed over the trees), ``probability`` and ``prediction``; lives as long as its written trees."""

    def __init__(self, trees: DataFrame, count: int, classes: int, edges: list[np.ndarray], features: str = "features"):
        super().__init__()
        self.trees, self.getNumTrees, self.numClasses, self.edges, self.features = trees, count, classes, edges, features
        self.numFeatures = len(edges)

    def _transform(self, df: DataFrame) -> DataFrame:
        size, classes, count = self.numFeatures, self.numClasses, self.getNumTrees
        keyed = binned(df, self.edges, self.features)

        def blocks(batches: Iterable[pa.RecordBatch]):
            for batch in batches:
                for i in range(0, batch.num_rows, _BLOCK):
                    part = batch.column(0).slice(i, _BLOCK).to_pylist()
                    yield pa.RecordBatch.from_pydict({"cells": pa.array([b"".join(part)], pa.binary())})

        def answers(batches: Iterable[pa.RecordBatch]):
            for batch in batches:
                for block, cells, pack in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "pack"))):
                    bins = np.frombuffer(cells, np.uint8).reshape(-1, size)
                    out = sum(asked(tree, bins) for tree in pickle.loads(pack))
                    yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "cells": pa.array([cells], pa.binary()), "sums": pa.array([out.tobytes()], pa.binary())})

        def added(frame: pd.DataFrame) -> pd.DataFrame:
            cells = frame["cells"].iloc[0]
            # In one order, as sums of rounded numbers depend on it.
            out = sum(np.frombuffer(x).reshape(-1, classes) for x in sorted(frame["sums"]))
            return pd.DataFrame({"cell": [cells[i : i + size] for i in range(0, len(cells), size)], "raw": list(out)})

        cells = cut_lineage(keyed.select("cell").distinct().mapInArrow(blocks, "cells binary").withColumn("block", F.monotonically_increasing_id()))
        met = cells.crossJoin(self.trees.hint("shuffle_replicate_nl")).mapInArrow(answers, "block long, cells binary, sums binary")
        told = cut_lineage(met.groupBy("block").applyInPandas(added, "cell binary, raw array<double>"))
        if told.count() <= SENT_CELLS:
            told = F.broadcast(told)
        joined = keyed.join(told, "cell")
        likeliest = (F.array_position("raw", F.array_max("raw")) - 1).cast("double")
        chances = F.transform("raw", lambda x: x / F.lit(float(count)))
        return joined.select(*df.columns, array_to_vector("raw").alias("rawPrediction"), array_to_vector(chances).alias("probability"), likeliest.alias("prediction"))


class CountedForest:
    """Grows ``trees`` trees over all rows, each with its own bootstrap and its own features at every node.

    Gini impurity, ``BINS`` bins, depth and features as in ``trees.random_forest``. Where the rows make over
    ``ENTRIES`` different entries, or features are nominal, ``otherwise`` is fitted on the rows instead.
    """

    def __init__(self, trees: int, depth: int, features: float, seed: int, otherwise):
        self.count, self.depth, self.features, self.seed, self.otherwise = trees, depth, features, seed, otherwise

    def fit(self, df: DataFrame):
        spark, attrs = df.sparkSession, df.schema["features"].metadata["ml_attr"]["attrs"]
        if any(len(a.get("vals", ())) > 2 for a in attrs.get("nominal", [])):
            return self.otherwise.fit(df)
        size, classes = sum(map(len, attrs.values())), len(df.schema["label"].metadata["ml_attr"]["vals"])
        edges = bin_edges(df, size)
        entries = cut_lineage(binned(df, edges).groupBy("cell", "label", "weight").agg(F.count(F.lit(1)).alias("n")))
        if entries.count() > ENTRIES:
            return self.otherwise.fit(df)
        held = entries.toPandas().sort_values(["cell", "label", "weight"])
        cells, cell = np.unique(np.array([np.void(c) for c in held["cell"]]), return_inverse=True)
        bins = np.frombuffer(cells.tobytes(), np.uint8).reshape(-1, size)
        sent = spark.sparkContext.broadcast((bins, cell, held["label"].to_numpy(int), held["weight"].to_numpy(float), held["n"].to_numpy(float)))
        depth, share, seed = self.depth, max(1, math.ceil(self.features * size)), self.seed

        def work(batches: Iterable[pa.RecordBatch]):
            bins, cell, label, weight, n = sent.value
            for batch in batches:
                numbers = batch.column(0).to_pylist()
                for i in range(0, len(numbers), _TREES):
                    grown = []
                    for number in numbers[i : i + _TREES]:
                        rng = np.random.default_rng([seed, number])
                        drawn = np.bincount(cell * classes + label, rng.poisson(n) * weight, len(bins) * classes).reshape(-1, classes)
                        some = drawn.sum(axis=1) > 0
                        grown.append(grow(bins[some], drawn[some], depth, share, rng))
                    yield pa.RecordBatch.from_pydict({"pack": pa.array([pickle.dumps(grown)], pa.binary())})

        numbers = spark.range(0, self.count, 1, -(-self.count // _TREES))
        return CountedForestModel(cut_lineage(numbers.mapInArrow(work, "pack binary")), self.count, classes, edges)
