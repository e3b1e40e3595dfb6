"""k-means of many starts in one scan an iteration, exact silhouettes, and the latent stage."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.models.evaluate import internal_scores, squared_distance
from ledgerloom.operators.split import split_flag
from ledgerloom.session import cut_lineage, spread

TOLERANCE = 1e-4
BLOCK_ROWS = 2_000
# Matrices of more tasks than this are added up by ADDERS tasks before they go to the driver.
ADDERS, SUMMED_TASKS = 8, 64
# Rows of a packed matrix, and bytes that a task of a scan reads on average.
PACKED_ROWS, TASK_BYTES = 4096, 64 << 20
# A full scan is due once the rows measured since the last one exceed this share of all.
SPENT = 0.5
# Rounding of margins, as a share of the longest vector.
_SLACK = 1e-6


class NearestCentre(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``cluster``, the number of the nearest centre (the first of equally near ones)."""

    state = Param(Params._dummy(), "state", "centres and column names as JSON", TypeConverters.toString)

    def __init__(self, centres=None, vector="features", into="cluster"):
        super().__init__()
        if centres is not None:
            self._set(state=json.dumps({"centres": np.asarray(centres).tolist(), "vector": vector, "into": into}))

    def clusterCenters(self) -> list[np.ndarray]:
        return [np.array(c) for c in json.loads(self.getOrDefault(self.state))["centres"]]

    def _transform(self, df: DataFrame) -> DataFrame:
        held = json.loads(self.getOrDefault(self.state))
        point = vector_to_array(held["vector"])
        far = F.array(*[squared_distance(point, F.array(*[F.lit(x) for x in c])) for c in held["centres"]])
        return df.withColumn("__far", far).withColumn(held["into"], (F.array_position("__far", F.array_min("__far")) - 1).cast("int")).drop("__far")


def _seeded(drawn: np.ndarray, k: int) -> np.ndarray:
    """The centres of a start: the first ``k`` rows that were drawn for it."""
    return drawn[:k].copy()


def _sooner(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Of two matrices, each row from the one with the lesser first number."""
    a, b = a.reshape(-1, width), b.reshape(-1, width)
    return np.where(a[:, :1] <= b[:, :1], a, b).ravel()


def _drawn(packed: DataFrame, size: int, ks: list[int], seed: int) -> np.ndarray:
    """k-means++ over all rows, for all starts at once: each next centre is drawn by squared distance from those before.

    One pass over the rows for each place of a start. A draw is a race: every row has an exponential time divided by
    its weight, and the first one wins, so a task sends its first row of each start and never its rows. The draws are
    repeatable on the same partitions.
    """
    drawn = np.zeros((len(ks), max(ks), size))
    for place in range(max(ks)):
        open_starts = [i for i, k in enumerate(ks) if k > place]
        stacked = drawn[open_starts, :place].reshape(-1, size)

        def work(batches: Iterable[pa.RecordBatch]):
            first = np.full((len(open_starts), 1 + size), np.inf)
            rng = np.random.default_rng([seed, place, TaskContext.get().partitionId()])
            square = (stacked * stacked).sum(axis=1)
            for batch in batches:
                for blob in batch.column(0):
                    points = np.frombuffer(blob.as_buffer()).reshape(-1, size)
                    for i in range(0, len(points), 1024):
                        part = points[i : i + 1024]
                        time = rng.exponential(size=(len(part), len(open_starts)))
                        if place:
                            own = (part * part).sum(axis=1)[:, None]
                            far = square - 2 * (part @ stacked.T) + own
                            # What rounding leaves of a row that is a centre itself.
                            far[far <= 1e-12 * (own + square)] = 0
                            far = far.reshape(len(part), -1, place).min(axis=2)
                            # Rows that are centres come after all others, and are drawn evenly if there are no others.
                            time = np.where(far > 0, time / np.where(far > 0, far, 1), 1e300 * (1 + time))
                        at = time.argmin(axis=0)
                        least = time[at, np.arange(len(open_starts))]
                        sooner = least < first[:, 0]
                        first[sooner, 0], first[sooner, 1:] = least[sooner], part[at[sooner]]
            yield pa.RecordBatch.from_arrays([pa.array([first.tobytes()], pa.binary())], names=["first"])

        sent = _gathered(packed.mapInArrow(work, "first binary"), lambda a, b: _sooner(a, b, 1 + size))
        drawn[open_starts, place] = sent.reshape(len(open_starts), -1)[:, 1:]
    return drawn


def _packed(points: DataFrame, size: int, sets: int) -> DataFrame:
    """``points``: matrices of so many rows at most, in as many partitions as a scan has tasks."""
    def work(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            blobs = [np.ascontiguousarray(rows[i : i + PACKED_ROWS]).tobytes() for i in range(0, len(rows), PACKED_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary())], names=["points"])

    scanned = points.count() * (8 * size + 6 * sets)
    tasks = max(points.sparkSession.sparkContext.defaultParallelism, -(-scanned // TASK_BYTES))
    return cut_lineage(points.coalesce(tasks).mapInArrow(work, "points binary"))


def _edges(sets: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def _gathered(sent: DataFrame, join) -> np.ndarray:
    """The arrays that tasks send, joined two by two; of many tasks, a few join them before the driver joins the rest."""
    name = sent.columns[0]

    def work(batches: Iterable[pa.RecordBatch]):
        out = None
        for batch in batches:
            for blob in batch.column(0):
                one = np.frombuffer(blob.as_buffer())
                out = one if out is None else join(out, one)
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=[name])

    if sent.sparkSession.sparkContext.defaultParallelism > SUMMED_TASKS:
        sent = sent.repartition(ADDERS).mapInArrow(work, f"{name} binary")
    return functools.reduce(join, (np.frombuffer(r[0]) for r in sent.collect()))


def _added(totals: DataFrame, rows: int) -> np.ndarray:
    """Sum of the matrices that tasks send."""
    return _gathered(totals, np.add).reshape(rows, -1)


_STATE = ["points", "near", "margin", "total"]


def _state(points=None, near=None, margin=None, total=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x if x is None else x.tobytes()], pa.binary()) for x in (points, near, margin, total)], names=_STATE)


def _scan(packed: DataFrame, sets: list[np.ndarray], keep: bool = True) -> DataFrame:
    """Each row is measured against each centre of each set.

    ``total`` of a task: the sums and counts of the rows nearest to each centre and their squared distances. With
    ``keep`` also, for each matrix of ``points``: the place of the ``near`` centre of each set and row, and the
    ``margin`` by which the second nearest one is farther.
    """
    stacked, first = np.concatenate(sets), _edges(sets)
    kind = np.min_scalar_type(max(map(len, sets)))

    def work(batches: Iterable[pa.RecordBatch]):
        total = np.zeros((len(stacked), stacked.shape[1] + 2))
        square = (stacked * stacked).sum(axis=1)
        for batch in batches:
            for blob in batch.column(0):
                points = np.frombuffer(blob.as_buffer()).reshape(-1, stacked.shape[1])
                near, margin = np.empty((len(sets), len(points)), kind), np.empty((len(sets), len(points)), "float32")
                for i in range(0, len(points), 1024):
                    part = points[i : i + 1024]
                    own, at = (part * part).sum(axis=1), np.arange(len(part))
                    far = square - 2 * (part @ stacked.T)
                    hit = np.zeros(far.shape)
                    for n, (a, b) in enumerate(zip(first, first[1:])):
                        some = far[:, a:b]
                        chosen = some.argmin(axis=1)
                        least = some[at, chosen]
                        hit[at, a + chosen] = 1.0
                        total[a:b, -1] += np.bincount(chosen, np.maximum(least + own, 0), b - a)
                        if keep:
                            some[at, chosen] = np.inf
                            near[n, i : i + 1024] = chosen
                            margin[n, i : i + 1024] = np.sqrt(np.maximum(some.min(axis=1) + own, 0)) - np.sqrt(np.maximum(least + own, 0))
                    total[:, :-2] += hit.T @ part
                    total[:, -2] += hit.sum(axis=0)
                if keep:
                    yield _state(points, near, margin)
        yield _state(total=total)

    return packed.mapInArrow(work, ", ".join(f"{c} binary" for c in _STATE))


def _drifted(state: DataFrame, sets: list[np.ndarray], places: list[int], held: int, drift: np.ndarray) -> tuple[np.ndarray, int]:
    """How sums and counts differ from those of the scan that made ``state``, and how many rows were measured for that.

    The sets, those with ``places`` among the ``held`` ones of that scan, have since moved by ``drift`` at most.
    A row whose margin is over twice that still has the same nearest centre and is not measured.
    """
    stacked, first = np.concatenate(sets), _edges(sets)

    def work(batches: Iterable[pa.RecordBatch]):
        total = np.zeros((len(stacked) + 1, stacked.shape[1] + 1))
        square = (stacked * stacked).sum(axis=1)
        for batch in batches:
            for blob, nears, margins in zip(*(batch.column(c) for c in _STATE[:3])):
                if not blob.is_valid:
                    continue
                points = np.frombuffer(blob.as_buffer()).reshape(-1, stacked.shape[1])
                margin = np.frombuffer(margins.as_buffer(), "float32").reshape(held, -1)
                near = np.frombuffer(nears.as_buffer(), f"u{nears.as_buffer().size // margin.size}").reshape(held, -1)
                size = np.sqrt(max(square.max(), (points * points).sum(axis=1).max()))
                for place, reach, a, b in zip(places, 2 * drift, first, first[1:]):
                    open_rows = np.flatnonzero(margin[place] <= reach * (1 + _SLACK) + size * _SLACK)
                    if not len(open_rows):
                        continue
                    total[-1, -1] += len(open_rows)
                    some, before = points[open_rows], near[place][open_rows]
                    now = (square[a:b] - 2 * (some @ stacked[a:b].T)).argmin(axis=1)
                    moved = np.flatnonzero(now != before)
                    change = np.zeros((len(moved), b - a))
                    change[np.arange(len(moved)), now[moved]] = 1.0
                    change[np.arange(len(moved)), before[moved]] = -1.0
                    total[a:b, :-1] += change.T @ some[moved]
                    total[a:b, -1] += change.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    out = _added(state.select(*_STATE[:3]).mapInArrow(work, "total binary"), len(stacked) + 1)
    return out[:-1], int(out[-1, -1])


def many_starts(df: DataFrame, vector: str, ks, restarts: int = 20, iterations: int = 300, seed: int = 42) -> dict[int, tuple[np.ndarray, float]]:
    """``{k: (centres, cost)}`` of the cheapest of ``restarts`` starts for each ``k``.

    All sets of centres of all ``k`` move together, one scan an iteration; a set that moves less
    than ``TOLERANCE`` rests. Starts are k-means++ over all rows.

    A full scan keeps what is nearest to each row, and by what margin. Later iterations measure only the rows
    that the drift of the centres since then could have given to another, until these are so many that a full
    scan is due. The steps are those of full scans.
    """
    points = df.select(vector_to_array(vector).alias("v"))
    fixed = cut_lineage(spread(points.filter(F.col("v").isNotNull())))
    counts = [k for k in ks for _ in range(restarts)]
    size = len(fixed.first()["v"])
    packed = _packed(fixed, size, len(counts))
    starts = [(k, _seeded(drawn, k)) for k, drawn in zip(counts, _drawn(packed, size, counts, seed))]
    sets, moving = [s for _, s in starts], list(range(len(starts)))
    state, spent = None, 0.0
    for _ in range(iterations):
        if not moving:
            break
        now = [sets[i] for i in moving]
        if state is None or spent > SPENT:
            if state is not None:
                state.unpersist()
            held, kept, spent = moving, now, 0.0
            state = _scan(packed, now).persist()
            base = _added(state.filter("total IS NOT NULL").select("total"), sum(map(len, now)))[:, :-1]
            edges, rows = _edges(now), base[: len(now[0]), -1].sum()
            moments = base
        else:
            places = [held.index(i) for i in moving]
            drift = np.array([np.sqrt(((kept[p] - s) ** 2).sum(axis=1).max()) for p, s in zip(places, now)])
            change, measured = _drifted(state, now, places, len(held), drift)
            spent += measured / (rows * len(moving))
            moments = np.concatenate([base[edges[p] : edges[p + 1]] for p in places]) + change
        at, still = 0, []
        for i in moving:
            k = len(sets[i])
            sums, n = moments[at : at + k, :-1], moments[at : at + k, -1:]
            new = np.where(n > 0, sums / np.maximum(n, 1), sets[i])
            if ((new - sets[i]) ** 2).sum(axis=1).max() > TOLERANCE**2:
                still.append(i)
            sets[i], at = new, at + k
        moving = still
    if state is not None:
        state.unpersist()
    costs = _added(_scan(packed, sets, keep=False).select("total"), sum(map(len, sets)))[:, -1]
    cost = np.add.reduceat(costs, _edges(sets)[:-1])
    best = {}
    for i, (k, _) in enumerate(starts):
        if k not in best or cost[i] < best[k][1]:
            best[k] = (sets[i], float(cost[i]))
    return best


def silhouettes(df: DataFrame, vector: str, clusters: list[str], block: int = BLOCK_ROWS) -> dict[str, float]:
    """Mean Euclidean silhouette under each cluster column; a row alone in its cluster counts 0.

    Exact over all rows, so the work grows with their square. Rows are packed in blocks, every block meets
    every other one, and what leaves a task is the sum of distances of each row to each cluster, never pairs.
    """
    ways = len(clusters)
    points = df.select(vector_to_array(vector).alias("v"), F.array(*[F.col(c).cast("int") for c in clusters]).alias("c")).filter("v IS NOT NULL")
    points = cut_lineage(spread(points))
    sizes = {(r["way"], r["cluster"]): r["n"] for r in points.select(F.posexplode("c").alias("way", "cluster")).groupBy("way", "cluster").agg(F.count("*").alias("n")).collect()}
    # A column for each cluster of each way.
    columns = {pair: i for i, pair in enumerate(sorted(sizes))}

    def packed(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for i in range(0, batch.num_rows, block):
                part = batch.slice(i, block)
                rows = part.column(0).flatten().to_numpy().reshape(part.num_rows, -1)
                own = np.array([[columns[way, c] for way, c in enumerate(r)] for r in part.column(1).to_pylist()], "int32")
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (rows, own)], names=["points", "own"])

    blocks = cut_lineage(points.mapInArrow(packed, "points binary, own binary").withColumn("block", F.monotonically_increasing_id()))

    def distances(batches: Iterable[pa.RecordBatch]):
        now = None
        for batch in batches:
            for a, x, own, y, theirs in zip(*(batch.column(c) for c in ("block", "points", "own", "y", "theirs"))):
                if now is None or a.as_py() != now[0]:
                    if now is not None:
                        yield _row_sums(*now)
                    own = own.as_py()
                    rows = len(own) // (4 * ways)
                    now = a.as_py(), own, np.zeros((rows, len(columns)))
                    p = np.frombuffer(x.as_buffer()).reshape(rows, -1)
                q, their = np.frombuffer(y.as_buffer()).reshape(-1, p.shape[1]), np.frombuffer(theirs.as_buffer(), "int32").reshape(-1, ways)
                for i in range(0, len(q), 256):
                    part = q[i : i + 256]
                    far = np.sqrt(((p[:, None, :] - part[None]) ** 2).sum(axis=2)) if p.shape[1] <= 16 else _far(p, part)
                    hot = np.zeros((len(part), len(columns)))
                    np.put_along_axis(hot, their[i : i + 256], 1.0, axis=1)
                    now[2][:] += far @ hot
        if now is not None:
            yield _row_sums(*now)

    counts = np.array([sizes[pair] for pair in sorted(sizes)], float)
    of_way = np.array([way for way, _ in sorted(sizes)])

    def judged(frame: pd.DataFrame) -> pd.DataFrame:
        far = sum(np.frombuffer(x).reshape(-1, len(columns)) for x in frame["sums"])
        own, at = np.frombuffer(frame["own"].iloc[0], "int32").reshape(-1, ways), np.arange(len(far))
        out = []
        for way in range(ways):
            n = counts[own[:, way]]
            inside = far[at, own[:, way]] / np.maximum(n - 1, 1)
            others = np.where(of_way[None] == way, far / counts, np.inf)
            others[at, own[:, way]] = np.inf
            outside = others.min(axis=1)
            most = np.maximum(inside, outside)
            told = (n > 1) & np.isfinite(outside) & (most > 0)
            out.append((np.where(told, outside, 0) - np.where(told, inside, 0))[told] / most[told])
        return pd.DataFrame({"way": range(ways), "worth": [x.sum() for x in out], "n": len(far)})

    others = blocks.select(F.col("points").alias("y"), F.col("own").alias("theirs"))
    # Every partition meets every other one, without a shuffle.
    met = blocks.select("block", "points", "own").crossJoin(others.hint("shuffle_replicate_nl"))
    sums = met.mapInArrow(distances, "block long, own binary, sums binary")
    worth = sums.groupBy("block").applyInPandas(judged, "way int, worth double, n long")
    found = {r["way"]: r["s"] for r in worth.groupBy("way").agg((F.sum("worth") / F.sum("n")).alias("s")).collect()}
    return {c: float(found.get(i, 0.0)) for i, c in enumerate(clusters)}


def _row_sums(block: int, own: bytes, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([own], pa.binary()), pa.array([sums.tobytes()], pa.binary())], names=["block", "own", "sums"])


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((p * p).sum(axis=1)[:, None] - 2 * (p @ q.T) + (q * q).sum(axis=1)[None], 0))


def kmeans_search(df: DataFrame, vector: str, ks=range(3, 11), restarts: int = 20, iterations: int = 300, seed: int = 42):
    """(best model, table of scores per k); each k keeps its cheapest start, the best Euclidean silhouette over all rows wins."""
    fixed = cut_lineage(spread(df.select(vector)))
    found = many_starts(fixed, vector, ks, restarts, iterations, seed)
    models = {k: NearestCentre(centres, vector, f"cluster_{k}") for k, (centres, _) in found.items()}
    assigned = fixed
    for model in models.values():
        assigned = model.transform(assigned)
    assigned = cut_lineage(assigned)
    silhouette = silhouettes(assigned, vector, [f"cluster_{k}" for k in models])
    rows = []
    for k in models:
        scores = internal_scores(assigned, vector, f"cluster_{k}").first()
        rows.append((k, float(scores["inertia"]), silhouette[f"cluster_{k}"], float(scores["calinski_harabasz"]), float(scores["davies_bouldin"])))
    best = max(rows, key=lambda r: (r[2], -r[0]))[0]
    table = df.sparkSession.createDataFrame(rows, "n_clusters int, inertia double, silhouette double, calinski_harabasz double, davies_bouldin double")
    return NearestCentre(found[best][0], vector), table


def fit_latent(df: DataFrame, vector: str, k: int = 8, clusters: int = 8, restarts: int = 20, iterations: int = 500, seed: int = 42, standardize: bool = False) -> PipelineModel:
    """One stage that adds the low-dimensional form ``z`` and its ``cluster``, fitted on the rows of ``df`` alone."""
    shape = Pipeline(stages=[
        StandardScaler(inputCol=vector, outputCol="centred", withMean=True, withStd=standardize), PCA(k=k, inputCol="centred", outputCol="z"),
    ]).fit(df)
    low = shape.transform(df).select("z")
    centres, _ = many_starts(low, "z", [clusters], restarts, iterations, seed)[clusters]
    return PipelineModel(stages=[*shape.stages, NearestCentre(centres, "z")])


def latent_table(df: DataFrame, vector: str, key: str, label: str, share: float = 0.2, seed: int = 42, **options) -> tuple[DataFrame, PipelineModel]:
    """(frame of key, z, label, cluster and ``is_test``; the fitted stage).

    The held-out share, of each label, plays no part in the fit.
    """
    flagged = cut_lineage(split_flag(df.select(key, vector, label), [key], share, seed, [label]))
    stage = fit_latent(flagged.filter("is_test = 0"), vector, seed=seed, **options)
    return stage.transform(flagged).select(key, "z", label, "cluster", "is_test"), stage
