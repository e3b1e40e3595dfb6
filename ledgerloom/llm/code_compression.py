"""Codes of vectors by Lloyd rounds over partition-local cover trees.

Vectors become integers and are cut into parts; each part position has its own codebook. The
kept vectors are written once, in blocks of ``BLOCK`` with a cover tree for each part: a node
covers a run of the block's points within its radius, its children lie more than half of that
apart and cover within half of it. A round walks the trees of a block level by level: where
the second nearest entry is further from a node's centre than the nearest by more than twice
the radius, the triangle inequality gives the whole run to the nearest, and cumulative sums
along the run give its sum and count at once; other nodes descend, down to single points,
which are compared exactly. A task returns its sums by entry; the driver holds codebooks only.

All decisions are exact: squared distances are whole numbers, ties go to the lower index, and
the inequality is used with room for rounding. ``ValueError`` is raised for vectors of unequal
length, of a length that the parts do not divide, or with components so large that squared
distances leave 62 bits.

Defined results: vectors that are NULL or hold NULL or non-finite components give no row;
repeated rows give one row each; NULL ids come last when the codebook is begun, rows of one id
in the order of their components; fewer vectors than entries make smaller codebooks; NULL
labels count together; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage, spread

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
BLOCK, LEAF = 1024, 8


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``."""
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    bound = 4 * most * most * a.shape[1]
    if bound < 1 << 53:
        # Whole numbers below 2^53 stay exact in floating point.
        x, y = a.astype(float), b.astype(float)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)[None]).astype(np.int64)
    if bound >= 1 << 62:
        raise ValueError("components are too large for exact squared distances")
    out = np.empty((len(a), len(b)), np.int64)
    for i in range(0, len(a), 64):
        out[i : i + 64] = ((a[i : i + 64, None] - b[None]) ** 2).sum(axis=2)
    return out


@dataclass
class Tree:
    """A cover tree over some points; ``order`` lists them so that each node covers a run."""

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray


def _net(points: np.ndarray, at: np.ndarray, center: int, reach: float, most: int):
    """Centres more than ``reach`` apart within ``reach`` of all points, each point's centre and distance; None beyond ``most``."""
    centers, owner = [center], np.zeros(len(at), np.int64)
    far = np.sqrt(squared(points[at], points[center][None])[:, 0])
    while far.max() > reach:
        if len(centers) == most:
            return None
        centers.append(int(at[far.argmax()]))
        found = np.sqrt(squared(points[at], points[centers[-1]][None])[:, 0])
        closer = found < far
        owner[closer], far[closer] = len(centers) - 1, found[closer]
    return centers, owner, far


def build_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    order = np.arange(len(points))
    radius = float(np.sqrt(squared(points, points[:1]).max(initial=0)))
    nodes, turn = [[0, len(points), 0, radius, 0, 0]], 0
    while turn < len(nodes):
        start, end, center, radius, _, _ = nodes[turn]
        at = order[start:end]
        net = _net(points, at, center, radius / 2, max(leaf, len(at) // 4)) if radius > 0 and len(at) > leaf else None
        if net:
            centers, owner, far = net
            nodes[turn][4:] = len(nodes), len(centers)
            order[start:end] = at[np.argsort(owner, kind="stable")]
            sizes = np.bincount(owner, minlength=len(centers))
            edges = start + np.concatenate([[0], np.cumsum(sizes)])
            for i, c in enumerate(centers):
                nodes.append([int(edges[i]), int(edges[i + 1]), c, float(far[owner == i].max()), 0, 0])
        turn += 1
    columns = list(zip(*nodes))
    return Tree(order, *[np.array(columns[i], float if i == 3 else np.int64) for i in range(6)])


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of many runs end to end."""
    begin = np.cumsum(length) - length
    return np.repeat(start - begin, length) + np.arange(length.sum())


def assign(points: np.ndarray, tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each point, and the sum and count of the points of each entry."""
    code = np.zeros(len(points), np.int64)
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
    total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points[tree.order], axis=0)])
    first = np.zeros(len(entries), bool)
    first[np.unique(entries, axis=0, return_index=True)[1]] = True
    active, single = np.zeros(1, np.int64), []
    while len(active):
        gaps = squared(points[tree.center[active]], entries)
        nearest, radius = gaps.argmin(axis=1), tree.radius[active]
        sure = radius == 0
        if first.sum() > 1:
            # Entries equal to one of lower index never win.
            two = np.sqrt(np.partition(gaps[:, first], 1, axis=1)[:, :2].astype(float))
            sure |= two[:, 1] - two[:, 0] > 2 * radius + 1e-9 * (1 + two[:, 1])
        else:
            sure[:] = True
        a, b, won = tree.start[active[sure]], tree.end[active[sure]], nearest[sure]
        np.add.at(sums, won, total[b] - total[a])
        np.add.at(counts, won, b - a)
        code[_spans(a, b - a)] = np.repeat(won, b - a)
        rest = active[~sure]
        leaves = tree.children[rest] == 0
        single.append(_spans(tree.start[rest[leaves]], (tree.end - tree.start)[rest[leaves]]))
        active = _spans(tree.child[rest[~leaves]], tree.children[rest[~leaves]])
    places = np.concatenate(single)
    if len(places):
        own = points[tree.order[places]]
        code[places] = squared(own, entries).argmin(axis=1)
        np.add.at(sums, code[places], own)
        np.add.at(counts, code[places], 1)
    out = np.empty_like(code)
    out[tree.order] = code
    return out, sums, counts


def usable(vector):
    """Whether a column of vectors holds one without NULL or non-finite components."""
    x = vector.cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & sound, F.lit(False))


def integers(vectors) -> np.ndarray:
    """Rows of whole numbers from equally long vectors."""
    rows = [np.floor(SCALE * np.asarray(v, float)) for v in vectors]
    width = {len(r) for r in rows}
    if len(width) > 1 or any(w % PARTS for w in width):
        raise ValueError(f"vectors need one length, a multiple of {PARTS}; found {sorted(width)}")
    grid = np.stack(rows) if rows else np.zeros((0, 0))
    if np.abs(grid).max(initial=0) >= 2.0**40:
        raise ValueError("components are too large for exact squared distances")
    return grid.astype(np.int64)


def blocks(kept: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of ``(id, label, vec)`` rows with their points and trees."""
    def packed(held, width, kind):
        ids, labels, vectors = zip(*held)
        points = integers(vectors)
        if width is not None and points.shape[1] != width:
            raise ValueError(f"vectors need one length; found {points.shape[1]} and {width}")
        trees = [build_tree(part) for part in np.split(points, PARTS, axis=1)]
        return pa.RecordBatch.from_arrays([pa.array([list(ids)], pa.list_(pa.int64())), pa.array([list(labels)], pa.list_(kind)), pa.array([pickle.dumps((points, trees))])], names=["ids", "labels", "held"])

    def work(batches):
        held, width, kind = [], None, None
        for batch in batches:
            kind = batch.schema.field("label").type
            held += zip(*[batch.column(c).to_pylist() for c in ("id", "label", "vec")])
            while len(held) >= size:
                yield packed(held[:size], width, kind)
                width, held = len(held[0][2]), held[size:]
        if held:
            yield packed(held, width, kind)

    return kept.mapInArrow(work, f"ids array<bigint>, labels array<{kept.schema['label'].dataType.simpleString()}>, held binary")


def _round(held: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks moved to the floor of the mean of the points nearest to each entry."""
    def work(batches):
        sums = [np.zeros((len(c), c.shape[1] + 1), np.int64) for c in codebooks]
        for batch in batches:
            for blob in batch.column("held"):
                points, trees = pickle.loads(blob.as_buffer())
                for total, part, tree, entries in zip(sums, np.split(points, PARTS, axis=1), trees, codebooks):
                    _, by_entry, counts = assign(part, tree, entries)
                    total += np.column_stack([by_entry, counts])
        for p, total in enumerate(sums):
            used = np.flatnonzero(total[:, -1])
            columns = total.shape[1]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(used) * columns, p, np.int32)), pa.array(np.repeat(used, columns).astype(np.int32)),
                pa.array(np.tile(np.arange(columns, dtype=np.int32), len(used))), pa.array(total[used].reshape(-1)),
            ], names=["part", "entry", "place", "total"])

    summed = held.select("held").mapInArrow(work, "part int, entry int, place int, total long").groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))
    # One number for each component of the codebooks, whatever the number of vectors.
    totals = [np.zeros((len(c), c.shape[1] + 1), np.int64) for c in codebooks]
    for r in summed.collect():
        totals[r["part"]][r["entry"], r["place"]] = r["total"]
    return [np.where(t[:, -1:] > 0, t[:, :-1] // np.maximum(t[:, -1:], 1), c) for t, c in zip(totals, codebooks)]


def spelled(codebooks: list[np.ndarray]) -> str:
    return ",".join(str(x) for c in codebooks for x in c.reshape(-1).tolist())


def fit(held: DataFrame, kept: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of each part after ``rounds`` rounds, begun with the vectors of the least ids."""
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    codebooks = np.split(integers([r["vec"] for r in first]), PARTS, axis=1)
    for _ in range(rounds):
        codebooks = _round(held, codebooks)
    return codebooks


def encode(held: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """``(id, label, code, error)`` of every vector."""
    def work(batches):
        for batch in batches:
            for ids, labels, blob in zip(*[batch.column(c) for c in ("ids", "labels", "held")]):
                points, trees = pickle.loads(blob.as_buffer())
                code, error = np.empty((len(points), PARTS), np.uint8), np.zeros(len(points), np.int64)
                for p, (part, tree, entries) in enumerate(zip(np.split(points, PARTS, axis=1), trees, codebooks)):
                    found = assign(part, tree, entries)[0]
                    code[:, p] = found
                    error += ((part - entries[found]) ** 2).sum(axis=1)
                text = code.tobytes().hex()
                digits = 2 * PARTS
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array([text[i : i + digits] for i in range(0, len(text), digits)]), pa.array(error)], names=["id", "label", "code", "error"])

    label = held.schema["labels"].dataType.elementType.simpleString()
    return held.mapInArrow(work, f"id bigint, label {label}, code string, error bigint")


def compress(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Of each usable vector: its id, code, error, the error of all vectors of its label, and a digest of the codebooks."""
    column = df[f"`{vector}`"]
    kept = df.filter(usable(column)).select(df[f"`{id_column}`"].cast("long").alias("id"), df[f"`{label}`"].alias("label"), column.cast("array<double>").alias("vec"))
    held = cut_lineage(blocks(spread(kept)))
    codebooks = fit(held, kept)
    digest = hashlib.sha256(spelled(codebooks).encode()).hexdigest()
    coded = cut_lineage(encode(held, codebooks))
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(totals, coded["label"].eqNullSafe(totals["of"])).select(
        F.col("id").alias(id_column), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
