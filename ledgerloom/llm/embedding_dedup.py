"""Near-duplicate vectors by product quantisation, checked by exact cosine.

Equal vectors of a label are one class. Unit vectors are dealt to coarse inverted lists (the
nearest of ``lists`` centres); what is left after the centre is cut into subspaces and coded
by the nearest of 256 codewords each. A vector visits the lists that could hold a partner: the
distance of a partner is at most ``reach``, and it stands in another list only if it lies
beyond the plane between both centres, so a list is visited if the vector is no further from
that plane than ``margin``. In a list, table look-ups give the distance of each visitor to all
coded members; by the triangle inequality a member can only be a partner if that distance is at
most ``reach`` plus the member's coding error. Cosine in double precision decides what is left.

``margin`` equal to ``reach`` loses nothing, whatever the data. The default is ``SPREAD`` times
the part of ``reach`` that falls on one direction if the difference of a pair lies evenly over
the dimensions (``reach / sqrt(dimensions)``), since the exact margin visits most lists where
vectors fill the sphere; a pair is lost only if both sides miss, and tests measure the recall.

Centres and codewords are fitted on ``SAMPLE`` classes at most (least hashes); the number of
lists follows the square root of the number of classes, ``MOST_LISTS`` at most. Lists over
``PIECE`` members are cut into pieces, each of which sees all visitors, and over ``VISITS``
visitors take turns before a copy of the members. A task returns counts and one link per
vector and piece, never pairs.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite components, vectors
with NULL label and rows with NULL id link with nothing (the latter have a NULL component and
``kept``); vectors of different length are never compared; rows repeated with one id are
vectors of their own, so they count as linked to each other; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.code_compression import usable
from ledgerloom.llm.simhash import _settle, components
from ledgerloom.session import cut_lineage, spread

COSINE = 0.93
SUBSPACES, CODEWORDS = 16, 256
SAMPLE, SAMPLE_BYTES = 16_384, 64_000_000
MOST_LISTS, PIECE, VISITS = 4096, 65_536, 262_144
# Distances looked up, and cosines computed, at once.
LOOK_UPS, COSINES = 2_000_000, 50_000
SPREAD = 4.0
# Room for rounding in bounds; the cosine itself is compared as it is.
_SLACK = 1e-6


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safe for very large and very small components."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None], 0)


def lloyd(points: np.ndarray, count: int, turns: int = 8, seed: int = 13) -> np.ndarray:
    """``count`` centres (fewer if there are fewer points)."""
    centers = points[np.random.default_rng(seed).permutation(len(points))[:count]].copy()
    for _ in range(turns):
        own = np.concatenate([_gaps(points[i : i + 4096], centers).argmin(axis=1) for i in range(0, len(points), 4096)])
        counts = np.bincount(own, minlength=len(centers))
        sums = np.stack([np.bincount(own, column, len(centers)) for column in points.T], axis=1)
        centers[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centers


class Quantiser:
    """Coarse centres, and codewords of each subspace for what is left after the centre."""

    def __init__(self, sample: np.ndarray, lists: int, cosine: float = COSINE, margin: float | None = None):
        self.dims = sample.shape[1]
        self.reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
        self.margin = min(self.reach, SPREAD * self.reach / np.sqrt(self.dims)) if margin is None else margin
        self.centers = lloyd(sample, lists)
        left = sample - self.centers[_gaps(sample, self.centers).argmin(axis=1)]
        self.cuts = np.linspace(0, self.dims, min(SUBSPACES, self.dims) + 1).astype(int)
        self.words = [lloyd(left[:, a:b], CODEWORDS) for a, b in zip(self.cuts, self.cuts[1:])]
        between = np.sqrt(_gaps(self.centers, self.centers))
        np.fill_diagonal(between, 1)
        self.between = np.maximum(between, 1e-12)

    def visits(self, points: np.ndarray, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Each point's list, and whether it visits each list (its own included)."""
        gaps = _gaps(points, self.centers)
        own = gaps.argmin(axis=1) if own is None else own
        beyond = (gaps - gaps[np.arange(len(own)), own][:, None]) / (2 * self.between[own])
        visits = beyond <= self.margin + _SLACK
        visits[np.arange(len(own)), own] = True
        return own, visits

    def code(self, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of what is left after the centre, and the distance they are off by."""
        codes, error = np.empty((len(left), len(self.words)), np.uint8), np.zeros(len(left))
        for s, (a, b, words) in enumerate(zip(self.cuts, self.cuts[1:], self.words)):
            codes[:, s] = _gaps(left[:, a:b], words).argmin(axis=1)
            error += ((left[:, a:b] - words[codes[:, s]]) ** 2).sum(axis=1)
        return codes, np.sqrt(error)

    def look_up(self, left: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distance of each point of ``left`` to each coded one, added up from tables."""
        total = np.zeros((len(left), len(codes)))
        for s, (a, b, words) in enumerate(zip(self.cuts, self.cuts[1:], self.words)):
            total += _gaps(left[:, a:b], words)[:, codes[:, s]]
        return np.sqrt(total)


class _Piece:
    """The members of one piece of a list; visitors come in chunks."""

    def __init__(self, quantiser: Quantiser, cosine: float, where: tuple[int, int], node, points, weight):
        self.q, self.cosine, self.where = quantiser, cosine, where
        self.node, self.points, self.weight = node, points, weight
        self.center = quantiser.centers[where[0]]
        self.codes, error = quantiser.code(points - self.center)
        self.limit = quantiser.reach + error + _SLACK
        self.count, self.label = np.zeros(len(node), np.int64), np.arange(len(node))
        self.chunk = max(1, LOOK_UPS // len(node))

    def pairs(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of visitors and members whose cosine reaches the threshold."""
        a, b = np.nonzero(self.q.look_up(points - self.center, self.codes) <= self.limit)
        near = np.zeros(len(a), bool)
        for i in range(0, len(a), COSINES):
            part = slice(i, i + COSINES)
            near[part] = np.einsum("ij,ij->i", points[a[part]], self.points[b[part]]) >= self.cosine
        return a[near], b[near]

    def inside(self) -> None:
        """Links among the members."""
        for i in range(0, len(self.node), self.chunk):
            a, b = self.pairs(self.points[i : i + self.chunk])
            a = a + i
            a, b = a[a < b], b[a < b]
            np.add.at(self.count, a, self.weight[b])
            np.add.at(self.count, b, self.weight[a])
            _settle(self.label, a, b)

    def visit(self, node, points, weight, own_list, own_piece):
        """``(node, links, linked node)`` of the visitors that have links here."""
        a, b = self.pairs(points)
        # A member that visits the visitor's piece meets it there too; the lesser of both places counts the pair.
        lists, pieces = own_list[a], own_piece[a]
        members, place = np.unique(b, return_inverse=True)
        back = self.q.visits(self.points[members], np.full(len(members), self.where[0]))[1][place, lists]
        earlier = (lists < self.where[0]) | ((lists == self.where[0]) & (pieces < self.where[1]))
        here = ~(back & earlier)
        a, b = a[here], b[here]
        np.add.at(self.count, b, weight[a])
        found, partner = np.zeros((2, len(node)), np.int64)
        np.add.at(found, a, self.weight[b])
        linked, first = np.unique(a, return_index=True)
        partner[linked] = b[first]
        _settle(self.label, partner[a], b)
        return node[linked], found[linked], self.node[partner[linked]]


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(len(column), -1)


def _search(dealt: DataFrame, quantiser: Quantiser, cosine: float) -> DataFrame:
    """``(node, n, other)`` from rows in the order of their pieces, members before visitors."""
    def batch(node, n, other):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (node, n, other)], names=["node", "n", "other"])

    def begin(place, waiting):
        piece = _Piece(quantiser, cosine, place[1:3], *[np.concatenate(x) for x in zip(*waiting)])
        if place[3] == 0:
            piece.inside()
        return piece

    def finish(piece):
        some = np.flatnonzero(piece.count)
        return batch(piece.node[some], piece.count[some], piece.node[piece.label[some]])

    def work(batches):
        piece, place, waiting = None, None, []
        for given in batches:
            plain = {c: given.column(c).to_numpy(zero_copy_only=False) for c in given.schema.names if c != "vec"}
            points, at = _vectors(given.column("vec")), np.stack([plain[c] for c in PLACE], axis=1)
            marks = np.column_stack([at, plain["member"]])
            heads = np.flatnonzero(np.concatenate([[True], (marks[1:] != marks[:-1]).any(axis=1)])) if len(at) else []
            for a, b in zip(heads, [*heads[1:], len(at)]):
                if place != tuple(at[a]):
                    if waiting:
                        piece = begin(place, waiting)
                    if piece is not None:
                        yield finish(piece)
                    piece, place, waiting = None, tuple(at[a].tolist()), []
                rows = plain["node"][a:b], points[a:b], plain["weight"][a:b]
                if plain["member"][a]:
                    waiting.append(rows)
                    continue
                if waiting:
                    piece, waiting = begin(place, waiting), []
                if piece is None:
                    # No member fell to this piece.
                    continue
                rows += plain["own_list"][a:b], plain["own_piece"][a:b]
                for i in range(0, b - a, piece.chunk):
                    yield batch(*piece.visit(*[r[i : i + piece.chunk] for r in rows]))
        if waiting:
            piece = begin(place, waiting)
        if piece is not None:
            yield finish(piece)

    return dealt.mapInArrow(work, "node long, n long, other long")


PLACE = ["grp", "list", "piece", "turn"]


def _dealt(classes: DataFrame, quantiser: Quantiser, piece: int, visits: int) -> DataFrame:
    """Members and visitors of each piece of a list, side by side and members first."""
    def placed(batches):
        for given in batches:
            if given.num_rows:
                own, visited = quantiser.visits(_vectors(given.column("vec")))
                lists = [np.flatnonzero(v).astype(np.int32) for v in visited]
                yield pa.RecordBatch.from_arrays([*given.columns, pa.array(own.astype(np.int32)), pa.array(lists, pa.list_(pa.int32()))], names=[*given.schema.names, "own_list", "visits"])

    at = cut_lineage(classes.mapInArrow(placed, "node long, grp long, weight long, vec binary, own_list int, visits array<int>"))
    at = at.select("node", "grp", "weight", "vec", "own_list", F.explode("visits").alias("list"))
    home = F.col("list") == F.col("own_list")
    sizes = at.groupBy("grp", "list").agg(F.sum(home.cast("int")).alias("members"), F.count("*").alias("visits"))
    # Lists without a member of the group fall out of the join.
    sizes = sizes.filter("members > 0").select("grp", "list", F.ceil(F.col("members") / piece).cast("int").alias("pieces"), F.ceil(F.col("visits") / visits).cast("int").alias("turns"))
    at = at.join(sizes, ["grp", "list"])
    at = at.withColumn("own_piece", F.when(home, F.pmod(F.xxhash64("node"), F.col("pieces"))).otherwise(0).cast("int"))
    at = at.withColumn("my_turn", F.pmod(F.xxhash64("node", F.lit(3)), F.col("turns")).cast("int"))
    seat = lambda p, t, member: F.struct(p.alias("piece"), t.alias("turn"), F.lit(member).alias("member"))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    as_visitor = F.transform(F.filter(upto("pieces"), lambda p: ~home | (p != F.col("own_piece"))), lambda p: seat(p, F.col("my_turn"), False))
    as_member = F.transform(upto("turns"), lambda t: seat(F.col("own_piece"), t, True))
    seats = F.when(home, F.concat(as_member, as_visitor)).otherwise(as_visitor)
    rows = at.select("grp", "list", "node", "weight", "vec", "own_list", "own_piece", F.inline(seats))
    partitions = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, *PLACE).sortWithinPartitions(*PLACE, F.col("member").desc())


def near_vectors(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, margin: float | None = None, lists: int | None = None, piece: int = PIECE, visits: int = VISITS) -> DataFrame:
    """Of each row: its id, how many other vectors it is linked to, its component (least id) and whether it is kept."""
    if not 0 < cosine <= 1:
        raise ValueError("the cosine is over 0 and 1 at most")
    column, kind = df[f"`{vector}`"].cast("array<double>"), df[f"`{label}`"]
    sound = usable(column) & F.exists(column, lambda x: x != 0) & kind.isNotNull() & df[f"`{id_column}`"].isNotNull()
    rows = df.select(
        df[f"`{id_column}`"].cast("long").alias("id"), F.coalesce(sound, F.lit(False)).alias("sound"), F.xxhash64(kind, F.size(column)).alias("grp"), column.alias("vec"),
        F.xxhash64(kind, column).alias("h1"), F.xxhash64(F.lit(1), column, kind).alias("h2"))
    classes = rows.filter("sound").groupBy("h1", "h2").agg(F.min("id").alias("least"), F.count("*").alias("weight"), F.first("grp").alias("grp"), F.first("vec").alias("vec"))
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()))
    found = _links(classes, cosine, margin, lists, piece, visits)
    classes = classes.select("h1", "h2", "node", "least", "weight")
    if found is None:
        named = classes.select("h1", "h2", (F.col("weight") - 1).alias("n_links"), F.col("least").alias("component_id"))
    else:
        links = found.groupBy("node").agg(F.sum("n").alias("n"))
        roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b"))).withColumnRenamed("id", "node")
        named = classes.join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = named.groupBy("root").agg(F.min("least").alias("component_id"))
        named = named.join(least, "root").select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    rows = rows.select("id", *[F.when(F.col("sound"), F.col(h)).alias(h) for h in ("h1", "h2")])
    component = F.coalesce(F.col("component_id"), F.col("id"))
    return rows.join(named, ["h1", "h2"], "left").select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))


def _links(classes: DataFrame, cosine: float, margin: float | None, lists: int | None, piece: int, visits: int) -> DataFrame | None:
    """``(node, n, other)``: links of each class, in parts; vectors of each length are searched apart."""
    found = None
    for dims, count in sorted(tuple(r) for r in classes.groupBy(F.size("vec")).count().collect()):
        # Lengths are those of the embedding models in the table, a handful.
        same = classes.filter(F.size("vec") == dims)
        sample = same.orderBy("h1").limit(max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dims)))).select("vec")
        points = unit(np.array([r["vec"] for r in sample.collect()], float))
        quantiser = Quantiser(points, lists or min(MOST_LISTS, int(np.ceil(np.sqrt(count) / 4))), cosine, margin)

        def units(batches):
            for given in batches:
                if given.num_rows:
                    vectors = unit(given.column("vec").flatten().to_numpy().reshape(given.num_rows, -1))
                    yield pa.RecordBatch.from_arrays([*[given.column(c) for c in ("node", "grp", "weight")], pa.array([v.tobytes() for v in vectors], pa.binary())], names=["node", "grp", "weight", "vec"])

        ready = spread(same.select("node", "grp", "weight", "vec")).mapInArrow(units, "node long, grp long, weight long, vec binary")
        part = cut_lineage(_search(_dealt(ready, quantiser, piece, visits), quantiser, cosine))
        found = part if found is None else found.unionByName(part)
    return found
