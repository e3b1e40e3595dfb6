"""SimHash near-dedup with bit-sliced comparison.

Distinct fingerprints are spread by every pair of four 16-bit blocks: two fingerprints
that differ in two bits at most agree on at least two blocks, so they meet. Within a
bucket the fingerprints stand as 64 bit planes; all places are compared with the place
``s`` further on at once, carry-save counters add up the differing planes, and words of
64 comparisons are dropped as soon as all of them exceed the radius. Each task hands on
a forest of its links, never all pairs.

A bucket over ``BUCKET`` fingerprints is dealt anew by every value one bit away: within
two bits means a common neighbour, and such a bucket cannot hold over 65. Links are
joined by alternating large-star and small-star rounds over written tables.

``keep_one`` keeps one row of each component, by the same fingerprints and links.

Defined results: NULL and empty texts have fingerprint zero and link to each other; links
are between fingerprints, so rows that share an id but not their text may stand in different
components; a row with NULL id links like any other and has NULL as component; an empty
table gives an empty one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import Words, slices
from ledgerloom.session import cut_lineage

SHINGLE = 3
RADIUS = 2
BLOCKS = 4
BUCKET = 2048
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints(texts: pa.Array, k: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each text over its ``k``-word shingles, repeats included."""
    words = Words(texts)
    words.data = _LOWER[words.data]
    joined, at = words.joined()
    count = np.diff(words.first)
    shingles = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(shingles)])
    first = np.repeat(words.first[:-1] - begin[:-1], shingles) + np.arange(begin[-1])
    last = np.minimum(first + k, np.repeat(words.first[1:], shingles))
    blob, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(blob[a:b], 42) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist())), np.uint64, len(first))
    out = np.zeros(len(count), np.uint64)
    some = np.flatnonzero(shingles)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, begin[some], axis=0, dtype=np.int32)
        majority = (2 * ones > shingles[some, None]).astype(np.uint8)
        out[some] = np.packbits(majority, axis=1, bitorder="little").reshape(-1).view(np.uint64)
    return out


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit ``b`` of all values as one row of words, lane ``i`` at bit ``i`` mod 64 (one spare word)."""
    n = -(-len(values) // 64) + 1
    padded = np.zeros(n * 64, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits, axis=0, bitorder="little").T.copy().view(np.uint64)


def _count(counters: list[np.ndarray], differs: np.ndarray) -> np.ndarray:
    """Add one plane of bits to the counters (least bit first); what they cannot hold is returned."""
    for i, bit in enumerate(counters):
        counters[i], differs = bit ^ differs, bit & differs
    return differs


def _exceed(counters: list[np.ndarray], radius: int, over: np.ndarray) -> np.ndarray:
    equal = np.full_like(over, _FULL)
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal &= counters[i]
        else:
            over = over | (equal & counters[i])
            equal &= ~counters[i]
    return over


def close_pairs(values: np.ndarray, bucket: np.ndarray, radius: int):
    """Pairs of places ``(a, b)``, in turns, of one bucket with at most ``radius`` differing bits.

    Buckets must be contiguous. Each turn takes all pairs at one distance of places.
    """
    n = len(values)
    planes = _planes(values)
    ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, n)
    left = ends[np.searchsorted(ends, np.arange(n), "right")] - np.arange(n) - 1
    padded = np.zeros(planes.shape[1] * 64, left.dtype)
    padded[:n] = left
    farthest = padded.reshape(-1, 64).max(axis=1)
    active = np.flatnonzero(farthest >= 1)
    for shift in range(1, int(left.max(initial=0)) + 1):
        active = active[farthest[active] >= shift]
        words, (skip, turn) = active, divmod(shift, 64)
        turn = np.uint64(turn)
        # Lanes whose partner stands in another bucket count as exceeded from the start.
        over = ~np.packbits(padded.reshape(-1, 64)[words] >= shift, axis=1, bitorder="little").view(np.uint64).reshape(-1)
        counters = [np.zeros(len(words), np.uint64) for _ in range(radius.bit_length())]
        for base in range(0, 64, 8):
            for plane in planes[base : base + 8]:
                other = plane[words + skip]
                if turn:
                    other = (other >> turn) | (plane[np.minimum(words + skip + 1, len(plane) - 1)] << (np.uint64(64) - turn))
                over |= _count(counters, plane[words] ^ other)
            over = _exceed(counters, radius, over)
            stay = over != _FULL
            words, over, counters = words[stay], over[stay], [c[stay] for c in counters]
            if not len(words):
                break
        if len(words):
            alive = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, lane = np.nonzero(alive)
            a = words[word] * 64 + lane
            yield a, a + shift


def _settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give each place the least label reachable from it over the pairs."""
    while True:
        la, lb = label[a], label[b]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        if (low == high).all():
            return
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label[:] = label[label]


def forest(n: int, pairs) -> np.ndarray:
    """Least place reachable from each of ``n`` places over the pairs."""
    label = np.arange(n)
    for a, b in pairs:
        _settle(label, a, b)
    return label


def _links(keyed: DataFrame, radius: int, partitions: int) -> DataFrame:
    """Links ``(a, b)`` between the ids of fingerprints that share a key and lie within the radius: a star for each component of a bucket."""
    def stars(key, value, rep):
        root = forest(len(value), close_pairs(value.view(np.uint64), key, radius))
        linked = np.flatnonzero(root != np.arange(len(root)))
        if len(linked):
            yield pa.RecordBatch.from_arrays([pa.array(rep[linked]), pa.array(rep[root[linked]])], names=["a", "b"])

    def work(batches):
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
            # The last bucket may go on in the next batch.
            done = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if done >= 50_000:
                yield from stars(*[h[:done] for h in held])
                held = [h[done:] for h in held]
        if len(held[0]):
            yield from stars(*held)

    # Dealt by a digest of the key: after a join by the key itself the planner takes this exchange for a needless one, and
    # when adaptive execution then broadcasts the other side, the rows of a key stay in many tasks.
    dealt = keyed.select("key", "fp", "rep").repartition(partitions, F.xxhash64("key")).sortWithinPartitions("key", "rep")
    return dealt.mapInArrow(work, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` for every linked id, root being the least id of its component.

    Large-star and small-star rounds (Kiveris et al. 2014) over written tables; hubs are
    reduced map-side and joined with skew handling.
    """
    edges = cut_lineage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.select(F.inline(F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.inline(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))))
        edges = cut_lineage(small.filter("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
        before = now


def _printed(texts: DataFrame, shingle: int) -> DataFrame:
    """``texts`` with the fingerprint ``fp`` in place of the column ``text``."""
    keep = [c for c in texts.columns if c != "text"]

    def work(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = pa.array(fingerprints(part.column("text"), shingle).view(np.int64))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], found], names=[*keep, "fp"])

    return texts.mapInArrow(work, ", ".join([*[f"{c} long" for c in keep], "fp long"]))


def fingerprint_table(df: DataFrame, id_column: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp)`` of every row."""
    return _printed(df.select(df[f"`{id_column}`"].cast("long").alias("id"), df[f"`{text}`"].alias("text")), shingle)


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links between the ``rep`` of distinct fingerprints ``(fp, rep)`` within the radius; enough of them to connect all."""
    if not 0 <= radius <= 2:
        raise ValueError("the radius is 0, 1 or 2")
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = lambda i: F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))
    keys = F.array(*[F.lit(n << 32) + block(i) * 65536 + block(j) for n, (i, j) in enumerate(combinations(range(BLOCKS), 2))])
    near = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.expr("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))))
    keyed = distinct.select("fp", "rep", F.explode(keys).alias("key"))
    return _links(_deal(keyed, lambda crowded: crowded.select(F.explode(near).alias("key"), "fp", "rep"), bucket), radius, partitions)


def _deal(keyed: DataFrame, anew, bucket: int) -> DataFrame:
    """The rows of keys with two rows or more; rows of keys with over ``bucket`` rows are dealt ``anew``, by other keys."""
    sizes = cut_lineage(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    small = keyed.join(sizes.filter(F.col("n") <= bucket), "key").select("key", "fp", "rep")
    if sizes.filter(F.col("n") > bucket).isEmpty():
        return small
    crowded = keyed.join(sizes.filter(F.col("n") > bucket), "key", "left_semi").select("fp", "rep").distinct()
    return small.unionByName(anew(crowded))


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Of each row: the id, its fingerprint (16 hex digits) and the least id of its component."""
    prints = cut_lineage(fingerprint_table(df, id_column, text, shingle))
    # Fingerprints are the places of the graph: ids may be shared by rows of different texts.
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("id").alias("first")).withColumn("rep", F.col("fp")))
    roots = components(fingerprint_links(distinct, radius)).withColumnRenamed("id", "rep")
    classes = distinct.join(roots, "rep", "left").select("fp", "first", F.coalesce("root", "rep").alias("class"))
    least = classes.groupBy("class").agg(F.min("first").alias("component"))
    named = classes.join(least, "class").select("fp", "component")
    out = prints.join(named, "fp", "left")
    return out.select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"))


def keep_one(df: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The row of ``df`` with the least id of each component of fingerprints, unchanged.

    Texts without words share fingerprint zero, so one of them stays. Rows with NULL id all
    stay. Rows that share an id are told apart by their texts: of a component's rows with the
    least id the least hash of the text stays, of rows with equal id and text the least hash
    of the other columns.
    """
    columns = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    ids, body = F.col(f"c{columns.index(id_column)}"), F.col(f"c{columns.index(text)}")
    texts = plain.filter(ids.isNotNull()).select(ids.cast("long").alias("id"), F.xxhash64(body).alias("print"), body.alias("text"))
    classes = _printed(texts, shingle).groupBy("fp").agg(F.min(F.struct("id", "print")).alias("first"))
    classes = cut_lineage(classes.select("fp", "first", F.col("fp").alias("rep")))
    # One row a fingerprint from here on; roots name a component by its least fingerprint.
    roots = components(fingerprint_links(classes, radius)).withColumnRenamed("id", "rep")
    kept = classes.join(roots, "rep", "left").groupBy(F.coalesce("root", "rep").alias("component")).agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.id").alias("kept_id"), F.col("first.print").alias("kept_print"))
    ordered = [c for c, t in plain.dtypes if "map<" not in t and "variant" not in t]
    rows = plain.join(kept, (ids.cast("long") == F.col("kept_id")) & (F.xxhash64(body) == F.col("kept_print")))
    single = rows.groupBy("kept_id", "kept_print").agg(F.min_by(F.struct(*plain.columns), F.xxhash64(*ordered)).alias("row")).select("row.*")
    return single.unionByName(plain.filter(ids.isNull())).toDF(*columns)
