"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Texts are lower-cased and ASCII punctuation reads as space. A document window as long as
an item is fingerprinted over its words; the index has the fingerprint's four 16-bit
blocks with all values up to ``RADIUS // 4`` bits away, so it finds every item of that
length within ``RADIUS`` bits. Candidates are verified by the weighted Jaccard
similarity of their five-word shingles (a shingle weighs as often as it occurs). A text
with fewer words than an item is one window, verified against each longer item it shares a
shingle with.

Windows that share no shingle with an item of their length have similarity zero, so only
the others are fingerprinted; this drops no result. Items go in blocks of
``ITEMS`` with a bounded index each. Map passes only, no shuffle.

Defined results: NULL or wordless items match nothing; an item under five words is one
shingle and matches only itself; NULL texts and empty tables match nothing; repeated rows
are reported each, repeated items once; a NULL id is reported as NULL.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import Words, chain, slices

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
ITEMS = 4000

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32
# Where a shingle's low bits point to: a small filter before the exact search.
_FILTER_BITS = 20


def normal_words(texts: pa.Array) -> Words:
    texts = pc.utf8_lower(texts.cast(pa.large_string()))
    raw, offsets = (pc.fill_null(texts, "") if texts.null_count else texts), None
    _, offsets, data = raw.buffers()
    at = np.frombuffer(offsets, np.int64)[raw.offset : raw.offset + len(raw) + 1]
    plain = _PLAIN[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
    return Words(pa.Array.from_buffers(pa.large_binary(), len(raw), [None, pa.py_buffer(np.ascontiguousarray(at)), pa.py_buffer(plain)]))


def _signed_bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def window_prints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash over the words of each window of ``size`` words."""
    total = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(_signed_bits(hashes), axis=0, out=total[1:])
    ones = (total[starts + size] - total[starts] > 0).astype(np.uint8)
    return np.packbits(ones, axis=1, bitorder="little").reshape(-1).view(np.uint64)


def _near_blocks(limit: int) -> np.ndarray:
    """All 16-bit differences of up to ``limit`` bits."""
    return np.array([sum(1 << b for b in bits) for k in range(limit + 1) for bits in combinations(range(16), k)], np.int64)


class HammingIndex:
    """Finds all of some fingerprints within ``radius`` bits of a given one."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius, self.tables = prints, radius, []
        near = _near_blocks(radius // 4)
        for block in range(4):
            value = ((prints >> np.uint64(16 * block)) & np.uint64(0xFFFF)).astype(np.int64)
            keys = (value[:, None] ^ near[None, :]).reshape(-1)
            owner = np.repeat(np.arange(len(prints), dtype=np.int32), len(near))
            order = np.argsort(keys, kind="stable")
            self.tables.append((np.searchsorted(keys[order], np.arange(65537)).astype(np.int64), owner[order]))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (query, item) places within the radius."""
        found = []
        for block, (head, owner) in enumerate(self.tables):
            value = ((queries >> np.uint64(16 * block)) & np.uint64(0xFFFF)).astype(np.int64)
            count = head[value + 1] - head[value]
            query = np.repeat(np.arange(len(queries)), count)
            at = np.repeat(head[value] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            item = owner[at]
            near = np.bitwise_count(queries[query] ^ self.prints[item]) <= self.radius
            found.append(query[near] * len(self.prints) + item[near])
        both = np.unique(np.concatenate(found))
        return both // len(self.prints), both % len(self.prints)


def weighted_similarity(a: Counter, b: Counter) -> float:
    least = sum((a & b).values())
    return least / (sum(a.values()) + sum(b.values()) - least)


class Items:
    """The searchable form of a bounded block of benchmark items."""

    def __init__(self, rows: list[tuple[int | None, str | None]], radius: int):
        words = normal_words(pa.array([t for _, t in rows], pa.string()))
        hashes, self.ids = words.hashes(), [i for i, _ in rows]
        self.bags: list[Counter] = []
        by_length = defaultdict(list)
        holders = defaultdict(lambda: defaultdict(list))
        for place, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            k = min(SHINGLE, b - a)
            bag = Counter(chain(hashes[a:b], k).tolist()) if b > a else Counter()
            self.bags.append(bag)
            if bag:
                by_length[b - a].append(place)
                for shingle in bag:
                    holders[k, shingle][b - a].append(place)
        self.groups = {}
        for length, places in by_length.items():
            prints = np.concatenate([window_prints(hashes[words.first[p] : words.first[p + 1]], np.zeros(1, np.int64), length) for p in places])
            self.groups[length] = (HammingIndex(prints, radius), places)
        self.known = {}
        for k in sorted({k for k, _ in holders}):
            shingles = np.sort(np.array([s for kk, s in holders if kk == k], np.uint64))
            table = np.zeros(1 << _FILTER_BITS, bool)
            table[shingles & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.known[k] = (table, shingles, [dict(sorted(holders[k, s].items())) for s in shingles.tolist()])

    def matches(self, words: Words, similarity: float):
        """Best match of each (text, item): (text, item place, similarity, first word, words)."""
        hashes = words.hashes()
        starts = defaultdict(lambda: defaultdict(set))
        longer = defaultdict(set)
        for k, (table, shingles, held) in self.known.items():
            runs = chain(hashes, k)
            maybe = np.flatnonzero(table[runs & np.uint64((1 << _FILTER_BITS) - 1)])
            slot = np.minimum(np.searchsorted(shingles, runs[maybe]), len(shingles) - 1)
            hit = (shingles[slot] == runs[maybe]) & (words.text[maybe] == words.text[maybe + k - 1])
            for at, s in zip(maybe[hit].tolist(), slot[hit].tolist()):
                text = int(words.text[at])
                a, b = int(words.first[text]), int(words.first[text + 1])
                for n, places in held[s].items():
                    if n <= b - a:
                        starts[text][n].update(range(max(a, at + k - n), min(at, b - n) + 1))
                    elif (b - a - k + 1) / (n - k + 1) >= similarity:
                        longer[text].update((k, place) for place in places)
        for text in sorted(starts.keys() | longer.keys()):
            by_length, best = starts.get(text, {}), {}
            a, b = int(words.first[text]), int(words.first[text + 1])
            for k, place in longer.get(text, ()):
                score = weighted_similarity(Counter(chain(hashes[a:b], k).tolist()), self.bags[place])
                if score >= similarity:
                    best[place] = (score, 0, b - a)
            for n, places in by_length.items():
                if not places:
                    continue
                index, members = self.groups[n]
                first = np.array(sorted(places))
                base = first[0]
                region = hashes[base : first[-1] + n]
                query, item = index.search(window_prints(region, first - base, n))
                k = min(SHINGLE, n)
                for q, m in zip(query.tolist(), item.tolist()):
                    place, at = members[m], int(first[q])
                    score = weighted_similarity(Counter(chain(hashes[at : at + n], k).tolist()), self.bags[place])
                    if score >= similarity and (place not in best or score > best[place][0]):
                        best[place] = (score, at - int(words.first[text]), n)
            for place, (score, at, n) in sorted(best.items()):
                yield text, place, score, at, n


def _blocks(items: DataFrame, id_column: str, text: str, radius: int):
    """Broadcast indexes over the items, at most about ``ITEMS`` in each."""
    spark = items.sparkSession
    narrow = items.select(items[f"`{id_column}`"].cast("long").alias("i"), items[f"`{text}`"].alias("t")).filter("t IS NOT NULL").distinct()
    count = -(-narrow.count() // ITEMS)
    for block in range(count):
        rows = narrow.filter(F.pmod(F.hash("i", "t"), F.lit(count)) == block).orderBy("i", "t").collect()
        yield spark.sparkContext.broadcast(Items([(r["i"], r["t"]) for r in rows], radius))


def matches(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", item_column: str = "item_id", text: str = "text",
            similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``(id, item, similarity, first_word, n_words)``: where a text best resembles an item, if it does."""
    def scan(index):
        def work(batches):
            for batch in batches:
                for part in slices(batch, "text"):
                    rows = list(index.value.matches(normal_words(part.column("text")), similarity))
                    yield pa.RecordBatch.from_arrays([
                        part.column("id").take(pa.array([r[0] for r in rows], pa.int64())), pa.array([index.value.ids[r[1]] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64()),
                    ], names=names)
        return work

    names = [id_column, item_column, "similarity", "first_word", "n_words"]
    schema = f"`{id_column}` long, `{item_column}` long, similarity double, first_word long, n_words long"
    narrow = docs.select(docs[f"`{id_column}`"].cast("long").alias("id"), docs[f"`{text}`"].alias("text"))
    out = None
    for index in _blocks(items, item_column, text, radius):
        found = narrow.mapInArrow(scan(index), schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that match no item, unchanged."""
    def scan(index):
        def work(batches):
            for batch in batches:
                for part in slices(batch, body):
                    keep = np.ones(part.num_rows, bool)
                    keep[[m[0] for m in index.value.matches(normal_words(part.column(body)), similarity)]] = False
                    yield part.filter(pa.array(keep))
        return work

    columns = docs.columns
    out, body = docs.toDF(*[f"c{i}" for i in range(len(columns))]), f"c{columns.index(text)}"
    for index in _blocks(items, "item_id", "text", radius):
        out = out.mapInArrow(scan(index), out.schema)
    return out.toDF(*columns)
