"""Substring dedup by super-k-mer partitioning.

Every window of ``window`` consecutive words has a minimiser, the least hash among its
runs of ``seed`` words. Consecutive windows with one minimiser form a super-k-mer; it
travels as one packed string to the bucket of that minimiser, so equal windows always
meet. In the bucket the windows are sorted by hash, equal neighbours are compared word
for word, and each occurrence outside the smallest id becomes a span to remove.

A minimiser that holds more than a quarter of a partition's share is hot. Hot ones are
found first (each slice reports its frequent ones, a proven bound of eight per partition
stays) and their windows go through an aggregation that combines map-side and a join
that adaptive execution can split, with the same result.

Defined results: NULL text has no words; a row with NULL id is kept whole and removes
nothing; repeated ids count as one document, so they never remove each other's words;
texts under ``window`` words stay; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.heavy import heavy_values
from ledgerloom.llm.words import Words, chain, gather, mix, slices

WINDOW = 13
SEED = 3
# Buckets for each shuffle partition: a task holds one bucket at a time.
BUCKETS_PER_PARTITION = 8
SALTS = 32
# Text that is packed at once; more gives longer packed strings.
PACKED_BYTES = 4_000_000


def _super_kmers(words: Words, window: int, seed: int):
    """First window, last window (word places) and minimiser of each super-k-mer."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    seeds = chain(words.hashes(), seed)
    least = seeds[:n].copy()
    for j in range(1, window - seed + 1):
        np.minimum(least, seeds[j : j + n], out=least)
    valid = words.text[:n] == words.text[window - 1 :]
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (words.text[1:n] != words.text[: n - 1])
    starts = np.flatnonzero(new & valid)
    stop = np.append(np.flatnonzero(new | ~valid), n)
    ends = stop[np.searchsorted(stop, starts, "right")] - 1
    return starts, ends, least[starts]


def _spans_of(first: np.ndarray, row: np.ndarray, window: int):
    """Unite consecutive flagged windows: (index of the first flagged, index of the last)."""
    cut = np.flatnonzero((np.diff(first) != 1) | (np.diff(row) != 0)) + 1
    return np.concatenate([[0], cut]).astype(np.int64), np.concatenate([cut - 1, [len(first) - 1]]).astype(np.int64)


def _equal_windows(tokens: np.ndarray, at: np.ndarray, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort windows and number the distinct ones exactly: (order, group of each in that order)."""
    order = np.argsort(hashes, kind="stable")
    near = hashes[order[1:]] == hashes[order[:-1]]
    a, b = at[order[:-1]][near], at[order[1:]][near]
    same = np.ones(len(a), bool)
    for j in range(window):
        same &= tokens[a + j] == tokens[b + j]
    if not same.all():
        # Two word sequences share a hash: sort by the words themselves.
        order = np.lexsort([tokens[at + j] for j in range(window)])
        near = np.ones(len(at) - 1, bool)
        for j in range(window):
            near &= tokens[at[order[1:]] + j] == tokens[at[order[:-1]] + j]
    return order, np.concatenate([[0], np.cumsum(~near)])


def _repeated(packed: pa.Array, doc: np.ndarray, start: np.ndarray, window: int):
    """Spans (row, first word, word after the last) of windows that a smaller id has too."""
    words = Words(packed)
    n = len(words) - window + 1
    if n <= 0:
        return None
    at = np.flatnonzero(words.text[:n] == words.text[window - 1 :])
    if not len(at):
        return None
    tokens, _ = words.ids()
    order, group = _equal_windows(tokens, at, chain(mix(tokens.astype(np.uint64)), window)[at], window)
    owner = doc[words.text[at]]
    heads = np.flatnonzero(np.concatenate([[True], np.diff(group) > 0]))
    least = np.minimum.reduceat(owner[order], heads)
    flagged = np.zeros(len(at), bool)
    flagged[order] = least[group] < owner[order]
    at = at[flagged]
    if not len(at):
        return None
    row = words.text[at]
    place = at - words.first[row] + start[row]
    a, b = _spans_of(place, row, window)
    return row[a], place[a], place[b] + window


def _hot_minimisers(docs: DataFrame, window: int, seed: int, partitions: int) -> np.ndarray:
    """Minimisers with more than a quarter of a partition's share of all super-k-mers."""
    return heavy_values(docs, lambda texts: _super_kmers(Words(texts), window, seed)[2], 4 * partitions)


def _cold_spans(docs: DataFrame, hot: np.ndarray, window: int, seed: int, partitions: int) -> DataFrame:
    buckets = partitions * BUCKETS_PER_PARTITION

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=6).compress
        for batch in batches:
            for part in slices(batch, "text", PACKED_BYTES):
                words = Words(part.column("text"))
                first, last, least = _super_kmers(words, window, seed)
                bucket = (least % np.uint64(buckets)).astype(np.int64)
                if len(hot):
                    bucket[np.isin(least, hot)] = -1
                order = np.argsort(bucket, kind="stable")
                order = order[bucket[order] >= 0]
                if not len(order):
                    continue
                first, last, bucket = first[order], last[order], bucket[order]
                joined, at = words.joined()
                # One packed line for each super-k-mer; the space after its last word ends it.
                data, ends = gather(joined, at[first], at[last + window])
                data[ends[1:] - 1] = 10
                text = words.text[first]
                ids = part.column("id").to_numpy()[text]
                prints = part.column("print").to_numpy()[text]
                place = (first - words.first[text]).astype(np.int32)
                cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
                # Ids and places rise within a row of the exchange, so steps compress well.
                rows = [(int(bucket[a]), squeeze(data[ends[a] : ends[b]].tobytes()), squeeze(np.diff(ids[a:b], prepend=0).tobytes()),
                         prints[a:b].tobytes(), squeeze(np.diff(place[a:b], prepend=0).astype(np.int32).tobytes()))
                        for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["bucket", "packed", "ids", "prints", "places"])

    def compare(bucket):
        if not bucket:
            return None
        expand = zstandard.ZstdDecompressor().decompress
        data = np.frombuffer(b"".join(expand(r[0]) for r in bucket), np.uint8)
        ids = np.concatenate([np.cumsum(np.frombuffer(expand(r[1]), np.int64)) for r in bucket])
        prints = np.concatenate([np.frombuffer(r[2], np.int32) for r in bucket])
        places = np.concatenate([np.cumsum(np.frombuffer(expand(r[3]), np.int32)) for r in bucket])
        offsets = np.concatenate([[0], np.flatnonzero(data == 10) + 1]).astype(np.int64)
        packed = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        found = _repeated(packed, ids, places, window)
        if found is None:
            return None
        row, a, b = found
        return pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(prints[row]), pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["id", "print", "a", "b"])

    def meet(batches):
        current, held = None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for key, *row in zip(*columns):
                if key != current:
                    if (out := compare(held)) is not None:
                        yield out
                    current, held = key, []
                held.append(row)
        if (out := compare(held)) is not None:
            yield out

    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    sent = docs.mapInArrow(pack, "bucket int, packed binary, ids binary, prints binary, places binary")
    return sent.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "id long, print int, a int, b int")


def _hot_spans(docs: DataFrame, hot: np.ndarray, window: int, seed: int) -> DataFrame:
    def windows(batches):
        for batch in batches:
            for part in slices(batch, "text", 500_000):
                words = Words(part.column("text"))
                first, last, least = _super_kmers(words, window, seed)
                chosen = np.isin(least, hot)
                first, last = first[chosen], last[chosen]
                if not len(first):
                    continue
                count = last - first + 1
                at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
                joined, offset = words.joined()
                data, ends = gather(joined, offset[at], offset[at + window] - 1)
                text = words.text[at]
                yield pa.RecordBatch.from_arrays([
                    pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary()),
                    pa.array(part.column("id").to_numpy()[text]), pa.array(part.column("print").to_numpy()[text]),
                    pa.array((at - words.first[text]).astype(np.int32)),
                ], names=["window", "id", "print", "a"])

    found = docs.mapInArrow(windows, "window binary, id long, print int, a int")
    shared = found.groupBy("window").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most")
    # A window may hold most of the occurrences, so the join is salted.
    salted = found.withColumn("salt", F.pmod(F.hash("id", "a"), F.lit(SALTS)))
    shared = shared.select("window", "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return salted.join(shared, ["window", "salt"]).filter("id > least").select("id", "print", "a", (F.col("a") + window).alias("b"))


def repeated_spans(df: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Word ranges ``[a, b)`` of each document whose windows start in a document with a smaller id too.

    Columns ``id``, ``print`` (a hash of the text, tells rows with one id apart), ``a``, ``b``.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.filter(df[f"`{id_column}`"].isNotNull() & df[f"`{text}`"].isNotNull()).select(
        df[f"`{id_column}`"].cast("long").alias("id"), F.hash(df[f"`{text}`"]).alias("print"), df[f"`{text}`"].alias("text"))
    hot = _hot_minimisers(docs, window, seed, partitions)
    spans = _cold_spans(docs, hot, window, seed, partitions)
    return spans.unionByName(_hot_spans(docs, hot, window, seed)) if len(hot) else spans


def with_spans(df: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``df`` with ``__spans``, the packed ranges to remove (NULL: none), one entry for each document."""
    spans = repeated_spans(df, id_column, text, window, seed).groupBy("id", "print").agg(
        F.collect_list(F.struct("a", "b")).alias("__spans"))
    left = df.withColumn("__print", F.hash(df[f"`{text}`"])).withColumn("__id", df[f"`{id_column}`"].cast("long"))
    on = (F.col("__id") == F.col("id_")) & (F.col("__print") == F.col("print_"))
    return left.join(spans.withColumnsRenamed({"id": "id_", "print": "print_"}), on, "left").drop("id_", "print_", "__print", "__id")


def _per_text(part: pa.RecordBatch):
    """Words of each text and which of them go: (list of words, mask or None) in turn."""
    texts, spans = part.column("text"), part.column("__spans")
    some = spans.is_valid().to_pylist()
    values, offsets = spans.values, spans.offsets.to_pylist()
    a_all, b_all = values.field(0).to_numpy(), values.field(1).to_numpy()
    for i, text in enumerate(texts.to_pylist()):
        raw = (text or "").encode()
        words = raw.split()
        if not some[i]:
            yield raw, words, None
            continue
        edge = np.zeros(len(words) + 1, np.int64)
        at = slice(offsets[i], offsets[i + 1])
        np.add.at(edge, a_all[at], 1)
        np.add.at(edge, b_all[at], -1)
        yield raw, words, np.cumsum(edge[:-1]) > 0


def digests(df: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Of each row: the id, word and removed-word counts and the SHA-256 of the kept words joined by spaces."""
    def work(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                n, removed, digest = [], [], []
                for _, words, gone in _per_text(part):
                    kept = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
                    n.append(len(words))
                    removed.append(len(words) - len(kept))
                    digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                    names=[id_column, "n_words", "n_removed", "kept_sha256"])

    plain = df.select(df[f"`{id_column}`"].alias("id"), df[f"`{text}`"].alias("text"))
    marked = with_spans(plain, "id", "text", window, seed).select("id", "text", "__spans")
    return marked.mapInArrow(work, f"`{id_column}` {dict(df.dtypes)[id_column]}, n_words long, n_removed long, kept_sha256 string")


def cut_repeats(df: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``df`` with the repeated words cut out of its texts.

    Texts without a cut stay byte for byte; from others the removed words go with the
    white space after them. Rows that lose all their words go; rows without words stay.
    """
    word = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")

    def work(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                texts, keep = [], []
                for raw, words, gone in _per_text(part):
                    if gone is None or not gone.any():
                        texts.append(raw.decode())
                        keep.append(True)
                        continue
                    pieces = word.findall(raw)
                    texts.append(b"".join(p for p, g in zip(pieces, gone.tolist()) if not g).decode())
                    keep.append(not gone.all())
                valid = part.column("text").is_valid().to_pylist()
                new = pa.array([t if v else None for t, v in zip(texts, valid)], pa.string())
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(part.num_columns - 2)], new], names=[*others, "text"]).filter(pa.array(keep))

    columns = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    ids, body = f"c{columns.index(id_column)}", f"c{columns.index(text)}"
    others = [c for c in plain.columns if c != body]
    marked = with_spans(plain, ids, body, window, seed).select(*others, F.col(body).alias("text"), "__spans")
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in marked.schema.fields[:-2]) + "text string"
    out = marked.mapInArrow(work, schema)
    return out.select(*[F.col("text" if f"c{i}" == body else f"c{i}").alias(c) for i, c in enumerate(columns)])
