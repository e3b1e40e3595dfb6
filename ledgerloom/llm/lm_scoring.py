"""Language-model scoring by cross-entropy difference.

A text is its words, then an end mark; before the first stands a begin mark. Target and
background models are matched: over one vocabulary, with the background's counts scaled to
the target's size, each has a word model and a model of a word given the one before,

    P(w) = (c(w) + a) / (N + a V)        P(w | v) = (c(v w) + a) / (c(v) + a V)

with ``a`` the ``SMOOTHING`` and ``V`` the vocabulary size that smoothing reckons with. The
loss of a token is the mean of its two cross-entropies, weighted by ``PAIR_WEIGHT``; a
document's score is the mean over its tokens of background loss minus target loss, so
higher means closer to the target. A document's own counts are left out of both models.

Logarithms of numerators and denominators add up apart, so each count is used where it is
known: ``c(v)`` with all occurrences of the word ``v``, never beside its pairs.

Counts are exact and grow with the corpus. Every slice sends the grams of each bucket,
sorted, with document numbers and frequencies; a bucket thus sees all occurrences of its
grams, counts them and adds each document's share. Grams with a large share of all (a
proven bound of eight for each partition) are counted map-side and scored in a map pass.

Defined results: ``n_tokens`` counts words; NULL and empty texts score 0 with 0 tokens; NULL targets count as
background; rows with NULL ids count for the models and have no result; rows that share an
id leave out their own counts each and get one score; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.heavy import heavy_values
from ledgerloom.llm.words import Words, chain, mix, slices

SMOOTHING = 0.5
PAIR_WEIGHT = 0.5
VOCABULARY = 1 << 17
BUCKETS_PER_PARTITION = 4
PACKED_BYTES = 4_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PAIR = np.uint64(0xA5A5A5A5A5A5A5A5)
_BEGIN, _END = np.uint64(0x5BD1E995973A1F27), np.uint64(0x27D4EB2F165667C5)


def _grams(texts: pa.Array):
    """All grams of some texts: hash (lowest bit 1 for pairs, marks included), and the text of each; words of each text."""
    words = Words(texts)
    words.data = _LOWER[words.data]
    single = words.hashes()
    count = np.diff(words.first)
    worded = np.flatnonzero(count)
    # Each text with words between its marks.
    place = np.arange(len(single)) + 2 * np.searchsorted(worded, words.text) + 1
    marked, owner = np.full(len(single) + 2 * len(worded), _END), np.repeat(worded, count[worded] + 2)
    marked[place] = single
    marked[words.first[worded] + 2 * np.arange(len(worded))] = _BEGIN
    inside = owner[1:] == owner[:-1]
    pair = (chain(marked, 2) ^ _PAIR)[inside]
    one = np.uint64(1)
    return np.concatenate([single & ~one, mix(pair) | one]), np.concatenate([words.text, owner[1:][inside]]), count


def _bag(gram: np.ndarray, text: np.ndarray):
    """Distinct (gram, text) in the order of gram, with frequencies."""
    order = np.argsort(gram, kind="stable")
    gram, text = gram[order], text[order]
    # Texts rise within a gram because the sort is stable and pairs keep the texts' order.
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return gram[at], text[at], np.diff(np.append(at, len(gram)))


def score(df: DataFrame, target: Column, id_column: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY) -> DataFrame:
    """``(id, n_tokens, score)`` of every document; ``target`` marks the rows of the target corpus."""
    def difference(target_n, all_n, own_target, own_all, added):
        """Logarithm of the target's count to the background's, without the document's own."""
        return np.log((target_n - own_target + added) / ((all_n - own_all) * scale + added))

    def share(gram, tf, target_n, all_n, own_target):
        """What a gram that a document has ``tf`` times adds to its score: a pair as one seen, a word as one seen and one before."""
        seen = difference(target_n, all_n, own_target, tf, SMOOTHING)
        before = difference(target_n, all_n, own_target, tf, SMOOTHING * vocabulary)
        return tf * np.where(gram & np.uint64(1), PAIR_WEIGHT * seen, (1 - PAIR_WEIGHT) * seen - PAIR_WEIGHT * before)

    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = partitions * BUCKETS_PER_PARTITION
    docs = df.select(df[f"`{id_column}`"].cast("long").alias("id"), F.coalesce(target, F.lit(False)).alias("target"), df[f"`{text}`"].alias("text"))
    heavy = heavy_values(docs, lambda texts: _grams(texts)[0], 4 * partitions)

    def totals(batches):
        for batch in batches:
            for part in slices(batch, "text", PACKED_BYTES):
                gram, owner, n = _grams(part.column("text"))
                goal = part.column("target").to_numpy(zero_copy_only=False)
                at = np.searchsorted(heavy, gram)
                hit = np.isin(gram, heavy)
                at, flag = at[hit], goal[owner[hit]]
                size = len(heavy)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(-2, size), pa.int64()),
                    pa.array(np.concatenate([[(n[goal] > 0).sum(), n[goal].sum()], np.bincount(at[flag], minlength=size)]).astype(np.int64)),
                    pa.array(np.concatenate([[(n > 0).sum(), n.sum()], np.bincount(at, minlength=size)]).astype(np.int64)),
                ], names=["gram", "t", "b"])

    counted = docs.mapInArrow(totals, "gram long, t long, b long").groupBy("gram").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
    known = {r["gram"]: (r["t"], r["b"]) for r in counted.collect()}
    ends_target, ends_all = known.get(-2, (0, 0))
    # Tokens: the words and the end marks.
    n_target, n_all = (w + e for w, e in zip(known.get(-1, (0, 0)), (ends_target, ends_all)))
    scale = n_target / n_all if n_all else 1.0
    heavy_counts = np.array([known[i] for i in range(len(heavy))] if known else [], np.float64).reshape(-1, 2)

    def lone(batches):
        """Counts of words and tokens, and the part of the score that marks, sizes of the models and heavy grams give."""
        for batch in batches:
            for part in slices(batch, "text", PACKED_BYTES):
                gram, owner, n = _grams(part.column("text"))
                goal = part.column("target").to_numpy(zero_copy_only=False)
                hit = np.isin(gram, heavy)
                gram, owner, tf = _bag(gram[hit], owner[hit])
                counts = heavy_counts[np.searchsorted(heavy, gram)] if len(gram) else np.zeros((0, 2))
                part_score = np.bincount(owner, share(gram, tf, counts[:, 0], counts[:, 1], tf * goal[owner]), len(n)).astype(np.float64)
                worded = np.flatnonzero(n)
                tokens, own = n[worded] + 1, goal[worded].astype(np.int64)
                part_score[worded] += (1 - PAIR_WEIGHT) * difference(ends_target, ends_all, own, 1, SMOOTHING) - PAIR_WEIGHT * difference(ends_target, ends_all, own, 1, SMOOTHING * vocabulary)
                part_score[worded] -= (1 - PAIR_WEIGHT) * tokens * difference(n_target, n_all, own * tokens, tokens, SMOOTHING * vocabulary)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), pa.array(n + (n > 0), pa.int64()), pa.array(part_score)], names=["id", "n", "e", "s"])

    def send(batches):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in slices(batch, "text", PACKED_BYTES):
                gram, owner, _ = _grams(part.column("text"))
                if len(heavy):
                    light = ~np.isin(gram, heavy)
                    gram, owner = gram[light], owner[light]
                if not len(gram):
                    continue
                gram, owner, tf = _bag(gram, owner)
                bucket = ((gram >> np.uint64(1)) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                gram, owner, tf, bucket = gram[order], owner[order].astype(np.uint32), np.minimum(tf, 2**31 - 1).astype(np.uint32)[order], bucket[order]
                first = np.ones(len(gram), bool)
                first[1:] = (gram[1:] != gram[:-1])
                cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
                ids, goal = part.column("id"), part.column("target")
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                numbers = ids.fill_null(0).to_numpy()
                flags = (goal.to_numpy(zero_copy_only=False) | (missing.astype(np.uint8) << 1)).astype(np.uint8)
                rows = []
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    texts, at = np.unique(owner[a:b], return_inverse=True)
                    own = np.flatnonzero(first[a:b])
                    rows.append((
                        int(bucket[a]), gram[a:b][own].tobytes(), squeeze(np.diff(np.append(own, b - a)).astype(np.uint32).tobytes()),
                        squeeze(at.astype(np.uint32).tobytes()), squeeze(tf[a:b].tobytes()), squeeze(numbers[texts].tobytes()), squeeze(flags[texts].tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))], names=names)

    def gather_bucket(rows):
        expand = zstandard.ZstdDecompressor().decompress
        gram, doc, goal, tf = [], [], [], []
        for own, repeat, at, freq, ids, flags in rows:
            at = np.frombuffer(expand(at), np.uint32)
            gram.append(np.repeat(np.frombuffer(own, np.uint64), np.frombuffer(expand(repeat), np.uint32)))
            doc.append(np.frombuffer(expand(ids), np.int64)[at])
            goal.append(np.frombuffer(expand(flags), np.uint8)[at])
            tf.append(np.frombuffer(expand(freq), np.uint32))
        gram, doc, goal, tf = np.concatenate(gram), np.concatenate(doc), np.concatenate(goal), np.concatenate(tf).astype(np.float64)
        order = np.argsort(gram, kind="stable")
        gram, doc, goal, tf = gram[order], doc[order], goal[order], tf[order]
        group = np.concatenate([[0], np.cumsum(gram[1:] != gram[:-1])])
        own_target = tf * (goal & 1)
        target_n, all_n = np.bincount(group, own_target), np.bincount(group, tf)
        part_score = share(gram, tf, target_n[group], all_n[group], own_target)
        named = goal < 2
        docs_, at = np.unique(doc[named], return_inverse=True)
        return docs_, np.bincount(at, part_score[named], len(docs_)).astype(np.float64)

    def add_up(batches):
        current, held, sums = None, [], []

        def flush():
            ids, at = np.unique(np.concatenate([d for d, _ in sums]), return_inverse=True)
            total = np.bincount(at, np.concatenate([s for _, s in sums]), len(ids)).astype(np.float64)
            group = (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(group, kind="stable")
            ids, total, group = ids[order], total[order], group[order]
            cut = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
            rows = [(int(group[a]), ids[a:b].tobytes(), total[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:])]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))], names=["docs", "ids", "sums"])

        for batch in batches:
            for key, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if key != current and held:
                    sums.append(gather_bucket(held))
                    held = []
                    if sum(len(d) for d, _ in sums) > 1_000_000:
                        yield flush()
                        sums = []
                current = key
                held.append(row)
        if held:
            sums.append(gather_bucket(held))
        if sums:
            yield flush()

    def per_document(batches):
        current, held = None, []

        def total():
            ids, at = np.unique(np.concatenate([np.frombuffer(i, np.int64) for i, _ in held]), return_inverse=True)
            part_score = np.bincount(at, np.concatenate([np.frombuffer(s, np.float64) for _, s in held]), len(ids))
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.zeros(len(ids), np.int64)), pa.array(np.zeros(len(ids), np.int64)), pa.array(part_score)], names=["id", "n", "e", "s"])

        for batch in batches:
            for key, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if key != current and held:
                    yield total()
                    held = []
                current = key
                held.append(row)
        if held:
            yield total()

    names = ["bucket", "grams", "repeats", "at", "tf", "ids", "flags"]
    sent = docs.mapInArrow(send, "bucket int, grams binary, repeats binary, at binary, tf binary, ids binary, flags binary")
    shares = sent.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(add_up, "docs int, ids binary, sums binary")
    # The parts of a document's score come from all tasks; they travel as arrays by document.
    shares = shares.repartition(partitions, "docs").sortWithinPartitions("docs").mapInArrow(per_document, "id long, n long, e long, s double")
    alone = docs.mapInArrow(lone, "id long, n long, e long, s double").filter("id IS NOT NULL")
    summed = alone.unionByName(shares).groupBy("id").agg(F.sum("n").alias("n_tokens"), F.sum("e").alias("e"), F.sum("s").alias("s"))
    mean = F.when(F.col("e") > 0, F.round(F.col("s") / F.col("e"), 9)).otherwise(F.lit(0.0))
    return summed.select(F.col("id").alias(id_column), "n_tokens", mean.alias("score"))
