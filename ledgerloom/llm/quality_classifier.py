"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts come from one vectorised map pass. The trees are fitted on at
most ``FIT_ROWS`` labelled rows (those with the least hash of their id, a documented
bound), then flattened into complete-tree arrays that numpy walks for all rows and trees
of a slice at once. Labels, language, source and ids are never statistics.

Defined results: NULL and empty texts have zero statistics and a score like any other;
rows without a label, NULL labels and NULL ids are not fitted on; with no labelled row or
one class the score is the class share (0.5 without any); repeated rows are scored each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.quality_rules import duplicate_lines, repeats
from ledgerloom.llm.words import Words, slices

FIT_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LAMBDA = 80, 4, 32, 0.15, 1.0

_CLASSES = {
    "upper": [c for c in range(128) if chr(c).isupper()], "lower": [c for c in range(128) if chr(c).islower()],
    "digit": [c for c in range(128) if chr(c).isdigit()], "stop": list(b".?"), "comma": list(b",;:"), "bang": list(b"!"),
    "bar": list(b"|"), "symbol": list(b"#*$%&<>"), "other": list(b"'\"()[]{}@/\\=+_~^`-"), "high": list(range(128, 256)),
    "newline": [10],
}
STATISTICS = [
    "log_words", "word_length", "word_spread", "short_words", "long_words", "distinct", "top_word", "same_as_last", "covered", "longest",
    "dup_lines", "words_a_line", *_CLASSES,
]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text."""
    words = Words(texts)
    n_texts, n = len(words.first) - 1, np.diff(words.first)
    some, chars = np.maximum(n, 1), np.maximum(np.diff(words.offsets), 1)
    length = words.lengths()
    tokens, spelled = words.ids()
    pair, count = np.unique(words.text * (len(spelled) + 1) + tokens, return_counts=True)
    owner = pair // (len(spelled) + 1)
    top = np.zeros(n_texts, np.int64)
    np.maximum.at(top, owner, count)
    last = np.zeros(len(words), bool)
    last[1:] = (tokens[1:] == tokens[:-1]) & (words.text[1:] == words.text[:-1])
    covered, longest = repeats(words, 8)
    mean = words.per_text(length) / some
    blob, ends = words.raw.tobytes(), words.offsets.tolist()
    dup = np.array([duplicate_lines(blob[a:b]) for a, b in zip(ends, ends[1:])], np.int64)
    of_class = {}
    for name, members in _CLASSES.items():
        table = np.zeros(256, bool)
        table[members] = True
        total = np.concatenate([[0], np.cumsum(table[words.raw])])
        of_class[name] = total[words.offsets[1:]] - total[words.offsets[:-1]]
    lines = of_class["newline"] + 1
    columns = [
        np.log1p(n), mean, np.sqrt(np.maximum(words.per_text(length * length) / some - mean * mean, 0)), words.per_text(length <= 2) / some,
        words.per_text(length >= 12) / some, np.bincount(owner, minlength=n_texts) / some, top / some, words.per_text(last) / some, covered / some,
        np.log1p(longest), dup / lines, n / lines, *[v / chars for v in of_class.values()],
    ]
    return np.column_stack(columns).astype(np.float64) if n_texts else np.zeros((0, len(STATISTICS)))


@dataclass
class Trees:
    """Complete trees as arrays: row ``t`` holds tree ``t``, node ``i`` has children ``2i+1`` and ``2i+2``."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        n, trees = len(x), np.arange(len(self.feature))[None, :]
        node = np.zeros((n, len(self.feature)), np.int64)
        rows = np.arange(n)[:, None]
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        return self.base + self.leaf[trees, node - (2**DEPTH - 1)].sum(axis=1) if len(self.feature) else np.full(n, self.base)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, rate: float = RATE) -> Trees:
    """Boost ``trees`` trees on the logistic loss; splits are sought over ``BINS`` quantile bins."""
    n, width = x.shape
    inner = 2**DEPTH - 1
    share = y.mean() if n else 0.5
    if n == 0 or share in (0, 1):
        base = float(np.clip(np.log(max(share, 1e-9) / max(1 - share, 1e-9)), -30, 30))
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], axis=1)
    base = float(np.log(share / (1 - share)))
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    margin, columns = np.full(n, base), np.arange(width) * BINS
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for depth in range(DEPTH):
            here = 2**depth
            first = here - 1
            cell = ((node - first)[:, None] * width * BINS + columns + binned).reshape(-1)
            shape = (here, width, BINS)
            gs = np.bincount(cell, np.repeat(g, width), here * width * BINS).reshape(shape).cumsum(axis=2)
            hs = np.bincount(cell, np.repeat(h, width), here * width * BINS).reshape(shape).cumsum(axis=2)
            g_all, h_all = gs[:, :1, -1:], hs[:, :1, -1:]
            gain = gs**2 / (hs + LAMBDA) + (g_all - gs) ** 2 / (h_all - hs + LAMBDA) - g_all**2 / (h_all + LAMBDA)
            gain[:, :, -1] = 0
            best = gain.reshape(here, -1).argmax(axis=1)
            f, b = best // BINS, best % BINS
            useful = gain.reshape(here, -1)[np.arange(here), best] > 1e-6
            feature[t, first : first + here] = f
            threshold[t, first : first + here] = np.where(useful, edges[f, np.minimum(b, BINS - 2)], np.inf)
            at = node - first
            node = 2 * node + 1 + ((binned[np.arange(n), f[at]] > b[at]) & useful[at])
        at = node - inner
        leaf[t] = -rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + LAMBDA)
        margin += leaf[t][at]
    return Trees(base, feature, threshold, leaf)


def labelled_sample(labels: DataFrame, label: str, held_out, id_column: str = "doc_id", rows: int = FIT_ROWS) -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out part, by least hash: ``(id, y)``; of several labels of an id, the least."""
    ids = labels.select(labels[f"`{id_column}`"].cast("long").alias("id"), labels[f"`{label}`"].cast("int").alias("y"))
    ids = ids.filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    return ids.orderBy(F.xxhash64("id"), "id").limit(rows)


def sampled_texts(docs: DataFrame, sample: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, y, text)``, one row for each id of the sample (bounded by its caller); of several texts of an id, the least."""
    plain = docs.select(docs[f"`{id_column}`"].cast("long").alias("id"), docs[f"`{text}`"].alias("text"))
    return plain.join(F.broadcast(sample), "id").groupBy("id", "y").agg(F.min("text").alias("text"))


def _map_statistics(df: DataFrame, keep: list[str], finish, tail: str) -> DataFrame:
    def work(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                columns = finish(statistics(part.column("text")))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *columns], names=[*keep, *names])

    names = [c.split()[0] for c in tail.split(", ")]
    head = "".join(f"{c} {dict(df.dtypes)[c]}, " for c in keep)
    return df.select(*keep, "text").mapInArrow(work, head + tail)


def fit(docs: DataFrame, labels: DataFrame, label: str, held_out, id_column: str = "doc_id", text: str = "text", rows: int = FIT_ROWS) -> Trees:
    """Trees for ``label`` from at most ``rows`` labelled documents outside the held-out part."""
    sample = labelled_sample(labels, label, held_out, id_column, rows)
    plain = docs.select(docs[f"`{id_column}`"].cast("long").alias("id"), docs[f"`{text}`"].alias("text"))
    # The sample is bounded by `rows`, 16 bytes each. Statistics are taken where the texts are; of several texts of an id, the least hash counts.
    chosen = plain.join(F.broadcast(sample), "id").withColumn("print", F.xxhash64("text"))
    taken = _map_statistics(chosen, ["id", "y", "print"], lambda x: [pa.array(list(x), pa.list_(pa.float64()))], "x array<double>")
    found = taken.groupBy("id", "y").agg(F.min(F.struct("print", "x")).alias("m")).select("id", "y", "m.x").toPandas().sort_values("id", kind="stable")
    x = np.array(found["x"].tolist(), np.float64).reshape(len(found), len(STATISTICS))
    return fit_trees(x, found["y"].to_numpy(np.float64))


def score(docs: DataFrame, trees: Trees, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, score)`` of every row."""
    model = docs.sparkSession.sparkContext.broadcast(trees)
    plain = docs.select(docs[f"`{id_column}`"].cast("long").alias("id"), docs[f"`{text}`"].alias("text"))
    return _map_statistics(plain, ["id"], lambda x: [pa.array(model.value.score(x))], "score double")
