"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters by its spelling (hashed embedding and log-odds of its label) and by its
characters (hashed four-byte runs and five-byte beginnings: mean embedding, greatest
log-odds). Every text is scored in all its overlapping windows of ``WINDOW`` words, a new
one each ``STRIDE`` words; a logistic layer over the windows' logits gives the score.

Fitting takes at most ``FIT_ROWS`` labelled rows of each label (least hash of the id, a
documented bound) and weights them back to the labels' true shares. Labels, language,
source and ids are never inputs.

Defined results: NULL and empty texts are one empty window and get its score; NULL labels
and ids are not fitted on; with no labelled row, or one class, the score is the class share
(0.5 without any); repeated rows are scored each; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.decontaminate import normal_words
from ledgerloom.llm.quality_classifier import sampled_texts
from ledgerloom.llm.words import Words, mix, slices

FIT_ROWS = 2000
FIT_BYTES = 1 << 15
WINDOW, STRIDE = 32, 24
HIDDEN, EMBED, ATTEND = 8, 6, 8
WORD_BITS, CHAR_BITS, ODDS_BITS = 13, 12, 18
EPOCHS, STEPS, BATCH, RATE = 4, 250, 128, 0.01
_SCORED_AT_ONCE = 1024


class Features:
    """Hashed word and character features of the distinct words of some texts."""

    def __init__(self, words: Words):
        self.tokens, spelled = words.ids()
        n = len(spelled)
        if not n:
            self.word = np.zeros(0, np.uint64)
            self.gram, self.begin = np.zeros(0, np.uint64), np.zeros(1, np.int64)
            return
        one = Words(spelled.cast(pa.large_binary()))
        self.word = one.hashes()
        data = np.concatenate([one.data, np.zeros(4, np.uint8)]).astype(np.uint64)
        at, end = one.at[:-1], one.at[1:]
        size = end - at
        # Runs of four bytes inside the word (one shorter run for shorter words), then the beginning.
        runs = np.maximum(size - 3, 1)
        begin = np.concatenate([[0], np.cumsum(runs + 1)])
        place = np.repeat(at - begin[:-1], runs + 1) + np.arange(begin[-1])
        stop = np.repeat(end, runs + 1)
        code = np.zeros(len(place), np.uint64)
        for j in range(4):
            inside = place + j < stop
            code |= np.where(inside, data[np.minimum(place + j, len(data) - 1)], 0) << np.uint64(8 * j)
        last = begin[1:] - 1
        head = np.full(n, 1 << 60, np.uint64)
        for j in range(5):
            head |= np.where(j < size, data[np.minimum(at + j, len(data) - 1)], 0) << np.uint64(8 * j)
        code[last] = head
        self.gram, self.begin = mix(code), begin


def _slot(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


class Odds:
    """Log-odds of a label given that a hashed feature stands in the text, shrunk where few texts have it."""

    def __init__(self, smoothing: float = 2.0, shrink: float = 8.0):
        self.counts, self.texts, self.smoothing, self.shrink = np.zeros((2, 1 << ODDS_BITS)), np.zeros(2), smoothing, shrink

    def add(self, slots: np.ndarray, label: int):
        self.counts[label][np.unique(slots)] += 1
        self.texts[label] += 1

    def table(self) -> np.ndarray:
        share = (self.counts + self.smoothing) / (self.texts[:, None] + 2 * self.smoothing)
        seen = self.counts.sum(axis=0)
        return ((np.log(share[1]) - np.log(share[0])) * seen / (seen + self.shrink)).astype(np.float32)


def inputs(found: Features, p: dict) -> np.ndarray:
    """The input vector of each distinct word."""
    n = len(found.word)
    x = np.zeros((n, 2 + 2 * EMBED), np.float32)
    if n:
        count = np.diff(found.begin).astype(np.float32)
        x[:, 0] = p["word_odds"][_slot(found.word, ODDS_BITS)]
        x[:, 1] = np.maximum.reduceat(p["char_odds"][_slot(found.gram, ODDS_BITS)], found.begin[:-1])
        x[:, 2 : 2 + EMBED] = p["word_embed"][_slot(found.word, WORD_BITS)]
        x[:, 2 + EMBED :] = np.add.reduceat(p["char_embed"][_slot(found.gram, CHAR_BITS)], found.begin[:-1], axis=0) / count[:, None]
    return x


def windows_of(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and first word (in its text) of every window; a text without words has one."""
    count = np.maximum(-(-(n_words - (WINDOW - STRIDE)) // STRIDE), 1)
    text = np.repeat(np.arange(len(n_words)), count)
    return text, (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * STRIDE


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gru(gates: np.ndarray, mask: np.ndarray, wh: np.ndarray, reverse: bool, keep: bool = True):
    """States (steps, n, HIDDEN) for input gates (steps, n, 3 * HIDDEN), and what the gradient needs."""
    steps, n, _ = gates.shape
    h = np.zeros((n, HIDDEN), gates.dtype)
    states, kept = np.zeros((steps, n, HIDDEN), gates.dtype), [None] * steps
    for t in reversed(range(steps)) if reverse else range(steps):
        zr = _sigmoid(gates[t, :, : 2 * HIDDEN] + h @ wh[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        new = np.tanh(gates[t, :, 2 * HIDDEN :] + (r * h) @ wh[:, 2 * HIDDEN :])
        if keep:
            kept[t] = (h, z, r, new)
        h = h + mask[t][:, None] * z * (new - h)
        states[t] = h
    return states, kept


def gru_back(d_states: np.ndarray, mask: np.ndarray, wh: np.ndarray, kept, reverse: bool):
    steps, n, _ = d_states.shape
    d_gates, d_wh = np.zeros((steps, n, 3 * HIDDEN), d_states.dtype), np.zeros_like(wh)
    d_h = np.zeros((n, HIDDEN), d_states.dtype)
    for t in range(steps) if reverse else reversed(range(steps)):
        h, z, r, new = kept[t]
        d = d_h + d_states[t]
        m = mask[t][:, None]
        d_z, d_new = d * m * (new - h) * z * (1 - z), d * m * z * (1 - new * new)
        d_rh = d_new @ wh[:, 2 * HIDDEN :].T
        d_r = d_rh * h * r * (1 - r)
        d_zr = np.concatenate([d_z, d_r], axis=1)
        d_gates[t, :, : 2 * HIDDEN], d_gates[t, :, 2 * HIDDEN :] = d_zr, d_new
        d_wh[:, : 2 * HIDDEN] += h.T @ d_zr
        d_wh[:, 2 * HIDDEN :] += (r * h).T @ d_new
        d_h = d * (1 - m * z) + d_zr @ wh[:, : 2 * HIDDEN].T + d_rh * r
    return d_gates, d_wh


def _pool(states: np.ndarray, mask: np.ndarray, p: dict):
    deep = np.tanh(states @ p["attend"])
    weight = np.exp(np.clip(deep @ p["query"], -20, 20)) * mask
    weight = weight / np.maximum(weight.sum(axis=0), 1e-9)
    return (weight[:, :, None] * states).sum(axis=0), weight, deep


def logits(x: np.ndarray, place: np.ndarray, mask: np.ndarray, p: dict) -> np.ndarray:
    """Logit of each window; ``place`` (n, WINDOW) points into the word inputs ``x``."""
    out = np.zeros(len(place), np.float32)
    front, back = x @ p["wx_f"] + p["b_f"], x @ p["wx_b"] + p["b_b"]
    for a in range(0, len(place), _SCORED_AT_ONCE):
        at, m = place[a : a + _SCORED_AT_ONCE].T, mask[a : a + _SCORED_AT_ONCE].T.astype(np.float32)
        states = np.concatenate([gru(front[at], m, p["wh_f"], False, False)[0], gru(back[at], m, p["wh_b"], True, False)[0]], axis=2)
        out[a : a + _SCORED_AT_ONCE] = _pool(states, m, p)[0] @ p["out"] + p["bias"]
    return out


def loss_and_gradient(x: np.ndarray, mask: np.ndarray, y: np.ndarray, p: dict):
    """Mean logistic loss of windows with inputs ``x`` (WINDOW, n, width), and the gradients by parameter (``x`` included)."""
    front, keep_f = gru(x @ p["wx_f"] + p["b_f"], mask, p["wh_f"], False)
    back, keep_b = gru(x @ p["wx_b"] + p["b_b"], mask, p["wh_b"], True)
    states = np.concatenate([front, back], axis=2)
    pooled, weight, deep = _pool(states, mask, p)
    score = pooled @ p["out"] + p["bias"]
    probability = _sigmoid(score)
    loss = -np.mean(np.log(np.where(y > 0, probability, 1 - probability) + 1e-9))
    d_score = (probability - y) / len(y)
    d_pooled = d_score[:, None] * p["out"]
    g = {"out": pooled.T @ d_score, "bias": d_score.sum(keepdims=True)}
    d_weight = (states * d_pooled).sum(axis=2)
    d_raw = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_deep = d_raw[:, :, None] * p["query"] * (1 - deep * deep)
    g["query"] = np.tensordot(deep, d_raw, ([0, 1], [0, 1]))
    g["attend"] = np.tensordot(states, d_deep, ([0, 1], [0, 1]))
    d_states = weight[:, :, None] * d_pooled + d_deep @ p["attend"].T
    d_x = 0
    for tail, part, kept, reverse in (("f", d_states[:, :, :HIDDEN], keep_f, False), ("b", d_states[:, :, HIDDEN:], keep_b, True)):
        d_gates, g[f"wh_{tail}"] = gru_back(part, mask, p[f"wh_{tail}"], kept, reverse)
        g[f"wx_{tail}"] = np.tensordot(x, d_gates, ([0, 1], [0, 1]))
        g[f"b_{tail}"] = d_gates.sum(axis=(0, 1))
        d_x = d_x + d_gates @ p[f"wx_{tail}"].T
    g["x"] = d_x
    return loss, g


def start(draw: np.random.Generator) -> dict:
    width = 2 + 2 * EMBED
    normal = lambda *shape: (draw.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"attend": normal(2 * HIDDEN, ATTEND), "query": normal(ATTEND), "out": normal(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
    for tail in "fb":
        p |= {f"wx_{tail}": normal(width, 3 * HIDDEN), f"wh_{tail}": normal(HIDDEN, 3 * HIDDEN), f"b_{tail}": np.zeros(3 * HIDDEN, np.float32)}
    return p | {"word_embed": 0.1 * normal(1, 1 << WORD_BITS, EMBED)[0], "char_embed": 0.1 * normal(1, 1 << CHAR_BITS, EMBED)[0]}


def _grid(tokens: np.ndarray, first: np.ndarray, n_words: np.ndarray, text: np.ndarray, at: np.ndarray):
    """Word places (n, WINDOW) and mask of some windows."""
    step = at[:, None] + np.arange(WINDOW)
    mask = step < n_words[text][:, None]
    if not len(tokens):
        return np.zeros(mask.shape, np.int64), mask
    return tokens[np.minimum(first[text][:, None] + step, len(tokens) - 1)], mask


def _summary(logit: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Of each text's windows: greatest and next logit, mean, log count."""
    order = np.lexsort([-logit, text])
    head = np.searchsorted(text[order], np.arange(n_texts))
    count = np.bincount(text, minlength=n_texts)
    sorted_ = logit[order]
    second = sorted_[np.minimum(head + 1, len(sorted_) - 1)]
    top = sorted_[head]
    return np.column_stack([top, np.where(count > 1, second, top), np.bincount(text, logit, n_texts) / count, np.log(count)]).astype(np.float64)


def _summaries(words: Words, p: dict) -> np.ndarray:
    found, n_words = Features(words), np.diff(words.first)
    x = inputs(found, p)
    if not len(x):
        x = np.zeros((1, 2 + 2 * EMBED), np.float32)
    text, at = windows_of(n_words)
    return _summary(logits(x, *_grid(found.tokens, words.first[:-1], n_words, text, at), p), text, len(n_words))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        q = _sigmoid(x @ w)
        hessian = (x * (weight * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (weight * (q - y)) + ridge * w)
    return w


def train(texts: pa.Array, y: np.ndarray, weight: np.ndarray, seed: int = 7) -> dict:
    """Parameters from labelled texts; ``weight`` gives each text its share among all labelled ones."""
    total = weight.sum()
    if len(y) == 0 or y.min() == y.max():
        return {"constant": float((y * weight).sum() / total) if total else 0.5}
    draw = np.random.default_rng(seed)
    words = normal_words(texts)
    found, n_words = Features(words), np.diff(words.first)
    # Two folds: a training text meets log-odds learned from the other half, as a new text will.
    fold = np.arange(len(y)) % 2
    odds = {(k, f): Odds() for k in ("word", "char") for f in (0, 1, 2)}
    word_slot, gram_slot = _slot(found.word, ODDS_BITS), _slot(found.gram, ODDS_BITS)
    gram_of = np.diff(found.begin)
    for i, label in enumerate(y.astype(int)):
        own = np.unique(found.tokens[words.first[i] : words.first[i + 1]])
        runs = np.repeat(found.begin[own] - np.cumsum(gram_of[own]) + gram_of[own], gram_of[own]) + np.arange(gram_of[own].sum())
        for f in (1 - fold[i], 2):
            odds["word", f].add(word_slot[own], label)
            odds["char", f].add(gram_slot[runs], label)
    p = start(draw)
    shown = [{"word_odds": odds["word", f].table(), "char_odds": odds["char", f].table()} for f in (0, 1, 2)]
    if not len(found.word):
        return {"constant": float((y * weight).sum() / total)}
    x = np.stack([inputs(found, p | shown[f]) for f in (0, 1)])
    # The most suspect window of each text stands for it, beside a random one of the clean texts.
    text, at = windows_of(n_words)
    place, mask = _grid(found.tokens, words.first[:-1], n_words, text, at)
    suspect = np.maximum(x[:, :, :2], 0).sum(axis=2)[fold[text][:, None], place] * mask
    order = np.lexsort([-suspect.max(axis=1), text])
    chosen = order[np.searchsorted(text[order], np.arange(len(y)))]
    begin = np.searchsorted(text, np.arange(len(y)))
    other = begin + (draw.random(len(y)) * np.bincount(text, minlength=len(y))).astype(np.int64)
    chosen = np.concatenate([chosen, other[y == 0]])
    place, mask, goal, half = place[chosen], mask[chosen].astype(np.float32), y[text[chosen]].astype(np.float32), fold[text[chosen]]
    dense = [k for k in p if not k.endswith("embed")]
    first, second = {k: np.zeros_like(p[k]) for k in dense}, {k: np.zeros_like(p[k]) for k in dense}
    seen = {k: np.full_like(p[k], 1e-4) for k in ("word_embed", "char_embed")}
    step = 0
    # Few texts are gone through more often, so that the network gets its least number of steps.
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(goal)))):
        for batch in np.array_split(draw.permutation(len(goal)), max(1, len(goal) // BATCH)):
            used, where = np.unique(place[batch], return_inverse=True)
            own = Features.__new__(Features)
            own.word = found.word[used]
            size = gram_of[used]
            own.begin = np.concatenate([[0], np.cumsum(size)])
            own.gram = found.gram[np.repeat(found.begin[used] - own.begin[:-1], size) + np.arange(own.begin[-1])]
            where = where.reshape(len(batch), WINDOW)
            _, g = loss_and_gradient(np.stack([inputs(own, p | shown[f]) for f in (0, 1)])[half[batch][:, None], where].transpose(1, 0, 2), mask[batch].T, goal[batch], p)
            step += 1
            for k in dense:
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.01 * (g[k] ** 2 - second[k])
                p[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            d_word = np.zeros((len(used), 2 + 2 * EMBED), np.float32)
            np.add.at(d_word, where.T, g["x"] * mask[batch].T[:, :, None])
            d_gram = np.repeat(d_word[:, 2 + EMBED :] / size[:, None], size, axis=0)
            for k, slot, d in (("word_embed", _slot(own.word, WORD_BITS), d_word[:, 2 : 2 + EMBED]), ("char_embed", _slot(own.gram, CHAR_BITS), d_gram)):
                full = np.zeros_like(p[k])
                np.add.at(full, slot, d)
                seen[k] += full**2
                p[k] -= RATE * full / np.sqrt(seen[k])
    summary = np.zeros((len(y), 4))
    for f in (0, 1):
        summary[fold == f] = _summaries(normal_words(texts.filter(pa.array(fold == f))), p | shown[f])
    return p | shown[2] | {"final": _logistic(summary, y, weight / weight.mean())}


def score_texts(texts: pa.Array, p: dict) -> np.ndarray:
    if "constant" in p:
        return np.full(len(texts), p["constant"])
    summary = _summaries(normal_words(texts), p)
    return _sigmoid(np.column_stack([summary, np.ones(len(summary))]) @ p["final"])


def fit(docs: DataFrame, labels: DataFrame, label: str, held_out, id_column: str = "doc_id", text: str = "text", rows: int = FIT_ROWS) -> dict:
    """Parameters for ``label`` from at most ``rows`` labelled documents of each label outside the held-out part.

    An id has one row, of its least label and least text. Texts of over ``FIT_BYTES`` bytes are scored but not
    learnt from, so the driver holds at most ``2 * rows * FIT_BYTES`` bytes of texts.
    """
    ids = labels.select(labels[f"`{id_column}`"].cast("long").alias("id"), labels[f"`{label}`"].cast("int").alias("y"))
    ids = ids.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    total = {r["y"]: r["n"] for r in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}
    least = lambda y: ids.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows)
    sample = least(0).unionByName(least(1))
    found = sampled_texts(docs, sample, id_column, text).filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= FIT_BYTES)
    chosen = found.toPandas().sort_values("id", kind="stable")
    y = chosen["y"].to_numpy(np.float64)
    weight = np.where(y == 1, total.get(1, 0) / max((y == 1).sum(), 1), total.get(0, 0) / max((y == 0).sum(), 1))
    return train(pa.array(chosen["text"].tolist(), pa.string()), y, weight)


def score(docs: DataFrame, parameters: dict, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, score)`` of every row."""
    model = docs.sparkSession.sparkContext.broadcast(parameters)

    def work(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score_texts(part.column("text"), model.value).astype(np.float64))], names=["id", "score"])

    plain = docs.select(docs[f"`{id_column}`"].cast("long").alias("id"), docs[f"`{text}`"].alias("text"))
    return plain.mapInArrow(work, "id long, score double")
