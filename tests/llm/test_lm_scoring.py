import math
import random
from collections import Counter, defaultdict

import pytest

from brute import words
from ledgerloom.llm import lm_scoring as L


def lower(w):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)


class Model:
    """Counts of the words and pairs of some texts, end and begin marks among them."""

    def __init__(self, texts, scale=1.0):
        self.word, self.pair, self.before, self.scale = Counter(), Counter(), Counter(), scale
        for w in texts:
            if w:
                self.word.update([*w, "END"])
                for v, x in zip(["BEGIN", *w], [*w, "END"]):
                    self.pair[v, x] += 1
                    self.before[v] += 1

    def loss(self, v, x, vocabulary):
        alone = (self.word[x] * self.scale + 0.5) / (sum(self.word.values()) * self.scale + 0.5 * vocabulary)
        given = (self.pair[v, x] * self.scale + 0.5) / (self.before[v] * self.scale + 0.5 * vocabulary)
        return -0.5 * math.log(alone) - 0.5 * math.log(given)


def brute(rows, vocabulary):
    """Token by token, with models of all the other rows."""
    texts = [[lower(x) for x in words(t)] for _, t, _ in rows]
    tokens = [len(w) + 1 if w else 0 for w in texts]
    scale = sum(n for n, r in zip(tokens, rows) if r[2]) / (sum(tokens) or 1)
    n, e, s = defaultdict(int), defaultdict(int), defaultdict(float)
    for k, (i, _, _) in enumerate(rows):
        target = Model([w for j, w in enumerate(texts) if j != k and rows[j][2]])
        background = Model([w for j, w in enumerate(texts) if j != k], scale)
        w = texts[k]
        n[i] += len(w)
        e[i] += tokens[k]
        if w:
            s[i] += sum(background.loss(v, x, vocabulary) - target.loss(v, x, vocabulary) for v, x in zip(["BEGIN", *w], [*w, "END"]))
    return {i: (n[i], s[i] / e[i] if e[i] else 0.0) for i in n if i is not None}


@pytest.mark.parametrize("partitions", ["3", "60"])
def test_against_brute_force(spark, partitions):
    draw = random.Random(5)
    rows = [(1, None, True), (2, "", None), (3, " \n", False), (None, "the a b", True), (4, "x y x", True), (4, "x y x", True)]
    for i in range(80):
        vocabulary = ["the", "The", "a"] * 3 + [f"{'t' if i % 3 else 'b'}{draw.randint(0, 60)}" for _ in range(20)]
        rows.append((10 + i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 80))), bool(i % 3)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string, score boolean")
        got = {r.doc_id: (r.n_tokens, r.score) for r in L.score(df, L.F.col("score"), vocabulary=100).collect()}
        want = brute(rows, 100)
        assert set(got) == set(want)
        for i, (n, s) in want.items():
            assert got[i][0] == n and math.isclose(got[i][1], s, abs_tol=1e-8), i
        assert L.score(df.limit(0), L.F.col("score")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_given_words_sum_to_one():
    model = Model([["a", "b", "a"], ["b"]])
    assert math.isclose(sum((model.pair["a", x] + 0.5) / (model.before["a"] + 0.5 * 3) for x in ("a", "b", "END")), 1)


def test_very_long_text(spark):
    text = " ".join(f"w{i % 5000}" for i in range(600_000))
    df = spark.createDataFrame([(1, text), (2, "w1 w2")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in L.score(df, L.F.col("doc_id") == 1).collect()}
    assert got == {1: 600_000, 2: 2}
