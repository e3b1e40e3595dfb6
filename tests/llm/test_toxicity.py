import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import toxicity as T
from ledgerloom.llm.decontaminate import normal_words
from ledgerloom.llm.queries import remainder

FOLDER = "/root/testdata/sf0.1"


def problem():
    draw = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in T.start(draw).items()}
    x = draw.normal(size=(T.WINDOW, 5, 2 + 2 * T.EMBED))
    mask = (np.arange(T.WINDOW)[:, None] < np.array([32, 5, 0, 17, 1])).astype(float)
    return x, mask, np.array([0, 1, 1, 0, 1.0]), p


@pytest.mark.parametrize("name", ["wx_f", "wh_f", "b_f", "wx_b", "wh_b", "b_b", "attend", "query", "out", "bias"])
def test_gradient(name):
    x, mask, y, p = problem()
    loss, g = T.loss_and_gradient(x, mask, y, p)
    at = tuple(0 if n == 1 else n // 2 for n in p[name].shape)
    moved = p | {name: p[name].copy()}
    moved[name][at] += 1e-6
    assert np.isclose((T.loss_and_gradient(x, mask, y, moved)[0] - loss) / 1e-6, g[name][at], atol=1e-6)


def test_windows_cover_every_word():
    n_words = np.array([0, 1, 31, 32, 33, 56, 57, 400])
    text, at = T.windows_of(n_words)
    for i, n in enumerate(n_words):
        own = at[text == i]
        assert own[0] == 0 and (np.diff(own) == T.STRIDE).all() and own[-1] + T.WINDOW >= n
        assert len(own) == 1 or own[-1] < n


def test_features_of_a_word_do_not_depend_on_its_company():
    alone, company = T.Features(normal_words(pa.array(["Éclair"]))), T.Features(normal_words(pa.array(["a éclair, zz", None, ""])))
    at = company.word.tolist().index(alone.word[0])
    assert company.gram[company.begin[at] : company.begin[at + 1]].tolist() == alone.gram.tolist()


def test_degenerate():
    one = np.ones(2)
    assert T.score_texts(pa.array(["a", None]), T.train(pa.array(["x", "y"]), one, one)).tolist() == [1.0, 1.0]
    assert T.score_texts(pa.array(["a"]), T.train(pa.array([], pa.string()), np.zeros(0), np.zeros(0))).tolist() == [0.5]
    assert len(T.score_texts(pa.array([None, ""], pa.string()), T.train(pa.array(["", None]), np.array([0, 1.0]), one))) == 2


def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    held = remainder(4, 2)
    p = T.fit(docs, labels, "toxic", held)
    rows = T.score(docs, p).join(labels, T.F.col("id") == labels.doc_id).filter(held(T.F.col("id"))).collect()
    hit = [(r.score >= 0.3, r.toxic == 1) for r in rows]
    assert sum(a == b for a, b in hit) / len(hit) > 0.93
    assert sum(a and b for a, b in hit) >= 0.7 * sum(b for _, b in hit)


def test_nulls_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "bad words here", 0.5), (None, None, 0.5), (1, "bad words here", 0.5), (2, "", None), (3, "x " * 3000, 0.1)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, 0), (4, None)], "doc_id long, toxic int")
    p = T.fit(docs, labels, "toxic", lambda i: T.F.lit(False))
    scores = [r.score for r in T.score(docs, p).collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    assert T.score(docs.limit(0), p).count() == 0
