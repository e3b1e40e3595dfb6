import numpy as np
import pyarrow as pa

from ledgerloom.llm import quality_classifier as C
from ledgerloom.llm.queries import remainder

FOLDER = "/root/testdata/sf0.01"


def walk(trees, row):
    total = trees.base
    for t in range(len(trees.feature)):
        node = 0
        while node < 2**C.DEPTH - 1:
            node = 2 * node + 1 + int(row[trees.feature[t, node]] > trees.threshold[t, node])
        total += trees.leaf[t, node - (2**C.DEPTH - 1)]
    return total


def test_trees_learn_and_flat_walk_is_right():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = C.fit_trees(x[:1500], y[:1500])
    assert ((trees.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.95
    assert np.allclose(trees.margin(x[:50]), [walk(trees, r) for r in x[:50]])


def test_degenerate_labels():
    assert C.fit_trees(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (C.fit_trees(np.ones((4, 3)), np.ones(4)).score(np.ones((2, 3))) > 0.99).all()
    assert 0.3 < C.fit_trees(np.ones((4, 3)), np.array([0, 1, 0, 1.0])).score(np.ones((1, 3)))[0] < 0.7


def test_statistics():
    got = C.statistics(pa.array([None, "", "Aa bb! Aa", "a\na\n| 7"]))
    at = {n: i for i, n in enumerate(C.STATISTICS)}
    assert not got[0].any() - 0 or got[0][at["log_words"]] == 0
    assert np.isclose(got[2][at["distinct"]], 2 / 3) and np.isclose(got[2][at["bang"]], 1 / 9)
    assert np.isclose(got[3][at["dup_lines"]], 1 / 3) and np.isclose(got[3][at["same_as_last"]], 1 / 4)
    assert C.statistics(pa.array([], pa.string())).shape == (0, len(C.STATISTICS))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    held = remainder(3, 1)
    trees = C.fit(docs, labels, "quality", held)
    rows = C.score(docs, trees).join(labels, C.F.col("id") == labels.doc_id).filter(held(C.F.col("id"))).collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows) > 0.9


def test_nulls_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 0.5), (None, None, 0.5), (1, "a b", 0.5), (2, "", None)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    trees = C.fit(docs, labels, "quality", lambda i: C.F.lit(False))
    assert C.score(docs, trees).count() == 4
    assert C.score(docs.limit(0), C.fit(docs, labels.limit(0), "quality", lambda i: C.F.lit(False))).count() == 0


def test_one_row_of_each_id_is_learnt_from(spark):
    docs = spark.range(40_000).selectExpr("id % 2 AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(5_000).selectExpr("id % 2 AS doc_id", "CAST(id % 3 = 0 AS INT) AS quality")
    held = lambda i: C.F.lit(False)
    sample = C.labelled_sample(labels, "quality", held)
    assert sorted(map(tuple, sample.collect())) == [(0, 0), (1, 0)]
    assert sorted(map(tuple, C.sampled_texts(docs, sample).collect())) == [(0, 0, "text 0"), (1, 0, "text 1")]
