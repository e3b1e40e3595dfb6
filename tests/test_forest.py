import os
import pickle
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from ledgerloom.models import forest, train, trees
from ledgerloom.operators.split import train_test
from ledgerloom.plans import q_models

FOLDER = "/root/testdata/sf0.001"
COLUMNS = train.Columns("y", ("cat",), ("amount", "year"), ("id",))


def gini(w):
    return w.sum() - (w * w).sum() / w.sum() if w.sum() else 0.0


def test_a_split_is_the_best_one():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, [6, 2, 5], (80, 3)).astype(np.uint8)
    weight = np.zeros((80, 3))
    weight[np.arange(80), (bins[:, 2] > 2) * 1 + (rng.random(80) < 0.2)] = rng.integers(1, 4, 80)
    gains = {}
    for f in range(3):
        for b in range(bins[:, f].max()):
            left = bins[:, f] <= b
            gains[f, b] = gini(weight.sum(axis=0)) - gini(weight[left].sum(axis=0)) - gini(weight[~left].sum(axis=0))
    feature, place, _, chance = forest.grow(bins, weight, 1, 3, rng)
    assert gains[feature[0], place[0]] == pytest.approx(max(gains.values()))
    left = bins[:, feature[0]] <= place[0]
    assert chance[1] == pytest.approx(weight[left].sum(axis=0) / weight[left].sum())


def test_a_deep_tree_tells_all_cells_apart():
    rng = np.random.default_rng(4)
    bins = np.unique(rng.integers(0, 32, (3000, 3)).astype(np.uint8), axis=0)
    label = rng.integers(0, 3, len(bins))
    tree = forest.grow(bins, np.eye(3)[label], 40, 3, rng)
    # All but rare nodes that no single split makes purer.
    assert (forest.asked(tree, bins).argmax(axis=1) == label).mean() > 0.99
    feature, _, left, _ = tree
    assert sorted([0, *left[feature >= 0], *(left[feature >= 0] + 1)]) == list(range(len(feature)))


@pytest.fixture(scope="module")
def prepared(spark):
    rng = random.Random(8)
    rows = []
    for i in range(4000):
        cat, amount, year = rng.choice("abcde"), rng.gauss(0, 3), float(rng.randint(0, 6))
        y = rng.choice("xyz") if rng.random() < 0.1 else "x" if amount > 2 and cat != "a" else "y" if year < 2 else "z"
        rows.append((i, cat, amount, year, y))
    return train.prepare(spark.createDataFrame(rows, "id int, cat string, amount double, year double, y string").repartition(3), COLUMNS)


def told(model, df):
    rows = model.transform(df).select("digest", vector_to_array("probability").alias("p"), vector_to_array("rawPrediction").alias("r"), "prediction").collect()
    return {r.digest: (np.array(r.p), np.array(r.r), r.prediction) for r in rows}


@pytest.mark.parametrize("depth", [5, 12])
def test_counted_forest_answers_like_mllib(prepared, depth):
    counted = told(prepared.train(trees.counted_forest(trees=60, depth=depth, features=0.35)), prepared.ready)
    plain = told(prepared.train(trees.random_forest(trees=60, depth=depth)), prepared.ready)
    assert counted.keys() == plain.keys() and len(counted) == 4000
    assert np.mean([counted[d][2] == plain[d][2] for d in plain]) > 0.96
    assert np.mean([np.abs(counted[d][0] - plain[d][0]).mean() for d in plain]) < 0.03
    assert all(p.sum() == pytest.approx(1) and r == pytest.approx(60 * p) and at == p.argmax() for p, r, at in counted.values())


def test_answers_are_sums_over_all_trees(prepared):
    model = prepared.train(trees.counted_forest(trees=19, depth=8))
    grown = [t for r in model.trees.collect() for t in pickle.loads(r.pack)]
    assert len(grown) == 19
    got, rows = told(model, prepared.ready), forest.binned(prepared.ready, model.edges).select("digest", "cell").collect()
    bins = np.frombuffer(b"".join(bytes(r.cell) for r in rows), np.uint8).reshape(len(rows), -1)
    want = sum(forest.asked(t, bins) for t in grown)
    assert all(got[r.digest][1] == pytest.approx(w) for r, w in zip(rows, want))


def test_too_many_entries_are_fitted_by_rows(prepared, monkeypatch):
    monkeypatch.setattr(forest, "ENTRIES", 10)
    assert prepared.train(trees.counted_forest(trees=4, depth=3, parts=2)).getNumTrees == 4


class Seen(Exception):
    pass


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
@pytest.mark.parametrize("name", ["train_rf", "predict_confidence", "refit_evaluate", "train_gbt_ovr"])
def test_training_queries_fit_on_all_rows(spark, monkeypatch, name):
    def watch(self, df):
        raise Seen(df.count())

    monkeypatch.setattr(trees.CountedForest, "fit", watch)
    monkeypatch.setattr(trees.BoostedPerClass, "fit", watch)
    with pytest.raises(Seen) as seen:
        getattr(q_models, name)(spark, FOLDER)
    learn = q_models._split(spark, FOLDER)[0]
    if name == "refit_evaluate":
        learn = train_test(learn, ["o_orderkey"], 0.15, 42, by=["o_orderstatus"])[0]
    assert seen.value.args[0] == learn.count() > q_models.FIT_ROWS
