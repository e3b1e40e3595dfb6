import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
# Training queries take long; the model tests cover their parts on small frames.
SLOW = {"train_rf", "train_lr", "train_gbt_ovr", "train_mlp", "cross_validation", "grid_search", "random_search", "importance", "kmeans_select", "latent_cluster", "latent_knn", "importance_columns", "refit_evaluate", "predict_confidence", "rank_candidates"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query(spark, con, name):
    frame, sql = entry.queries()[name](spark, FOLDER), entry.oracle_sql().get(name)
    if sql is None:
        assert len(frame.columns) > 0 and frame.count() > 0
    else:
        problem, _ = differences(frame, con, sql)
        assert problem is None, problem


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
