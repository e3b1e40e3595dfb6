import json
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgerloom.models import clusters, evaluate, network, serve, train, trees
from ledgerloom.models.features import AssetFeatures, CategoryCollapser, PopulationScaler, QuantileBinner, feature_names, matrix_stages
from ledgerloom.sources import reports, results
from ledgerloom.sources.columns import prune_features

# A published 8-class confusion matrix and the metrics published with it.
LABELS = [
    "individual__commercial_services", "individual__industrial_ops", "individual__primary", "individual__public_social",
    "individual__unknown", "llc__commercial_services", "llc__industrial_ops", "llc__primary",
]
MATRIX = [
    [265, 6, 2, 3, 0, 5, 0, 0], [16, 33, 1, 0, 0, 0, 2, 1], [1, 1, 15, 0, 0, 0, 0, 1], [1, 1, 0, 8, 0, 0, 0, 0],
    [0, 0, 0, 0, 21, 0, 0, 0], [6, 0, 0, 0, 0, 84, 3, 1], [1, 1, 0, 0, 0, 5, 35, 0], [0, 0, 0, 0, 0, 1, 1, 5],
]


@pytest.fixture(scope="module")
def predictions(spark):
    cells = [(LABELS[i], LABELS[j], n) for i, row in enumerate(MATRIX) for j, n in enumerate(row) if n]
    df = spark.createDataFrame(cells, "truth string, prediction string, n int")
    return df.select("truth", "prediction", F.explode(F.sequence(F.lit(1), "n")).alias("i")).drop("i")


def test_published_metrics(predictions):
    got = evaluate.metric_summary(predictions, "truth", "prediction").first()
    assert got["accuracy"] == pytest.approx(0.8859315589353612, abs=1e-12)
    assert got["balanced_accuracy"] == pytest.approx(0.8300339262354475, abs=1e-12)
    assert got["macro_f1"] == pytest.approx(0.8271375167481438, abs=1e-12)
    assert got["weighted_f1"] == pytest.approx(0.8838538527715594, abs=1e-12)


def test_published_report_and_confusion(predictions):
    report = evaluate.class_report(predictions, "truth", "prediction")
    row = report.filter(F.col("label") == "llc__primary").first()
    assert (row["precision"], row["recall"], row["support"]) == (0.625, pytest.approx(5 / 7), 7)
    weighted = evaluate.report_averages(report).filter("average = 'weighted avg'").first()
    assert weighted["precision"] == pytest.approx(0.8840986587353983, abs=1e-12)
    grid = {(r["truth"], r["prediction"]): r["count"] for r in evaluate.confusion(predictions, "truth", "prediction").collect()}
    assert [[grid[(a, b)] for b in LABELS] for a in LABELS] == MATRIX


def test_empty_classes_count_as_zero(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "t string, p string")
    got = {r["label"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in evaluate.class_report(df, "t", "p").collect()}
    assert got["b"] == (0.0, 0.0, 0.0, 0) and got["c"] == (0.0, 0.0, 0.0, 1)


def test_published_fold_summary(spark):
    scores = [0.8832553550107881, 0.9026806467496217, 0.9131190704720116, 0.8589055132335129, 0.9439901742203443]
    folds = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "fold int, macro_f1 double")
    got = evaluate.fold_summary(folds, ["macro_f1"]).first()
    assert (got["mean"], got["std"]) == (pytest.approx(0.9003901519372558), pytest.approx(0.028575549656050712))


def test_published_k_choice_and_trace(spark):
    silhouettes = [0.17090367161247097, 0.17093867684763558, 0.18790483407036726, 0.15465002627005944, 0.17001143771952554, 0.17546018245069597]
    log = spark.createDataFrame([(k, s) for k, s in enumerate(silhouettes, start=3)], "trial int, score double")
    assert evaluate.best_trial(log).first()["trial"] == 5
    trace = evaluate.search_trace(log).orderBy("trial").collect()
    assert [r["best_so_far"] for r in trace] == silhouettes[:3] + [silhouettes[2]] * 3 and trace[-1]["baseline"] == silhouettes[0]


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "y string")
    assert {r["label"]: r["weight"] for r in evaluate.class_weights(df, "y").collect()} == {"a": pytest.approx(8 / 12), "b": 2.0}


def test_external_scores_of_equal_partitions(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 3)], "t string, c int")
    got = evaluate.external_scores(df, "t", "c").first()
    assert (got["ari"], got["nmi"]) == (pytest.approx(1.0), pytest.approx(1.0))


def test_collapser_rare_and_unseen(spark, tmp_path):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 5, "c string")
    new = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    plain = CategoryCollapser(inputCols=["c"], threshold=5).fit(df).transform(new)
    assert [r[0] for r in plain.collect()] == ["a", "__rare__", "__rare__", "__missing__"]
    apart = CategoryCollapser(inputCols=["c"], threshold=5, unseenApart=True).fit(df).transform(new)
    assert [r[0] for r in apart.collect()] == ["a", "__rare__", "z", "__missing__"]
    for unseen_apart, want in [(False, ["__missing__", "__rare__", "__rare__", "a"]), (True, ["__missing__", "__rare__", "a", "z"])]:
        as_table = CategoryCollapser(inputCols=["c"], threshold=5, unseenApart=unseen_apart, listed=1).fit(df)
        assert sorted(r[0] for r in as_table.transform(new).collect()) == want
        as_table.write().overwrite().save(str(tmp_path / "stage"))
        assert sorted(r[0] for r in type(as_table).load(str(tmp_path / "stage")).transform(new).collect()) == want


def test_long_category_list_reloads_in_a_pipeline(spark, tmp_path):
    df = spark.range(3000).selectExpr("'v' || (id % 1000) AS c", "double(id) AS n")
    model = Pipeline(stages=[CategoryCollapser(inputCols=["c"], threshold=3, listed=100)]).fit(df)
    model.write().overwrite().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    new = spark.createDataFrame([("v7",), ("other",)], "c string")
    assert sorted(r.c for r in again.transform(new).collect()) == ["__rare__", "v7"]


def test_forest_depth_is_never_cut():
    with pytest.raises(ValueError):
        trees.random_forest(depth=31)


def test_internal_scores_of_coinciding_centroids(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(Vectors.dense([0.0]), 0), (Vectors.dense([2.0]), 0), (Vectors.dense([1.0]), 1), (Vectors.dense([1.0]), 1), (Vectors.dense([9.0]), 2)]
    got = evaluate.internal_scores(spark.createDataFrame(rows, ["v", "c"]), "v", "c").first()
    assert got.davies_bouldin > 0 and got.calinski_harabasz > 0
    flat = evaluate.internal_scores(spark.createDataFrame([(Vectors.dense([0.0]), 0), (Vectors.dense([5.0]), 1), (Vectors.dense([5.0]), 1)], ["v", "c"]), "v", "c").first()
    assert flat.calinski_harabasz == 1.0


def test_matrix_stages_and_reload(spark, tmp_path):
    df = spark.createDataFrame([("a" if i < 6 else "b", float(i)) for i in range(12)], "c string, n double")
    model = Pipeline(stages=matrix_stages(["c"], ["n"], 5)).fit(df)
    new = spark.createDataFrame([("a", None), ("z", 3.0)], "c string, n double")
    want = [r["features"] for r in model.transform(new).collect()]
    assert want[0].toArray().tolist() == [1.0, 0.0, 0.0] and want[1].toArray()[:2].tolist() == [0.0, 0.0]
    reports.save_model(model, str(tmp_path / "m"), {"classes": 2})
    again = reports.load_model(str(tmp_path / "m"))
    assert isinstance(again, PipelineModel) and [r["features"] for r in again.transform(new).collect()] == want
    assert len(feature_names(model.transform(df))) == 3
    assert json.loads(spark.read.text(str(tmp_path / "m_metadata")).first()[0]) == {"classes": 2}


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(float(i), 1.0) for i in range(1, 13)], "v double, flat double")
    out = QuantileBinner(inputCols=["v", "flat"], bins=3).fit(df).transform(df.unionByName(spark.createDataFrame([(None, None), (99.0, 1.0)], "v double, flat double")))
    assert "flat_bin" not in out.columns
    got = {r["v"]: r["v_bin"] for r in out.collect()}
    assert got[1.0] == "1" and got[4.0] == "1" and got[5.0] == "2" and got[99.0] == "3" and got[None] == "__missing__"


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "v double, flat double")
    rows = PopulationScaler(inputCols=["v", "flat"]).fit(df).transform(df).collect()
    assert [r["v_scaled"] for r in rows] == [pytest.approx(-(1.5**0.5)), pytest.approx(1.5**0.5), 0.0]
    assert {r["flat_scaled"] for r in rows} == {0.0}


def test_asset_features_add_what_is_absent(spark):
    stage = AssetFeatures.build("o", "l", "p", "c", ["c", "t"], [("tok", "land")])
    row = stage.transform(spark.createDataFrame([("4", " TOKE ")], "o string, c string")).first()
    assert (row["total_area_m2_custom"], row["is_object_only_custom"], row["c"], row["t"], row["asset_type_bucket_custom"]) == (4.0, 1, "toke", None, "land")
    assert row["price_per_total_m2_custom"] == 0.0 and row["log_price_custom"] == 0.0


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, "x" if i % 3 else "y", float(i % 10), "big" if (i % 10) > 6 else ("odd" if i % 3 == 0 else "small")) for i in range(240)]
    return spark.createDataFrame(rows, "id int, c string, n double, label_text string")


COLUMNS = train.Columns("label_text", ("c",), ("n",), ("id",))


@pytest.mark.parametrize("make", [
    lambda: trees.random_forest(trees=5, depth=5), lambda: train.logistic(iterations=60),
    lambda: trees.boosted_trees(iterations=2, depth=3), lambda: train.perceptron(hidden=(8,), iterations=60),
], ids=["forest", "logistic", "boosted", "perceptron"])
def test_classifiers_learn(labelled, make):
    fitted = train.fit(labelled, COLUMNS, make())
    scores = evaluate.metric_summary(fitted.score(labelled), "label_text", "predicted").first()
    assert scores["accuracy"] > 0.75 and fitted.labels == ["big", "odd", "small"]


def test_cross_validation_and_importance(spark, labelled):
    forest = trees.random_forest(trees=5, depth=5)
    assert train.cross_validate(labelled, COLUMNS, forest, k=2).count() == 2
    importance = train.importance_frame(spark, train.fit(labelled, COLUMNS, forest), labelled)
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_refit_measures_three_parts(labelled):
    whole, table = train.refit(labelled.filter("id % 5 <> 0"), labelled.filter("id % 5 = 0"), COLUMNS, trees.random_forest(trees=5, depth=5))
    assert sorted((r["fit"], r["part"]) for r in table.collect()) == [("all", "test"), ("share", "test"), ("share", "validation")]
    told = evaluate.prediction_table(whole.score(labelled), "label_text", "predicted", "probability", keep=["id"])
    assert told.filter("confidence between 0.3 and 1 and is_correct in (0, 1)").count() == 240


def test_pruning_by_importance(spark):
    importance = spark.createDataFrame([("a", 0.5), ("b", 0.0)], "feature string, importance double")
    assert prune_features(["a", "b", "c"], importance) == ["a", "c"]


def test_random_configs_are_seeded():
    space = {"a": [1, 2, 3], "b": [4, 5]}
    assert train.random_configs(space, 4) == train.random_configs(space, 4)


def test_kmeans_search_finds_the_groups(spark):
    rows = [(i, Vectors.dense([i % 3 * 10 + (i % 7) / 10, i % 3 * -5 + (i % 5) / 10])) for i in range(90)]
    model, table = clusters.kmeans_search(spark.createDataFrame(rows, ["id", "v"]), "v", range(2, 5), restarts=2)
    assert len(model.clusterCenters()) == 3 and table.count() == 3
    found = model.transform(spark.createDataFrame(rows, ["id", "v"])).selectExpr("id % 3 AS g", "cluster").distinct().collect()
    assert len(found) == 3 == len({r.cluster for r in found})


def test_many_starts_match_separate_fits(spark):
    from pyspark.ml.clustering import KMeans

    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(40, 3)) + c for c in ([0, 0, 0], [9, 0, 0], [0, 9, 0], [0, 0, 9], [9, 9, 9])])
    df = spark.createDataFrame([(Vectors.dense(p),) for p in points], ["v"]).repartition(3)
    found = clusters.many_starts(df, "v", [2, 5], restarts=6)
    for k, (centres, cost) in found.items():
        best = min((KMeans(featuresCol="v", k=k, seed=s).fit(df) for s in range(6)), key=lambda m: m.summary.trainingCost)
        plain = ((points[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()
        assert cost == pytest.approx(plain) and cost <= best.summary.trainingCost * 1.0001
    assert sorted(map(tuple, np.round(found[5][0]).tolist())) == sorted([(0, 0, 0), (9, 0, 0), (0, 9, 0), (0, 0, 9), (9, 9, 9)])


def test_many_starts_take_the_steps_of_full_scans(spark, monkeypatch):
    """Rows far from a border are not measured again, and the centres are those of plain rounds."""
    rng = np.random.default_rng(6)
    points = rng.normal(size=(900, 2))
    points[:40] = points[40:80]
    df = spark.createDataFrame([(Vectors.dense(p),) for p in points], ["v"])
    begun, measured, scans, seeded, drifted, scan = [], [], [], clusters._seeded, clusters._drifted, clusters._scan
    monkeypatch.setattr(clusters, "_seeded", lambda *a: begun.append(seeded(*a)) or begun[-1])
    monkeypatch.setattr(clusters, "_drifted", lambda state, sets, *a: (out := drifted(state, sets, *a), measured.append(out[1] / (900 * len(sets))))[0])
    monkeypatch.setattr(clusters, "_scan", lambda *a, **o: scans.append(1) or scan(*a, **o))
    found = clusters.many_starts(df, "v", [3, 6], restarts=2, iterations=40)
    ends = {3: [], 6: []}
    for centres in begun:
        for _ in range(40):
            far = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
            new = np.array([points[far.argmin(axis=1) == c].mean(axis=0) for c in range(len(centres))])
            still, centres = ((new - centres) ** 2).sum(axis=1).max() <= clusters.TOLERANCE**2, new
            if still:
                break
        ends[len(centres)].append((((points[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum(), centres))
    for k, (centres, cost) in found.items():
        best = min(ends[k], key=lambda e: e[0])
        assert cost == pytest.approx(best[0], rel=1e-12) and np.allclose(centres, best[1], atol=1e-9)
    assert len(scans) < len(measured) and np.mean(measured) < 0.3


@pytest.mark.parametrize("dims,block", [(2, 7), (20, 1000)])
def test_silhouettes_equal_brute_force(spark, dims, block):

    rng = np.random.default_rng(dims)
    points, ways = rng.normal(size=(60, dims)), [rng.integers(0, 3, 60), np.append(rng.integers(0, 2, 59), 7)]
    df = spark.createDataFrame([(Vectors.dense(p), int(a), int(b)) for p, a, b in zip(points, *ways)], ["v", "a", "b"])
    got = clusters.silhouettes(df, "v", ["a", "b"], block=block)
    far = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    for name, own in zip("ab", ways):
        values = []
        for i in range(60):
            mine = (own == own[i]) & (np.arange(60) != i)
            a = far[i, mine].mean() if mine.any() else None
            b = min(far[i, own == c].mean() for c in set(own) - {own[i]})
            values.append(0.0 if a is None else (b - a) / max(a, b))
        assert got[name] == pytest.approx(np.mean(values))


def test_clustering_takes_starts_and_silhouettes_from_all_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(10_500, 2))
    points[:2] = [1e4, 0], [1e4, 1]
    df = spark.createDataFrame([(Vectors.dense(p), int(p[1] > 0)) for p in points], ["v", "c"]).repartition(3)
    begun, seeded = [], clusters._seeded
    monkeypatch.setattr(clusters, "_seeded", lambda *a: begun.append(seeded(*a)) or begun[-1])
    clusters.many_starts(df, "v", [2], restarts=6, iterations=2)
    # The two far rows are a centre of every start, whatever their digest.
    assert all(sorted(c[:, 0] > 1e3) == [False, True] for c in begun)
    own, total = points[:, 1] > 0, 0.0
    for i in range(0, len(points), 500):
        some = points[i : i + 500]
        far = np.sqrt(((some[:, None] - points[None]) ** 2).sum(axis=2))
        yes, no = far[:, own].sum(axis=1), far[:, ~own].sum(axis=1)
        mine, n = own[i : i + 500], own.sum()
        a = np.where(mine, yes / (n - 1), no / (len(points) - n - 1))
        b = np.where(mine, no / (len(points) - n), yes / n)
        total += ((b - a) / np.maximum(a, b)).sum()
    assert clusters.silhouettes(df, "v", ["c"])["c"] == pytest.approx(total / len(points), rel=1e-9)


def test_latent_stage_is_fitted_on_training_rows(spark, tmp_path):

    rng = np.random.default_rng(3)
    points = rng.normal(size=(80, 4)) * [5, 1, 0.1, 0.1]
    df = spark.createDataFrame([(i, Vectors.dense(p), "ab"[i % 2]) for i, p in enumerate(points)], ["id", "v", "y"])
    table, stage = clusters.latent_table(df, "v", "id", "y", k=2, clusters=3, restarts=2)
    held = {r.id for r in table.filter("is_test = 1").collect()}
    assert len(held) == 16 and table.count() == 80 and table.filter("y = 'a' and is_test = 1").count() == 8
    # Held-out rows far off leave the components, the mean and the centres where they were.
    moved = spark.createDataFrame([(i, Vectors.dense([0, 0, 900, 900]) if i in held else Vectors.dense(p), "ab"[i % 2]) for i, p in enumerate(points)], ["id", "v", "y"])
    _, again = clusters.latent_table(moved, "v", "id", "y", k=2, clusters=3, restarts=2)
    for a, b in zip((stage.stages[0].mean, stage.stages[1].pc), (again.stages[0].mean, again.stages[1].pc)):
        assert np.allclose(a.toArray(), b.toArray())
    assert np.allclose(stage.stages[2].clusterCenters(), again.stages[2].clusterCenters())
    stage.write().overwrite().save(str(tmp_path / "latent"))
    saved = PipelineModel.load(str(tmp_path / "latent")).transform(df)
    assert {(r.id, r.cluster) for r in saved.collect()} == {(r.id, r.cluster) for r in table.collect()}


def test_forest_in_parts_is_one_forest(labelled):
    fitted = train.fit(labelled, COLUMNS, trees.random_forest(trees=7, depth=5, parts=3))
    assert fitted.model.stages[-2].getNumTrees == 7
    assert sum(fitted.model.stages[-2].featureImportances.toArray()) == pytest.approx(1.0)
    assert evaluate.metric_summary(fitted.score(labelled), "label_text", "predicted").first()["accuracy"] > 0.75


def test_fit_is_bounded_by_least_digests(labelled):
    few = train.least_digests(labelled, ["id"], 50)
    assert few.count() == 50 and few.rdd.getNumPartitions() == 1
    assert {r.id for r in few.collect()} == {r.id for r in train.least_digests(labelled.repartition(5), ["id"], 50).collect()}
    seen = []

    class Watch:
        def fit(self, df):
            seen.append(df.count())
            return trees.random_forest(trees=2, depth=3).fit(df)

    train.fit(labelled, COLUMNS, Watch(), rows=50)
    assert seen == [50]


def test_penalty_follows_the_weight_of_the_rows_fitted_on(labelled):
    seen = []

    def build(shape):
        seen.append(shape)
        return train.logistic(c=2.0)(shape)

    train.fit(labelled.filter("id < 120"), COLUMNS, build)
    assert seen[0].weight == pytest.approx(120) and seen[0].classes == 3
    assert build(seen[0]).getRegParam() == pytest.approx(1 / 240)


def test_ordered_target_statistics(spark):
    from ledgerloom.models.target_stats import OrderedTargetEncoder

    rows = [("ab" [i % 2] if i % 5 else None, float(i % 3 == 0), (i * 7919) % 101 * (1 << 56) - (1 << 62)) for i in range(60)]
    df = spark.createDataFrame(rows, "c string, label double, digest long").repartition(4)
    model = OrderedTargetEncoder(inputCols=["c"], smoothing=2.0).fit(df)
    share = sum(y for _, y, _ in rows) / len(rows)
    assert model.output_columns() == ["c_stat0", "c_stat1"]
    for bits in (12, 1):
        got = sorted((str(r.c), r.digest, r.label, round(r.c_stat1, 9), round(r.c_stat0, 9)) for r in model.encode_training(df, bits).collect())
        # Blocks of digests go in the order of their bits, read as a number without sign.
        place = lambda d: ((d % (1 << 64)) >> (64 - bits), d)
        want = []
        for c, y, d in rows:
            before = [v for k, v, e in rows if k == c and place(e) < place(d)]
            stat = (sum(before) + 2 * share) / (len(before) + 2)
            want.append((str(c), d, y, round(stat, 9), round((len(before) - sum(before) + 2 * (1 - share)) / (len(before) + 2), 9)))
        assert got == sorted(want)
    new = model.transform(spark.createDataFrame([("a",), (None,), ("z",)], "c string"))
    mine = [y for k, y, _ in rows if k == "a"]
    assert new.filter("c = 'a'").first().c_stat1 == pytest.approx((sum(mine) + 2 * share) / (len(mine) + 2))
    assert new.filter("c = 'z'").first().c_stat1 == pytest.approx(share)
    with pytest.raises(ValueError):
        OrderedTargetEncoder(inputCols=["c"], most=2).fit(df)


def test_boosting_takes_many_categories_and_stops_early(spark):
    rows = [(i, f"v{i % 500}", float(i % 7), "yes" if ((i % 500) % 3 == 0) != (i % 11 == 0) else "no") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, c string, n double, y string")
    cols = train.Columns("y", ("c",), ("n",), ("id",))
    fitted = train.fit(df, cols, trees.boosted_trees(iterations=60, depth=6, step=0.3), targets=True, scale=False)
    assert evaluate.metric_summary(fitted.score(df), "y", "predicted").first()["accuracy"] > 0.85
    assert all(m.getNumTrees < 60 for m in fitted.model.stages[-2].models)
    by_column = {r.feature: r.importance for r in train.importance_frame(spark, fitted, df, by_column=True).collect()}
    assert set(by_column) == {"c", "n"} and by_column["c"] > by_column["n"]
    # Categories as indexes: a bin for each.
    assert train.fit(df, cols, trees.boosted_trees(iterations=1, depth=2), ordinal=True, scale=False).labels == ["no", "yes"]


def test_importance_by_column_prunes_a_constant(spark, labelled):
    df = labelled.withColumn("same", F.lit(3.0))
    cols = train.Columns("label_text", ("c",), ("n", "same"), ("id",))
    for classifier in (trees.random_forest(trees=5, depth=5), train.logistic(iterations=60)):
        fitted = train.fit(df, cols, classifier)
        importance = train.importance_frame(spark, fitted, df, by_column=True)
        assert {r.feature for r in importance.collect()} == {"c", "n", "same"}
        assert train.prune(cols, importance, 1e-9) == train.Columns("label_text", ("c",), ("n",), ("id",))


def test_search_goes_on_where_it_stopped(spark, labelled, tmp_path):
    configs, built, log = [{"depth": 1}, {"depth": 3}, {"depth": 5}], [], str(tmp_path / "log")

    def build(c):
        built.append(c["depth"])
        if c["depth"] == 5 and len(set(built)) == 3 and not resumed:
            raise RuntimeError("killed")
        return trees.random_forest(trees=3, depth=c["depth"])

    resumed = False
    with pytest.raises(RuntimeError):
        train.search(labelled, COLUMNS, build, configs, k=2, rows=120, log=log, parallelism=1)
    assert train.trial_log(spark, log).count() == 4
    resumed, built[:] = True, []
    table = train.search(labelled, COLUMNS, build, configs, k=2, rows=120, log=log)
    assert built == [5, 5] and [r.trial for r in table.orderBy("trial").collect()] == [0, 1, 2]
    built.clear()
    again = train.search(labelled, COLUMNS, build, configs, k=2, rows=120, log=log)
    assert not built and sorted(map(tuple, again.collect())) == sorted(map(tuple, table.collect()))
    plain = train.search(labelled, COLUMNS, build, configs, k=2, rows=120)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, table.collect()))
    built.clear()
    train.search(labelled, COLUMNS, build, configs[:1], k=2, rows=100, log=log)
    assert built == [1, 1]


def test_top_candidates(spark):
    df = spark.createDataFrame([(1, [0.1, 0.5, 0.4]), (2, [0.4, 0.2, 0.4])], "id int, p array<double>")
    top = lambda **o: [tuple(r) for r in serve.top_candidates(df, ["id"], F.col("p"), ["b", "OTHER", "a"], catch_all="OTHER", **o).orderBy("id", "rank").collect()]
    assert top(k=2) == [(1, 1, "OTHER", 0.5, 0.5), (1, 2, "a", 0.4, 0.5), (2, 1, "a", 0.4, 0.2), (2, 2, "b", 0.4, 0.2)]
    assert top(k=2, exclude_catch_all=True)[:2] == [(1, 1, "a", 0.4, 0.5), (1, 2, "b", 0.1, 0.5)]
    assert top(min_probability=0.9) == []


def test_metric_artefacts_of_three_layouts(spark, tmp_path):
    docs = {
        "nested": {"test": {"accuracy": 0.9, "balanced_accuracy": 0.8, "macro_f1": 0.7}, "cv_summary": {"weighted_f1": {"mean": 0.6, "std": 0.1}}},
        "flat": {"accuracy": 0.5, "macro_f1": 0.4},
        "held": {"holdout": {"accuracy": 0.3}},
    }
    paths = {}
    for name, doc in docs.items():
        paths[name] = str(tmp_path / f"{name}.json")
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=1))
    sibling = tmp_path / "cv.json"
    sibling.write_text(json.dumps({"summary": {"macro_f1": {"mean": 0.45}}}))
    got = {(r["model"], r["scope"], r["metric"]): r["value"] for r in reports.read_metrics(spark, paths, {"flat": str(sibling)}).collect()}
    assert got[("nested", "test", "accuracy")] == 0.9 and got[("nested", "test", "weighted_f1")] == 0.6
    assert got[("flat", "test", "macro_f1")] == 0.4 and got[("flat", "cv", "macro_f1")] == 0.45 and got[("flat", "test", "weighted_f1")] == 0.0
    assert got[("held", "test", "accuracy")] == 0.3


def test_cross_validation_artefacts(spark, tmp_path):
    docs = {
        "nested": {"cv_summary": {"macro_f1": {"mean": 0.6, "std": 0.1}, "accuracy": {"mean": 0.7}}},
        "suffixed": {"cv_summary": {"macro_f1_mean": 0.5, "macro_f1_std": 0.02, "weighted_f1": 0.4}},
        "sibling": {"accuracy": 0.9}, "none": {"cv_summary": "see elsewhere"},
    }
    paths = {name: str(tmp_path / f"{name}.json") for name in docs}
    for name, doc in docs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "cv.json").write_text(json.dumps({"summary": {"macro_f1": {"mean": 0.45, "std": 0.03}}}))
    got = {(r["model"], r["metric"]): (r["mean"], r["std"]) for r in reports.read_cv(spark, paths, {"sibling": str(tmp_path / "cv.json")}).collect()}
    assert got == {
        ("nested", "macro_f1"): (0.6, 0.1), ("nested", "accuracy"): (0.7, 0.0), ("suffixed", "macro_f1"): (0.5, 0.02),
        ("suffixed", "weighted_f1"): (0.4, 0.0), ("sibling", "macro_f1"): (0.45, 0.03),
    }


def test_shrinkage_counts_features(spark):
    before = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "x")], "model string, feature string")
    got = evaluate.feature_shrinkage(before, before.filter("feature = 'y'")).orderBy("model").collect()
    assert [tuple(r) for r in got] == [("a", 2, 1, 1), ("b", 1, 0, 1)]


def test_result_sinks(spark, tmp_path):
    rows = [(1, "a", "a", Vectors.dense([0.9, 0.1]), [1, 2], 3), (2, "b", "a", Vectors.dense([0.6, 0.4]), [], 4), (3, None, "a", Vectors.dense([0.5, 0.5]), None, 4)]
    df = spark.createDataFrame(rows, ["id", "truth", "predicted", "probability", "tags", "cluster"])
    results.write_predictions(df, f"{tmp_path}/predictions", "truth", probability="probability")
    got = spark.read.option("header", True).csv(f"{tmp_path}/predictions").orderBy("id").collect()
    assert [(r["truth"], r["predicted_label"], r["is_correct"], float(r["prediction_confidence"]), r["tags"]) for r in got] == [
        ("a", "a", "true", 0.9, "[1,2]"), ("b", "a", "false", 0.6, "[]"), (None, "a", "false", 0.5, None)]
    results.write_assignments(df, f"{tmp_path}/assignments")
    assert spark.read.option("header", True).csv(f"{tmp_path}/assignments").filter("cluster_id = 4").count() == 2
    results.write_importance(spark.createDataFrame([("x", 0.2), ("y", 0.8)], "feature string, importance double"), f"{tmp_path}/importance")
    assert [r["feature"] for r in spark.read.option("header", True).csv(f"{tmp_path}/importance").collect()] == ["y", "x"]
    results.write_latent(df.select("id", F.col("probability").alias("z"), F.lit("train").alias("split")), f"{tmp_path}/latent")
    assert spark.read.parquet(f"{tmp_path}/latent").filter("split = 'train' AND size(z) = 2").count() == 3


def test_settings_of_the_reference():
    from ledgerloom.plans import q_models as Q

    assert len(Q.LOGISTIC_GRID) == 10 and Q.FOLDS == 5
    assert (Q.FOREST, Q.BOOSTING["iterations"], Q.NETWORK["hidden"]) == ({"trees": 1200, "depth": 24}, 2500, (256, 128, 64))
    assert (list(Q.KMEANS["ks"]), Q.KMEANS["restarts"], Q.KMEANS["iterations"]) == (list(range(3, 11)), 20, 500)


# ---- network ----------------------------------------------------------------

def test_network_gradient_equals_finite_differences():
    rng = np.random.default_rng(1)
    sizes, x, y, weight = [4, 5, 3, 2], rng.normal(size=(20, 4)), rng.integers(0, 2, 20), rng.uniform(0.2, 3, 20)
    flat = network.started(sizes, 2) + rng.normal(0, 0.1, len(network.started(sizes, 2)))
    loss, gradient = network.loss_and_gradient(x, y, weight, flat, sizes)
    for at in range(len(flat)):
        moved = flat.copy()
        moved[at] += 1e-6
        assert (network.loss_and_gradient(x, y, weight, moved, sizes)[0] - loss) / 1e-6 == pytest.approx(gradient[at], abs=1e-3)


def test_weight_counts_as_repeats():
    rng = np.random.default_rng(2)
    sizes, x, y = [3, 4, 2], rng.normal(size=(10, 3)), rng.integers(0, 2, 10)
    flat, times = network.started(sizes, 1), rng.integers(1, 4, 10)
    once = network.loss_and_gradient(x, y, times / 2, flat, sizes)
    again = network.loss_and_gradient(np.repeat(x, times, axis=0), np.repeat(y, times), np.full(times.sum(), 0.5), flat, sizes)
    assert once[0] == pytest.approx(again[0]) and once[1] == pytest.approx(again[1])


def test_network_learns_in_bands_and_saves(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(Vectors.dense(v), float((v[0] > 0) != (v[1] > 0)), 1.0, i) for i, v in enumerate(rng.uniform(-1, 1, (600, 2)).tolist())]
    df = spark.createDataFrame(rows, ["features", "label", "weight", "digest"])
    model = network.WeightedNetwork(2, 2, (16,), iterations=30, rate=0.05, batch_rows=250).fit(df)
    model.save(f"{tmp_path}/network")
    told = network.NetworkModel.load(f"{tmp_path}/network").transform(df)
    assert told.filter("label = prediction").count() > 540
    assert told.select(F.max(F.abs(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x) - 1))).first()[0] < 1e-9


def test_network_stops_when_kept_out_rows_get_worse(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(Vectors.dense(rng.normal(size=6).tolist()), float(rng.integers(0, 2)), 1.0, i) for i in range(80)]
    steps, summed = [], network._summed
    monkeypatch.setattr(network, "_summed", lambda *a: steps.append(1) or summed(*a))
    network.WeightedNetwork(6, 2, (16,), iterations=60, rate=0.1, share=0.3, patience=3).fit(spark.createDataFrame(rows, ["features", "label", "weight", "digest"]))
    assert 3 < len(steps) < 40


def test_network_deals_each_band_evenly_to_all_tasks(spark):
    # Four bands on four cores: with both told from one hash, each band was one file, read by one task.
    df = spark.range(8192).select(array_to_vector(F.array(F.rand(1), F.rand(2))).alias("features"), F.lit(0.0).alias("label"), F.lit(1.0).alias("weight"), F.col("id").alias("digest"))
    blocks, bands, tasks = network.WeightedNetwork(2, 2, batch_rows=2048)._banded(df, 8)
    shares = blocks.glom().map(lambda rows: sum(len(r[0]) // 40 for r in rows)).collect()
    assert (bands, tasks, sum(shares)) == (4, 4, 8192) and 400 < min(shares) <= max(shares) < 640


def test_network_step_adds_up_all_shares_of_a_band(spark):
    rng = np.random.default_rng(5)
    x, y, weight = rng.normal(size=(3000, 3)), rng.integers(0, 2, 3000), rng.uniform(0.5, 2, 3000)
    df = spark.createDataFrame([(Vectors.dense(v), float(c), w, i) for i, (v, c, w) in enumerate(zip(x.tolist(), y, weight.tolist()))], ["features", "label", "weight", "digest"])
    sizes = [3, 5, 2]
    flat = network.started(sizes, 6)
    blocks, bands, tasks = network.WeightedNetwork(3, 2, (5,), share=0.0, batch_rows=1500)._banded(df, flat.nbytes)
    found = [network._summed(blocks, range(band * tasks, (band + 1) * tasks), flat, sizes) for band in range(bands)]
    assert bands == 2 and tasks > 1 and sum(f[1] for f in found) == pytest.approx(weight.sum())
    assert sum(f[0] for f in found) == pytest.approx(network.loss_and_gradient(x, y, weight, flat, sizes)[1])


def asked_by_row(fitted, ready, kind):
    """What the model says when each row is asked by itself."""
    return kind._transform(fitted, ready)


@pytest.mark.parametrize("named", [False, True], ids=["continuous", "nominal"])
def test_cells_of_a_forest_answer_as_its_rows(spark, named, monkeypatch):
    from pyspark.ml.classification import RandomForestClassificationModel

    rng = random.Random(8)
    rows = [(i, rng.choice("abcde"), rng.gauss(0, 3), float(rng.randint(0, 6)), rng.choice("xyz")) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, cat string, amount double, year double, y string")
    cols = train.Columns("y", ("cat",), ("amount", "year"), ("id",))
    prepared = train.prepare(df, cols, ordinal=named)
    model = prepared.train(trees.random_forest(trees=12, depth=8, parts=3))
    told = lambda d: {r.digest: (r.p, r.r, r.prediction) for r in d.select("digest", vector_to_array("probability").alias("p"), vector_to_array("rawPrediction").alias("r"), "prediction").collect()}
    want = told(asked_by_row(model, prepared.ready, RandomForestClassificationModel))
    asked = []
    ask = RandomForestClassificationModel._transform
    monkeypatch.setattr(RandomForestClassificationModel, "_transform", lambda self, d: (asked.append(d.count()), ask(self, d))[1])
    twice = prepared.ready.unionByName(prepared.ready)
    got = model.transform(twice)
    assert got.columns == [*prepared.ready.columns, "rawPrediction", "probability", "prediction"]
    assert told(got) == want and got.count() == 800
    assert 1 < len(set(map(str, want.values()))) <= asked[0] <= 400


def test_thresholds_hold_all_categories_up_to_the_named_ones():
    told = "If (feature 2 <= -1.5E-4)\n If (feature 0 in {1.0,3.0})\n Else (feature 0 not in {1.0,3.0})\nElse (feature 2 > -1.5E-4)\n If (feature 2 <= 7.0)"
    assert trees.thresholds([told]) == {0: [0.0, 1.0, 2.0, 3.0], 2: [-1.5e-4, 7.0]}
    assert trees.thresholds(["Predict: 0.0"]) == {}


def test_cells_of_boosted_models_answer_as_their_rows(spark):
    from pyspark.ml.classification import OneVsRestModel

    rng = random.Random(3)
    rows = [(i, rng.choice("abcde"), rng.gauss(0, 3), rng.choice("xyz")) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, cat string, amount double, y string")
    prepared = train.prepare(df, train.Columns("y", ("cat",), ("amount",), ("id",)), targets=True, scale=False)
    model = prepared.train(trees.boosted_trees(iterations=4, depth=3))
    told = lambda d: {r.digest: r.prediction for r in d.select("digest", "prediction").collect()}
    got, want = told(model.transform(prepared.ready)), told(asked_by_row(model, prepared.ready, OneVsRestModel))
    assert got == want and len(set(want.values())) > 1
