"""Catalogue: model features, training, evaluation, clustering, comparison."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ledgerloom.models import clusters, evaluate, serve, train, trees
from ledgerloom.models.features import (
    AssetFeatures,
    CategoryCollapser,
    PopulationScaler,
    QuantileBinner,
    one_hot_stages,
    ordinal_stage,
    pca_projection,
)
from ledgerloom.operators import split
from ledgerloom.plans.registry import query, table
from ledgerloom.session import cut_lineage

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
KEYS = KEY.split(", ")


# ---- features ---------------------------------------------------------------

def _halves(spark, d):
    """Line items with a text category; lines with status F are the training part."""
    li = table(spark, d, "lineitem").select(*KEYS, "l_linestatus", (F.col("l_partkey") % 97 * F.col("l_suppkey") % 89).cast("string").alias("cat"), "l_extendedprice", "l_quantity", "l_tax")
    li = li.withColumn("cat", F.when(F.col("l_partkey") % 31 != 0, F.col("cat")))
    return li.filter("l_linestatus = 'F'"), li


HALVES = """halves AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus, l_extendedprice, l_quantity, l_tax,
    coalesce(CASE WHEN l_partkey % 31 <> 0 THEN CAST(l_partkey % 97 * l_suppkey % 89 AS VARCHAR) END, '__missing__') AS cat FROM lineitem),
  seen AS (SELECT cat, count(*) AS c FROM halves WHERE l_linestatus = 'F' GROUP BY 1)"""


@query("rare_category", f"""WITH {HALVES} SELECT {KEY}, CASE WHEN coalesce(c, 0) >= 100 THEN cat ELSE '__rare__' END AS cat FROM halves LEFT JOIN seen USING (cat)""")
def rare_category(spark, d):
    part, whole = _halves(spark, d)
    return CategoryCollapser(inputCols=["cat"], threshold=100).fit(part).transform(whole).select(*KEYS, "cat")


@query("quantile_bins", f"""WITH e AS (SELECT quantile_cont(l_extendedprice, [1/6, 2/6, 3/6, 4/6, 5/6]) AS q FROM lineitem WHERE l_linestatus = 'F')
SELECT {KEY}, CAST(1 + len(list_filter(q, lambda x: l_extendedprice > x)) AS VARCHAR) AS price_bin FROM lineitem, e""")
def quantile_bins(spark, d):
    part, whole = _halves(spark, d)
    binned = QuantileBinner(inputCols=["l_extendedprice", "l_tax"]).fit(part).transform(whole)
    return binned.select(*KEYS, F.col("l_extendedprice_bin").alias("price_bin"))


@query("standardize", f"""WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM lineitem WHERE l_linestatus = 'F')
SELECT {KEY}, round((l_extendedprice - m) / s, 6) AS scaled FROM lineitem, s""")
def standardize(spark, d):
    part, whole = _halves(spark, d)
    scaled = PopulationScaler(inputCols=["l_extendedprice"]).fit(part).transform(whole)
    return scaled.select(*KEYS, F.round("l_extendedprice_scaled", 6).alias("scaled"))


@query("ordinal_encode", """WITH seen AS (SELECT o_orderpriority AS p, row_number() OVER (ORDER BY o_orderpriority) - 1 AS i FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '3-MEDIUM'))
SELECT o_orderkey, CAST(coalesce(i, (SELECT count(*) FROM seen)) AS DOUBLE) AS code FROM orders LEFT JOIN seen ON o_orderpriority = p""")
def ordinal_encode(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    model = ordinal_stage(["o_orderpriority"]).fit(o.filter("o_orderpriority <> '3-MEDIUM'"))
    return model.transform(o).select("o_orderkey", F.col("o_orderpriority_idx").alias("code"))


@query("label_decode", "SELECT o_orderkey, o_orderpriority AS decoded, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS label FROM orders")
def label_decode(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    indexer = train.label_index(o, "o_orderpriority")
    coded = indexer.transform(o).withColumn("prediction", F.col("label"))
    return train._decoder(indexer).transform(coded).select("o_orderkey", F.col("predicted").alias("decoded"), "label")


@query("one_hot_frequent", f"""WITH {HALVES}, kept AS (SELECT CASE WHEN c >= 100 THEN cat ELSE '__rare__' END AS slot FROM seen GROUP BY 1),
  slots AS (SELECT slot, row_number() OVER (ORDER BY slot) - 1 AS i FROM kept)
SELECT {KEY}, CAST(i AS BIGINT) AS hot FROM halves LEFT JOIN seen USING (cat) LEFT JOIN slots ON slot = CASE WHEN c >= 100 THEN cat WHEN c IS NOT NULL THEN '__rare__' END""")
def one_hot_frequent(spark, d):
    from pyspark.ml import Pipeline

    part, whole = _halves(spark, d)
    encoded = Pipeline(stages=one_hot_stages(["cat"], 100)).fit(part).transform(whole)
    where = F.array_position(vector_to_array("cat_hot"), F.lit(1.0))
    return encoded.select(*KEYS, F.when(where > 0, where - 1).alias("hot"))


@query("serving_features", f"""WITH t AS (SELECT {KEY}, CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity ELSE 0 END AS o, CASE WHEN l_linenumber % 4 <> 0 THEN l_tax * 100 ELSE 0 END AS l,
  l_extendedprice AS p, lower(trim(p_name)) AS cat FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT {KEY}, o + l AS total_area_m2_custom, CAST(o > 0 AND l <= 0 AS INTEGER) AS is_object_only_custom, CAST(o > 0 AND l > 0 AS INTEGER) AS is_mixed_asset_custom,
  CASE WHEN o + l > 0 THEN p / greatest(o + l, 1e-6) ELSE 0 END AS price_per_total_m2_custom, round(ln(1 + p), 6) AS log_price_custom, cat AS p_name,
  CASE WHEN contains(cat, 'ring') THEN 'land' WHEN regexp_matches(cat, 'rod|gear') THEN 'object' ELSE 'other' END AS asset_type_bucket_custom FROM t""")
def serving_features(spark, d):
    li = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    rows = li.select(
        *KEYS, F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")).alias("oa"), F.when(F.col("l_linenumber") % 4 != 0, F.col("l_tax") * 100).alias("la"),
        F.col("l_extendedprice").alias("price"), F.concat(F.lit(" "), F.upper("p_name")).alias("p_name"),
    )
    stage = AssetFeatures.build("oa", "la", "price", "p_name", ["p_name", "zone"], [("ring", "land"), ("rod|gear", "object")])
    return stage.transform(rows).select(
        *KEYS, "total_area_m2_custom", "is_object_only_custom", "is_mixed_asset_custom", "price_per_total_m2_custom", F.round("log_price_custom", 6).alias("log_price_custom"),
        "p_name", "asset_type_bucket_custom",
    )


# ---- evaluation -------------------------------------------------------------

def _predictions(spark, d):
    """Order priority as truth, a rule on price and date as prediction."""
    o = table(spark, d, "orders")
    guess = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).when(F.col("o_totalprice") > 250000, "1-URGENT").otherwise("6-NEVER")
    return o.select("o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("truth"), guess.alias("prediction"))


PREDICTIONS = """predicted AS (SELECT o_orderkey, o_orderstatus, o_orderpriority AS truth,
    CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority WHEN o_totalprice > 250000 THEN '1-URGENT' ELSE '6-NEVER' END AS prediction FROM orders)"""


def _report_sql(by=""):
    b = f"{by}, " if by else ""
    on = f"USING ({b}label)"
    return f"""s AS (SELECT {b}truth AS label, count(*) AS support, count(*) FILTER (WHERE truth = prediction) AS hits FROM predicted GROUP BY ALL),
  p AS (SELECT {b}prediction AS label, count(*) AS predicted FROM predicted GROUP BY ALL),
  r AS (SELECT {b}label, coalesce(support, 0) AS support, CASE WHEN coalesce(predicted, 0) > 0 THEN coalesce(hits, 0) / predicted ELSE 0 END AS precision,
    CASE WHEN coalesce(support, 0) > 0 THEN hits / support ELSE 0 END AS recall FROM s FULL JOIN p {on}),
  f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM r)"""


@query("confusion", f"""WITH {PREDICTIONS}, l AS (SELECT truth AS x FROM predicted UNION SELECT prediction FROM predicted), c AS (SELECT truth, prediction, count(*) AS n FROM predicted GROUP BY 1, 2)
SELECT a.x AS truth, b.x AS prediction, coalesce(n, 0) AS count FROM l a CROSS JOIN l b LEFT JOIN c ON c.truth = a.x AND c.prediction = b.x""")
def confusion(spark, d):
    return evaluate.confusion(_predictions(spark, d), "truth", "prediction")


@query("class_report", f"WITH {PREDICTIONS}, {_report_sql()} SELECT label, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM f")
def class_report(spark, d):
    r = evaluate.class_report(_predictions(spark, d), "truth", "prediction")
    return r.select("label", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("report_averages", f"""WITH {PREDICTIONS}, {_report_sql()}
SELECT 'macro avg' AS average, round(avg(precision), 8) AS precision, round(avg(recall), 8) AS recall, round(avg(f1), 8) AS f1, CAST(sum(support) AS BIGINT) AS support FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 8), round(sum(recall * support) / sum(support), 8), round(sum(f1 * support) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM f""")
def report_averages(spark, d):
    r = evaluate.report_averages(evaluate.class_report(_predictions(spark, d), "truth", "prediction"))
    return r.select("average", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("metric_summary", f"""WITH {PREDICTIONS}, {_report_sql()}
SELECT round(sum(recall * support) / sum(support), 8) AS accuracy, round(avg(recall) FILTER (WHERE support > 0), 8) AS balanced_accuracy, round(avg(f1), 8) AS macro_f1,
  round(sum(f1 * support) / sum(support), 8) AS weighted_f1 FROM f""")
def metric_summary(spark, d):
    m = evaluate.metric_summary(_predictions(spark, d), "truth", "prediction")
    return m.select(*[F.round(c, 8).alias(c) for c in train.METRICS])


@query("prediction_table", f"WITH {PREDICTIONS} SELECT o_orderkey, truth AS true_label, prediction AS predicted_label, CAST(truth = prediction AS INTEGER) AS is_correct FROM predicted")
def prediction_table(spark, d):
    return evaluate.prediction_table(_predictions(spark, d), "truth", "prediction", keep=["o_orderkey"]).drop("confidence")


FOLD_ROWS = """folds AS (SELECT o_orderkey % 5 AS fold, avg(o_totalprice) / 500000 AS accuracy, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END) AS macro_f1 FROM orders GROUP BY 1)"""


def _folds(spark, d):
    return table(spark, d, "orders").groupBy((F.col("o_orderkey") % 5).alias("fold")).agg(
        (F.avg("o_totalprice") / 500000).alias("accuracy"), F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("macro_f1")
    )


@query("fold_summary", f"""WITH {FOLD_ROWS}, l AS (UNPIVOT folds ON accuracy, macro_f1 INTO NAME metric VALUE v)
SELECT metric, round(avg(v), 8) AS mean, round(stddev_pop(v), 8) AS std, round(min(v), 8) AS min, round(max(v), 8) AS max FROM l GROUP BY 1""")
def fold_summary(spark, d):
    s = evaluate.fold_summary(_folds(spark, d), ["accuracy", "macro_f1"])
    return s.select("metric", *[F.round(c, 8).alias(c) for c in ("mean", "std", "min", "max")])


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), "label", (F.col("label") % 3).alias("group")
    )


@query("cluster_external", """WITH k AS (SELECT label AS t, CASE WHEN vec_id % 4 = 0 THEN 9 ELSE label % 3 END AS c, count(*) AS n FROM embeddings GROUP BY ALL),
  g AS (SELECT t, c, sum(n) AS n FROM k GROUP BY 1, 2), a AS (SELECT sum(n) AS n FROM g GROUP BY t), b AS (SELECT sum(n) AS n FROM g GROUP BY c),
  s AS (SELECT (SELECT sum(n) FROM g) AS n, (SELECT sum(n * (n - 1) / 2) FROM g) AS idx, (SELECT sum(n * (n - 1) / 2) FROM a) AS pa, (SELECT sum(n * (n - 1) / 2) FROM b) AS pb,
    (SELECT sum(n * ln(n)) FROM g) AS hj, (SELECT sum(n * ln(n)) FROM a) AS ha, (SELECT sum(n * ln(n)) FROM b) AS hb)
SELECT round((idx - pa * pb / (n * (n - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (n * (n - 1) / 2)), 8) AS ari,
  round(2 * (ln(n) - ha / n + ln(n) - hb / n - (ln(n) - hj / n)) / (2 * ln(n) - ha / n - hb / n), 8) AS nmi FROM s""")
def cluster_external(spark, d):
    v = table(spark, d, "embeddings").select("label", F.when(F.col("vec_id") % 4 == 0, 9).otherwise(F.col("label") % 3).alias("c"))
    s = evaluate.external_scores(v, "label", "c")
    return s.select(F.round("ari", 8).alias("ari"), F.round("nmi", 8).alias("nmi"))


@query("cluster_internal", """WITH v AS (SELECT vec_id, label AS c, i, CAST(embedding[i] AS DOUBLE) AS x FROM (SELECT vec_id, label, embedding, unnest(range(1, 65)) AS i FROM embeddings)),
  m AS (SELECT c, i, avg(x) AS m FROM v GROUP BY 1, 2), o AS (SELECT i, avg(x) AS m FROM v GROUP BY 1), z AS (SELECT label AS c, count(*) AS n FROM embeddings GROUP BY 1),
  dist AS (SELECT v.c, vec_id, sum((x - m) ** 2) AS d FROM v JOIN m ON v.c = m.c AND v.i = m.i GROUP BY 1, 2), w AS (SELECT c, sum(d) AS w, avg(sqrt(d)) AS s FROM dist GROUP BY 1),
  bt AS (SELECT sum(n * (m.m - o.m) ** 2) AS b FROM m JOIN o USING (i) JOIN z USING (c)), t AS (SELECT sum(n) AS n, count(*) AS k FROM z),
  pr AS (SELECT a.c, b.c AS c2, sqrt(sum((a.m - b.m) ** 2)) AS gap FROM m a JOIN m b ON a.i = b.i AND a.c <> b.c GROUP BY 1, 2),
  worst AS (SELECT pr.c, max((w1.s + w2.s) / gap) AS r FROM pr JOIN w w1 ON pr.c = w1.c JOIN w w2 ON pr.c2 = w2.c GROUP BY 1)
SELECT round((SELECT sum(w) FROM w), 6) AS inertia, round((b / (k - 1)) / ((SELECT sum(w) FROM w) / (n - k)), 6) AS calinski_harabasz, round((SELECT avg(r) FROM worst), 6) AS davies_bouldin FROM bt, t""")
def cluster_internal(spark, d):
    s = evaluate.internal_scores(_vectors(spark, d), "features", "label")
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


# ---- training ---------------------------------------------------------------

# Settings of the reference: forest, boosting, network, search spaces. Queries that fit several forests grow a
FOREST = {"trees": 1200, "depth": 24}
TUNED_FOREST = {"trees": 1800 // 3, "depth": 30}
FOLD_FOREST = {"trees": 1200 // 4, "depth": 24}
SEARCH_SHARE, SEARCH_FOLDS = 40, 3
BOOSTING = {"iterations": 2500, "depth": 7, "step": 0.03}
NETWORK = {"hidden": (256, 128, 64), "iterations": 200}
# Most labelled rows that a forest, boosting or a search is fitted on (those of least digest of the key); all
# held-out rows are scored.
FIT_ROWS = 1000
# Concurrent fits that a forest's trees are shared among.
PARTS = 8
FOLDS = 5
# The reference searches depths up to 32; a forest has 30 at most.
FOREST_SPACE = {"trees": list(range(400, 2001, 200)), "depth": list(range(8, 31)), "leaf": list(range(1, 9)), "features": ["sqrt", "log2", "0.3", "0.4", "0.5"]}
TRIALS = 4
# (inverse penalty, share of L1, whether classes are balanced)
LOGISTIC_GRID = [(1.0, 0.0, False), *[(c, 0.0, True) for c in (1.0, 0.3, 0.1, 3.0, 10.0)], *[(c, 1.0, True) for c in (0.3, 0.1, 0.03, 1.0)]]
LOGISTIC_ITERATIONS = 8000
KMEANS = {"ks": range(3, 11), "restarts": 20, "iterations": 500}

ORDER_COLUMNS = train.Columns("o_orderstatus", ("c_mktsegment", "o_orderpriority"), ("o_totalprice", "c_acctbal", "year"), ("o_orderkey",))


def _order_features(spark, d):
    """Orders with customer features; the label depends on price and segment, so there is something to learn."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    o = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    signal = F.when((F.col("o_totalprice") > 300000) & (F.col("c_mktsegment") != "BUILDING"), "P").when(F.col("c_acctbal") < 2000, "F").otherwise("O")
    noisy = F.when(F.pmod(F.xxhash64("o_orderkey"), F.lit(10)) == 0, F.col("o_orderstatus")).otherwise(signal)
    return o.select("o_orderkey", noisy.alias("o_orderstatus"), "c_mktsegment", "o_orderpriority", "o_totalprice", "c_acctbal", F.year("o_orderdate").cast("double").alias("year"))


def _evaluate(spark, d, classifier, **options):
    fitted_on, held_out = split.train_test(_order_features(spark, d), ["o_orderkey"], 0.2, by=["o_orderstatus"])
    fitted = train.fit(fitted_on, ORDER_COLUMNS, classifier, **options)
    return evaluate.metric_summary(fitted.score(held_out), "o_orderstatus", "predicted")


def _split(spark, d):
    return split.train_test(_order_features(spark, d), ["o_orderkey"], 0.2, by=["o_orderstatus"])


@query("train_rf")
def train_rf(spark, d):
    return _evaluate(spark, d, trees.counted_forest(**FOREST, parts=PARTS))


@query("train_lr")
def train_lr(spark, d):
    return _evaluate(spark, d, train.logistic(c=1.0, iterations=50))


@query("train_gbt_ovr")
def train_gbt_ovr(spark, d):
    return _evaluate(spark, d, trees.boosted_trees(**BOOSTING), targets=True, scale=False)


@query("train_mlp")
def train_mlp(spark, d):
    return _evaluate(spark, d, train.perceptron(**NETWORK))


@query("refit_evaluate")
def refit_evaluate(spark, d):
    return train.refit(*_split(spark, d), ORDER_COLUMNS, trees.counted_forest(**TUNED_FOREST, parts=PARTS))[1]


@query("predict_confidence")
def predict_confidence(spark, d):
    learn, held_out = _split(spark, d)
    fitted = train.fit(learn, ORDER_COLUMNS, trees.counted_forest(**FOREST, parts=PARTS))
    return evaluate.prediction_table(fitted.score(held_out), "o_orderstatus", "predicted", "probability", keep=["o_orderkey"])


@query("rank_candidates")
def rank_candidates(spark, d):
    data = _order_features(spark, d)
    fitted = train.fit(data, ORDER_COLUMNS, trees.random_forest(**FOREST, parts=PARTS), rows=FIT_ROWS)
    return serve.top_candidates(
        fitted.score(data), ["o_orderkey"], vector_to_array("probability"), fitted.labels, k=2, min_probability=0.05, catch_all="O", exclude_catch_all=True
    )


@query("cross_validation")
def cross_validation(spark, d):
    folds = train.cross_validate(_order_features(spark, d), ORDER_COLUMNS, trees.random_forest(**FOLD_FOREST, parts=2), k=FOLDS, rows=FIT_ROWS)
    return evaluate.fold_summary(folds, train.METRICS)


@query("grid_search")
def grid_search(spark, d):
    build = lambda c: train.logistic(c["c"], c["l1"], LOGISTIC_ITERATIONS, "weight" if c["balanced"] else "equal")
    configs = [dict(zip(("c", "l1", "balanced"), point)) for point in LOGISTIC_GRID]
    return train.search(_order_features(spark, d), ORDER_COLUMNS, build, configs, k=FOLDS, rows=FIT_ROWS)


@query("random_search")
def random_search(spark, d):
    build = lambda c: trees.random_forest(c["trees"] // SEARCH_SHARE, c["depth"], c["features"], minInstancesPerNode=c["leaf"])
    configs = [{**FOREST, "leaf": 1, "features": "0.35"}, *train.random_configs(FOREST_SPACE, TRIALS)]
    log = train.search(_order_features(spark, d), ORDER_COLUMNS, build, configs, k=SEARCH_FOLDS, rows=FIT_ROWS)
    return evaluate.search_trace(log)


def _importance(spark, d, by_column):
    data = _order_features(spark, d)
    fitted = train.fit(data, ORDER_COLUMNS, trees.random_forest(**FOREST, parts=PARTS), rows=FIT_ROWS)
    return train.importance_frame(spark, fitted, data, by_column).orderBy(F.desc("importance"), "feature")


@query("importance")
def importance(spark, d):
    return _importance(spark, d, False).limit(25)


@query("importance_columns")
def importance_columns(spark, d):
    return _importance(spark, d, True)


@query("pca_project")
def pca_project(spark, d):
    projected, _ = pca_projection(_vectors(spark, d), "features", 2)
    return projected.select("id", "label", *[vector_to_array("projected")[i].alias(f"pc{i + 1}") for i in range(2)])


@query("kmeans_select")
def kmeans_select(spark, d):
    _, scores = clusters.kmeans_search(_vectors(spark, d), "features", **KMEANS)
    return scores


def _latent(spark, d):
    return clusters.latent_table(_vectors(spark, d), "features", "id", "label", k=8, clusters=8, restarts=KMEANS["restarts"], iterations=KMEANS["iterations"])[0]


@query("latent_cluster")
def latent_cluster(spark, d):
    return evaluate.external_scores(_latent(spark, d), "label", "cluster")


@query("latent_knn")
def latent_knn(spark, d):
    rows = cut_lineage(_latent(spark, d).select("id", vector_to_array("z").alias("vector"), "label", "is_test"))
    learn, held_out = rows.filter("is_test = 0").drop("is_test"), rows.filter("is_test = 1").drop("is_test")
    voted = train.knn_classify(learn, held_out.drop("label"))
    joined = held_out.select("id", F.col("label").cast("string").alias("truth")).join(voted, "id")
    return evaluate.metric_summary(joined, "truth", "prediction")


# ---- comparison -------------------------------------------------------------

def _runs(spark, d):
    """Event types as models, weekdays as trials, mean values as scores."""
    e = table(spark, d, "events")
    return e.groupBy(F.col("event_type").alias("model"), F.dayofmonth("ts").alias("trial")).agg((F.avg("value") / 100).alias("score"))


RUNS = "runs AS (SELECT event_type AS model, CAST(extract(day FROM ts) AS INTEGER) AS trial, avg(value) / 100 AS score FROM events GROUP BY 1, 2)"


@query("search_trace", f"""WITH {RUNS} SELECT model, trial, round(score, 8) AS score, round(max(score) OVER (PARTITION BY model ORDER BY trial ROWS UNBOUNDED PRECEDING), 8) AS best_so_far,
  round(first_value(score) OVER (PARTITION BY model ORDER BY trial), 8) AS baseline FROM runs""")
def search_trace(spark, d):
    t = evaluate.search_trace(_runs(spark, d), ["model"])
    return t.select("model", "trial", *[F.round(c, 8).alias(c) for c in ("score", "best_so_far", "baseline")])


@query("best_trial", f"WITH {RUNS} SELECT model, arg_max(trial, score) AS trial, round(max(score), 8) AS score FROM runs GROUP BY 1")
def best_trial(spark, d):
    return evaluate.best_trial(_runs(spark, d), ["model"]).withColumn("score", F.round("score", 8))


METRIC_ROWS = """m AS (SELECT event_type AS model, CASE WHEN user_id % 2 = 0 THEN 'accuracy' ELSE 'macro_f1' END AS metric, CASE WHEN event_id % 2 = 0 THEN 'before' ELSE 'after' END AS run,
    avg(value) / 100 AS value FROM events GROUP BY 1, 2, 3)"""


def _metric_rows(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(
        F.col("event_type").alias("model"), F.when(F.col("user_id") % 2 == 0, "accuracy").otherwise("macro_f1").alias("metric"),
        F.when(F.col("event_id") % 2 == 0, "before").otherwise("after").alias("run"),
    ).agg((F.avg("value") / 100).alias("value"))


@query("compare_models", f"""WITH {METRIC_ROWS} SELECT model, CASE WHEN model = 'error' THEN 'unsupervised' ELSE 'supervised' END AS kind,
  round(max(value) FILTER (WHERE metric = 'accuracy'), 8) AS accuracy, round(max(value) FILTER (WHERE metric = 'macro_f1'), 8) AS macro_f1 FROM m WHERE run = 'after' GROUP BY 1, 2""")
def compare_models(spark, d):
    after = _metric_rows(spark, d).filter("run = 'after'")
    wide = evaluate.supervision_table(evaluate.compare_models(after, ["accuracy", "macro_f1"]), ["error"])
    return wide.select("model", "kind", F.round("accuracy", 8).alias("accuracy"), F.round("macro_f1", 8).alias("macro_f1"))


@query("uplift", f"""WITH {METRIC_ROWS} SELECT b.model, b.metric, round(b.value, 8) AS before, round(a.value, 8) AS after, round((a.value - b.value) * 100, 6) AS points
FROM m b JOIN m a ON a.model = b.model AND a.metric = b.metric WHERE b.run = 'before' AND a.run = 'after'""")
def uplift(spark, d):
    m = _metric_rows(spark, d)
    u = evaluate.uplift(m.filter("run = 'before'"), m.filter("run = 'after'"))
    return u.select("model", "metric", F.round("before", 8).alias("before"), F.round("after", 8).alias("after"), F.round("points", 6).alias("points"))


@query("cv_stability", f"""WITH {RUNS} SELECT model, round(avg(score), 8) AS mean, round(stddev_pop(score), 8) AS std FROM runs GROUP BY 1""")
def cv_stability(spark, d):
    s = evaluate.fold_summary(_runs(spark, d), ["score"], by=["model"])
    return s.select("model", F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"))


@query("feature_shrinkage", """WITH f AS (SELECT event_type AS model, user_id % 50 AS feature, sum(value) AS worth FROM events GROUP BY 1, 2),
  m AS (SELECT model, avg(worth) AS usual FROM f GROUP BY 1)
SELECT model, count(*) AS before, count(*) FILTER (worth > usual) AS after, count(*) FILTER (NOT worth > usual) AS removed FROM f JOIN m USING (model) GROUP BY 1""")
def feature_shrinkage(spark, d):
    worth = table(spark, d, "events").groupBy(F.col("event_type").alias("model"), (F.col("user_id") % 50).alias("feature")).agg(F.sum("value").alias("worth"))
    usual = worth.groupBy("model").agg(F.avg("worth").alias("usual"))
    return evaluate.feature_shrinkage(worth, worth.join(usual, "model").filter("worth > usual"))


@query("per_class_f1", f"""WITH {PREDICTIONS}, {_report_sql('o_orderstatus')}, l AS (SELECT DISTINCT label FROM f), k AS (SELECT DISTINCT o_orderstatus FROM orders)
SELECT l.label, k.o_orderstatus AS model, round(coalesce(f1, 0), 8) AS f1 FROM l CROSS JOIN k LEFT JOIN f ON f.label = l.label AND f.o_orderstatus = k.o_orderstatus""")
def per_class_f1(spark, d):
    reports = evaluate.class_report(_predictions(spark, d), "truth", "prediction", by=["o_orderstatus"]).withColumnRenamed("o_orderstatus", "model")
    return evaluate.per_class_f1(reports.select("label", "model", "f1")).withColumn("f1", F.round("f1", 8))
