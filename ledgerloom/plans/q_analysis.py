"""Catalogue: profiles, column filters, outliers, imputation, splits, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.functions import features as fx
from ledgerloom.models import evaluate
from ledgerloom.operators import dedup, filters, impute, order_stats, outliers, profile, split, watch
from ledgerloom.plans import views
from ledgerloom.plans.registry import query, table
from ledgerloom.session import cut_lineage
from ledgerloom.sources import columns

IQR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "line_value"]


def _valued_lines(spark, d):
    """Line items with a long-tailed value and NULLs."""
    li = table(spark, d, "lineitem")
    tail = F.when(F.col("l_partkey") % 50 == 0, 40).otherwise(1)
    return li.withColumn("line_value", F.when(F.col("l_suppkey") % 8 != 0, F.col("l_extendedprice") * tail - 3000))


VALUED = """valued AS (SELECT *, CASE WHEN l_suppkey % 8 <> 0 THEN l_extendedprice * CASE WHEN l_partkey % 50 = 0 THEN 40 ELSE 1 END - 3000 END AS line_value FROM lineitem)"""


def _iqr_sql(columns_):
    one = """SELECT '{c}' AS "column", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM valued"""
    return "marks AS (" + " UNION ALL ".join(one.format(c=c) for c in columns_) + """), bounds AS (
  SELECT "column", q1, q3, q3 - q1 AS iqr, CASE WHEN contains("column", 'price') THEN greatest(q1 - 1.5 * (q3 - q1), 0) ELSE q1 - 1.5 * (q3 - q1) END AS lower,
    q3 + 1.5 * (q3 - q1) AS upper FROM marks WHERE q3 <> q1)"""


@query("outlier_rate", f"""WITH {VALUED}, cleaned AS (
  SELECT *, TRY_CAST(regexp_replace('€ ' || CAST(CAST(round(line_value * 100) AS BIGINT) AS VARCHAR), '[^0-9.\\-]', '', 'g') AS DOUBLE) / 100 AS amount FROM valued),
  firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_suppkey, l_linenumber, l_extendedprice, l_quantity) AS rn FROM cleaned) WHERE rn = 1),
  b AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM firsts)
SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (WHERE amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1)) AS outliers,
  round(count(*) FILTER (WHERE amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1)) * 100.0 / count(*), 6) AS percent
FROM firsts, b GROUP BY l_returnflag""")
def outlier_rate(spark, d):
    from ledgerloom.functions.text import clean_numeric

    v = _valued_lines(spark, d)
    spelled = F.concat(F.lit("€ "), F.round(F.col("line_value") * 100).cast("long").cast("string"))
    cleaned = v.select(
        "l_orderkey", "l_partkey", "l_returnflag", (clean_numeric(spelled) / 100).alias("amount"),
        F.struct("l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity").alias("place"),
    )
    # Cut here: the bounds take several passes and must not repeat the shuffle.
    kept = cut_lineage(dedup.keep_first(cleaned, ["l_orderkey", "l_partkey"], "place").select("l_returnflag", "amount"))
    flagged = outliers.iqr_flags(kept, outliers.iqr_stats(kept, ["amount"]))
    hits, rows = F.sum("amount_is_outlier_iqr"), F.count(F.lit(1))
    return flagged.groupBy("l_returnflag").agg(rows.alias("n_rows"), hits.alias("outliers"), F.round(hits * 100.0 / rows, 6).alias("percent"))


@query("iqr_stats", f"""WITH {VALUED}, {_iqr_sql(IQR_COLUMNS)}, cells AS (
  UNPIVOT (SELECT {', '.join(IQR_COLUMNS)} FROM valued) ON {', '.join(IQR_COLUMNS)} INTO NAME "column" VALUE v)
SELECT b."column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(iqr, 4) AS iqr, round(lower, 4) AS lower, round(upper, 4) AS upper,
  count(*) FILTER (WHERE v < lower OR v > upper) AS outlier_count, round(count(*) FILTER (WHERE v < lower OR v > upper) / (SELECT count(*) FROM valued), 8) AS outlier_ratio
FROM bounds b JOIN cells c ON b."column" = c."column" GROUP BY ALL""")
def iqr_stats(spark, d):
    stats = outliers.iqr_stats(_valued_lines(spark, d), IQR_COLUMNS, ["price"])
    f = outliers.stats_frame(spark, stats)
    return f.select("column", *[F.round(c, 4).alias(c) for c in ("q1", "q3", "iqr", "lower", "upper")], "outlier_count", F.round("outlier_ratio", 8).alias("outlier_ratio"))


@query("iqr_flags", f"""WITH {VALUED}, {_iqr_sql(IQR_COLUMNS)}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(coalesce(line_value < lower OR line_value > upper, false) AS INTEGER) AS line_value_is_outlier_iqr
FROM valued, bounds WHERE "column" = 'line_value'""")
def iqr_flags(spark, d):
    v = _valued_lines(spark, d)
    flagged = outliers.iqr_flags(v, outliers.iqr_stats(v, ["line_value", "l_quantity"]))
    return flagged.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "line_value_is_outlier_iqr")


# ---- profiles ---------------------------------------------------------------

PROFILED = ["status", "price", "odate", "priority"]


@query("profile_nulls", f"""WITH {views.MESSY_ORDERS}, n AS (SELECT count(*) AS r, count(status) AS a, count(price) AS b, count(odate) AS c, count(priority) AS d FROM messy_orders)
SELECT "column", non_nulls, r - non_nulls AS nulls, round((r - non_nulls) * 100.0 / r, 6) AS null_percent FROM (
  SELECT r, unnest(['status', 'price', 'odate', 'priority']) AS "column", unnest([a, b, c, d]) AS non_nulls FROM n)""")
def profile_nulls(spark, d):
    return profile.null_profile(views.messy_orders(spark, d), PROFILED).withColumn("null_percent", F.round("null_percent", 6))


@query("profile_cardinality", f"""WITH {views.MESSY_ORDERS}
SELECT 'status' AS "column", count(DISTINCT status) AS distinct_values, round(count(DISTINCT status) * 100.0 / count(*), 6) AS distinct_percent FROM messy_orders
UNION ALL SELECT 'priority', count(DISTINCT priority), round(count(DISTINCT priority) * 100.0 / count(*), 6) FROM messy_orders
UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey), round(count(DISTINCT o_custkey) * 100.0 / count(*), 6) FROM messy_orders""")
def profile_cardinality(spark, d):
    return profile.cardinality_profile(views.messy_orders(spark, d), ["status", "priority", "o_custkey"]).withColumn("distinct_percent", F.round("distinct_percent", 6))


@query("value_freq", f"""WITH {views.MESSY_ORDERS}
SELECT priority AS value, count(*) AS count, round(count(*) / (SELECT count(*) FROM messy_orders), 8) AS share FROM messy_orders GROUP BY 1""")
def value_freq(spark, d):
    return profile.value_frequency(views.messy_orders(spark, d), "priority", with_null=True).withColumn("share", F.round("share", 8))


@query("top_values", "SELECT l_partkey AS value, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, CAST(l_partkey AS VARCHAR) LIMIT 15")
def top_values(spark, d):
    counts = profile.value_frequency(table(spark, d, "lineitem"), "l_partkey")
    return profile.top_n(counts, "count", 15, ["value"]).select(F.col("value").cast("long").alias("value"), "count")


@query("match_rate", f"""WITH {views.MESSY_ORDERS}
SELECT count(*) AS rows, count(priority) AS matched, round(count(priority) * 100.0 / count(*), 6) AS match_percent FROM messy_orders""")
def match_rate(spark, d):
    return profile.match_rate(views.messy_orders(spark, d), "priority").withColumn("match_percent", F.round("match_percent", 6))


def _histogram_sql(source, expr, bins=50):
    return f"""WITH v AS (SELECT {expr} AS v FROM {source}), m AS (SELECT min(v) AS a, max(v) AS b, (max(v) - min(v)) / {bins} AS w FROM v),
  c AS (SELECT least(CAST(floor((v - a) / w) AS INTEGER), {bins - 1}) AS bin, count(*) AS n FROM v, m WHERE v IS NOT NULL GROUP BY 1)
SELECT CAST(e.bin AS INTEGER) AS bin, round(a + e.bin * w, 4) AS low, round(a + (e.bin + 1) * w, 4) AS high, coalesce(n, 0) AS count
FROM (SELECT unnest(range(0, {bins})) AS bin) e CROSS JOIN m LEFT JOIN c ON c.bin = e.bin"""


@query("histogram_50", _histogram_sql("lineitem", "l_extendedprice"))
def histogram_50(spark, d):
    h = profile.histogram(table(spark, d, "lineitem"), ["l_extendedprice"])
    return h.select("bin", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"), "count")


@query("histogram_log", f"WITH {VALUED[:-1]})" + ", x AS (SELECT ln(1 + greatest(coalesce(line_value, 0), 0)) AS lv FROM valued) " + _histogram_sql("x", "round(lv, 9)").replace("WITH v AS", ", v AS", 1))
def histogram_log(spark, d):
    v = _valued_lines(spark, d).select(F.round(fx.log_amount("line_value"), 9).alias("lv"))
    return profile.histogram(v, ["lv"]).select("bin", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"), "count")


@query("box_summary", f"""WITH {VALUED}, cells AS (UNPIVOT (SELECT l_quantity, line_value FROM valued) ON l_quantity, line_value INTO NAME "column" VALUE v),
  q AS (SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM cells GROUP BY 1)
SELECT q."column", round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(min(v), 4) AS low_whisker, round(max(v), 4) AS high_whisker
FROM q JOIN cells c ON q."column" = c."column" WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY ALL""")
def box_summary(spark, d):
    b = profile.box_summary(_valued_lines(spark, d), ["l_quantity", "line_value"])
    return b.select("column", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3", "low_whisker", "high_whisker")])


# ---- column filters ---------------------------------------------------------

def _flagged_lines(spark, d):
    """Line items with a nearly empty, a constant and two dominated columns."""
    li = table(spark, d, "lineitem")
    return li.select(
        "l_returnflag", "l_linestatus", F.when(F.col("l_partkey") % 20 == 0, F.col("l_tax")).alias("sparse"), F.lit("same").alias("constant"),
        F.when(F.col("l_partkey") % 10 == 0, "y").otherwise("n").alias("dominant_two"),
        F.when(F.col("l_partkey") % 10 != 0, "n").when(F.col("l_partkey") % 30 == 0, F.lit(None)).otherwise((F.col("l_partkey") % 40).cast("string")).alias("dominant_many"),
        F.when(F.col("l_partkey") % 9 == 0, "p").alias("dominant_null"),
    )


FLAGGED_COLUMNS = ["l_returnflag", "l_linestatus", "sparse", "constant", "dominant_two", "dominant_many", "dominant_null"]
FLAGGED = f"""flagged AS (SELECT l_returnflag, l_linestatus, CASE WHEN l_partkey % 20 = 0 THEN CAST(l_tax AS VARCHAR) END AS sparse, 'same' AS "constant",
    CASE WHEN l_partkey % 10 = 0 THEN 'y' ELSE 'n' END AS dominant_two,
    CASE WHEN l_partkey % 10 <> 0 THEN 'n' WHEN l_partkey % 30 = 0 THEN NULL ELSE CAST(l_partkey % 40 AS VARCHAR) END AS dominant_many,
    CASE WHEN l_partkey % 9 = 0 THEN 'p' END AS dominant_null FROM lineitem),
  counted AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, " + f'"{c}" AS v, count(*) AS c FROM flagged GROUP BY 2' for c in FLAGGED_COLUMNS)}),
  facts AS (SELECT col, sum(c) AS n, coalesce(sum(c) FILTER (WHERE v IS NULL), 0) AS nulls, count(*) AS distinct_values, max(c) AS top FROM counted GROUP BY 1)"""


@query("column_filter_sparse", f"""WITH {FLAGGED} SELECT col AS "column", round(nulls / n, 8) AS null_ratio FROM facts WHERE nulls / n > 0.85""")
def column_filter_sparse(spark, d):
    facts = filters.column_facts(_flagged_lines(spark, d), FLAGGED_COLUMNS)
    return filters.sparse_columns(facts, 0.85).withColumn("null_ratio", F.round("null_ratio", 8))


@query("column_filter_constant", f"""WITH {FLAGGED} SELECT col AS "column", distinct_values FROM facts WHERE distinct_values <= 1""")
def column_filter_constant(spark, d):
    return filters.constant_columns(filters.column_facts(_flagged_lines(spark, d), FLAGGED_COLUMNS))


@query("column_filter_dominant", f"""WITH {FLAGGED} SELECT col AS "column", round(top / n, 8) AS dominant_ratio, distinct_values FROM facts
WHERE top / n >= 0.85 AND distinct_values <= 3 AND col <> 'constant'""")
def column_filter_dominant(spark, d):
    found = filters.dominant_columns(filters.column_facts(_flagged_lines(spark, d), FLAGGED_COLUMNS), 0.85, 3, exempt=["constant"])
    return found.withColumn("dominant_ratio", F.round("dominant_ratio", 8))


# ---- imputation -------------------------------------------------------------

@query("median_flags", f"""WITH {views.MESSY_ORDERS}, m AS (SELECT median(price) AS med, median(epoch_us(odate)) AS dmed FROM messy_orders)
SELECT o_orderkey, CAST(coalesce(price, 0) > med AS INTEGER) AS is_high, CAST(coalesce(epoch_us(odate) > dmed, false) AS INTEGER) AS is_late FROM messy_orders, m""")
def median_flags(spark, d):
    from ledgerloom.functions.dates import epoch_micros

    m = views.messy_orders(spark, d)
    med = order_stats.medians_of(m, ["price", "odate"])
    return m.select("o_orderkey", fx.above("price", med["price"]).alias("is_high"), fx.above(epoch_micros("odate"), med["odate"]).alias("is_late"))


@query("impute_rules", f"""WITH {views.MESSY_ORDERS}
SELECT o_orderkey, CASE WHEN status = 'F' AND price IS NULL THEN 0 ELSE price END AS price, coalesce(priority, 'none given') AS priority,
  coalesce(status, 'Status i panjohur') AS status FROM messy_orders""")
def impute_rules(spark, d):
    m = impute.fill_where(views.messy_orders(spark, d), "price", F.coalesce(F.col("status") == "F", F.lit(False)), 0.0)
    m = impute.fill_constant(impute.fill_matching(m, "prior", "none given"), {"status": "Status i panjohur", "absent": "x"})
    return m.select("o_orderkey", "price", "priority", "status")


@query("impute_group_median", f"""WITH {views.MESSY_ORDERS}, s AS (SELECT o_custkey, priority, median(price) AS med, count(price) AS n FROM messy_orders GROUP BY 1, 2)
SELECT o_orderkey, round(CASE WHEN price IS NULL AND n >= 4 THEN med ELSE price END, 4) AS price
FROM messy_orders m JOIN s ON m.o_custkey = s.o_custkey AND m.priority IS NOT DISTINCT FROM s.priority""")
def impute_group_median(spark, d):
    filled = impute.group_median_fill(views.messy_orders(spark, d), "price", ["o_custkey", "priority", "absent"], 4)
    return filled.select("o_orderkey", F.round("price", 4).alias("price"))


def _level_sql(source, target, keys, size):
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
    names = ", ".join(keys)
    return f"""{target} AS (SELECT t.* REPLACE (CASE WHEN t.price IS NULL AND n >= {size} THEN med ELSE t.price END AS price)
  FROM {source} t JOIN (SELECT {names}, median(price) AS med, count(price) AS n FROM {source} GROUP BY {names}) s ON {on})"""


@query("impute_hierarchy", f"""WITH {views.MESSY_ORDERS}, {_level_sql('messy_orders', 'a', ['o_custkey', 'priority', 'status'], 4)},
  {_level_sql('a', 'b', ['o_custkey', 'priority'], 4)}, {_level_sql('b', 'c', ['status'], 4)}
SELECT o_orderkey, round(price, 4) AS price FROM c""")
def impute_hierarchy(spark, d):
    levels = [["o_custkey", "priority", "status"], ["o_custkey", "priority"], ["status"]]
    filled = impute.hierarchical_median_fill(views.messy_orders(spark, d), ["price"], levels, 4)
    return filled.select("o_orderkey", F.round("price", 4).alias("price"))


@query("impute_areas", """WITH t AS (SELECT o_orderkey, o_custkey % 50 AS grp, o_orderpriority AS cat, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS oa,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice / 2 END AS la, o_orderpriority = '1-URGENT' AS l, o_orderpriority = '2-HIGH' AS o, o_orderpriority IN ('3-MEDIUM', '5-LOW') AS m FROM orders),
  z AS (SELECT *, CASE WHEN l AND oa IS NULL THEN 0 ELSE oa END AS oa0, CASE WHEN o AND la IS NULL THEN 0 ELSE la END AS la0 FROM t),
  s AS (SELECT cat, grp, median(oa0) AS mo, count(oa0) AS no, median(la0) AS ml, count(la0) AS nl FROM z GROUP BY 1, 2)
SELECT o_orderkey, round(coalesce(CASE WHEN m AND oa0 IS NULL AND no >= 5 THEN mo ELSE oa0 END, 0), 4) AS oa, round(coalesce(CASE WHEN m AND la0 IS NULL AND nl >= 5 THEN ml ELSE la0 END, 0), 4) AS la,
  CAST(oa IS NULL AS INTEGER) AS oa_was_missing, CAST(la IS NOT NULL AS INTEGER) AS raw_has_land_area FROM z JOIN s USING (cat, grp)""")
def impute_areas(spark, d):
    o, p = table(spark, d, "orders"), F.col("cat")
    t = o.select(
        "o_orderkey", (F.col("o_custkey") % 50).alias("grp"), F.col("o_orderpriority").alias("cat"), views.null_every("o_totalprice", "o_orderkey", 4).alias("oa"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice") / 2).alias("la"),
    )
    masks = {"land_only": p == "1-URGENT", "object_only": p == "2-HIGH", "mixed": p.isin("3-MEDIUM", "5-LOW")}
    filled = impute.infer_areas(t, "oa", "la", masks, [["cat", "grp"]], 5)
    return filled.select("o_orderkey", F.round("oa", 4).alias("oa"), F.round("la", 4).alias("la"), "oa_was_missing", "raw_has_land_area")


@query("impute_dates", f"""WITH {views.MESSY_ORDERS}, m AS (SELECT make_timestamp(CAST(floor(median(epoch_us(odate))) AS BIGINT)) AS med FROM messy_orders)
SELECT o_orderkey, CAST(coalesce(odate, med) AS VARCHAR) AS odate, CAST(med - INTERVAL 365 DAY AS VARCHAR) AS derived FROM messy_orders, m""")
def impute_dates(spark, d):
    m = views.messy_orders(spark, d).withColumn("derived", F.lit(None).cast("timestamp_ntz"))
    # The empty date is derived from the other one's median before that is filled.
    filled = impute.fill_dates(impute.fill_dates(m, "derived", other="odate"), "odate")
    return filled.select("o_orderkey", F.col("odate").cast("string").alias("odate"), F.col("derived").cast("string").alias("derived"))


@query("impute_fallback", f"""WITH {views.MESSY_ORDERS}, f AS (SELECT (SELECT status FROM messy_orders WHERE status IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS s,
    (SELECT priority FROM messy_orders WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS p,
    (SELECT make_timestamp(CAST(floor(median(epoch_us(odate))) AS BIGINT)) FROM messy_orders) AS d)
SELECT o_orderkey, coalesce(status, s) AS status, coalesce(price, 0) AS price, CAST(coalesce(odate, d) AS VARCHAR) AS odate, coalesce(priority, p) AS priority,
  'Te panjohura' AS nothing FROM messy_orders, f""")
def impute_fallback(spark, d):
    m = views.messy_orders(spark, d).withColumn("nothing", F.lit(None).cast("string"))
    filled = filters.assert_no_null(impute.fill_fallback(m, lambda c: "Te panjohura"))
    return filled.select("o_orderkey", "status", "price", F.col("odate").cast("string").alias("odate"), "priority", "nothing")


@query("missing_flags", f"""WITH {views.MESSY_ORDERS}
SELECT o_orderkey, CAST(price IS NULL AS INTEGER) AS price_was_missing, CAST(odate IS NULL AS INTEGER) AS odate_was_missing FROM messy_orders""")
def missing_flags(spark, d):
    m = views.messy_orders(spark, d)
    return m.withColumns(fx.missing_flags(["price", "odate", "absent"], m.columns)).select("o_orderkey", "price_was_missing", "odate_was_missing")


# ---- splits -----------------------------------------------------------------

DIGEST = "md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42'))"


@query("split_80_20", f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {DIGEST}, o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST(rn <= ceil(round(n * 0.2, 9)) AS INTEGER) AS is_test FROM r""")
def split_80_20(spark, d):
    return split.split_flag(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 0.2)


@query("split_stratified", f"""WITH r AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {DIGEST}, o_orderkey) AS rn,
  count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) SELECT o_orderkey, o_orderpriority, CAST(rn <= ceil(round(n * 0.15, 9)) AS INTEGER) AS is_test FROM r""")
def split_stratified(spark, d):
    return split.split_flag(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderkey"], 0.15, by=["o_orderpriority"])


@query("stratified_folds", f"""SELECT o_orderkey, o_orderpriority, CAST((row_number() OVER (PARTITION BY o_orderpriority ORDER BY {DIGEST}, o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM orders""")
def stratified_folds(spark, d):
    return split.stratified_folds(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderkey"], "o_orderpriority", 5)


@query("shuffle_validation", f"""WITH r AS (SELECT event_id, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(event_id AS VARCHAR), '42')), event_id) AS rn, count(*) OVER () AS n FROM events)
SELECT event_id, CASE WHEN rn <= ceil(round(n * 0.15, 9)) THEN 'validation' ELSE 'train' END AS part FROM r""")
def shuffle_validation(spark, d):
    train, validation = split.tail_validation(table(spark, d, "events").select("event_id"), ["event_id"], 0.15)
    return train.withColumn("part", F.lit("train")).unionByName(validation.withColumn("part", F.lit("validation")))


# ---- class statistics and reports -------------------------------------------

@query("class_weights", """SELECT o_orderpriority AS label, count(*) AS count, round((SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderpriority) FROM orders) * count(*)), 8) AS weight FROM orders GROUP BY 1""")
def class_weights(spark, d):
    return evaluate.class_weights(table(spark, d, "orders"), "o_orderpriority").withColumn("weight", F.round("weight", 8))


@query("crosstab_norm", """SELECT l_returnflag AS row, l_linestatus AS column, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag), 8) AS share FROM lineitem GROUP BY 1, 2""")
def crosstab_norm(spark, d):
    return evaluate.crosstab_share(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus").withColumn("share", F.round("share", 8))


@query("cluster_profile", """WITH c AS (SELECT o_orderstatus AS cluster, o_custkey AS label, count(*) AS count FROM orders GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY count DESC, label) AS place, CAST(sum(count) OVER (PARTITION BY cluster) AS BIGINT) AS size FROM c)
SELECT cluster, size, place, label, count, round(count / size, 8) AS ratio FROM r WHERE place <= 5""")
def cluster_profile(spark, d):
    return evaluate.cluster_profile(table(spark, d, "orders"), "o_orderstatus", "o_custkey").withColumn("ratio", F.round("ratio", 8))


@query("label_list", "SELECT DISTINCT o_orderpriority AS label FROM orders ORDER BY 1")
def label_list(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderpriority").alias("label")).distinct().orderBy("label")


@query("type_features", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 6 <> 0 THEN l_returnflag ELSE '__missing__' END AS flag,
  CASE WHEN l_partkey % 4 <> 0 THEN l_quantity ELSE 0 END AS amount FROM lineitem""")
def type_features(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_partkey") % 6 != 0, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_partkey") % 4 != 0, F.col("l_quantity").cast("string")).otherwise("much").alias("amount"),
    )
    return columns.type_features(li, ["flag"], ["amount"], numeric_fill=0.0)


@query("feature_select", """SELECT l_returnflag, l_quantity, l_tax FROM lineitem""")
def feature_select(spark, d):
    li = table(spark, d, "lineitem")
    picked = columns.pick_features(li, [["l_returnflag", "absent"], ["l_quantity", "l_tax", "l_discount", "l_returnflag"]], leaking=["l_discount"])
    return columns.ordered(li, picked)


@query("rename_and_drop", "SELECT o_orderkey AS nr_e_porosise, o_totalprice AS cmimi_perqind, o_orderpriority AS klasi_dhe_lloji FROM orders")
def rename_and_drop(spark, d):
    o = table(spark, d, "orders").toDF("Nr. e porosisë", "Blerësi", "[Statusi]", "Çmimi (%)", "Data/kontratës", 'Klasi & "lloji"')
    kept, _ = columns.drop_present(columns.normalize_columns(o), ["bleresi", "statusi", "data_kontrates", "absent"])
    return kept


@query("step_report", f"""WITH {views.COPIED_ORDERS}, a AS (SELECT DISTINCT o_orderkey, o_custkey, status, price, odate, priority FROM copied)
SELECT 'input' AS step, count(*) AS rows, count(price) AS filled FROM copied UNION ALL SELECT 'distinct', count(*), count(price) FROM a
UNION ALL SELECT 'required', count(*), count(price) FROM a WHERE status IS NOT NULL""")
def step_report(spark, d):
    """The steps run once; their rows are counted as they pass."""
    w = watch.Watch()
    distinct = w.rows(dedup.drop_full_duplicates(w.rows(views.copied_orders(spark, d), "input", ["price"]), "row_id"), "distinct", ["price"])
    w.rows(filters.drop_null(distinct, "status"), "required", ["price"]).write.format("noop").mode("overwrite").save()
    found = w.to_df(spark)
    pick = lambda metric: F.max(F.when(F.col("metric") == metric, F.col("value")))
    return found.groupBy(F.col("section").alias("step")).agg(pick("rows").alias("rows"), pick("filled price").alias("filled"))


@query("parse_losses", """SELECT 'dates' AS section, unnest(['read opened', 'lost opened', 'read amount', 'lost amount']) AS metric, unnest([count(*) FILTER (o_orderkey % 5 < 4), count(*) FILTER (o_orderkey % 5 = 4),
  count(*) FILTER (o_orderkey % 3 > 0), count(*) FILTER (o_orderkey % 3 = 0)])::BIGINT AS value FROM orders""")
def parse_losses(spark, d):
    """What parsing failed to read, counted while the parsed table is written."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey") % 5
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    spelled = (
        F.when(k == 0, F.concat(day, F.lit(" 10:00:00.25"))).when(k == 1, F.concat(day, F.lit("T10:00:00+02:00")))
        .when(k == 2, F.date_format("o_orderdate", "M/d/yy")).when(k == 3, day).otherwise(F.lit("next week"))
    )
    amount = F.when(F.col("o_orderkey") % 3 == 0, F.lit("n/k")).otherwise(F.col("o_totalprice").cast("string"))
    rows = o.select("o_orderkey", spelled.alias("opened_text"), amount.alias("amount_text"))
    w = watch.Watch()
    parsed = w.parsed(rows, "dates", {"opened": dates.parse_lenient("opened_text"), "amount": F.expr("try_cast(amount_text AS DOUBLE)")}, {"opened": "opened_text", "amount": "amount_text"})
    parsed.write.format("noop").mode("overwrite").save()
    return w.to_df(spark)
