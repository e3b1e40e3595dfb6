import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.similarity import sorted_similarity
from ledgerloom.operators import dedup, filters, impute, knn, match, order_stats, outliers, profile, ranking, split
from ledgerloom.sources import sheets, tables


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# ---- order statistics -------------------------------------------------------

@pytest.mark.parametrize("small", [10, 100_000])
def test_quantiles_equal_numpy(spark, small):
    rng = np.random.default_rng(5)
    data = [("a", float(x)) for x in rng.lognormal(3, 2, 4000)] + [("b", float(x)) for x in rng.integers(0, 6, 900)] + [(None, 7.0), ("c", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = {(r["g"], r["prob"]): (r["n"], r["value"]) for r in order_stats.exact_quantiles(df, ["v"], probs, ["g"], accuracy=200, small_group=small).collect()}
    for g in ("a", "b", None):
        xs = [v for k, v in data if k == g]
        for p in probs:
            n, value = got[(g, p)]
            assert n == len(xs) and value == pytest.approx(np.quantile(xs, p), rel=1e-12)
    assert ("c", 0.5) not in got


def test_modes_take_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "x string")
    assert order_stats.modes_of(df, ["x"]) == {"x": "a"}


# ---- ranking ----------------------------------------------------------------

def test_numbering_and_carry_forward(spark):
    df = spark.createDataFrame([(i * 3, "x" if i % 7 == 2 else None) for i in range(50)], "o long, v string")
    numbered = ranking.number_rows(df, "o", "nr", start=5, pieces=5)
    assert [r["nr"] for r in numbered.orderBy("o").collect()] == list(range(5, 55))
    marked = df.withColumn("v", F.when(F.col("v").isNotNull(), F.col("o").cast("string"))).withColumn("s", F.lit("f")).withColumn("b", F.expr("o div 10"))
    got = [r["c"] for r in ranking.carry_forward(marked, "v", "c", "s", "b", "o").orderBy("o").collect()]
    last, want = None, []
    for r in marked.orderBy("o").collect():
        last = r["v"] or last
        want.append(last)
    assert got == want


# ---- filters and duplicates -------------------------------------------------

def test_dedup_keeps_first_and_is_idempotent(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, None, 1), (4, None, 1), (5, "a", 2)], "row_id int, k string, v int")
    kept = dedup.keep_first(df, ["k"], "row_id")
    assert rows_of(kept, "row_id") == [(1, "a", None), (3, None, 1)]
    assert rows_of(dedup.keep_first(kept, ["k"], "row_id"), "row_id") == rows_of(kept, "row_id")
    assert [r[0] for r in rows_of(dedup.drop_full_duplicates(df, "row_id"), "row_id")] == [1, 3, 5]
    assert [r["row_id"] for r in dedup.list_duplicates(df, ["k", "v"]).orderBy("row_id").collect()] == [1, 2, 3, 4]


def test_column_filters(spark):
    rows = [("c", None, "n" if i < 86 else "y", "n" if i < 86 else str(i), i) for i in range(100)]
    df = spark.createDataFrame(rows, "const string, empty string, two string, many string, id int")
    facts = filters.column_facts(df, df.columns)
    assert filters.names_in(filters.sparse_columns(facts, 0.85)) == ["empty"]
    assert filters.names_in(filters.constant_columns(facts)) == ["const", "empty"]
    assert filters.names_in(filters.dominant_columns(facts, 0.85, 3)) == ["const", "empty", "two"]
    with pytest.raises(ValueError, match="empty"):
        filters.assert_no_null(df)


def test_dominant_column_with_many_values(spark):
    df = spark.range(2000).selectExpr("if(id % 10 < 9, 'n', 'v' || (id % 1000)) AS c", "id")
    far = filters.column_facts(df, ["c", "id"], at_most=200)
    assert filters.names_in(filters.dominant_columns(far, 0.85, 200)) == ["c"]
    with pytest.raises(Exception, match="at_most=200"):
        filters.dominant_columns(filters.column_facts(df, ["c"]), 0.85, 200).collect()


def test_profiles(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (None, "a"), (11.0, "b")], "v double, s string")
    assert rows_of(profile.null_profile(df), "column") == [("s", 3, 1, 25.0), ("v", 3, 1, 25.0)]
    assert profile.type_categories(df) == {"Numeric": 1, "Date/Time": 0, "Text/Object": 1}
    bins = profile.histogram(df, ["v"], 5).orderBy("bin").collect()
    assert [r["count"] for r in bins] == [2, 0, 0, 0, 1] and bins[-1]["high"] == 11.0


def test_iqr_bounds_and_flags(spark):
    # Published quartiles and the bounds that belong to them.
    assert outliers.iqr_bounds(918.5, 2539.5, False) == (-1513.0, 4971.0)
    assert outliers.iqr_bounds(0.0, 112.06, True)[1] == pytest.approx(280.15)
    assert outliers.iqr_bounds(13525.0, 146673.3, True) == (0.0, pytest.approx(346395.75))
    df = spark.createDataFrame([(float(i), 1.0) for i in range(20)] + [(500.0, 1.0), (None, 1.0)], "price double, flat double")
    stats = outliers.iqr_stats(df, ["price", "flat"], ["price"])
    assert list(stats) == ["price"] and stats["price"]["lower"] == 0.0 and stats["price"]["outlier_count"] == 1
    assert stats["price"]["outlier_ratio"] == pytest.approx(1 / 22)
    assert outliers.iqr_flags(df, stats).agg(F.sum("price_is_outlier_iqr")).first()[0] == 1


# ---- imputation -------------------------------------------------------------

def test_group_median_sizes_and_null_keys(spark):
    rows = [("five", float(i)) for i in range(5)] + [("four", float(i)) for i in range(4)] + [(None, 3.0)] * 5
    rows += [("five", None), ("four", None), (None, None)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("i", F.monotonically_increasing_id())
    filled = impute.group_median_fill(df, "v", ["g"], 5)
    added = {r["g"]: r["v"] for r in filled.join(df.filter("v is null").select("i"), "i").collect()}
    assert added == {"five": 2.0, "four": None, None: 3.0}
    changed = filled.alias("a").join(df.alias("b"), "i").filter("b.v is not null and a.v <> b.v")
    assert changed.count() == 0 and filled.count() == df.count()


def test_levels_are_sequential(spark):
    # The second level's median includes what the first level filled in.
    rows = [("a", "x", 1.0), ("a", "x", 1.0), ("a", "x", None), ("a", "y", 9.0), ("a", "y", None), ("b", "z", None)]
    df = spark.createDataFrame(rows, "p string, q string, v double")
    filled = impute.hierarchical_median_fill(df, ["v"], [["p", "q"], ["p"]], 2)
    assert sorted((r["q"], r["v"]) for r in filled.collect() if r["v"] is not None) == [("x", 1.0), ("x", 1.0), ("x", 1.0), ("y", 1.0), ("y", 9.0)]


def test_date_and_fallback_fills(spark):
    df = spark.createDataFrame([("2020-01-01", None, "a", None), ("2020-01-03", None, None, None), (None, None, "a", 4)], "d string, e string, t string, n int")
    df = df.withColumn("d", F.col("d").cast("timestamp_ntz")).withColumn("e", F.col("e").cast("timestamp_ntz"))
    both = impute.fill_dates(impute.fill_dates(df, "d"), "e", other="d")
    assert [str(r["d"])[:10] for r in both.orderBy("d").collect()] == ["2020-01-01", "2020-01-02", "2020-01-03"]
    assert {str(r["e"])[:10] for r in both.collect()} == {"2019-01-02"}
    constant = impute.fill_dates(df.select("e"), "e", constant="1999-01-01")
    assert {str(r["e"])[:10] for r in constant.collect()} == {"1999-01-01"}
    done = impute.fill_fallback(df, lambda c: "none")
    filters.assert_no_null(done)
    assert sorted(r["t"] for r in done.collect()) == ["a", "a", "a"] and sorted(r["n"] for r in done.collect()) == [0, 0, 4]


# ---- sheets -----------------------------------------------------------------

def test_stitching_from_files(spark, tmp_path):
    lines = [
        "lost,before,first,x", "Nr.,Priority,Price,Date", "1,Alfa,10,", ",more,,2020", "  ,,,", "Nr.,Priority,Price,Date", "2,Beta  x,,", "tail,,5,end", "03,Gama,,",
    ]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    (tmp_path / "b.csv").write_text("orphan,,,\n9,Solo,1,1\n")
    names = ["c1", "c2", "c3", "c4"]
    grid = tables.read_grid(spark, str(tmp_path), names)
    records = sheets.stitch_records(grid, names, [[r"nr\.", "priority"]])
    got = sorted(tuple(r[c] for c in names) for r in records.collect())
    assert got == [("03", "Gama", "", ""), ("1", "Alfa more", "10", "2020"), ("2 tail", "Beta x", "5", "end"), ("9", "Solo", "1", "1")]


def test_cells_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"two\nlines",x\n,"and ""more""",\n2,b,c\n')
    grid = tables.read_grid(spark, str(tmp_path), ["a", "b", "c"], multiline=True)
    got = sorted(tuple(r[c] for c in "abc") for r in sheets.stitch_records(grid, ["a", "b", "c"]).collect())
    assert got == [("1", 'two lines and "more"', "x"), ("2", "b", "c")]


# ---- matching ---------------------------------------------------------------

def _names(rng, count):
    words = ["alfa", "beta", "gama", "ndertim", "trade", "impex", "ardi", "drini", "korabi", "shpk", "llc", "x", "petrol"]
    return sorted({" ".join(sorted(rng.sample(words, rng.randint(1, 4)))) for _ in range(count)})


def _misspelt(rng, name):
    chars = list(name)
    for _ in range(rng.randint(0, 3)):
        where = rng.randrange(len(chars)) if chars else 0
        if rng.random() < 0.5 and len(chars) > 1:
            del chars[where]
        else:
            chars.insert(where, rng.choice("abcdefgh "))
    return " ".join("".join(chars).split()) or "q"


@pytest.mark.parametrize("threshold", [85.0, 88.0, 70.0])
def test_fuzzy_pairs_equal_brute_force(spark, threshold):
    rng = random.Random(11)
    right = _names(rng, 120)
    left = sorted({_misspelt(rng, rng.choice(right)) for _ in range(150)} | {"a", "ab", "abc"})
    want = {(a, b) for a in left for b in right if sorted_similarity(a, b) >= threshold}
    got = match.fuzzy_pairs(spark.createDataFrame([(a,) for a in left], "a string"), spark.createDataFrame([(b,) for b in right], "b string"), threshold)
    assert {(r["a"], r["b"]) for r in got.collect()} == want and len(want) > 50


def _common(a, b):
    """Longest common subsequence by the plain table, apart from the library's own."""
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            rows[i][j] = rows[i - 1][j - 1] + 1 if x == y else max(rows[i - 1][j], rows[i][j - 1])
    return rows[-1][-1]


def test_a_gram_dealt_over_a_grid_loses_no_pair(spark, monkeypatch):
    monkeypatch.setattr(match, "GRAM_ROWS", 7)
    rng = random.Random(5)
    right = sorted({f"trade {n}" for n in _names(rng, 40)})
    left = sorted({_misspelt(rng, rng.choice(right)) for _ in range(60)})
    want = {(a, b) for a in left for b in right if 200.0 * _common(a, b) >= 85.0 * (len(a) + len(b))}
    got = match.fuzzy_pairs(spark.createDataFrame([(a,) for a in left], "a string"), spark.createDataFrame([(b,) for b in right], "b string"), 85.0)
    pairs = [(r["a"], r["b"]) for r in got.collect()]
    assert set(pairs) == want and len(pairs) == len(want) > 20


def _broadcasts(df):
    return [line.strip() for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastExchange" in line]


def test_sides_that_grow_are_not_broadcast(spark):
    """However small the files are said to be; lists of grams, whose number is bounded, may be."""
    names = spark.createDataFrame([("alfa trade", 0, "alfa trade"), ("drini", 0, "drini")], "name string, pos int, norm string")
    keys = spark.createDataFrame([("alfa trade", 1, 1)], "norm string, reg_id int, last_id int")
    registry = spark.createDataFrame([(1, "Alfa Trade")], "id int, business string")
    hits = match.exact_tier(names, keys)
    enriched = match.enrich(names, "name", hits.withColumn("field", F.lit("b")), registry, "id", {"found": F.col("business")}, {})
    assert _broadcasts(hits) == _broadcasts(enriched) == []
    assert sorted((r["name"], r["found"]) for r in enriched.collect()) == [("alfa trade", "Alfa Trade"), ("drini", "")]
    pairs = match.fuzzy_pairs(names.select(F.col("norm").alias("a")), keys.select(F.col("norm").alias("b")), 88.0)
    assert [(r["a"], r["b"]) for r in pairs.collect()] == [("alfa trade", "alfa trade")]
    # The grams' cells and lengths alone, by their one key.
    assert all("List(input[0, string" in line for line in _broadcasts(pairs))


def test_numbering_ignores_gaps(spark):
    df = spark.range(500).select((F.col("id") * 1_000_003).alias("o"))
    got = ranking.number_rows(df, "o", "nr", pieces=8).orderBy("o").collect()
    assert [r["nr"] for r in got] == list(range(1, 501))
    assert ranking.number_rows(df.limit(0), "o", "nr").count() == 0


def test_repeated_registry_name(spark):
    registry = match.prepare_registry(spark.createDataFrame(
        [(1, "Drini Trade", "x"), (2, "Drini Trade", "y"), (3, "Zeta", "z")], "id int, business string, owner string"), "business", "owner")
    tiers = [match.Tier("business_norm", "b"), match.Tier("business_norm", "bf", 88.0)]
    names = spark.createDataFrame([("Drini Trade",), ("Trade Drinii",)], "name string")
    found = {r["name"]: (r["reg_id"], r["field"]) for r in match.match_names(names, registry, tiers, "id").collect()}
    assert found == {"Drini Trade": (1, "b"), "Trade Drinii": (2, "bf")}


def test_cascade(spark):
    registry = match.prepare_registry(spark.createDataFrame(
        [(1, "Alfa Ndërtim SH.P.K.", "Ana Gashi;1;100"), (2, "alfa ndertim shpk", "Ben Krasniqi;;"), (3, "Drini Trade L.L.C", "Cen Hoxha;5;50"), (4, "Zeta", None)],
        "id int, business string, owner string",
    ), "business", "owner")
    tiers = [match.Tier("business_norm", "b"), match.Tier("owner_norm", "o"), match.Tier("business_norm", "bf", 88), match.Tier("owner_norm", "of", 85)]
    names = ["ALFA NDERTIM Sh.p.k", "Ben Krasniqi, drini trade llc", "cen hoxha", "Trade Drini LLC", "Ana Gashii", "nobody at all", None, ""]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    found = {r["name"]: (r["reg_id"], r["field"], r["score"]) for r in match.match_names(rows, registry, tiers, "id").collect()}
    assert found["ALFA NDERTIM Sh.p.k"] == (1, "b", 100.0)
    assert found["Ben Krasniqi, drini trade llc"] == (3, "b", 100.0)
    assert found["cen hoxha"] == (3, "o", 100.0)
    assert found["Trade Drini LLC"] == (3, "bf", 100.0)
    assert found["Ana Gashii"][:2] == (1, "of") and found["Ana Gashii"][2] == pytest.approx(200 * 9 / 19)
    assert "nobody at all" not in found
    joined = match.enrich(rows, "name", match.match_names(rows, registry, tiers, "id"), registry, "id", {"business_name": F.col("business")}, {})
    assert joined.count() == len(names) and joined.filter("i = 5").first()["business_name"] == ""


# ---- nearest neighbours -----------------------------------------------------

@pytest.mark.parametrize("slab_rows, part, lot, size", [(1000, 64, 64, 3), (10, 7, 5, 3), (10, 4096, 4096, 2), (20, 7, 64, 9)])
def test_knn_equals_brute_force(spark, monkeypatch, slab_rows, part, lot, size):
    monkeypatch.setattr(knn, "PART", part)
    monkeypatch.setattr(knn, "LOT", lot)
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 5, (5, size))
    points = [(i, [float(x) for x in centres[i % 5] + rng.normal(0, 1, size)], str(i % 5)) for i in range(160)]
    points += [(200 + i, points[i % 3][1], "dup") for i in range(60)]
    train = spark.createDataFrame([*points, (900, None, "none")], "id long, vector array<double>, label string")
    asked = [(1000 + i, [float(x) for x in rng.normal(0, 5, size)]) for i in range(40)] + [(5000, points[7][1]), (5001, points[1][1])]
    queries = spark.createDataFrame([*asked, (5002, None)], "id long, vector array<double>")
    got = {}
    for r in knn.knn_join(train, queries, 5, slab_rows=slab_rows).collect():
        got.setdefault(r["id"], {})[r["place"]] = (r["train_id"], r["label"], r["distance"])
    assert set(got) == {i for i, _ in asked}
    for i, v in asked:
        near = sorted((float(np.linalg.norm(np.array(v) - np.array(p[1]))), p[0], p[2]) for p in points)[:5]
        assert [got[i][n][:2] for n in range(1, 6)] == [p[1:] for p in near]
        assert [got[i][n][2] for n in range(1, 6)] == pytest.approx([p[0] for p in near])
    assert knn.knn_join(train.limit(0), queries, 5).count() == 0 and knn.knn_join(train, queries.limit(0), 5).count() == 0
    assert knn.knn_join(train.limit(3), queries.limit(1), 5).count() == 3


def test_prefix_distance_is_a_lower_bound():
    rng = np.random.default_rng(4)
    points = rng.normal(0, 3, (300, 12)) @ rng.normal(0, 1, (12, 12))
    slabs = knn._halved(points, 4)
    prefix = slabs.prefixes(points)
    far = np.linalg.norm(points[:, None] - points[None], axis=2)
    assert (np.linalg.norm(prefix[:, None] - prefix[None], axis=2) <= far + 1e-9).all()
    assert np.bincount(slabs.place(prefix), minlength=16).min() > 10


def test_vote_prefers_exact_hits(spark):
    near = spark.createDataFrame([(1, "a", 0.0), (1, "b", 0.001), (1, "b", 0.001), (2, "a", 1.0), (2, "b", 0.4)], "id long, label string, distance double")
    assert rows_of(knn.knn_vote(near), "id") == [(1, "a"), (2, "b")]


# ---- splits -----------------------------------------------------------------

def test_splits_cover_and_are_even(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(203)], "id int, label string")
    train, test = split.train_test(df, ["id"], 0.2)
    assert test.count() == 41 and train.count() == 162 and train.join(test, "id").count() == 0
    folds = split.stratified_folds(df, ["id"], "label", 5)
    sizes = {}
    for r in folds.groupBy("label", "fold").count().collect():
        sizes.setdefault(r["label"], []).append(r["count"])
    assert all(max(s) - min(s) <= 1 and len(s) == 5 for s in sizes.values())
    assert rows_of(split.split_flag(df, ["id"], 0.2), "id") == rows_of(split.split_flag(df.repartition(3), ["id"], 0.2), "id")


def test_split_size_rounds_up(spark):
    df = spark.range(2628)
    assert split.train_test(df, ["id"], 0.2)[1].count() == 526


def test_spellings_are_normalised_once(spark, monkeypatch):
    # A filter on the comparable form was moved below it, so that each spelling was normalised twice; and a cell of one name came twice.
    plans, real, written = [], match.cut_lineage, []

    def spied(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        written.append(real(df))
        return written[-1]

    monkeypatch.setattr(match, "cut_lineage", spied)
    names = spark.createDataFrame([("Alfa shpk",), ("Beta, Gama",), ("?",), (None,)], "name string")
    registry = spark.createDataFrame([(1, "alfa shpk"), (2, "gama"), (3, "beta gama")], "id int, norm string")
    found = match.match_names(names, registry, [match.Tier("norm", "firm")], "id")
    assert sorted((r["name"], r["reg_id"]) for r in found.collect()) == [("Alfa shpk", 1), ("Beta, Gama", 3)]
    assert plans[0].count("[^a-z0-9]+") == 1
    assert [r["n"] for r in written[0].groupBy("name").agg(F.count("*").alias("n")).orderBy("name").collect()] == [1, 1, 4]


def test_registry_text_is_made_by_all_tasks(spark, tmp_path):
    from ledgerloom.plans import views

    rows = [(i, i % 25, "BUILDING") for i in range(100)]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_mktsegment string").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    made = views.registry_rows(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() > 1 and made.count() == 100


def test_only_the_activity_taken_is_parsed(spark):
    df = spark.createDataFrame([("1, 2;a,b;P",)], "source string").select(match.activity_columns("source")["activity_2_code"].alias("code"))
    assert df.first()["code"] == "2"
    assert "description" not in df._jdf.queryExecution().optimizedPlan().toString()
