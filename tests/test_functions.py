import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, rules, text
from ledgerloom.functions import features as fx
from ledgerloom.functions.similarity import lcs_length, sorted_similarity
from ledgerloom.operators import watch
from ledgerloom.plans import values
from ledgerloom.sources import columns


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first()["y"]


def many(spark, cases, expression):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    return [r["y"] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_spaces_knows_no_break_space(spark):
    assert many(spark, ["a\n b", " a  b ", None, "\r\n"], text.clean_spaces) == ["a b", "a b", "", ""]


def test_locale_number(spark):
    cases = ["1,350.00", "1.897,90", "12,5", "1,350", "€ 50", "text", "50", "", "7 EUR", "1,2,3", "1e3", "-4.5", "1 234"]
    assert many(spark, cases, text.locale_number) == [1350.0, 1897.9, 12.5, 1350.0, 50.0, None, 50.0, None, 7.0, None, 1000.0, -4.5, None]


def test_clean_numeric_drops_commas(spark):
    cases = ["1.897,90", "€ 1,250.50", "nan", "<NA>", "None", " ", "5%", "1-2", "abc", "-3"]
    assert many(spark, cases, text.clean_numeric) == [1.8979, 1250.5, None, None, None, None, 5.0, None, None, -3.0]


def test_entity_name(spark):
    cases = [" Müller & Söhne Sh.P.K. ", "ÇELIKU SH.A", "X L.L.C.", "A/B,C.D;E\"F'G", "ﬁrma ĳ", "ëma", "日本 co", None, "sh.p.k.a"]
    assert many(spark, cases, text.entity_name) == ["muller dhe sohne shpk", "celiku sha", "x llc", "a b c d e f g", "firma ij", "ema", "co", "", "shpka"]


def test_name_candidates(spark):
    got = one(spark, " Alfa SH.P.K , Beta dhe alfa shpk ", text.name_candidates)
    assert [(c["name"], c["norm"]) for c in got] == [
        ("Alfa SH.P.K , Beta dhe alfa shpk", "alfa shpk beta dhe alfa shpk"), ("Alfa SH.P.K", "alfa shpk"), ("Beta", "beta"),
        ("Alfa SH.P.K Beta alfa shpk", "alfa shpk beta alfa shpk"),
    ]
    assert one(spark, None, text.name_candidates) == []
    assert [c["norm"] for c in one(spark, "solo", text.name_candidates)] == ["solo"]


def test_nested_fields(spark):
    assert tuple(one(spark, " Ana ; 10 ;50", text.owner_fields)) == ("Ana", "10", "50")
    assert tuple(one(spark, None, text.owner_fields)) == ("", "", "")
    got = one(spark, "1, 2,3,4,5,6;a,b", text.activity_fields)
    assert [tuple(a) for a in got] == [("1", "a", ""), ("2", "b", ""), ("3", "", ""), ("4", "", ""), ("5", "", "")]


def test_dates(spark):
    assert [str(d) if d else None for d in many(spark, ["3/4/2020", "31.12.1999", "2020-01-02", "junk", ""], dates.parse_day_first)] == [
        "2020-04-03 00:00:00", "1999-12-31 00:00:00", "2020-01-02 00:00:00", None, None]
    stamp = "2021-03-28 02:30:15.123456"
    back = one(spark, stamp, lambda c: dates.from_epoch_micros(dates.epoch_micros(c.cast("timestamp_ntz"))).cast("string"))
    assert back == stamp


def test_age_days(spark):
    rows = spark.createDataFrame(
        [("2020-01-10 00:00:00", "2020-01-01 12:00:00"), ("2020-01-01", "2020-02-01"), (None, "2020-01-01")], "a string, b string"
    ).select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    assert [r[0] for r in rows.select(dates.age_days("a", "b")).collect()] == [8, 0, None]


def test_asset_masks(spark):
    masks = rules.asset_masks(text.rule_text(F.col("x")), values.LAND_PATTERN, values.OBJECT_PATTERN, values.MIXED_PATTERN)
    cases = ["Tokë bujqësore", "Lokal", "Depo dhe tokë", "lokal me parcelë", "Anije", "toke", "Ndërtesë"]
    label = lambda c: rules.masks_to_label(masks, values.STRUCTURE_LABELS, values.UNKNOWN_STRUCTURE)
    # The object pattern is written without accents, so an accented spelling is not met.
    assert many(spark, cases, label) == [
        "land_only", "object_only", "mixed_asset", "mixed_asset", "unknown_asset_type", "land_only", "unknown_asset_type"]


def test_rent_rules(spark):
    years = lambda c: rules.return_years(c, values.RETURN_YEARS, values.DEFAULT_RETURN_YEARS)
    assert many(spark, ["Lokal afarist", "Kioska", "Fabrikë", "TOKË BUJQËSORE", "tjeter", "toke komerciale me depo"], years) == [15, 10, 20, 25, 15, 15]
    rows = spark.createDataFrame([("100", "mujore"), ("100", "vjetore"), ("100", ""), ("x", "mujore")], "v string, p string")
    got = rows.select(rules.annual_amount("v", "p", values.PERIOD_FACTORS)).collect()
    # 'mujore' holds 'mujor'; an unreadable amount stays missing.
    assert [r[0] for r in got] == [1200.0, 100.0, 100.0, None]


def test_profile_rules(spark):
    code = lambda c: rules.range_bucket(c, values.ACTIVITY_RANGES, "unknown")
    assert many(spark, ["1", "399.9", "400", "1000", "8399", "8400", None, "9999", "10000"], code) == [
        "primary", "primary", "unknown", "manufacturing", "unknown", "public_social", "unknown", "other_services", "unknown"]
    rows = spark.createDataFrame([("Biznes Individual", "x"), ("Ortakëri", ""), (None, "Firma SH.P.K"), ("tjeter", "Ana")], "k string, n string")
    got = rows.select(rules.entity_group(F.col("k"), F.col("n"), values.ENTITY_RULES, values.COMPANY_TOKENS)).collect()
    assert [r[0] for r in got] == ["individual", "partnership", "company", "other"]


def test_guarded_ratio(spark):
    rows = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, None), (None, 2.0), (1.0, -2.0)], "a double, b double")
    assert [r[0] for r in rows.select(fx.guarded_ratio("a", "b")).collect()] == [2.5, 0.0, 0.0, None, 0.0]


def test_similarity():
    assert lcs_length("abcbdab", "bdcaba") == 4
    assert sorted_similarity("", "") == 100.0
    assert sorted_similarity("abc", "abd") == pytest.approx(200 * 2 / 6)


def test_column_names(spark):
    assert columns.normalize_name(" Sipërfaqja e tokës (në m²) [m2] ") == "siperfaqja_e_tokes_ne_m_m2"
    assert columns.normalize_name("Komuna/Qyteti & Zona 5%") == "komuna_qyteti_dhe_zona_5_perqind"
    with pytest.raises(ValueError, match="collide"):
        columns.normalize_columns(spark.createDataFrame([(1, 2)], ["A b", "a-B"]))
    with pytest.raises(ValueError, match="missing"):
        columns.require_columns(spark.range(1), ["nope"])


def test_feature_groups_sizes(spark):
    everything = [c for g in values.FEATURE_GROUPS.values() for c in g]
    df = spark.createDataFrame([], ", ".join(f"`{c}` double" for c in dict.fromkeys(everything)))
    groups = [values.FEATURE_GROUPS[g] for g in values.FEATURE_MODES["full"]]
    assert len(columns.pick_features(df, groups)) == 52
    assert len(columns.pick_features(df, groups, dropped=values.PRUNED_AWAY)) == 33


def test_lenient_dates_and_their_losses(spark):
    texts = ["2024-03-01 10:11:12.5", "2024-03-01T10:11:12.123456", "2024-03-01T10:11:12+02:00", "2024-03-01 10:11:12.25Z", "3/1/99", "3/1/24", "03/01/2024", "soon", " ", None]
    want = ["2024-03-01 10:11:12.5", "2024-03-01 10:11:12.123456", "2024-03-01 08:11:12", "2024-03-01 10:11:12.25", "1999-03-01 00:00:00", "2024-03-01 00:00:00", "2024-03-01 00:00:00", None, None, None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    w = watch.Watch()
    rows = w.parsed(w.rows(df, "input", ["t"]), "dates", {"day": dates.parse_lenient("t")}, {"day": "t"}).orderBy("i").collect()
    assert [None if r["day"] is None else str(r["day"]).rstrip("0") if "." in str(r["day"]) else str(r["day"]) for r in rows] == want
    assert rows[0].asDict().keys() == {"i", "t", "day"}
    assert w.facts() == [("input", "rows", 10), ("input", "filled t", 9), ("dates", "read day", 7), ("dates", "lost day", 1)]
