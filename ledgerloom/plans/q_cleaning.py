"""Catalogue: text, numbers, dates, rules, sheets, filters, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import dates, rules, text
from ledgerloom.functions import features as fx
from ledgerloom.operators import dedup, filters, ranking
from ledgerloom.plans import values, views
from ledgerloom.plans.registry import query, table
from ledgerloom.sources import columns, sheets


@query("clean_numeric", f"""WITH {views.PRICE_TEXT}
SELECT o_orderkey, TRY_CAST(regexp_replace(CASE WHEN trim(price_text) IN ('', 'nan', 'None', '<NA>') THEN NULL ELSE trim(price_text) END,
  '[^0-9.\\-]', '', 'g') AS DOUBLE) AS value FROM price_text""")
def clean_numeric(spark, d):
    return views.price_text(spark, d).select("o_orderkey", text.clean_numeric("price_text").alias("value"))


@query("parse_locale_number", f"""WITH {views.PRICE_TEXT}, t AS (
  SELECT o_orderkey, cents // 100 AS units, lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS rest FROM price_text)
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 4 THEN NULL WHEN 3 THEN CAST(units AS DOUBLE)
  WHEN 5 THEN CAST(units % 1000 AS DOUBLE) + CAST(substr(rest, 1, 1) AS DOUBLE) / 10
  ELSE CAST(units || '.' || rest AS DOUBLE) END AS value FROM t""")
def parse_locale_number(spark, d):
    p = views.price_text(spark, d)
    k, units, rest = F.col("o_orderkey") % 6, F.expr("cents div 100"), F.lpad((F.col("cents") % 100).cast("string"), 2, "0")
    high, low = F.expr("cents div 100000").cast("string"), F.lpad(((F.expr("cents div 100")) % 1000).cast("string"), 3, "0")
    grouped = lambda mark: F.when(units >= 1000, F.concat(high, F.lit(mark), low)).otherwise(units.cast("string"))
    spelled = (
        F.when(k == 0, F.concat(grouped(","), F.lit("."), rest)).when(k == 1, F.concat(grouped("."), F.lit(","), rest))
        .when(k == 2, F.concat(F.lit("EUR "), F.col("plain"))).when(k == 3, grouped(","))
        .when(k == 4, F.lit("no price")).otherwise(F.concat((units % 1000).cast("string"), F.lit(","), F.substring(rest, 1, 1), F.lit("\n€")))
    )
    return p.select("o_orderkey", text.locale_number(spelled).alias("value"))


@query("parse_dates", """WITH t AS (SELECT o_orderkey, o_orderkey % 5 AS k, o_orderdate AS d FROM orders)
SELECT o_orderkey, CASE WHEN k = 4 THEN NULL ELSE CAST(d AS VARCHAR) END AS day_first,
  CASE WHEN k IN (2, 3) THEN CAST(d AS VARCHAR)
    WHEN k = 0 AND extract(day FROM d) <= 12 THEN strftime(strptime(strftime(d, '%d/%m/%Y'), '%m/%d/%Y'), '%Y-%m-%d %H:%M:%S') END AS lenient
FROM t""")
def parse_dates(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey") % 5
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    day, month, year = two(F.dayofmonth("o_orderdate")), two(F.month("o_orderdate")), F.year("o_orderdate").cast("string")
    spelled = (
        F.when(k == 0, F.concat_ws("/", day, month, year)).when(k == 1, F.concat_ws(".", day, month, year))
        .when(k == 2, F.concat_ws("-", year, month, day)).when(k == 3, F.col("o_orderdate").cast("string")).otherwise(F.lit("next week"))
    )
    return o.select(
        "o_orderkey", dates.parse_day_first(spelled).cast("string").alias("day_first"), dates.parse_timestamp(spelled).cast("string").alias("lenient")
    )


@query("normalize_names", f"""WITH {views.BUYERS}
SELECT o_orderkey, {views.norm_sql('buyer')} AS norm, trim(regexp_replace(lower(buyer), '\\s+', ' ', 'g')) AS rule_text FROM buyers""")
def normalize_names(spark, d):
    return views.buyer_rows(spark, d).select("o_orderkey", text.entity_name("buyer").alias("norm"), text.rule_text("buyer").alias("rule_text"))


CANDIDATES = f"""parts AS (
  SELECT o_orderkey, trim(buyer) AS raw, list_filter(list_transform(string_split_regex(trim(buyer), '(?i),|/|;| dhe | and '), lambda p: trim(p)), lambda p: p <> '') AS p
  FROM buyers), spelled AS (
  SELECT o_orderkey, list_concat([raw], p, CASE WHEN len(p) > 1 THEN [array_to_string(p, ' ')] ELSE [] END) AS s FROM parts),
  numbered AS (SELECT o_orderkey, unnest(s) AS name, generate_subscripts(s, 1) AS i FROM spelled),
  normed AS (SELECT o_orderkey, name, i, {views.norm_sql('name')} AS norm FROM numbered),
  first_seen AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey, norm ORDER BY i) AS seen FROM normed WHERE norm <> ''),
  candidates AS (SELECT o_orderkey, norm, name, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY i) - 1 AS BIGINT) AS pos FROM first_seen WHERE seen = 1)"""


@query("split_names", f"WITH {views.BUYERS}, {CANDIDATES} SELECT o_orderkey, pos, name, norm FROM candidates")
def split_names(spark, d):
    b = views.buyer_rows(spark, d)
    return b.select("o_orderkey", F.posexplode(text.name_candidates("buyer")).alias("pos", "c")).select("o_orderkey", F.col("pos").cast("long").alias("pos"), "c.name", "c.norm")


@query("parse_nested_fields", f"""WITH {views.REGISTRY}, s AS (
  SELECT reg_order, string_split(owner_field, ';') AS o, string_split(activity_field, ';') AS a FROM registry)
SELECT reg_order, i, trim(o[1]) AS owner, trim(o[2]) AS capital, trim(o[3]) AS percent,
  coalesce(trim(string_split(a[1], ',')[i]), '') AS code, coalesce(trim(string_split(a[2], ',')[i]), '') AS description,
  coalesce(trim(string_split(a[3], ',')[i]), '') AS type
FROM s, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS i)""")
def parse_nested_fields(spark, d):
    r = views.registry_rows(spark, d)
    owner = text.owner_fields("owner_field")
    return r.select("reg_order", owner.alias("o"), F.posexplode(text.activity_fields("activity_field")).alias("p", "a")).select(
        "reg_order", (F.col("p") + 1).alias("i"), "o.owner", "o.capital", "o.percent", "a.code", "a.description", "a.type"
    )


PART_TEXT = "lower(p_name || ' ' || p_type)"


@query("classify_assets", f"""WITH t AS (SELECT p_partkey, {PART_TEXT} AS x FROM part), f AS (
  SELECT p_partkey, regexp_matches(x, 'ring\\b|bolt|plate') AS l, regexp_matches(x, 'widget|gear|standard|promo') AS o,
    regexp_matches(x, 'hot\\s+(rod|anvil)') AS m FROM t)
SELECT p_partkey, CASE WHEN l AND NOT o AND NOT m THEN 'land_only' WHEN o AND NOT l AND NOT m THEN 'object_only'
  WHEN m OR (l AND o) THEN 'mixed_asset' ELSE 'unknown_asset_type' END AS kind FROM f""")
def classify_assets(spark, d):
    masks = rules.asset_masks(text.joined_text(["p_name", "p_type"]), r"ring\b|bolt|plate", "widget|gear|standard|promo", r"hot\s+(rod|anvil)")
    label = rules.masks_to_label(masks, values.STRUCTURE_LABELS, values.UNKNOWN_STRUCTURE)
    return table(spark, d, "part").select("p_partkey", label.alias("kind"))


@query("bucket_keywords", """SELECT p_partkey, CASE WHEN contains(lower(p_name), 'ring') THEN 'land' WHEN regexp_matches(lower(p_name), 'rod|gear|old') THEN 'object'
  WHEN regexp_matches(lower(p_name), 'bolt|hot') THEN 'special_object' ELSE 'other' END AS bucket,
  CASE WHEN contains(lower(p_type || ' ' || p_brand), 'mall') THEN 'village' ELSE 'city' END AS place,
  contains(lower(p_name), 'o') AND contains(lower(p_name), 'd') AS has_all FROM part""")
def bucket_keywords(spark, d):
    name = F.lower(F.col("p_name"))
    return table(spark, d, "part").select(
        "p_partkey", rules.first_regex(name, [("ring", "land"), ("rod|gear|old", "object"), ("bolt|hot", "special_object")], "other").alias("bucket"),
        rules.place_kind("p_type", "p_brand", "mall", "village", "city").alias("place"), text.contains_all("p_name", ["O", "d"]).alias("has_all"),
    )


@query("lookup_rules", """WITH t AS (SELECT p_partkey, lower(p_name) AS c, p_retailprice AS v, p_type AS period, contains(lower(p_name), 'ring') OR contains(lower(p_name), 'old') AS l,
    contains(lower(p_name), 'gear') OR contains(lower(p_name), 'cold') AS o FROM part),
  y AS (SELECT *, CASE WHEN contains(c, 'ring') THEN 25 WHEN contains(c, 'old') THEN 10 WHEN contains(c, 'gear') THEN 20 ELSE 15 END AS years,
    v * CASE WHEN contains(lower(period), 'small') THEN 12 ELSE 1 END AS yearly FROM t)
SELECT p_partkey, years, round(yearly, 2) AS yearly, round(yearly * years, 2) AS sale_value,
  CASE WHEN NOT (l AND NOT o) THEN v END AS object_area, CASE WHEN l AND NOT o THEN v END AS land_area FROM y""")
def lookup_rules(spark, d):
    p = table(spark, d, "part")
    years = rules.return_years("p_name", [("ring", 25), ("old", 10), ("gear", 20)], 15)
    yearly = rules.annual_amount(F.col("p_retailprice"), "p_type", [("small", 12), ("large", 1)])
    house, land = rules.route_area("p_name", F.col("p_retailprice"), ["ring", "old"], ["gear", "cold"])
    return p.select(
        "p_partkey", years.alias("years"), rules.money(yearly).alias("yearly"), rules.money(yearly * years).alias("sale_value"),
        house.alias("object_area"), land.alias("land_area"),
    )


@query("profile_label", """WITH j AS (SELECT o_orderkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Biznes individual' WHEN 'FURNITURE' THEN 'Shoqëri aksionare'
      WHEN 'MACHINERY' THEN 'Shoqëri me përgjegjësi të kufizuara' WHEN 'BUILDING' THEN 'Dega e huaj' ELSE NULL END AS kind,
    CASE WHEN o_custkey % 2 = 0 THEN 'Firma L.L.C' ELSE 'Firma' END AS name, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE (o_orderkey * 37) % 10100 END AS code
    FROM orders JOIN customer ON o_custkey = c_custkey),
  g AS (SELECT o_orderkey, CASE WHEN kind = 'Biznes individual' THEN 'individual' WHEN kind = 'Shoqëri aksionare' THEN 'corporation'
      WHEN kind = 'Dega e huaj' THEN 'branch' WHEN kind IS NOT NULL THEN 'llc' WHEN name = 'Firma L.L.C' THEN 'company' ELSE 'other' END AS grp,
    CASE WHEN code BETWEEN 1 AND 399 THEN 'primary' WHEN code BETWEEN 8400 AND 8899 THEN 'public_social'
      WHEN code BETWEEN 1000 AND 3399 OR code BETWEEN 3500 AND 3999 OR code BETWEEN 4100 AND 4399 THEN 'industrial_ops'
      WHEN code BETWEEN 4500 AND 4799 OR code BETWEEN 4900 AND 5699 OR code BETWEEN 5800 AND 8299 OR code BETWEEN 9000 AND 9999 THEN 'commercial_services'
      ELSE 'unknown' END AS macro FROM j)
SELECT o_orderkey, grp || '__' || macro AS profile FROM g WHERE grp || '__' || macro IN ('llc__commercial_services', 'individual__industrial_ops',
  'individual__public_social', 'individual__commercial_services', 'llc__industrial_ops', 'llc__primary', 'individual__primary', 'individual__unknown')""")
def profile_label(spark, d):
    c = table(spark, d, "customer")
    kinds = {"HOUSEHOLD": "Biznes individual", "FURNITURE": "Shoqëri aksionare", "MACHINERY": "Shoqëri me përgjegjësi të kufizuara", "BUILDING": "Dega e huaj"}
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("c_mktsegment")]
    j = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", kind.alias("kind"), F.when(F.col("o_custkey") % 2 == 0, "Firma L.L.C").otherwise("Firma").alias("name"),
        F.when(F.col("o_orderkey") % 9 != 0, (F.col("o_orderkey") * 37) % 10100).alias("code"),
    )
    group = rules.entity_group(F.col("kind"), F.col("name"), values.ENTITY_RULES, values.COMPANY_TOKENS)
    macro = rules.roll_up(rules.range_bucket(F.col("code"), values.ACTIVITY_RANGES, "unknown"), values.MACRO_GROUPS, "unknown")
    labelled = j.select("o_orderkey", rules.profile_label(group, macro).alias("profile"))
    return filters.keep_allowed(labelled, "profile", values.ALLOWED_PROFILES)


@query("profile_summary", """WITH t AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE o_orderpriority END || '__' || o_orderstatus AS p FROM orders)
SELECT count(DISTINCT p) AS profiles, count(*) FILTER (WHERE contains(p, 'unknown')) AS unknown_rows FROM t""")
def profile_summary(spark, d):
    p = rules.profile_label(F.when(F.col("o_orderkey") % 3 == 0, "unknown").otherwise(F.col("o_orderpriority")), F.col("o_orderstatus"))
    return table(spark, d, "orders").select(p.alias("p")).agg(F.count_distinct("p").alias("profiles"), F.count_if(F.contains("p", F.lit("unknown"))).alias("unknown_rows"))


LINE_AREAS = """lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END AS oa,
    CASE WHEN l_linenumber % 4 <> 0 THEN l_tax * 100 END AS la, CASE WHEN l_suppkey % 9 <> 0 THEN l_extendedprice - 2000 END AS price,
    l_shipdate, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _line_areas(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")).alias("oa"),
        F.when(F.col("l_linenumber") % 4 != 0, F.col("l_tax") * 100).alias("la"),
        F.when(F.col("l_suppkey") % 9 != 0, F.col("l_extendedprice") - 2000).alias("price"), "l_shipdate", "o_orderdate",
    )


@query("derive_features", f"""WITH {LINE_AREAS}, t AS (SELECT *, coalesce(oa, 0) + coalesce(la, 0) AS total FROM lines)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(total, 6) AS total_area, CASE WHEN coalesce(la, 0) > 0 THEN coalesce(oa, 0) / la ELSE 0 END AS ratio,
  CASE WHEN total > 0 THEN price / total ELSE 0 END AS price_per_total, round(ln(1 + greatest(coalesce(price, 0), 0)), 6) AS log_price,
  CAST(oa IS NOT NULL AS INTEGER) + CAST(la IS NOT NULL AS INTEGER) AS completeness, CAST(oa IS NULL AS INTEGER) AS oa_was_missing,
  CAST(coalesce(oa > 0, false) AS INTEGER) AS has_object, CASE WHEN price IS NULL OR total <= 0 THEN 0 ELSE total * (price / total) END AS interaction,
  extract(year FROM l_shipdate) AS ship_year, extract(month FROM l_shipdate) AS ship_month, extract(quarter FROM l_shipdate) AS ship_quarter,
  greatest(date_diff('day', o_orderdate, l_shipdate), 0) AS age_days, round(greatest(date_diff('day', o_orderdate, l_shipdate), 0) / 365.25, 6) AS age_years FROM t""")
def derive_features(spark, d):
    t = _line_areas(spark, d).withColumn("total", fx.row_sum(["oa", "la"])).withColumn("ppt", fx.guarded_ratio("price", "total")).withColumn("age_days", dates.age_days("l_shipdate", "o_orderdate"))
    parts = dates.calendar_parts("l_shipdate", "ship")
    return t.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("total", 6).alias("total_area"),
        fx.guarded_ratio(fx.zero_if_null("oa"), fx.zero_if_null("la")).alias("ratio"), F.col("ppt").alias("price_per_total"),
        F.round(fx.log_amount("price"), 6).alias("log_price"), fx.presence_score(["oa", "la"]).alias("completeness"), fx.missing_flag("oa").alias("oa_was_missing"),
        fx.flag(F.col("oa") > 0).alias("has_object"), (fx.zero_if_null("total") * fx.zero_if_null("ppt")).alias("interaction"),
        *[c.cast("long").alias(n) for n, c in parts.items()], "age_days", F.round(dates.age_years("age_days"), 6).alias("age_years"),
    )


# ---- sheets -----------------------------------------------------------------

SHEET_COLUMNS = ["c1", "c2", "c3", "c4"]
HEADING = [[r"\bnr\b", "priority"], ["total price"]]


def sheet_grid(spark, d):
    """Orders as a dirty sheet per status: start rows, continuations, blanks, headings."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    row = lambda place, *cells: F.struct(F.lit(place).alias("place"), F.array(*cells).alias("cells"))
    none = F.lit("")
    rows = F.filter(F.array(
        F.when(k % 50 == 0, row(0, F.lit("Nr."), F.lit("Priority"), F.lit("Price"), F.lit("Date"))),
        F.when(k % 41 != 0, row(1, k.cast("string"), F.concat(F.lit(" "), F.col("o_orderpriority")), F.lit("a"), none)),
        F.when(k % 3 == 0, row(2, none, F.lit("more"), none, F.concat(F.lit("x\n"), k.cast("string")))),
        F.when(k % 8 == 0, row(3, none, F.lit("  "), none, none)),
        F.when(k % 5 == 0, row(4, F.lit("b"), none, F.lit("c  d"), F.lit("end"))),
    ), lambda r: r.isNotNull())
    flat = o.select(F.col("o_orderstatus").alias("source"), "o_orderkey", F.inline(rows))
    return flat.select("source", (F.col("o_orderkey") * 5 + F.col("place")).alias("pos"), *[F.col("cells")[i].alias(c) for i, c in enumerate(SHEET_COLUMNS)]).withColumn(
        "block", ranking.block_of("pos")
    )


SHEET = """grid AS (
  SELECT o_orderstatus AS source, o_orderkey * 5 + 0 AS pos, 'Nr.' AS c1, 'Priority' AS c2, 'Price' AS c3, 'Date' AS c4 FROM orders WHERE o_orderkey % 50 = 0
  UNION ALL SELECT o_orderstatus, o_orderkey * 5 + 1, CAST(o_orderkey AS VARCHAR), o_orderpriority, 'a', '' FROM orders WHERE o_orderkey % 41 <> 0
  UNION ALL SELECT o_orderstatus, o_orderkey * 5 + 2, '', 'more', '', 'x ' || o_orderkey FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderstatus, o_orderkey * 5 + 3, '', '', '', '' FROM orders WHERE o_orderkey % 8 = 0
  UNION ALL SELECT o_orderstatus, o_orderkey * 5 + 4, 'b', '', 'c d', 'end' FROM orders WHERE o_orderkey % 5 = 0),
  kept AS (SELECT * FROM grid WHERE NOT (c1 = '' AND c2 = '' AND c3 = '' AND c4 = '') AND c1 <> 'Nr.'),
  owned AS (SELECT *, last_value(CASE WHEN regexp_full_match(c1, '\\d+') THEN pos END IGNORE NULLS)
    OVER (PARTITION BY source ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS record FROM kept),
  records AS (SELECT source, record, string_agg(c1, ' ' ORDER BY pos) FILTER (WHERE c1 <> '') AS c1, string_agg(c2, ' ' ORDER BY pos) FILTER (WHERE c2 <> '') AS c2,
    string_agg(c3, ' ' ORDER BY pos) FILTER (WHERE c3 <> '') AS c3, coalesce(string_agg(c4, ' ' ORDER BY pos) FILTER (WHERE c4 <> ''), '') AS c4
    FROM owned WHERE record IS NOT NULL GROUP BY source, record)"""


@query("stitch_records", f"WITH {SHEET} SELECT source, record, c1, c2, c3, c4 FROM records")
def stitch_records(spark, d):
    records = sheets.stitch_records(sheet_grid(spark, d), SHEET_COLUMNS, HEADING)
    return records.select("source", F.col("record.pos").alias("record"), *SHEET_COLUMNS)


@query("drop_header_rows", f"WITH {SHEET} SELECT source, pos, c1 FROM kept")
def drop_header_rows(spark, d):
    return sheets.kept_rows(sheet_grid(spark, d), SHEET_COLUMNS, HEADING).select("source", "pos", F.col("cells")[0].alias("c1"))


@query("type_records", f"""WITH {SHEET}, t AS (SELECT source, record, c1, c4 FROM records)
SELECT source, record, TRY_CAST(c1 AS DOUBLE) AS number, trim(c4) AS note FROM t""")
def type_records(spark, d):
    records = sheets.stitch_records(sheet_grid(spark, d), SHEET_COLUMNS, HEADING)
    typed = sheets.type_records(records, {"c1": text.parse_float, "c4": text.clean_spaces})
    return typed.select("source", F.col("record.pos").alias("record"), F.col("c1").alias("number"), F.col("c4").alias("note"))


@query("convert_and_union", """WITH sales AS (SELECT o_orderkey AS nr, 'S_' || o_orderkey AS asset, o_orderpriority AS category, o_totalprice AS price, o_orderkey * 2 AS place, CAST(NULL AS DOUBLE) AS area FROM orders),
  rents AS (SELECT 'RENT_' || event_id AS asset, event_type AS category, round(value * CASE WHEN event_type = 'click' THEN 12 ELSE 1 END * CASE event_type WHEN 'click' THEN 10 WHEN 'view' THEN 25 ELSE 15 END, 2) AS price,
    value AS area, event_id FROM events),
  numbered AS (SELECT asset, category, price, area, (SELECT max(nr) FROM sales) + row_number() OVER (ORDER BY event_id) AS nr FROM rents)
SELECT CAST(row_number() OVER (ORDER BY nr) AS BIGINT) AS nr, asset, category, round(price, 2) AS price, area FROM (SELECT nr, asset, category, price, area FROM sales UNION ALL SELECT nr, asset, category, price, area FROM numbered)""")
def convert_and_union(spark, d):
    sales = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("nr"), F.concat(F.lit("S_"), F.col("o_orderkey").cast("string")).alias("asset"), F.col("o_orderpriority").alias("category"), F.col("o_totalprice").alias("price")
    )
    rents = table(spark, d, "events")
    years = rules.return_years("event_type", [("click", 10), ("view", 25)], 15)
    yearly = rules.annual_amount(F.col("value"), "event_type", [("click", 12)])
    last = sales.agg(F.max("nr")).first()[0] or 0
    converted = ranking.number_rows(rents, "event_id", "nr", start=last + 1).select(
        "nr", F.concat(F.lit("RENT_"), F.col("event_id").cast("string")).alias("asset"), F.col("event_type").alias("category"),
        rules.money(yearly * years).alias("price"), F.col("value").alias("area"),
    )
    both = columns.ordered(columns.add_missing(sales, {"area": "double"}), converted.columns).unionByName(converted)
    return ranking.number_rows(both.withColumnRenamed("nr", "old"), "old", "nr").select("nr", "asset", "category", F.round("price", 2).alias("price"), "area")


@query("number_rows", "SELECT event_id, CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) AS nr FROM events")
def number_rows(spark, d):
    return ranking.number_rows(table(spark, d, "events").select("event_id"), "event_id", "nr")


# ---- filters ----------------------------------------------------------------

@query("filter_required", f"WITH {views.MESSY_ORDERS} SELECT o_orderkey, status, priority FROM messy_orders WHERE status IS NOT NULL AND priority IS NOT NULL")
def filter_required(spark, d):
    m = columns.require_columns(views.messy_orders(spark, d), ["status", "priority"])
    return filters.drop_null(filters.drop_null(m, "status"), "priority").select("o_orderkey", "status", "priority")


@query("filter_allowed", f"WITH {views.MESSY_ORDERS} SELECT o_orderkey, priority FROM messy_orders WHERE priority IN ('1-URGENT', '3-MEDIUM')")
def filter_allowed(spark, d):
    return filters.keep_allowed(views.messy_orders(spark, d).select("o_orderkey", "priority"), "priority", ["1-URGENT", "3-MEDIUM"])


@query("filter_rare", """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 10)""")
def filter_rare(spark, d):
    return filters.drop_rare(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 10)


@query("filter_rare_learned", """WITH keep AS (SELECT l_partkey FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_partkey HAVING count(*) >= 15)
SELECT l_linestatus, l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM keep) GROUP BY 1, 2""")
def filter_rare_learned(spark, d):
    li = table(spark, d, "lineitem").select("l_linestatus", "l_partkey")
    train, other = li.filter("l_linestatus = 'F'"), li.filter("l_linestatus <> 'F'")
    a, b = filters.drop_rare_learned(train, [other], "l_partkey", 15)
    return a.unionByName(b).groupBy("l_linestatus", "l_partkey").agg(F.count(F.lit(1)).alias("n"))


# ---- duplicates -------------------------------------------------------------

@query("dedup_full", f"""WITH {views.COPIED_ORDERS}
SELECT min(row_id) AS row_id, o_orderkey, status, price, CAST(odate AS VARCHAR) AS odate FROM copied GROUP BY o_orderkey, o_custkey, status, price, odate, priority""")
def dedup_full(spark, d):
    return dedup.drop_full_duplicates(views.copied_orders(spark, d), "row_id").select("row_id", "o_orderkey", "status", "price", F.col("odate").cast("string").alias("odate"))


@query("dedup_key_first", f"""WITH {views.COPIED_ORDERS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, status, priority ORDER BY row_id) AS rn FROM copied)
SELECT row_id, o_orderkey, o_custkey, status, priority, price FROM r WHERE rn = 1""")
def dedup_key_first(spark, d):
    kept = dedup.keep_first(views.copied_orders(spark, d), ["o_custkey", "status", "priority", "not_there"], "row_id")
    return kept.select("row_id", "o_orderkey", "o_custkey", "status", "priority", "price")


@query("list_duplicates", f"""WITH {views.COPIED_ORDERS}
SELECT row_id, o_orderkey, count(*) OVER (PARTITION BY o_orderkey, o_custkey, status, price, odate, priority) AS copies FROM copied
QUALIFY copies > 1""")
def list_duplicates(spark, d):
    return dedup.list_duplicates(views.copied_orders(spark, d), ["o_orderkey", "o_custkey", "status", "price", "odate", "priority"]).select("row_id", "o_orderkey", "copies")


@query("duplicate_summary", f"""WITH {views.COPIED_ORDERS}, g AS (SELECT count(*) AS c FROM copied GROUP BY o_orderkey, o_custkey, status, price, odate, priority)
SELECT CAST(sum(c) AS BIGINT) AS rows, CAST(sum(c - 1) AS BIGINT) AS duplicates, round(sum(c - 1) * 100.0 / sum(c), 6) AS percent FROM g""")
def duplicate_summary(spark, d):
    s = dedup.duplicate_summary(views.copied_orders(spark, d), ["o_orderkey", "o_custkey", "status", "price", "odate", "priority"])
    return s.withColumn("percent", F.round("percent", 6))
