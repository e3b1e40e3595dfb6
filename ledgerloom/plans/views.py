"""Messy views over the clean tables, in DataFrame form and as SQL text.

The tables hold neither NULLs nor duplicates nor dirty text. Each view here
brings one kind of dirt in by the row's own key, so that both engines build the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.registry import table
from ledgerloom.session import spread


def null_every(column, key, step: int):
    return F.when(F.col(key) % step != 0, F.col(column))


def messy_orders(spark, folder) -> DataFrame:
    o = table(spark, folder, "orders")
    return o.select(
        "o_orderkey", "o_custkey",
        null_every("o_orderstatus", "o_orderkey", 11).alias("status"),
        null_every("o_totalprice", "o_orderkey", 7).alias("price"),
        null_every("o_orderdate", "o_orderkey", 13).alias("odate"),
        null_every("o_orderpriority", "o_orderkey", 5).alias("priority"),
    )


MESSY_ORDERS = """messy_orders AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS status,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price,
    CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS odate,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority
  FROM orders)"""


def copied_orders(spark, folder) -> DataFrame:
    """Messy orders with a copy of every tenth; every twentieth copy has another price."""
    m = messy_orders(spark, folder)
    first = m.withColumn("row_id", F.col("o_orderkey") * 2)
    copies = m.filter("o_orderkey % 10 = 0").withColumn("row_id", F.col("o_orderkey") * 2 + 1).withColumn(
        "price", F.when(F.col("o_orderkey") % 20 == 0, F.col("price") + 1).otherwise(F.col("price"))
    )
    return first.unionByName(copies)


COPIED_ORDERS = MESSY_ORDERS + """, copied AS (
  SELECT *, o_orderkey * 2 AS row_id FROM messy_orders
  UNION ALL
  SELECT o_orderkey, o_custkey, status, CASE WHEN o_orderkey % 20 = 0 THEN price + 1 ELSE price END AS price,
    odate, priority, o_orderkey * 2 + 1 AS row_id FROM messy_orders WHERE o_orderkey % 10 = 0)"""


def price_text(spark, folder) -> DataFrame:
    """Order prices as text in six spellings."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    plain = F.concat(F.expr("cents div 100").cast("string"), F.lit("."), F.lpad((F.col("cents") % 100).cast("string"), 2, "0"))
    o = table(spark, folder, "orders").select("o_orderkey", cents.alias("cents")).withColumn("plain", plain)
    k = F.col("o_orderkey") % 6
    text = (
        F.when(k == 0, F.concat(F.lit("€ "), "plain")).when(k == 1, F.concat(F.lit("  "), F.col("plain"), F.lit(" € ")))
        .when(k == 2, F.concat(F.col("plain"), F.lit(" %"))).when(k == 3, F.concat(F.lit("1,"), F.col("plain")))
        .when(k == 4, F.lit("nan")).otherwise(F.concat(F.lit("-"), F.col("plain")))
    )
    return o.select("o_orderkey", "cents", "plain", text.alias("price_text"))


PRICE_TEXT = """price_text AS (
  SELECT o_orderkey, cents, plain,
    CASE o_orderkey % 6 WHEN 0 THEN '€ ' || plain WHEN 1 THEN '  ' || plain || ' € ' WHEN 2 THEN plain || ' %'
      WHEN 3 THEN '1,' || plain WHEN 4 THEN 'nan' ELSE '-' || plain END AS price_text
  FROM (SELECT o_orderkey, cents, CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS plain
        FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)))"""


def firm_name(key, spark_prefix: str = ""):
    """A distinct pronounceable name made from a key's digest, in two words."""
    letters = F.translate(F.md5(F.concat(F.lit(spark_prefix), F.col(key).cast("string"))), "0123456789abcdef", "aeioubcdfglmnprs")
    # A space put in before the eighth letter: the digest is named, and so computed, once.
    return F.overlay(F.substring(letters, 1, 15), F.lit(" "), 8, 0)


def firm_name_sql(key: str, prefix: str = "") -> str:
    letters = f"translate(md5('{prefix}' || CAST({key} AS VARCHAR)), '0123456789abcdef', 'aeioubcdfglmnprs')"
    return f"(substr({letters}, 1, 7) || ' ' || substr({letters}, 8, 8))"


def registry_rows(spark, folder) -> DataFrame:
    """A business registry built from customers: name, composite owner and activity fields."""
    # A small file is one task, and the text work on its rows is not small.
    c = spread(table(spark, folder, "customer"), "c_custkey")
    count = F.col("c_custkey") % 7
    codes = F.array_join(F.transform(F.sequence(F.lit(0), count), lambda i: ((F.col("c_custkey") * 31 + i * 700) % 9999).cast("string")), ",")
    descriptions = F.array_join(F.transform(F.sequence(F.lit(0), count), lambda i: F.concat(F.lit("work "), i.cast("string"))), ", ")
    return c.select(
        F.col("c_custkey").alias("reg_order"),
        F.concat(firm_name("c_custkey", "b"), F.lit(" Sh.P.K.")).alias("business"),
        F.concat(firm_name("c_custkey", "o"), F.lit(";"), F.col("c_nationkey").cast("string"), F.lit(";50")).alias("owner_field"),
        F.concat(codes, F.lit(";"), descriptions, F.lit(";P,S")).alias("activity_field"),
        F.col("c_mktsegment").alias("kind"),
    )


REGISTRY = f"""registry AS (
  SELECT c_custkey AS reg_order, {firm_name_sql('c_custkey', 'b')} || ' Sh.P.K.' AS business,
    {firm_name_sql('c_custkey', 'o')} || ';' || c_nationkey || ';50' AS owner_field,
    list_aggregate(list_transform(range(0, c_custkey % 7 + 1), lambda i: CAST((c_custkey * 31 + i * 700) % 9999 AS VARCHAR)), 'string_agg', ',')
      || ';' || list_aggregate(list_transform(range(0, c_custkey % 7 + 1), lambda i: 'work ' || i), 'string_agg', ', ') || ';P,S' AS activity_field,
    c_mktsegment AS kind
  FROM customer)"""


def buyer_rows(spark, folder, misspelt: bool = False) -> DataFrame:
    """Orders with a buyer cell that names registry firms or owners in several spellings.

    By order key: plain firm, accented firm in capitals, owner, two names in one
    cell, swapped words, an unknown firm; ``misspelt`` also drops a letter.
    """
    o = table(spark, folder, "orders")
    firm, owner, k = firm_name("o_custkey", "b"), firm_name("o_custkey", "o"), F.col("o_orderkey") % 7
    swapped = F.concat(F.substring_index(firm, " ", -1), F.lit(" shpk "), F.substring_index(firm, " ", 1))
    dropped = F.concat(F.substring(firm, 1, 3), F.substring(firm, 5, 40), F.lit(" shpk"))
    buyer = (
        F.when(k == 0, F.concat(firm, F.lit(" SH.P.K")))
        .when(k == 1, F.concat(F.translate(F.upper(firm), "EU", "ËÜ"), F.lit(" Sh.p.k.")))
        .when(k == 2, owner)
        .when(k == 3, F.concat(F.lit("Nobody & Sons, "), firm, F.lit(" shpk dhe "), owner))
        .when(k == 4, F.concat(F.lit("unknown "), F.md5(F.col("o_orderkey").cast("string"))))
        .when(k == 5, dropped if misspelt else F.concat(F.lit("  "), firm, F.lit("/shpk ")))
        .otherwise(swapped if misspelt else owner)
    )
    return o.select("o_orderkey", buyer.alias("buyer"))


_FIRM, _OWNER = firm_name_sql("o_custkey", "b"), firm_name_sql("o_custkey", "o")


def buyers_sql(misspelt: bool = False) -> str:
    dropped = f"substr({_FIRM}, 1, 3) || substr({_FIRM}, 5, 40) || ' shpk'"
    swapped = f"split_part({_FIRM}, ' ', 2) || ' shpk ' || split_part({_FIRM}, ' ', 1)"
    return f"""buyers AS (
  SELECT o_orderkey, CASE o_orderkey % 7
    WHEN 0 THEN {_FIRM} || ' SH.P.K'
    WHEN 1 THEN translate(upper({_FIRM}), 'EU', 'ËÜ') || ' Sh.p.k.'
    WHEN 2 THEN {_OWNER}
    WHEN 3 THEN 'Nobody & Sons, ' || {_FIRM} || ' shpk dhe ' || {_OWNER}
    WHEN 4 THEN 'unknown ' || md5(CAST(o_orderkey AS VARCHAR))
    WHEN 5 THEN {dropped if misspelt else f"'  ' || {_FIRM} || '/shpk '"}
    ELSE {swapped if misspelt else _OWNER} END AS buyer
  FROM orders)"""


BUYERS = buyers_sql()


def norm_sql(text: str) -> str:
    """The comparable form of a name, in SQL."""
    s = f"strip_accents(lower(trim(coalesce({text}, ''))))"
    for a, b in [("sh.p.k.", "shpk"), ("sh.p.k", "shpk"), ("sh.a.", "sha"), ("sh.a", "sha"), ("l.l.c.", "llc"), ("l.l.c", "llc"), ("&", " dhe ")]:
        s = f"replace({s}, '{a}', '{b}')"
    return f"trim(regexp_replace({s}, '[^a-z0-9]+', ' ', 'g'))"
