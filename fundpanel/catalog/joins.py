"""Lookups, joins and stacking."""

from pyspark.sql import functions as F

from ..functions import pct, ratio
from ..operators.aggregate import exact_sum, sum_known, sum_strict
from ..operators.combine import local_only, replicate, series, served_by, stack, stack_tagged
from ..operators.lookup import (
    drop_known, keep_known, lookup, natural, recipe_rows, unmatched_codes,
)
from ..operators.metrics import per_capita, real_value
from ..operators.quality import coverage
from ..operators.reshape import wide_to_long
from ..sources.code_tables import code_table
from .base import LEVELS_SQL, MONEY, money, nation_levels, order_year, query, table


@query("""
SELECT c_custkey, c_nationkey, s.s_name AS first_supplier, s.s_acctbal AS supplier_balance
FROM customer LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier) WHERE rn = 1) AS s
ON s.s_nationkey = c_nationkey
""")
def lookup_first_match(spark, sf):
    facts = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return lookup(facts, table(spark, sf, "supplier"), {"c_nationkey": "s_nationkey"},
                  {"s_name": "first_supplier", "s_acctbal": "supplier_balance"}, position="s_suppkey")


@query("""
WITH seg AS (SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment FROM customer)
SELECT c_custkey, seg.segment, t.customers FROM seg
LEFT JOIN (SELECT segment, count(*) AS customers FROM seg GROUP BY 1) AS t ON t.segment IS NOT DISTINCT FROM seg.segment
""")
def lookup_null_key(spark, sf):
    facts = table(spark, sf, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"))
    sizes = facts.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    return lookup(facts, sizes, {"segment": "segment"}, ["customers"], null_matches=True)


@query("""
SELECT p_partkey, p_name, CAST(coalesce(l.n, 0) AS BIGINT) AS lines FROM part
LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) AS l ON l_partkey = p_partkey
""")
def natural_left(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("lines"))
    out = natural(table(spark, sf, "part").select("p_partkey", "p_name"), lines)
    return out.withColumn("lines", F.coalesce("lines", F.lit(0).cast("long")))


CODES = "A, accepted\nR, returned\nX, unused"


@query("""
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, vname, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM lineitem JOIN (VALUES ('A', 'accepted'), ('R', 'returned'), ('X', 'unused')) AS c(code, vname) ON code = l_returnflag
GROUP BY 1, 2
""")
def crosswalk_right_inner(spark, sf):
    codes = code_table(spark, CODES, ["l_returnflag", "vname"])
    sums = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year"), "l_returnflag").agg(
        exact_sum(F.col("l_extendedprice")).alias("value"))
    return natural(sums, codes, "inner").select("year", "vname", "value")


@query("""
SELECT c_custkey, c_name, CAST(sum(CASE WHEN o_orderkey IS NOT NULL THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS value
FROM orders AS o
RIGHT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
""")
def right_outer_codes(spark, sf):
    sums = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(sum_strict(F.col("o_totalprice")).alias("value"))
    return natural(sums, table(spark, sf, "customer").select("c_custkey", "c_name"), "right")


@query("""
SELECT coalesce(u.k, c_custkey) AS custkey, CASE WHEN u.k IS NULL THEN 'codes' ELSE 'units' END AS src, c_name
FROM (SELECT DISTINCT o_custkey AS k FROM orders) AS u
FULL JOIN customer AS c ON u.k = c_custkey
WHERE u.k IS NULL OR c_custkey IS NULL
""")
def code_coverage_full(spark, sf):
    used = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"))
    codes = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return unmatched_codes(used, codes, "custkey", "c_name")


@query("""
SELECT f.nationkey, f.finance, m.members FROM
 (SELECT c_nationkey AS nationkey, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS finance FROM customer GROUP BY 1) AS f
 JOIN (SELECT s_nationkey AS nationkey, count(*) AS members FROM supplier GROUP BY 1) AS m USING (nationkey)
""")
def finance_member_merge(spark, sf):
    finance = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        exact_sum(F.col("c_acctbal")).alias("finance"))
    members = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("members"))
    return natural(finance, members, "inner")


RECIPE = "eec, A\nerc, R\nerc, N\ncontrib, A\ncontrib, R\ncontrib, N\nwithdraw, Q"


@query("""
WITH recipe(variable, ic) AS (VALUES ('eec','A'), ('erc','R'), ('erc','N'), ('contrib','A'), ('contrib','R'), ('contrib','N'), ('withdraw','Q'))
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey, variable,
       CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS value
FROM recipe LEFT JOIN lineitem ON ic = l_returnflag GROUP BY 1, 2, 3
""")
def recipe_many_to_many(spark, sf):
    recipe = code_table(spark, RECIPE, ["variable", "ic"])
    facts = table(spark, sf, "lineitem").groupBy(
        F.year("l_shipdate").alias("year"), "l_suppkey", F.col("l_returnflag").alias("ic")).agg(
        F.sum(money("l_extendedprice")).alias("value"))
    return recipe_rows(facts, recipe).groupBy("year", "l_suppkey", "variable").agg(sum_known(F.col("value")).alias("value"))


@query("""
SELECT count(*) AS n, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS assets FROM supplier AS s
WHERE NOT EXISTS (SELECT 1 FROM supplier AS x WHERE x.s_acctbal BETWEEN 0 AND 5000 AND x.s_suppkey = s.s_suppkey)
""")
def anti_small(spark, sf):
    """Plans not in the list of small ones, though the list holds nulls."""
    plans = table(spark, sf, "supplier")
    small = plans.where(F.col("s_acctbal") <= 5000).select(F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey")).alias("s_suppkey"))
    return drop_known(plans, small, ["s_suppkey"]).agg(
        F.count(F.lit(1)).alias("n"), exact_sum(F.col("s_acctbal")).alias("assets"))


@query("""
SELECT c_custkey, c_nationkey FROM customer
WHERE EXISTS (SELECT 1 FROM supplier WHERE s_acctbal > 8000 AND s_nationkey = c_nationkey)
""")
def semi_known(spark, sf):
    known = table(spark, sf, "supplier").where(F.col("s_acctbal") > 8000).select(F.col("s_nationkey").alias("c_nationkey")).distinct()
    return keep_known(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), known, ["c_nationkey"])


@query(f"""
WITH {LEVELS_SQL},
pop AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey AS nationkey, count(DISTINCT o_custkey) AS pop
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT l.year, l.nation, l.admin, CAST(l.price AS DOUBLE) AS value, CAST(p.pop AS BIGINT) AS pop, CAST(l.price AS DOUBLE) / p.pop AS valpc
FROM levels AS l LEFT JOIN pop AS p ON p.year = l.year AND p.nationkey = l.nationkey
""")
def composite_lookup(spark, sf):
    pairs = table(spark, sf, "orders").select("o_custkey", order_year()).distinct()
    homes = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nationkey"))
    pop = pairs.join(homes, "o_custkey").groupBy("year", "nationkey").agg(F.count(F.lit(1)).alias("pop"))
    rows = nation_levels(spark, sf).select("year", "nationkey", "nation", "admin", F.col("price").cast("double").alias("value"))
    return per_capita(rows, pop, "nationkey").drop("nationkey")


@query(f"""
WITH {LEVELS_SQL},
prices AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
                  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS value
           FROM lineitem GROUP BY 1)
SELECT l.year, l.nation, l.admin, CAST(l.price AS DOUBLE) AS value,
       CAST(l.price AS DOUBLE) * (SELECT value FROM prices WHERE year = 1998) / p.value AS rvalue
FROM levels AS l LEFT JOIN prices AS p ON p.year = l.year
""")
def deflate_base_year(spark, sf):
    deflator = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(
        ratio(exact_sum(F.col("l_extendedprice")), exact_sum(F.col("l_quantity"))).alias("value"))
    rows = nation_levels(spark, sf).select("year", "nation", "admin", F.col("price").cast("double").alias("value"))
    return real_value(rows, deflator, 1998)


@query("""
SELECT s_suppkey, n_name AS stname, n_nationkey AS code FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def reverse_lookup(spark, sf):
    """Code to name, and the name back to its code."""
    nations = table(spark, sf, "nation")
    named = lookup(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), nations, {"s_nationkey": "n_nationkey"}, {"n_name": "stname"})
    return lookup(named, nations, {"stname": "n_name"}, {"n_nationkey": "code"}).drop("s_nationkey")


@query("""
SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS source FROM customer
UNION ALL BY NAME
SELECT s_name AS name, s_nationkey AS nationkey, s_acctbal AS balance, 'supplier' AS source FROM supplier
""")
def stack_sources(spark, sf):
    customers = table(spark, sf, "customer").selectExpr("c_name AS name", "c_nationkey AS nationkey", "c_acctbal AS balance", "c_mktsegment AS segment")
    suppliers = table(spark, sf, "supplier").selectExpr("s_name AS name", "s_nationkey AS nationkey", "s_acctbal AS balance")
    return stack_tagged({"customer": customers, "supplier": suppliers})


@query("SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey FROM orders")
def distinct_keys(spark, sf):
    return table(spark, sf, "orders").select(order_year(), "o_custkey").distinct()


@query("SELECT s_suppkey, s_name, y.year FROM supplier CROSS JOIN (VALUES (2012), (2013)) AS y(year)")
def replicate_vintage(spark, sf):
    return replicate(table(spark, sf, "supplier").select("s_suppkey", "s_name"), [2012, 2013])


SERVED = [("orders", None, 1997), ("lines", 1999, None)]


@query("""
SELECT year, source, count(*) AS rows, count(value) AS known FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'orders' AS source, nullif(o_orderpriority, '5-LOW') AS value FROM orders
  UNION ALL
  SELECT CAST(year(l_shipdate) AS INTEGER), 'lines', nullif(l_returnflag, 'N') FROM lineitem)
WHERE (source = 'orders' AND year <= 1997) OR (source = 'lines' AND year >= 1999)
GROUP BY 1, 2
""")
def source_precedence(spark, sf):
    orders = table(spark, sf, "orders").select(order_year(), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("value"))
    lines = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), F.nullif("l_returnflag", F.lit("N")).alias("value"))
    both = stack_tagged({"orders": orders, "lines": lines}).where(served_by(SERVED))
    return coverage(both, ["year", "source"])


@query(f"""
WITH {LEVELS_SQL}
SELECT year, r_name, CAST(sum(price) AS DOUBLE) AS value
FROM levels JOIN nation ON n_nationkey = nationkey JOIN region ON n_regionkey = r_regionkey
WHERE admin = 1 AND r_name IN ('ASIA', 'EUROPE') GROUP BY 1, 2
""")
def extract_series(spark, sf):
    regions = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = nation_levels(spark, sf).join(regions.select(F.col("n_nationkey").alias("nationkey"), "r_name"), "nationkey")
    sums = rows.groupBy("year", "r_name", "admin").agg(F.sum("price").cast("double").alias("price"), F.sum("n").cast("double").alias("n"))
    long = wide_to_long(sums, ["year", "r_name", "admin"])
    return series(long, {"r_name": ["ASIA", "EUROPE"], "variable": ["price"], "admin": [1]}, ["year", "r_name", "value"])


@query("""
SELECT s_suppkey, s_acctbal, n_regionkey AS type FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey <> 0
""")
def local_plans(spark, sf):
    plans = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    typed = lookup(plans, table(spark, sf, "nation"), {"s_nationkey": "n_nationkey"}, {"n_regionkey": "type"})
    return local_only(typed).drop("s_nationkey")


@query("""
SELECT a.orderkey, a.units, b.published, a.units / nullif(b.published, 0) * 100 AS pct FROM
 (SELECT l_orderkey AS orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS units FROM lineitem GROUP BY 1) AS a
 JOIN (SELECT o_orderkey AS orderkey, CAST(o_totalprice AS DOUBLE) AS published FROM orders) AS b USING (orderkey)
""")
def two_sources_per_order(spark, sf):
    units = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey")).agg(exact_sum(F.col("l_extendedprice")).alias("units"))
    published = table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("published"))
    return natural(units, published, "inner").withColumn("pct", pct(F.col("units"), F.col("published")))


@query("""
SELECT 'orders' AS tab, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS qty FROM orders
UNION ALL
SELECT 'lines', count(*), NULL, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem
""")
def stack_missing_columns(spark, sf):
    orders = table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast(MONEY)).cast("double").alias("price"))
    lines = table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast(MONEY)).cast("double").alias("qty"))
    return stack(orders.withColumn("tab", F.lit("orders")), lines.withColumn("tab", F.lit("lines")))
