"""Derived measures, quality reports and reconciliation."""

from pyspark.sql import functions as F

from ..operators.aggregate import exact_sum
from ..operators.metrics import (
    not_small, cash_flow, compare_sources, member_counts, rank_states as rank_by, small_and_big,
)
from ..operators.quality import code_as_year, duplicate_keys, findings, missing_by, reconcile, source_years, systems
from ..operators.reshape import count_matrix, values_of
from ..plans.state_panel import employee_share as share_of_employees, rank_by_real
from .base import LEVELS_SQL, PLANS_SQL, customer_sizes, money, nation_levels, order_year, query, table

FLOWS_SQL = """
flows AS (
  SELECT o_orderkey AS orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(v.total AS DOUBLE) END AS given,
    CAST(v.eec AS DOUBLE) AS eec, CAST(v.erc AS DOUBLE) AS erc, CAST(v.expend AS DOUBLE) AS expend,
    CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_totalprice END AS assets
  FROM (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total,
          sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS eec,
          sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS erc,
          coalesce(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0) AS expend
        FROM lineitem GROUP BY 1) AS v JOIN orders ON o_orderkey = v.l_orderkey)
"""


@query(f"""
WITH {FLOWS_SQL}, c AS (SELECT *, coalesce(given, eec + erc) AS contrib FROM flows)
SELECT orderkey, eec, erc, expend, assets, contrib, contrib - expend AS xcf, contrib / nullif(assets, 0) * 100 AS contrib_pct,
  expend / nullif(assets, 0) * 100 AS expend_pct, (contrib - expend) / nullif(assets, 0) * 100 AS xcf_pct FROM c
""")
def contributions_fallback(spark, sf):
    def flag(v):
        return F.sum(F.when(F.col("l_returnflag") == v, money("l_extendedprice"))).cast("double")

    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey")).agg(
        exact_sum(F.col("l_extendedprice")).alias("total"), flag("A").alias("eec"), flag("R").alias("erc"),
        F.coalesce(flag("N"), F.lit(0.0)).alias("expend"))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_orderstatus",
        F.when(F.col("o_orderpriority") == "5-LOW", 0.0).otherwise(F.col("o_totalprice")).alias("assets"))
    rows = lines.join(orders, "orderkey").withColumn("contrib", F.when(F.col("o_orderstatus") != "P", F.col("total")))
    return cash_flow(rows).drop("total", "o_orderstatus")


SUPPLIER_FLOWS_SQL = """
by_state AS (SELECT n_name AS stabbr, CAST(year(l_shipdate) AS INTEGER) AS year, CASE l_returnflag WHEN 'A' THEN 'eec' WHEN 'R' THEN 'erc' ELSE 'benefits' END AS variable,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2, 3)
"""


def flows_by_state(spark, sf):
    """(stabbr, year, variable, value): lines summed per supplier before the join."""
    variable = F.when(F.col("l_returnflag") == "A", "eec").when(F.col("l_returnflag") == "R", "erc").otherwise("benefits")
    per_supplier = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year"), variable.alias("variable")).agg(
        F.sum(money("l_extendedprice")).alias("v"))
    homes = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("stabbr"))
    return per_supplier.join(homes, "l_suppkey").groupBy("stabbr", "year", "variable").agg(F.sum("v").cast("double").alias("value"))


@query(f"""
WITH {SUPPLIER_FLOWS_SQL}
SELECT stabbr, eec, erc, eec / nullif(eec + erc, 0) * 100 AS eecpct FROM (
  SELECT stabbr, max(value) FILTER (WHERE variable = 'eec') AS eec, max(value) FILTER (WHERE variable = 'erc') AS erc
  FROM by_state WHERE year = 1998 AND variable <> 'benefits' GROUP BY 1)
ORDER BY eecpct DESC NULLS LAST, stabbr
""")
def employee_share(spark, sf):
    return share_of_employees(flows_by_state(spark, sf), 1998)


@query(f"""
WITH {SUPPLIER_FLOWS_SQL}
SELECT stabbr, year, 1 AS type, max(value) FILTER (WHERE variable = 'eec') AS eec, max(value) FILTER (WHERE variable = 'benefits') AS benefits
FROM by_state WHERE year = 1999 AND variable IN ('eec', 'benefits') GROUP BY 1, 2 ORDER BY benefits DESC NULLS LAST, stabbr
""")
def rank_states(spark, sf):
    rows = flows_by_state(spark, sf).withColumn("type", F.lit(1)).withColumnRenamed("value", "rvalpc")
    return rank_by_real(rows, 1999, ["eec", "benefits"], "benefits")


@query(f"""
WITH {LEVELS_SQL}
SELECT nation, CAST(price AS DOUBLE) AS value FROM levels WHERE admin = 1 AND year = 2000 ORDER BY value DESC NULLS LAST LIMIT 10
""")
def top_states(spark, sf):
    """The ten largest of one year."""
    rows = nation_levels(spark, sf).where((F.col("admin") == 1) & (F.col("year") == 2000))
    return rank_by(rows.select("nation", F.col("price").cast("double").alias("value")), "value", 10)


@query("""
WITH w AS (SELECT l_orderkey AS pid, CAST(sum(l_quantity) FILTER (WHERE l_linenumber = 1) AS DOUBLE) AS actives,
  CAST(sum(l_quantity) FILTER (WHERE l_linenumber = 2) AS DOUBLE) AS inactives, CAST(sum(l_quantity) FILTER (WHERE l_linenumber = 3) AS DOUBLE) AS retnorm,
  CAST(sum(l_quantity) FILTER (WHERE l_linenumber = 4) AS DOUBLE) AS retdisb, CAST(sum(l_quantity) FILTER (WHERE l_linenumber = 5) AS DOUBLE) AS survivors
  FROM lineitem WHERE l_linenumber <= 5 GROUP BY 1)
SELECT *, retnorm + retdisb + survivors AS beneficiaries, actives + inactives AS members,
  actives + inactives + retnorm + retdisb + survivors AS participants FROM w
""")
def members_of_plans(spark, sf):
    items = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("pid"), F.col("l_linenumber").alias("k")).agg(
        exact_sum(F.col("l_quantity")).alias("value"))
    return member_counts(items.select("pid", F.concat(F.lit("Z0"), F.col("k").cast("string")).alias("ic"), "value"))


@query(f"""
WITH {PLANS_SQL},
w AS (SELECT CASE WHEN members <= 10 THEN 'small' ELSE 'big' END AS which, assets, members FROM plans),
g AS (SELECT which, count(*) AS n, CASE WHEN count(*) = count(assets) THEN sum(CAST(assets AS DECIMAL(18,2))) END AS a, CASE WHEN count(*) = count(members) THEN sum(CAST(members AS DECIMAL(18,2))) END AS p FROM w GROUP BY 1
      UNION ALL SELECT 'all', count(*), CASE WHEN count(*) = count(assets) THEN sum(CAST(assets AS DECIMAL(18,2))) END, CASE WHEN count(*) = count(members) THEN sum(CAST(members AS DECIMAL(18,2))) END FROM w),
t AS (SELECT * FROM g WHERE which = 'all')
SELECT g.which, CAST(g.n AS DOUBLE) AS n, CAST(g.a AS DOUBLE) AS assets, CAST(g.p AS DOUBLE) AS parts, CAST(g.n AS DOUBLE) / t.n AS n_share,
  CAST(g.a AS DOUBLE) / CAST(t.a AS DOUBLE) AS assets_share, CAST(g.p AS DOUBLE) / CAST(t.p AS DOUBLE) AS parts_share FROM g, t
""")
def small_big_share(spark, sf):
    return small_and_big(customer_sizes(spark, sf), "plan", "members", 10)


@query(f"WITH {PLANS_SQL} SELECT plan, assets, members FROM plans WHERE NOT coalesce(members <= 10, false)")
def big_plans(spark, sf):
    return not_small(customer_sizes(spark, sf), "plan", "members", 10).select("plan", "assets", "members")


@query("""
SELECT year, first, second, first / nullif(second, 0) * 100 AS pct FROM
 (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS first FROM orders GROUP BY 1) AS a
 FULL JOIN (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS second FROM lineitem GROUP BY 1) AS b USING (year)
""")
def source_compare(spark, sf):
    a = table(spark, sf, "orders").select(order_year(), F.col("o_totalprice").alias("value"))
    b = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("value"))
    return compare_sources(a, b, ["year"], {"a": "first", "b": "second"}, "value")


@query("""
WITH u AS (SELECT l_orderkey AS orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS unit_total FROM lineitem GROUP BY 1),
p AS (SELECT o_orderkey AS orderkey, CAST(o_totalprice AS DOUBLE) AS published_total FROM orders),
j AS (SELECT *, (unit_total - published_total) / nullif(published_total, 0) AS gap FROM u FULL JOIN p USING (orderkey))
SELECT *, CASE WHEN abs(gap) <= 0.05 THEN 'yes' WHEN gap IS NULL OR gap > 0 OR abs(gap) <= 0.2 THEN 'undecided' ELSE 'no' END AS use_units FROM j
""")
def source_reconcile(spark, sf):
    units = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_extendedprice").alias("value"))
    published = table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("value"))
    return reconcile(units, published, ["orderkey"], tolerance=0.05, doubtful=0.2)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, finding FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, 'high price' AS finding FROM lineitem WHERE l_extendedprice > 90000
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'no tax on a large line' FROM lineitem WHERE l_tax = 0 AND l_quantity >= 45
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'no discount' FROM lineitem WHERE nullif(l_discount, 0) IS NULL)
""")
def outlier_findings(spark, sf):
    return findings(table(spark, sf, "lineitem"), {
        "high price": F.col("l_extendedprice") > 90000,
        "no tax on a large line": (F.col("l_tax") == 0) & (F.col("l_quantity") >= 45),
        "no discount": F.nullif("l_discount", F.lit(0.0)).isNull(),
    }, ["l_orderkey", "l_linenumber", "l_partkey"])


@query("""
SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_linenumber = 1 GROUP BY 1, 2
""")
def code_in_place_of_year(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("start_year", F.when(F.col("l_linenumber") == 1, "1").otherwise(F.date_format("l_shipdate", "yyyy")))
    return code_as_year(rows, "start_year", "1", ["l_suppkey", "l_returnflag"])


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey, count(DISTINCT o_custkey) AS systems
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2
""")
def systems_per_year(spark, sf):
    pairs = table(spark, sf, "orders").select(order_year(), F.col("o_custkey").alias("c_custkey")).distinct()
    homes = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return systems(pairs.join(homes, "c_custkey"), ["year", "c_nationkey"], "c_custkey")


@query("""
SELECT c_nationkey, """ + ", ".join(f"count(*) FILTER (WHERE year = {y}) AS n_{y}" for y in range(1995, 2002)) + """
FROM (SELECT DISTINCT year(o_orderdate) AS year, o_custkey FROM orders) JOIN customer ON c_custkey = o_custkey GROUP BY 1
""")
def systems_matrix(spark, sf):
    pairs = table(spark, sf, "orders").select(order_year(), F.col("o_custkey").alias("c_custkey")).distinct()
    homes = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return count_matrix(pairs.join(homes, "c_custkey"), ["c_nationkey"], "year", values_of(pairs, "year"))


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, nullif(o_orderpriority, '5-LOW') IS NULL AS missing, count(*) AS n FROM orders GROUP BY 1, 2
""")
def missing_by_year(spark, sf):
    rows = table(spark, sf, "orders").select(order_year(), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("value"))
    return missing_by(rows, "year", "value")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def repeated_keys(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT 'orders' AS source, CAST(min(year(o_orderdate)) AS INTEGER) AS first, CAST(max(year(o_orderdate)) AS INTEGER) AS last, count(*) AS rows FROM orders
UNION ALL SELECT 'lines', CAST(min(year(l_shipdate)) AS INTEGER), CAST(max(year(l_shipdate)) AS INTEGER), count(*) FROM lineitem
""")
def years_of_sources(spark, sf):
    return source_years({
        "orders": table(spark, sf, "orders").select(order_year()),
        "lines": table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year")),
    })
