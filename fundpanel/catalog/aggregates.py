"""Counts, sums, quantiles, bins and totals."""

from pyspark.sql import functions as F

from ..operators.aggregate import (
    add_totals, count_by as count_rows, histogram, shares, size_distribution, sum_columns, sum_known, sum_strict,
    totals, value_range,
)
from ..operators.combine import stack
from ..operators.infer import select_type
from ..operators.metrics import state_table
from ..operators.quality import systems
from ..operators.running import column_summary as summarise, quantile_profile, quantiles
from ..plans.state_panel import reported_share
from ..plans.studies import DECILES, PROBS, groups_and_median
from pyspark.sql import types as T

from .base import PLANS_SQL, customer_sizes, money, order_year, orders_by_nation, query, table

@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, nullif(o_orderstatus, 'P') AS status, count(*) AS n
FROM orders GROUP BY 1, 2
""")
def count_by(spark, sf):
    orders = table(spark, sf, "orders").select(order_year(), F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return count_rows(orders, "year", "status")


LINE_VALUE = "CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END"


@query(f"SELECT l_orderkey, CAST(coalesce(sum({LINE_VALUE}), 0) AS DOUBLE) AS value FROM lineitem GROUP BY 1")
def sum_na_rm(spark, sf):
    value = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(sum_known(value).alias("value"))


@query(f"""
SELECT l_orderkey, CASE WHEN count(*) = count({LINE_VALUE}) THEN CAST(sum({LINE_VALUE}) AS DOUBLE) END AS value
FROM lineitem GROUP BY 1
""")
def sum_strict_nulls(spark, sf):
    value = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(sum_strict(value).alias("value"))


@query("""
SELECT CAST(sum(CAST(p_size AS DECIMAL(18,2))) AS DOUBLE) AS p_size, CAST(NULL AS DOUBLE) AS p_retailprice,
       CAST(sum(CAST(p_partkey AS DECIMAL(18,2))) AS DOUBLE) AS p_partkey
FROM part
""")
def sum_every_column(spark, sf):
    return sum_columns(table(spark, sf, "part").withColumn("p_retailprice", F.nullif("p_retailprice", F.lit(900.0))))


@query("""
SELECT n_name, year, status, CAST(price AS DOUBLE) AS price, CAST(n AS BIGINT) AS n FROM (
  SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS status,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS price, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3
  UNION ALL
  SELECT 'US Total', CAST(year(o_orderdate) AS INTEGER), o_orderstatus, sum(CAST(o_totalprice AS DECIMAL(18,2))), count(*)
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)
""")
def totals_rows(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    rows = orders_by_nation(spark, sf).join(nations, "nationkey")
    out = add_totals(rows, ["n_name", "year", "status"], {"n_name": "US Total"}, ["price", "n"])
    return out.withColumn("price", F.col("price").cast("double"))


def _quantile_sql(value: str, probs: dict) -> str:
    return ", ".join(f"round(quantile_cont({value}, {p}), 4) AS {n}" for n, p in probs.items())


def _rounded(df, names):
    return df.withColumns({n: F.round(n, 4) for n in names})


@query(f"SELECT count(*) AS n, {_quantile_sql('o_totalprice', PROBS)} FROM orders")
def quantile_vector(spark, sf):
    return _rounded(quantiles(table(spark, sf, "orders"), "o_totalprice", PROBS), PROBS)


@query(f"SELECT c_mktsegment, count(*) AS n, {_quantile_sql('c_acctbal', DECILES)} FROM customer GROUP BY 1")
def grouped_deciles(spark, sf):
    return _rounded(quantiles(table(spark, sf, "customer"), "c_acctbal", DECILES, ["c_mktsegment"]), DECILES)


PROFILE = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}


@query(f"""
SELECT variable, year, count(value) AS n, {_quantile_sql('value', PROFILE)}
FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount FROM lineitem)
UNPIVOT (value FOR variable IN (l_quantity, l_extendedprice, l_discount)) GROUP BY 1, 2
""")
def grouped_quantiles(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("year"), "l_quantity", "l_extendedprice", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"))
    return _rounded(quantile_profile(lines, ["year"], ["l_quantity", "l_extendedprice", "l_discount"], PROFILE), PROFILE)


@query("""
SELECT count(*) AS n_sum, median(plans) AS n_mdn FROM (SELECT c_nationkey, c_mktsegment, count(*) AS plans FROM customer GROUP BY 1, 2)
""")
def median_of_counts(spark, sf):
    return groups_and_median(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"])


@query("""
SELECT 'o_orderdate' AS variable, CAST(min(o_orderdate) AS DATE) AS min, CAST(max(o_orderdate) AS DATE) AS max FROM orders
UNION ALL
SELECT 'l_shipdate', CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE) FROM lineitem
""")
def date_range_profile(spark, sf):
    return stack(value_range(table(spark, sf, "orders"), ["o_orderdate"]), value_range(table(spark, sf, "lineitem"), ["l_shipdate"]))


SUMMARISED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("""
SELECT variable, min(value) AS min, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS mean, max(value) AS max,
       count(*) FILTER (WHERE value IS NULL) AS nulls,
       round(quantile_cont(value, 0.25), 4) AS q1, round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q3
FROM (SELECT l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, l_tax FROM lineitem)
UNPIVOT INCLUDE NULLS (value FOR variable IN (l_quantity, l_extendedprice, l_discount, l_tax)) GROUP BY 1
""")
def column_summary(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))
    return _rounded(summarise(lines, SUMMARISED), ["q1", "median", "q3"])


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_custkey) AS systems FROM orders GROUP BY 1")
def distinct_count(spark, sf):
    return systems(table(spark, sf, "orders").withColumn("year", order_year()), ["year"], "o_custkey")


EDGES = [0, 1, 2, 3, 4, 5, 10, 20, 50, 100, 1000, 10000, 100000]


@query(f"""
WITH {PLANS_SQL},
binned AS (SELECT CASE WHEN assets <= 0 THEN NULL {' '.join(f'WHEN assets <= {e} THEN {i}' for i, e in enumerate(EDGES) if i)} WHEN assets > 100000 THEN 13 END AS bin,
           CAST(members AS DECIMAL(18,2)) AS members, CAST(assets AS DECIMAL(18,2)) AS assets FROM plans),
g AS (SELECT bin, count(*) AS n, CASE WHEN count(*) = count(members) THEN sum(members) END AS members, CASE WHEN count(*) = count(assets) THEN sum(assets) END AS assets FROM binned GROUP BY 1),
t AS (SELECT sum(n) AS n, CASE WHEN count(*) = count(members) THEN sum(members) END AS members, CASE WHEN count(*) = count(assets) THEN sum(assets) END AS assets FROM g),
c AS (SELECT *, sum(n) OVER w AS n_cum, CASE WHEN count(*) OVER w = count(members) OVER w THEN sum(members) OVER w END AS members_cum,
        CASE WHEN count(*) OVER w = count(assets) OVER w THEN sum(assets) OVER w END AS assets_cum FROM g
      WINDOW w AS (ORDER BY bin ASC NULLS LAST ROWS UNBOUNDED PRECEDING))
SELECT CAST(bin AS INTEGER) AS bin,
  (['(0,1]','(1,2]','(2,3]','(3,4]','(4,5]','(5,10]','(10,20]','(20,50]','(50,100]','(100,1e+03]','(1e+03,1e+04]','(1e+04,1e+05]','(1e+05,Inf]'])[bin] AS size,
  n, CAST(n_cum AS BIGINT) AS n_cum, CAST(n AS DOUBLE) / CAST((SELECT n FROM t) AS DOUBLE) * 100 AS n_pct, CAST(n_cum AS DOUBLE) / CAST((SELECT n FROM t) AS DOUBLE) * 100 AS n_cumpct,
  CAST(members AS DOUBLE) AS members, CAST(members_cum AS DOUBLE) AS members_cum,
  CAST(members AS DOUBLE) / CAST((SELECT members FROM t) AS DOUBLE) * 100 AS members_pct, CAST(members_cum AS DOUBLE) / CAST((SELECT members FROM t) AS DOUBLE) * 100 AS members_cumpct,
  CAST(assets AS DOUBLE) AS assets, CAST(assets_cum AS DOUBLE) AS assets_cum,
  CAST(assets AS DOUBLE) / CAST((SELECT assets FROM t) AS DOUBLE) * 100 AS assets_pct, CAST(assets_cum AS DOUBLE) / CAST((SELECT assets FROM t) AS DOUBLE) * 100 AS assets_cumpct
FROM c
""")
def binned_size(spark, sf):
    out = size_distribution(customer_sizes(spark, sf), "assets", {"members": "members", "assets": "assets"})
    return out.withColumns({c: F.col(c).cast("double") for c in ("members", "members_cum", "assets", "assets_cum")})


@query("""
SELECT CAST(ceil(CAST(p_retailprice AS DOUBLE) / 10 - 0.5) * 10 + 0.0 AS DOUBLE) AS centre, count(*) AS n FROM part GROUP BY 1
""")
def histogram_counts(spark, sf):
    return histogram(table(spark, sf, "part"), "p_retailprice", 10.0)


@query("""
SELECT l_orderkey, CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / 1e8 AS tiny, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) * 1e18 AS large
FROM lineitem GROUP BY 1
""")
def sums_of_any_size(spark, sf):
    """Amounts of some 1e-8 and from 1e18 to beyond 1e20."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey")
    return lines.agg(sum_known(F.round(F.col("l_discount") / 1e6, 8)).alias("tiny"), sum_known(F.col("l_quantity") * 1e18).alias("large"))


@query("""
SELECT l_returnflag, F, O, F / nullif(F + O, 0) * 100 AS F_pct, O / nullif(F + O, 0) * 100 AS O_pct FROM (
  SELECT l_returnflag, CAST(coalesce(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS F,
         CAST(coalesce(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS O
  FROM lineitem GROUP BY 1)
""")
def share_by_flag(spark, sf):
    return shares(table(spark, sf, "lineitem"), ["l_returnflag"], "l_linestatus", ["F", "O"], "l_extendedprice")


@query("""
SELECT ic, noimp, imp, noimp / nullif(imp, 0) * 100 AS pct FROM (
  SELECT CAST(l_suppkey AS VARCHAR) AS ic,
         CAST(coalesce(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS noimp,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS imp
  FROM lineitem GROUP BY 1)
""")
def reported_of_imputed(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("ic"), F.col("l_extendedprice").alias("value"), "l_linestatus")
    return reported_share(lines.where(F.col("l_linestatus") == "F"), lines)


@query("""
SELECT count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS assets,
       CASE WHEN count(*) = count(nullif(c_acctbal, 0)) THEN CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) END AS strict FROM customer
""")
def overall_totals(spark, sf):
    plans = table(spark, sf, "customer").withColumn("strict", F.nullif("c_acctbal", F.lit(0.0)))
    return totals(plans, [], {"assets": "c_acctbal", "strict": "strict"})


@query(f"""
WITH {PLANS_SQL}
SELECT n_name, count(*) AS n, CAST(sum(CAST(assets AS DECIMAL(18,2))) AS DOUBLE) AS assets,
       CASE WHEN count(*) = count(members) THEN CAST(sum(CAST(members AS DECIMAL(18,2))) AS DOUBLE) END AS parts
FROM plans JOIN nation ON n_nationkey = nationkey GROUP BY 1 ORDER BY n DESC, n_name
""")
def state_rollup(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return state_table(customer_sizes(spark, sf).join(nations, "nationkey"), ["n_name"], {"assets": "assets", "parts": "members"})


@query("""
SELECT count(*) AS n, count(DISTINCT l_returnflag) AS flags, CAST(min(l_shipdate) AS DATE) AS first
FROM lineitem
""")
def columns_by_type(spark, sf):
    """Columns that are not double, chosen from the schema."""
    rest = select_type(table(spark, sf, "lineitem"), T.DoubleType, invert=True)
    return rest.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_returnflag").alias("flags"),
                    F.min("l_shipdate").cast("date").alias("first"))


@query("""
SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY 1 ORDER BY value DESC, l_suppkey
""")
def items_by_value(spark, sf):
    """Sum per item, largest first."""
    sums = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(money("l_extendedprice")).cast("double").alias("value"))
    return sums.orderBy(F.desc_nulls_last("value"), "l_suppkey")
