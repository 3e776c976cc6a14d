"""Registry of queries, and the derived tables several of them start from."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import add_totals
from ..operators.lookup import lookup
from ..provenance import tracking, with_note

MONEY = "decimal(18,2)"  # the given tables hold cents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that must agree."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


_noted = [False]


@contextmanager
def noted_inputs():
    """Within it, columns of the given tables carry the table's name as their source."""
    _noted.append(True)
    try:
        with tracking():
            yield
    finally:
        _noted.pop()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return with_note(rows, name) if _noted[-1] else rows


def order_year() -> F.Column:
    return F.year("o_orderdate").alias("year")


def money(name: str) -> F.Column:
    return F.col(name).cast(MONEY)


def customer_orders(spark: SparkSession, sf: str, statuses: tuple[str, ...] = ("F", "O", "P")) -> DataFrame:
    """(year, nationkey, status, price, n) per customer. Orders are summed before
    they meet the customers, so a customer with very many orders is a few rows."""
    status = F.col("o_orderstatus").alias("status")
    per_customer = table(spark, sf, "orders").where(status.isin(*statuses)).groupBy("o_custkey", order_year(), status).agg(
        F.sum(money("o_totalprice")).alias("price"), F.count(F.lit(1)).alias("n"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nationkey"))
    return per_customer.join(customers, "o_custkey").drop("o_custkey")


def orders_by_nation(spark: SparkSession, sf: str, statuses: tuple[str, ...] = ("F", "O", "P")) -> DataFrame:
    """(year, nationkey, status, price, n)."""
    return customer_orders(spark, sf, statuses).groupBy("year", "nationkey", "status").agg(
        F.sum("price").alias("price"), F.sum("n").alias("n"))


def nation_levels(spark: SparkSession, sf: str) -> DataFrame:
    """(year, nationkey, nation, admin, price, n): level 2 and 3 from the order
    status, level 1 their sum."""
    rows = customer_orders(spark, sf, ("F", "O"))
    rows = rows.withColumn("admin", F.when(F.col("status") == "F", 2).otherwise(3))
    rows = add_totals(rows, ["year", "nationkey", "admin"], {"admin": 1}, ["price", "n"])
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("nation"))
    return rows.join(nations, "nationkey")


def customer_levels(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of ``nation_levels`` and ``at`` for every customer by itself, so that
    sheets made of them grow with the tables."""
    status = F.col("o_orderstatus").alias("status")
    rows = table(spark, sf, "orders").where(status.isin("F", "O")).groupBy("o_custkey", order_year(), status).agg(
        F.sum(money("o_totalprice")).alias("price"), F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("admin", F.when(F.col("status") == "F", 2).otherwise(3)).withColumnRenamed("o_custkey", "at")
    rows = add_totals(rows, ["year", "at", "admin"], {"admin": 1}, ["price", "n"])
    homes = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("at"), F.col("c_nationkey").alias("nationkey"), F.col("n_name").alias("nation"))
    return rows.join(homes, "at").select("year", "nationkey", "nation", "admin", "price", "n", "at")


CUSTOMER_LEVELS_SQL = """
by_status AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey, CASE o_orderstatus WHEN 'F' THEN 2 ELSE 3 END AS admin,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS price, count(*) AS n
  FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2, 3),
levels AS (
  SELECT x.year, c_nationkey AS nationkey, n_name AS nation, x.admin, x.price, x.n
  FROM (SELECT * FROM by_status UNION ALL SELECT year, o_custkey, 1, sum(price), sum(n) FROM by_status GROUP BY 1, 2) AS x
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)
"""


LEVELS_SQL = """
by_status AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey AS nationkey, o_orderstatus AS status,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS price, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
two_levels AS (
  SELECT year, nationkey, CASE status WHEN 'F' THEN 2 ELSE 3 END AS admin, price, n
  FROM by_status WHERE status IN ('F', 'O')),
levels AS (
  SELECT x.year, x.nationkey, n_name AS nation, x.admin, x.price, x.n
  FROM (SELECT * FROM two_levels
        UNION ALL
        SELECT year, nationkey, 1, sum(price), sum(n) FROM two_levels GROUP BY 1, 2) AS x
  JOIN nation ON n_nationkey = x.nationkey)
"""


def nation_states(spark: SparkSession, sf: str) -> DataFrame:
    """State lookup (stabbr, stname, stcen) in which the nations stand for states and
    a fixed first row for the whole."""
    key = F.col("n_nationkey").cast("string")
    own = table(spark, sf, "nation").select(
        F.concat(F.lit("N"), F.lpad(key, 2, "0")).alias("stabbr"), F.col("n_name").alias("stname"),
        F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0").alias("stcen"))
    return own.unionByName(spark.sql("SELECT 'US' AS stabbr, 'United States' AS stname, '00' AS stcen"))


STABBR_SQL = "'N' || lpad(CAST(nationkey AS VARCHAR), 2, '0')"


def customer_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as plans: balance as assets, and the orders of each as members."""
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("plan")).agg(
        F.count(F.lit(1)).cast("double").alias("members"))
    plans = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("plan"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("assets"))
    return lookup(plans, orders, {"plan": "plan"}, ["members"])


PLANS_SQL = """
plans AS (
  SELECT c_custkey AS plan, c_nationkey AS nationkey, c_mktsegment AS segment, c_acctbal AS assets, CAST(m.n AS DOUBLE) AS members
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) AS m ON m.o_custkey = c_custkey)
"""
