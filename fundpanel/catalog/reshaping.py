"""Long and wide forms."""

from pyspark.sql import functions as F

from ..operators.aggregate import exact_sum
from ..operators.reshape import (
    count_matrix, long_to_wide, long_to_wide_sum, split_column, transpose_rows, wide_to_long as to_long,
)
from .base import MONEY, money, order_year, query, table


@query("""
SELECT p_partkey, variable, value
FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, nullif(p_retailprice, 900.0) AS p_retailprice FROM part)
UNPIVOT INCLUDE NULLS (value FOR variable IN (p_size, p_retailprice))
""")
def wide_to_long(spark, sf):
    part = table(spark, sf, "part").withColumn("p_retailprice", F.nullif("p_retailprice", F.lit(900.0)))
    return to_long(part, ["p_partkey"], ["p_size", "p_retailprice"])


@query("""
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS price_F,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS price_O,
       CAST(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS price_P
FROM orders GROUP BY 1, 2
""")
def long_to_wide_null(spark, sf):
    long = table(spark, sf, "orders").groupBy("o_custkey", order_year(), "o_orderstatus").agg(
        exact_sum(F.col("o_totalprice")).alias("value"))
    return long_to_wide(long, ["o_custkey", "year"], "o_orderstatus", ["F", "O", "P"], prefix="price_")


@query("""
SELECT l_suppkey,
       CAST(coalesce(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS qty_A,
       CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS qty_R,
       CAST(coalesce(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS qty_N,
       CAST(coalesce(sum(CASE WHEN l_returnflag = 'X' THEN CAST(l_quantity AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS qty_X
FROM lineitem GROUP BY 1
""")
def long_to_wide_sum0(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("q", money("l_quantity"))
    wide = long_to_wide_sum(lines, ["l_suppkey"], "l_returnflag", ["A", "R", "N", "X"], "q", prefix="qty_")
    return wide.select("l_suppkey", *[F.col(c).cast("double").alias(c) for c in ("qty_A", "qty_R", "qty_N", "qty_X")])


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_F, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS n_O,
       count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS n_P
FROM orders GROUP BY 1
""")
def coverage_matrix(spark, sf):
    return count_matrix(table(spark, sf, "orders").withColumn("year", order_year()), ["year"], "o_orderstatus", ["F", "O", "P"])


@query("""
SELECT p_partkey, split_part(p_brand, '#', 1) AS maker, split_part(p_brand, '#', 2) AS number, CAST(NULL AS VARCHAR) AS rest
FROM part
""")
def split_one_column(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return split_column(part, "p_brand", ["maker", "number", "rest"], "#")


@query("""
SELECT CAST(l_suppkey AS VARCHAR) AS file, CAST(position AS INTEGER) AS position,
       CAST(sum(CASE WHEN y = 1996 THEN v ELSE 0 END) AS VARCHAR) AS y1996, CAST(sum(CASE WHEN y = 1998 THEN v ELSE 0 END) AS VARCHAR) AS y1998
FROM (SELECT l_suppkey, year(l_shipdate) AS y, p.position, CASE WHEN (l_linestatus = 'F') = (p.position = 0) THEN 1 ELSE 0 END AS v
      FROM lineitem, (VALUES (0), (1)) AS p(position))
GROUP BY 1, 2
HAVING count(*) FILTER (WHERE y IN (1996, 1998)) > 0
""")
def transpose_grid(spark, sf):
    status = [F.count_if(F.col("l_linestatus") == s).cast("string") for s in ("F", "O")]
    grid = table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").cast("string").alias("file"), F.year("l_shipdate").alias("row_no")).agg(F.array(*status).alias("cells"))
    wide = transpose_rows(grid, {1996: "y1996", 1998: "y1998"})
    return wide.select("file", "position", *[F.coalesce(c, F.lit("0")).alias(c) for c in ("y1996", "y1998")])


@query("""
SELECT p_type, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS price, CAST(sum(p_size) AS DOUBLE) AS size
FROM part GROUP BY 1
""")
def there_and_back(spark, sf):
    """Wide to long and back gives the same table; then summed by type."""
    part = table(spark, sf, "part")
    long = to_long(part, ["p_partkey", "p_type"], ["p_size", "p_retailprice"])
    wide = long_to_wide(long, ["p_partkey", "p_type"], "variable", ["p_size", "p_retailprice"])
    return wide.groupBy("p_type").agg(
        F.sum(F.col("p_retailprice").cast(MONEY)).cast("double").alias("price"), exact_sum(F.col("p_size")).alias("size"))
