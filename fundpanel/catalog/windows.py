"""Running sums, ranks, file order, sorting."""

from pyspark.sql import functions as F

from ..operators.grid import context_fill as fill_context, slice_from_marker
from ..operators.metrics import rebased_index as rebase
from ..plans.studies import at_ranks, beside_totals, concentration
from .base import LEVELS_SQL, PLANS_SQL, customer_sizes, nation_levels, query, table


def _curve_sql(direction: str) -> str:
    order = "assets ASC, plan ASC" if direction == "up" else "assets DESC, plan ASC"
    pct = f"CAST({{}}_{direction} AS DOUBLE) / CAST({{}} AS DOUBLE) * 100 AS {{}}_{direction}pct"
    return f"""
WITH {PLANS_SQL},
kept AS (SELECT * FROM plans WHERE assets > 0 AND members > 0),
run AS (SELECT plan, assets, members,
    row_number() OVER w AS n_{direction}, sum(CAST(assets AS DECIMAL(18,2))) OVER w AS a, sum(CAST(members AS DECIMAL(18,2))) OVER w AS m,
    count(*) OVER () AS n, sum(CAST(assets AS DECIMAL(18,2))) OVER () AS ta, sum(CAST(members AS DECIMAL(18,2))) OVER () AS tm
  FROM kept WINDOW w AS (ORDER BY {order} ROWS UNBOUNDED PRECEDING))
SELECT plan, assets, members, n_{direction}, CAST(a AS DOUBLE) AS assets_{direction}, CAST(m AS DOUBLE) AS members_{direction},
  {pct.format('n', 'n', 'n')}, CAST(a AS DOUBLE) / CAST(ta AS DOUBLE) * 100 AS assets_{direction}pct,
  CAST(m AS DOUBLE) / CAST(tm AS DOUBLE) * 100 AS members_{direction}pct
FROM run
"""


def _curve(spark, sf, directions):
    curve = concentration(_sized(spark, sf), "assets", "plan", {"assets": "a", "members": "m"}, directions)
    return _shown(curve, directions)


def _shown(curve, directions):
    return curve.drop("a", "m", "n_sum", "assets_sum", "members_sum").withColumns({f"n_{d}": F.col(f"n_{d}").cast("long") for d in directions})


def _sized(spark, sf):
    plans = customer_sizes(spark, sf).where((F.col("assets") > 0) & (F.col("members") > 0)).select("plan", "assets", "members")
    return plans.withColumn("a", F.col("assets")).withColumn("m", F.col("members"))


@query(_curve_sql("up"))
def concentration_up(spark, sf):
    return _curve(spark, sf, ["up"])


@query(_curve_sql("down"))
def concentration_down(spark, sf):
    return _curve(spark, sf, ["down"])


@query(f"""
SELECT * FROM ({_curve_sql('down')}) WHERE n_down IN (100, 200, 250, 300)
""")
def rank_cut(spark, sf):
    return _shown(at_ranks(_sized(spark, sf), "assets", "plan", {"assets": "a", "members": "m"}), ["down"])


def _null_curve_sql() -> str:
    """The upward curve of all plans: members are null from the first plan without on."""
    return f"""
WITH {PLANS_SQL},
run AS (SELECT plan, assets, members, row_number() OVER w AS n_up, sum(CAST(assets AS DECIMAL(18,2))) OVER w AS a,
    CASE WHEN count(*) OVER w = count(members) OVER w THEN sum(members) OVER w END AS m,
    sum(CAST(assets AS DECIMAL(18,2))) OVER () AS ta, CASE WHEN count(*) OVER () = count(members) OVER () THEN sum(members) OVER () END AS tm,
    count(*) OVER () AS n
  FROM plans WINDOW w AS (ORDER BY assets ASC NULLS LAST, plan ASC ROWS UNBOUNDED PRECEDING))
SELECT plan, assets, members, n_up, CAST(a AS DOUBLE) AS assets_up, CAST(m AS DOUBLE) AS members_up, CAST(n_up AS DOUBLE) / CAST(n AS DOUBLE) * 100 AS n_uppct,
  CAST(a AS DOUBLE) / nullif(CAST(ta AS DOUBLE), 0) * 100 AS assets_uppct, CAST(m AS DOUBLE) / nullif(CAST(tm AS DOUBLE), 0) * 100 AS members_uppct
FROM run
"""


@query(_null_curve_sql())
def concentration_with_nulls(spark, sf):
    plans = customer_sizes(spark, sf).select("plan", "assets", "members")
    curve = concentration(plans.withColumn("a", F.col("assets")).withColumn("m", F.col("members")), "assets", "plan",
                          {"assets": "a", "members": "m"}, ["up"])
    return _shown(curve, ["up"])


@query(f"""
WITH {PLANS_SQL}
SELECT count(*) AS n_all, count(*) FILTER (WHERE assets >= 1000) AS n_sum,
  CASE WHEN count(*) = count(members) THEN CAST(sum(members) AS DOUBLE) END AS members_all,
  CASE WHEN count(*) FILTER (WHERE assets >= 1000) = count(members) FILTER (WHERE assets >= 1000) THEN CAST(sum(members) FILTER (WHERE assets >= 1000) AS DOUBLE) END AS members_sum
FROM plans
""")
def totals_with_nulls(spark, sf):
    return beside_totals(customer_sizes(spark, sf), F.col("assets") >= 1000, {"members": "members"})


@query(f"""
WITH {PLANS_SQL}
SELECT count(*) AS n_all, count(*) FILTER (WHERE assets >= 1000) AS n_sum,
  CAST(sum(CAST(assets AS DECIMAL(18,2))) AS DOUBLE) AS assets_all, CAST(sum(CAST(assets AS DECIMAL(18,2))) FILTER (WHERE assets >= 1000) AS DOUBLE) AS assets_sum
FROM plans
""")
def totals_before_and_after(spark, sf):
    return beside_totals(customer_sizes(spark, sf), F.col("assets") >= 1000, {"assets": "assets"})


@query(f"""
WITH {LEVELS_SQL}
SELECT year, nation, admin, CAST(price AS DOUBLE) AS value,
  CAST(price AS DOUBLE) / nullif(max(CASE WHEN year = 1996 THEN CAST(price AS DOUBLE) END) OVER (PARTITION BY nation, admin), 0) * 100 AS ivalue
FROM levels
""")
def rebased_index(spark, sf):
    rows = nation_levels(spark, sf).select("year", "nation", "admin", F.col("price").cast("double").alias("value"))
    return rebase(rows, ["nation", "admin"], 1996)


def _indented(spark, sf):
    """Levels as a sheet: the nation's row, then its State and Local rows."""
    admin = F.col("admin")
    return nation_levels(spark, sf).select(
        F.col("year").cast("string").alias("file"), (F.col("nationkey") * 3 + admin).alias("row_no"),
        F.when(admin == 1, F.col("nation")).when(admin == 2, "State").otherwise("Local").alias("label"),
        F.col("price").cast("double").alias("value"))


@query(f"""
WITH {LEVELS_SQL}
SELECT CAST(year AS VARCHAR) AS file, CAST(nationkey * 3 + admin AS INTEGER) AS row_no, nation AS entity,
  CASE admin WHEN 1 THEN 'Total' WHEN 2 THEN 'State' ELSE 'Local' END AS level, CAST(price AS DOUBLE) AS value
FROM levels
""")
def context_fill(spark, sf):
    return fill_context(_indented(spark, sf), "label", {"State": 1, "Local": 2}).drop("label")


@query(f"""
WITH {LEVELS_SQL},
sheet AS (SELECT CAST(year AS VARCHAR) AS file, CAST(nationkey * 3 + admin AS INTEGER) AS row_no,
  CASE admin WHEN 1 THEN nation WHEN 2 THEN 'State' ELSE 'Local' END AS label, CAST(price AS DOUBLE) AS value FROM levels)
SELECT s.* FROM sheet AS s JOIN (SELECT file, min(row_no) AS f FROM sheet WHERE label = 'NATION_3' GROUP BY 1) AS m
ON m.file = s.file AND s.row_no >= m.f
""")
def marker_slice(spark, sf):
    return slice_from_marker(_indented(spark, sf), "label", "NATION_3")


@query("""
SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment, c_acctbal FROM customer
ORDER BY segment ASC NULLS LAST, c_acctbal DESC NULLS LAST, c_custkey
""")
def sort_nulls_last(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"), "c_acctbal")
    return rows.orderBy(F.asc_nulls_last("segment"), F.desc_nulls_last("c_acctbal"), "c_custkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 200")
def top_n(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(200)
