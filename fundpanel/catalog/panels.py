"""The panel plans, each on sheets or records written from the given tables."""

from pyspark.sql import functions as F

from ..functions import ordinal, pad_code
from ..operators.aggregate import histogram, size_distribution, sum_strict, totals
from ..operators.lookup import keyed
from ..operators.metrics import small_and_big
from ..operators.reshape import values_of
from ..operators.running import quantiles
from ..plans.historical import historical_panel as historical, historical_wide as wide_history
from ..plans.items import items_panel as items
from ..plans.panels import (
    TABLE_LEVELS, Source, balance_panel as balances, census_panel as census, crosswalk, unified_from_tagged, unified_panel as unify,
    yearly_sheets_panel as yearly_sheets,
)
from ..plans.plan_table import plans_labelled, plans_raw
from ..plans.state_panel import (
    cash_flow_panel as cash_flows, levels_from_systems, real_per_capita as real_values, recipe_rollup as roll_up,
    state_panel as states_over_time, state_per_capita as per_head,
)
from ..plans.studies import PROBS, at_ranks, groups_and_median, size_study_table
from ..plans.survey import aff_panel as older_download, survey_panel as survey, variable_crosswalk
from ..plans.tables import tables_panel as tables
from ..plans.units import (
    INVESTMENTS, SUPPLEMENT, ids_2017, item_codes, plans_with_members, system_names, unit_rows, units_2017,
)
from ..provenance import sources_of
from ..session import settled
from ..sources.code_tables import code_table
from . import sheets
from .base import (
    CUSTOMER_LEVELS_SQL, LEVELS_SQL, money, nation_levels, nation_states, noted_inputs, order_year, query, table,
)
from .reports import SUPPLIER_FLOWS_SQL, flows_by_state

def _places(spark, sf):
    """The states, kept once for plans that look them up several times."""
    return keyed(nation_states(spark, sf), "stabbr", "stname", "stcen")


F0_CROSSWALK = "price, A, totprice\nprice, B, B01\norders, A, norders\norders, B, B02"


@query(f"""
WITH {LEVELS_SQL},
era AS (
  SELECT year, nation, admin, 'totprice' AS variable, CAST(price AS DOUBLE) AS value, 'A' AS file FROM levels WHERE year < 1998
  UNION ALL SELECT year, nation, admin, 'norders', CAST(n AS DOUBLE), 'A' FROM levels WHERE year < 1998
  UNION ALL SELECT year, nation, admin, 'B01', CAST(price AS DOUBLE), 'B' FROM levels WHERE year >= 1998
  UNION ALL SELECT year, nation, admin, 'B02', CAST(n AS DOUBLE), 'B' FROM levels WHERE year >= 1998),
walk(uvname, file, fvalue) AS (VALUES ('price','A','totprice'), ('price','B','B01'), ('orders','A','norders'), ('orders','B','B02'))
SELECT year, nation, CAST(admin AS INTEGER) AS admin, CASE admin WHEN 1 THEN 'State-local' WHEN 2 THEN 'State' ELSE 'Local' END AS adminf, uvname AS variable, value
FROM era JOIN walk ON walk.file = era.file AND fvalue = variable
""")
def unified_panel(spark, sf):
    """Two eras with their own variable names, in one vocabulary."""
    names = {"A": ("totprice", "norders"), "B": ("B01", "B02")}
    facts = F.array(*[
        F.struct(F.lit(file).alias("file"), F.lit(name).alias("variable"), F.col(c).cast("double").alias("value"))
        for file, pair in names.items() for name, c in zip(pair, ("price", "n"), strict=True)])
    rows = nation_levels(spark, sf).select("year", "nation", "admin", F.inline(facts))
    walk = code_table(spark, F0_CROSSWALK, ["uvname", "file", "fvalue"])
    return unified_from_tagged(rows, walk, [("A", None, 1997), ("B", 1998, None)], "nation")


@query(f"""
WITH {LEVELS_SQL}
SELECT CAST(year AS INTEGER) AS year, nation, CAST(admin AS INTEGER) AS admin, CASE admin WHEN 1 THEN 'State-local' WHEN 2 THEN 'State' ELSE 'Local' END AS adminf,
  v.variable, CAST(CASE v.variable WHEN 'price' THEN price ELSE n END AS DOUBLE) AS value
FROM levels, (VALUES ('price'), ('orders')) AS v(variable)
""")
def separate_sources_panel(spark, sf):
    """The same panel from two sources that are tables of their own."""
    levels = sheets.levels_of(spark, sf)

    def era(price, orders):
        return levels.select(
            "year", "nation", "admin", F.explode(F.create_map(
                F.lit(price), F.col("price").cast("double"), F.lit(orders), F.col("n").cast("double"))).alias("variable", "value"))

    walk = code_table(spark, F0_CROSSWALK, ["uvname", "file", "fvalue"])
    return unify([Source("A", era("totprice", "norders"), last=1997), Source("B", era("B01", "B02"), first=1998)], walk, "nation")


ADMINF = "CASE admin WHEN 1 THEN 'State-local total' WHEN 2 THEN 'State' ELSE 'Local' END AS adminf"


@query(f"WITH {LEVELS_SQL}, {sheets.HIST_SQL} SELECT year, stabbr, admin, {ADMINF}, variable, value, source FROM hist")
def historical_panel(spark, sf):
    return historical(*sheets.historical_sheets(spark, sf, sheets.levels_of(spark, sf)), nation_states(spark, sf))


@query(f"""
WITH {LEVELS_SQL}, {sheets.HIST_SQL}
SELECT stabbr, year, CASE admin WHEN 1 THEN 'Total' WHEN 2 THEN 'State' ELSE 'Local' END AS admin,
  coalesce(max(value) FILTER (WHERE variable = 'totercashsec'), 0) AS totercashsec, coalesce(max(value) FILTER (WHERE variable = 'totempcontrb'), 0) AS totempcontrb,
  coalesce(max(value) FILTER (WHERE variable = 'systems'), 0) AS systems, coalesce(max(value) FILTER (WHERE variable = 'totmemb'), 0) AS totmemb
FROM hist GROUP BY 1, 2, 3
""")
def historical_wide(spark, sf):
    return wide_history(*sheets.historical_sheets(spark, sf, sheets.levels_of(spark, sf)), nation_states(spark, sf), ["totercashsec", "totempcontrb"], ["systems", "totmemb"])


@query(f"WITH {LEVELS_SQL}, {sheets.TABLES_SQL} SELECT stabbr, admin, year, variable, CAST(value AS DOUBLE) AS value FROM tables")
def tables_panel(spark, sf):
    return tables(sheets.table_sheets(sheets.levels_of(spark, sf)), nation_states(spark, sf))


@query(f"WITH {LEVELS_SQL}, {sheets.ITEMS_SQL} SELECT * FROM items")
def items_panel(spark, sf):
    return items(sheets.item_sheets(sheets.levels_of(spark, sf)), nation_states(spark, sf))


@query(f"WITH {LEVELS_SQL}, {sheets.SURVEY_SQL} SELECT * FROM survey")
def survey_panel(spark, sf):
    walk = variable_crosswalk(sheets.survey_crosswalk(spark))
    return survey(sheets.survey_sheets(spark, sf, nation_levels(spark, sf)), walk, sheets.survey_layouts(spark), nation_states(spark, sf))


@query(f"""
WITH {LEVELS_SQL}
SELECT 'N' || lpad(CAST(k.nationkey AS VARCHAR), 2, '0') AS stabbr, CASE a.admin WHEN 1 THEN 'Total' WHEN 2 THEN 'State' ELSE 'Local' END AS admin,
  c.col, c.description, k.year + {sheets.SURVEY_SHIFT} AS year, CAST(CASE c.col WHEN 'C015' THEN l.price ELSE l.n END AS DOUBLE) AS value
FROM (SELECT DISTINCT year, nationkey FROM levels) AS k CROSS JOIN (VALUES (1), (2), (3)) AS a(admin)
CROSS JOIN (VALUES ('C015', 'Total assets'), ('C036', 'Number of systems')) AS c(col, description)
LEFT JOIN levels AS l ON l.year = k.year AND l.nationkey = k.nationkey AND l.admin = a.admin
""")
def older_download_panel(spark, sf):
    return older_download(sheets.aff_sheets(sheets.levels_of(spark, sf)), nation_states(spark, sf))


@query(f"""
WITH {LEVELS_SQL}, {sheets.HIST_SQL}, {sheets.TABLES_SQL}, {sheets.ITEMS_SQL}, {sheets.SURVEY_SQL},
panel AS (
  SELECT year, stabbr, admin, CASE variable WHEN 'totercashsec' THEN 'assets' WHEN 'totempcontrb' THEN 'eec' WHEN 'systems' THEN 'nsystems' WHEN 'totmemb' THEN 'members' END AS variable, value FROM hist
  UNION ALL SELECT year, stabbr, CASE admin WHEN 'Total' THEN 1 WHEN 'State' THEN 2 ELSE 3 END,
    CASE variable WHEN 'totpay' THEN 'totexpend' WHEN 'totmem' THEN 'members' ELSE variable END, value
    FROM tables WHERE admin <> 'Township' AND variable NOT IN ('withdraw', 'otherpay')
  UNION ALL SELECT year, stabbr, type, CASE ItemID WHEN 11 THEN 'assets' ELSE 'nsystems' END, value FROM items
  UNION ALL SELECT year, stabbr, admin, vname, value FROM survey)
SELECT year, stabbr, admin, CASE admin WHEN 1 THEN 'State-local' WHEN 2 THEN 'State' ELSE 'Local' END AS adminf, variable, CAST(value AS DOUBLE) AS value
FROM panel ORDER BY stabbr, admin, adminf, variable, year
""")
def four_era_panel(spark, sf):
    """All four eras, from their sheets to one sorted panel."""
    places, levels = _places(spark, sf), sheets.levels_of(spark, sf)
    return census(
        historical(*sheets.historical_sheets(spark, sf, levels), places), tables(sheets.table_sheets(levels), places),
        items(sheets.item_sheets(levels), places),
        survey(sheets.survey_sheets(spark, sf, levels), variable_crosswalk(sheets.survey_crosswalk(spark)), sheets.survey_layouts(spark), places),
        crosswalk(spark))


ERAS_SQL = """
  SELECT year, stabbr, admin, CASE variable WHEN 'totercashsec' THEN 'assets' WHEN 'totempcontrb' THEN 'eec' WHEN 'systems' THEN 'nsystems' WHEN 'totmemb' THEN 'members' END AS variable, value FROM hist
  UNION ALL SELECT year, stabbr, CASE admin WHEN 'Total' THEN 1 WHEN 'State' THEN 2 ELSE 3 END,
    CASE variable WHEN 'totpay' THEN 'totexpend' WHEN 'totmem' THEN 'members' ELSE variable END, value
    FROM tables WHERE admin <> 'Township' AND variable NOT IN ('withdraw', 'otherpay')
  UNION ALL SELECT year, stabbr, type, CASE ItemID WHEN 11 THEN 'assets' ELSE 'nsystems' END, value FROM items
"""


@query(f"WITH {CUSTOMER_LEVELS_SQL}, {sheets.HIST_SQL} SELECT year, stabbr, admin, {ADMINF}, variable, value, source FROM hist")
def historical_at_size(spark, sf):
    """Finance and membership sheets with a row for every customer, year and level."""
    return historical(*sheets.historical_sheets(spark, sf, sheets.levels_at_size(spark, sf)), nation_states(spark, sf))


@query(f"WITH {CUSTOMER_LEVELS_SQL}, {sheets.TABLES_SQL} SELECT stabbr, admin, year, variable, CAST(value AS DOUBLE) AS value FROM tables")
def tables_at_size(spark, sf):
    return tables(sheets.table_sheets(sheets.levels_at_size(spark, sf)), nation_states(spark, sf))


@query(f"WITH {CUSTOMER_LEVELS_SQL}, {sheets.ITEMS_SQL} SELECT * FROM items")
def items_at_size(spark, sf):
    return items(sheets.item_sheets(sheets.levels_at_size(spark, sf)), nation_states(spark, sf))


@query(f"""
WITH {CUSTOMER_LEVELS_SQL}, {sheets.HIST_SQL}, {sheets.TABLES_SQL}, {sheets.ITEMS_SQL}, panel AS ({ERAS_SQL})
SELECT year, stabbr, admin, CASE admin WHEN 1 THEN 'State-local' WHEN 2 THEN 'State' ELSE 'Local' END AS adminf, variable, count(*) AS rows, count(value) AS known,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM panel GROUP BY 1, 2, 3, 5
""")
def eras_at_size(spark, sf):
    """Three eras from sheets with a row for every customer to one vocabulary, summed."""
    places, levels = _places(spark, sf), sheets.levels_at_size(spark, sf)
    old, middle = historical(*sheets.historical_sheets(spark, sf, levels), places), tables(sheets.table_sheets(levels), places)
    late = items(sheets.item_sheets(levels), places).withColumnRenamed("type", "admin")
    panel = unify([Source("df1", old, last=1992), Source("df2", middle.withColumn("admin", ordinal(F.col("admin"), TABLE_LEVELS))),
                   Source("df3", late, native="ItemID")], crosswalk(spark))
    return panel.groupBy("year", "stabbr", "admin", "adminf", "variable").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("known"), F.sum(money("value")).cast("double").alias("value"))


BALANCE_HEADERS = {"assets": "Pension assets (billions)", "liabilities": "Pension liabilities (billions)", "ufl": "Funding status (billions)",
                   "fr": "Assets as a percent of liabilities", "ufl.gdp": "Funding status as a percent of state GDP",
                   "ufl.staterev": "Funding status as a percent of state revenue"}
BALANCE_VALUES = {"assets": "s", "liabilities": "t", "ufl": "s - t", "fr": "s / t * 100", "ufl.gdp": "n", "ufl.staterev": "CASE WHEN year = 2001 THEN NULL ELSE n / 2 END"}


@query(f"""
WITH {LEVELS_SQL},
w AS (SELECT year, nationkey, CAST(max(price) FILTER (WHERE admin = 2) AS DOUBLE) AS s, CAST(max(price) FILTER (WHERE admin = 1) AS DOUBLE) AS t,
      CAST(max(n) FILTER (WHERE admin = 1) AS DOUBLE) AS n FROM levels GROUP BY 1, 2)
{' UNION ALL '.join(f"SELECT 'N' || lpad(CAST(nationkey AS VARCHAR), 2, '0') AS stabbr, '{k}' AS vname, '{BALANCE_HEADERS[k]}' AS vdesc, year, CAST({v} AS DOUBLE) AS value, 'billions' AS unit FROM w" for k, v in BALANCE_VALUES.items())}
""")
def balance_panel(spark, sf):
    wide = nation_levels(spark, sf).groupBy("year", "nation").agg(
        F.max(F.when(F.col("admin") == 2, F.col("price"))).cast("double").alias("s"),
        F.max(F.when(F.col("admin") == 1, F.col("price"))).cast("double").alias("t"),
        F.max(F.when(F.col("admin") == 1, F.col("n"))).cast("double").alias("n"))
    sheet = wide.select(F.col("year").alias("Date"), F.col("nation").alias("Region"), *[
        F.expr(v).alias(BALANCE_HEADERS[k]) for k, v in BALANCE_VALUES.items()])
    return balances(sheet, nation_states(spark, sf), unit="billions")


@query(f"""
WITH {LEVELS_SQL}
SELECT 'N' || lpad(CAST(nationkey AS VARCHAR), 2, '0') AS stabbr, v.vname, year, CAST(CASE v.vname WHEN 'liabilities' THEN price ELSE n END AS DOUBLE) / 1000 AS value
FROM levels, (VALUES ('liabilities'), ('nc.er')) AS v(vname) WHERE admin = 1
""")
def yearly_sheets_panel(spark, sf):
    rows = sheets.levels_of(spark, sf).where(F.col("admin") == 1)
    found = values_of(rows, "year")

    def sheet(c):
        years = [F.max(F.when(F.col("year") == y, F.col(c))).cast("double").alias(str(y)) for y in found]
        return rows.groupBy(F.col("nationkey").alias("fips"), F.col("nation").alias("stname")).agg(*years)

    return yearly_sheets({"liabilities": sheet("price"), "nc.er": sheet("n")}, nation_states(spark, sf))


@query("""
SELECT CAST(p_partkey AS DOUBLE) AS plan_id, p_name AS PlanName, CAST(1995 + p_size AS DOUBLE) AS fy, CAST(CASE p_type WHEN 'SMALL' THEN 1 WHEN 'PROMO' THEN 2 WHEN 'LARGE' THEN 3 WHEN 'MEDIUM' THEN 4 WHEN 'ECONOMY' THEN 5 ELSE 9 END AS DOUBLE) AS PlanType,
  CAST(p_size AS DOUBLE) AS AdministeringGovt, CASE WHEN p_size > 10 THEN 1.0 ELSE 0.0 END::DOUBLE AS FundingMethCode1_GASB,
  CAST(CASE WHEN p_size < 30 THEN 2 WHEN p_size < 40 THEN 3 END AS DOUBLE) AS FundingMethCode2_GASB, CAST(0 AS DOUBLE) AS AssetValMethCode_GASB,
  CASE WHEN p_type = 'PROMO' THEN 'TRUE' WHEN p_type = 'SMALL' THEN 'FALSE' END AS promo, CAST(DATE '2001-06-30' AS DATE) AS fye, CAST(NULL AS VARCHAR) AS empty,
  CASE p_type WHEN 'SMALL' THEN 'General-S&L' WHEN 'PROMO' THEN 'Teachers' WHEN 'LARGE' THEN 'Safety' WHEN 'MEDIUM' THEN 'General-State' WHEN 'ECONOMY' THEN 'General-Local' END AS planf,
  CASE p_size WHEN 1 THEN 'County' WHEN 2 THEN 'City' WHEN 5 THEN 'School' END AS adminf, CASE WHEN p_size > 10 THEN 'levpercent' ELSE 'levdollar' END AS pctdollf,
  CASE WHEN p_size < 30 THEN 'fixed' WHEN p_size < 40 THEN 'closed' END AS openclosedf, 'smoothed' AS assetmethf
FROM part
""")
def plan_table(spark, sf):
    """All-text table, its inferred types, and the label columns."""
    size, kind = F.col("p_size"), F.col("p_type")
    codes = {"SMALL": "1", "PROMO": "2", "LARGE": "3", "MEDIUM": "4", "ECONOMY": "5"}
    plan_type = F.coalesce(*[F.when(kind == k, v) for k, v in codes.items()], F.lit("9"))
    text = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("plan_id"), F.col("p_name").alias("PlanName"), (size + 1995).cast("string").alias("fy"),
        plan_type.alias("PlanType"), size.cast("string").alias("AdministeringGovt"), F.when(size > 10, "1").otherwise("0").alias("FundingMethCode1_GASB"),
        F.when(size < 30, "2").when(size < 40, "3").alias("FundingMethCode2_GASB"), F.lit("0").alias("AssetValMethCode_GASB"),
        F.when(kind == "PROMO", "TRUE").when(kind == "SMALL", "F").alias("promo"), F.lit("2001-06-30").alias("fye"), F.lit("").alias("empty"))
    return plans_labelled(plans_raw(text, note="plan table written from the part table"))


@query("""
SELECT x.year, x.id, 'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS stabbr, CAST(n_regionkey AS INTEGER) AS type,
  (['State', 'County', 'City', 'Municipal/town', 'Special District', 'School'])[n_regionkey + 1] AS typef, x.ic,
  CASE x.ic WHEN 'Z01' THEN 'Number of Active Members' WHEN 'Z02' THEN 'Number of Inactive Members' WHEN 'Z13' THEN 'Retirement Benefits' END AS icf,
  x.value, CAST(x.year % 100 AS INTEGER) AS syear, CAST(x.year % 100 AS INTEGER) AS dyear, '12' AS source, s_name AS idname,
  CASE WHEN s_acctbal > 0 THEN 'Public ' || s_name ELSE s_name END AS pubname
FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, lpad(CAST(s_nationkey + 1 AS VARCHAR), 2, '0') || n_regionkey || lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS id, s_suppkey AS k,
        CASE l_linenumber WHEN 6 THEN 'Z13' WHEN 7 THEN 'Q07' ELSE 'Z0' || l_linenumber END AS ic, CAST(sum(l_quantity) AS DOUBLE) AS value
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2, 3, 4) AS x
JOIN supplier ON s_suppkey = x.k JOIN nation ON n_nationkey = s_nationkey
""")
def unit_files(spark, sf):
    """35-character unit records with state, item and system names."""
    names = system_names(*sheets.name_lines(spark, sf), later_years=sheets.later_years(spark, sf))
    own = code_table(spark, [("Item code", "Description"), ("Z01", "*Number of Active Members"), ("Z02", "Number of 'Inactive Members ")], ["ic", "icdesc"])
    codes = item_codes(own, code_table(spark, SUPPLEMENT, ["ic", "icdesc"]))
    return unit_rows(sheets.unit_lines(spark, sf), names, codes, nation_states(spark, sf))


def _plans(spark, sf):
    units, ids = sheets.plan_lines(spark, sf)
    return plans_with_members(units_2017(units), ids_2017(ids), nation_states(spark, sf))


@query(f"WITH {sheets.PLAN_UNITS_SQL} SELECT * FROM sized")
def plans_2017(spark, sf):
    """39-character unit and id records to one row per plan."""
    return _plans(spark, sf)


EDGES = [0, 1, 2, 3, 4, 5, 10, 20, 50, 100, 1000, 10000, 100000]
LABELS = "['(0,1]','(1,2]','(2,3]','(3,4]','(4,5]','(5,10]','(10,20]','(20,50]','(50,100]','(100,1e+03]','(1e+03,1e+04]','(1e+04,1e+05]','(1e+05,Inf]']"
QUANTILES = ", ".join(f"round(quantile_cont(participants, {p}), 4) AS {n}" for n, p in PROBS.items())


@query(f"WITH {sheets.PLAN_UNITS_SQL} SELECT count(*) AS n, {QUANTILES} FROM sized")
def size_quantiles(spark, sf):
    out = quantiles(settled(_plans(spark, sf).select("participants")), "participants", PROBS)
    return out.withColumns({n: F.round(n, 4) for n in PROBS})


@query(f"""
WITH {sheets.PLAN_UNITS_SQL},
b AS (SELECT CAST(CASE {' '.join(f'WHEN participants <= {e} THEN {i}' for i, e in enumerate(EDGES) if i)} ELSE 13 END AS INTEGER) AS bin, participants AS p, CAST(assets AS DECIMAL(24,6)) AS a FROM sized),
g AS (SELECT bin, count(*) AS n, sum(p) AS parts, CASE WHEN count(*) = count(a) THEN sum(a) END AS assets FROM b GROUP BY 1),
t AS (SELECT sum(n) AS n, sum(parts) AS parts, CASE WHEN count(*) = count(assets) THEN sum(assets) END AS assets FROM g),
c AS (SELECT *, sum(n) OVER w AS n_cum, sum(parts) OVER w AS parts_cum, CASE WHEN count(*) OVER w = count(assets) OVER w THEN sum(assets) OVER w END AS assets_cum FROM g
      WINDOW w AS (ORDER BY bin ROWS UNBOUNDED PRECEDING))
SELECT bin, ({LABELS})[bin] AS size, n, CAST(n_cum AS BIGINT) AS n_cum, CAST(parts AS DOUBLE) AS parts, CAST(parts_cum AS DOUBLE) AS parts_cum, CAST(assets AS DOUBLE) AS assets, CAST(assets_cum AS DOUBLE) AS assets_cum,
  {', '.join(f"CAST({m}{s} AS DOUBLE) / CAST((SELECT {m} FROM t) AS DOUBLE) * 100 AS {m}{s}pct" if s else f"CAST({m} AS DOUBLE) / CAST((SELECT {m} FROM t) AS DOUBLE) * 100 AS {m}_pct" for m in ('n', 'parts', 'assets') for s in ('', '_cum'))}
FROM c
""")
def size_bins_of_plans(spark, sf):
    sizes = size_distribution(_plans(spark, sf), "participants", {"parts": "participants", "assets": "assets"})
    return sizes.withColumns({c: F.col(c).cast("double") for c in ("parts", "parts_cum", "assets", "assets_cum")})


MEASURES = ("n", "parts", "assets")


def _cells_sql(part: str, item: str, columns: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{part}' AS part, {item} AS item, '{c}' AS measure, CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns)


@query(f"""
WITH {sheets.PLAN_UNITS_SQL}, q AS (SELECT count(*) AS n, {QUANTILES} FROM sized),
rows AS (SELECT CASE WHEN participants <= 120 THEN 'small' ELSE 'big' END AS which, CAST(CASE {' '.join(f'WHEN participants <= {e} THEN {i}' for i, e in enumerate(EDGES) if i)} ELSE 13 END AS INTEGER) AS bin,
  participants AS p, CAST(assets AS DECIMAL(24,6)) AS a FROM sized),
h0 AS (SELECT which, count(*) AS n, sum(p) AS parts, CASE WHEN count(*) = count(a) THEN sum(a) END AS assets FROM rows GROUP BY 1
  UNION ALL SELECT 'all', count(*), sum(p), CASE WHEN count(*) = count(a) THEN sum(a) END FROM rows),
h AS (SELECT h0.which, CAST(h0.n AS DOUBLE) AS n, CAST(h0.parts AS DOUBLE) AS parts, CAST(h0.assets AS DOUBLE) AS assets,
  {', '.join(f"CAST(h0.{m} AS DOUBLE) / CAST(t.{m} AS DOUBLE) AS {m}_share" for m in ("n", "parts", "assets"))} FROM h0, (SELECT * FROM h0 WHERE which = 'all') AS t),
g AS (SELECT bin, count(*) AS n, sum(p) AS parts, CASE WHEN count(*) = count(a) THEN sum(a) END AS assets FROM rows GROUP BY 1),
t AS (SELECT sum(n) AS n, sum(parts) AS parts, CASE WHEN count(*) = count(assets) THEN sum(assets) END AS assets FROM g),
c AS (SELECT *, sum(n) OVER w AS n_cum, sum(parts) OVER w AS parts_cum, CASE WHEN count(*) OVER w = count(assets) OVER w THEN sum(assets) OVER w END AS assets_cum FROM g WINDOW w AS (ORDER BY bin ROWS UNBOUNDED PRECEDING)),
b AS (SELECT ({LABELS})[bin] AS item, {', '.join(f"CAST(c.{m} AS DOUBLE) AS {m}, CAST({m}_cum AS DOUBLE) AS {m}_cum, CAST(c.{m} AS DOUBLE) / CAST(t.{m} AS DOUBLE) * 100 AS {m}_pct, CAST({m}_cum AS DOUBLE) / CAST(t.{m} AS DOUBLE) * 100 AS {m}_cumpct" for m in ("n", "parts", "assets"))} FROM c, t)
{_cells_sql("quantiles", "'all'", ["n", *PROBS], "q")}
UNION ALL {_cells_sql("shares", "which", [f"{m}{k}" for m in MEASURES for k in ("", "_share")], "h")}
UNION ALL {_cells_sql("sizes", "item", [f"{m}{k}" for m in MEASURES for k in ("", "_cum", "_pct", "_cumpct")], "b")}
""")
def size_study(spark, sf):
    """Quantiles, bins and shares of plans, of members and of assets, as one table."""
    study = size_study_table(_plans(spark, sf), limit=120)
    return study.withColumn("value", F.when(F.col("part") == "quantiles", F.round("value", 4)).otherwise(F.col("value")))


@query(f"""
WITH {sheets.PLAN_UNITS_SQL},
g AS (SELECT CASE WHEN participants <= 120 THEN 'small' ELSE 'big' END AS which, count(*) AS n, sum(participants) AS p, CASE WHEN count(*) = count(assets) THEN sum(CAST(assets AS DECIMAL(24,6))) END AS a FROM sized GROUP BY 1
      UNION ALL SELECT 'all', count(*), sum(participants), CASE WHEN count(*) = count(assets) THEN sum(CAST(assets AS DECIMAL(24,6))) END FROM sized)
SELECT which, CAST(n AS DOUBLE) AS n, CAST(p AS DOUBLE) AS parts, CAST(n AS DOUBLE) / (SELECT max(n) FROM g) AS n_share, CAST(p AS DOUBLE) / (SELECT max(p) FROM g) AS parts_share,
  CAST(a AS DOUBLE) AS assets, CAST(a AS DOUBLE) / (SELECT CAST(max(a) AS DOUBLE) FROM g) AS assets_share FROM g
""")
def small_plan_shares(spark, sf):
    return small_and_big(_plans(spark, sf), "pid", "participants", 120)


@query(f"WITH {sheets.PLAN_UNITS_SQL} SELECT count(*) AS n_sum, median(c) AS n_mdn FROM (SELECT stabbr, stname, count(*) AS c FROM sized GROUP BY 1, 2)")
def states_and_median(spark, sf):
    return groups_and_median(_plans(spark, sf), ["stabbr", "stname"])


@query(f"""
WITH {sheets.PLAN_UNITS_SQL},
r AS (SELECT pid, ptype, uname, assets, members, beneficiaries, row_number() OVER w AS n_down, sum(CAST(members AS DECIMAL(18,2))) OVER w AS m, sum(CAST(beneficiaries AS DECIMAL(18,2))) OVER w AS b,
  count(*) OVER () AS n, sum(CAST(members AS DECIMAL(18,2))) OVER () AS tm, sum(CAST(beneficiaries AS DECIMAL(18,2))) OVER () AS tb
  FROM sized WHERE assets >= 0.1 WINDOW w AS (ORDER BY assets DESC, pid ROWS UNBOUNDED PRECEDING))
SELECT pid, ptype, uname, assets, n_down, CAST(n_down AS DOUBLE) / n * 100 AS n_downpct, CAST(m AS DOUBLE) AS members_down, CAST(m AS DOUBLE) / CAST(tm AS DOUBLE) * 100 AS members_downpct,
  CAST(b AS DOUBLE) AS ben_down, CAST(b AS DOUBLE) / CAST(tb AS DOUBLE) * 100 AS ben_downpct
FROM r WHERE n_down IN (10, 20, 25, 100, 200, 250, 300)
""")
def concentration_at_ranks(spark, sf):
    """Shares held by the largest plans, at some ranks."""
    plans = settled(_plans(spark, sf).where(F.col("assets") >= 0.1))  # made by joins, and read three times
    few = at_ranks(plans.withColumn("m", F.col("members")).withColumn("b", F.col("beneficiaries")), "assets", "pid",
                   {"members": "m", "ben": "b"}, [10, 20, 25, 100, 200, 250, 300])
    return few.select(
        "pid", "ptype", "uname", "assets", F.col("n_down").cast("long").alias("n_down"), "n_downpct", "members_down", "members_downpct", "ben_down", "ben_downpct")


@query("""
SELECT ic, CASE WHEN count(*) = count(v) THEN CAST(sum(v) AS DOUBLE) END AS value FROM (
  SELECT CASE l_linenumber WHEN 1 THEN 'X21' WHEN 2 THEN 'X30' WHEN 3 THEN 'X46' WHEN 4 THEN 'X47' ELSE 'Z01' END AS ic, CASE WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN NULL ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS v FROM lineitem)
WHERE ic IN ('X21', 'X30', 'X46', 'X47') GROUP BY 1
""")
def investment_items(spark, sf):
    """Items on either investment list count once; a missing value leaves no sum."""
    k = F.col("l_linenumber")
    ic = F.when(k == 1, "X21").when(k == 2, "X30").when(k == 3, "X46").when(k == 4, "X47").otherwise("Z01")
    value = F.when(~((F.col("l_returnflag") == "R") & (k == 4)), F.col("l_quantity"))
    rows = table(spark, sf, "lineitem").select(ic.alias("ic"), value.alias("value"))
    return rows.where(F.col("ic").isin(INVESTMENTS)).groupBy("ic").agg(sum_strict(F.col("value")).alias("value"))


@query("""
SELECT ic, flag, count(*) AS n, CASE WHEN count(*) = count(v) THEN CAST(sum(v) AS DOUBLE) END AS value FROM (
  SELECT CASE l_linenumber WHEN 1 THEN 'X21' WHEN 2 THEN 'X30' WHEN 3 THEN 'X46' WHEN 4 THEN 'X47' ELSE 'Z01' END AS ic, CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'I' END AS flag,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN NULL ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS v FROM lineitem)
WHERE ic IN ('X21', 'X30', 'X46', 'X47') GROUP BY 1, 2
""")
def investment_items_by_flag(spark, sf):
    """Investment totals by item and by whether the amount was reported or imputed."""
    k = F.col("l_linenumber")
    ic = F.when(k == 1, "X21").when(k == 2, "X30").when(k == 3, "X46").when(k == 4, "X47").otherwise("Z01")
    flag = F.when(F.col("l_linestatus") == "F", "R").otherwise("I")
    value = F.when(~((F.col("l_returnflag") == "R") & (k == 4)), F.col("l_quantity"))
    rows = table(spark, sf, "lineitem").select(ic.alias("ic"), flag.alias("flag"), value.alias("value")).where(F.col("ic").isin(INVESTMENTS))
    return totals(rows, ["ic", "flag"], {"value": "value"})


@query(f"""
WITH {sheets.PLAN_UNITS_SQL}
SELECT CAST(ceil(assets / 0.05 - 0.5) * 0.05 + 0.0 AS DOUBLE) AS centre, count(*) AS n FROM sized WHERE assets >= 0.01 AND assets < 0.4 GROUP BY 1
""")
def asset_histogram(spark, sf):
    plans = _plans(spark, sf).where((F.col("assets") >= 0.01) & (F.col("assets") < 0.4))
    return histogram(plans, "assets", 0.05)


RECIPE = "eec, Z01\nerc, Z02\nerc, Z03\nexpend, Z04\nassets, Z05\nassets, Z13\ncontrib, Z99"
RECIPE_SQL = """
facts AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CASE WHEN s_suppkey < 100 THEN lpad(CAST(s_suppkey AS VARCHAR), 3, '0') ELSE CAST(s_suppkey AS VARCHAR) END AS id, n_name AS stabbr, n_regionkey AS type, s_name AS pubname,
    CASE l_linenumber WHEN 6 THEN 'Z13' WHEN 7 THEN 'Q07' ELSE 'Z0' || l_linenumber END AS ic, CAST(l_extendedprice AS DECIMAL(18,2)) AS value
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
recipe(variable, ic) AS (VALUES ('eec','Z01'), ('erc','Z02'), ('erc','Z03'), ('expend','Z04'), ('assets','Z05'), ('assets','Z13'), ('contrib','Z99')),
both_ AS (SELECT * FROM facts UNION ALL SELECT year, 'US Total', 'US', type, 'US Total', ic, value FROM facts),
systems AS (SELECT year, id, stabbr, type, pubname, variable, CAST(coalesce(sum(value), 0) AS DOUBLE) AS value
  FROM recipe LEFT JOIN both_ ON both_.ic = recipe.ic GROUP BY 1, 2, 3, 4, 5, 6)
"""


def _system_facts(spark, sf):
    """Unit facts (year, id, stabbr, type, pubname, ic, value), one row per system, year and item."""
    k = F.col("l_linenumber")
    item = F.when(k == 6, "Z13").when(k == 7, "Q07").otherwise(F.concat(F.lit("Z0"), k.cast("string")))
    sums = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year"), item.alias("ic")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("value"))
    homes = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), pad_code(F.col("s_suppkey").cast("string"), 3).alias("id"),
        F.col("n_name").alias("stabbr"), F.col("n_regionkey").alias("type"), F.col("s_name").alias("pubname"))
    return sums.join(homes, "l_suppkey").drop("l_suppkey")


def _systems(spark, sf):
    return roll_up(_system_facts(spark, sf), code_table(spark, RECIPE, ["variable", "ic"]))


@query(f"WITH {RECIPE_SQL} SELECT * FROM systems")
def recipe_rollup(spark, sf):
    return _systems(spark, sf)


@query(f"""
WITH {RECIPE_SQL},
l AS (SELECT stabbr, year, CASE WHEN type = 0 THEN 2 ELSE 3 END AS type, variable AS vname, CAST(value AS DECIMAL(18,2)) AS value FROM systems WHERE stabbr IS NOT NULL)
SELECT stabbr, year, type, vname, CAST(sum(value) AS DOUBLE) AS value FROM l GROUP BY 1, 2, 3, 4
UNION ALL SELECT stabbr, year, 1, vname, CAST(sum(value) AS DOUBLE) FROM l GROUP BY 1, 2, 4
""")
def system_levels(spark, sf):
    return levels_from_systems(_systems(spark, sf))


PRECEDENCE = [("sshistdb", None, 1996), ("ssxl", 1998, 1998), ("sysyearvar", 1999, None)]
PANEL_VARIABLES = ["assets", "contrib", "eec", "erc", "expend"]
STATE_PANEL_SQL = f"""
{LEVELS_SQL}, {RECIPE_SQL},
l AS (SELECT stabbr, year, CASE WHEN type = 0 THEN 2 ELSE 3 END AS type, variable AS vname, CAST(value AS DECIMAL(18,2)) AS value FROM systems WHERE stabbr IS NOT NULL),
sysvar AS (SELECT stabbr, year, type, vname, CAST(sum(value) AS DOUBLE) AS value FROM l GROUP BY 1, 2, 3, 4
  UNION ALL SELECT stabbr, year, 1, vname, CAST(sum(value) AS DOUBLE) FROM l GROUP BY 1, 2, 4),
stacked AS (
  SELECT year, nation AS stabbr, admin AS type, 'assets' AS vname, CAST(price AS DOUBLE) AS value, 'sshistdb' AS source FROM levels WHERE year <= 1996
  UNION ALL SELECT year, nation, admin, 'expend', CAST(n AS DOUBLE), 'sshistdb' FROM levels WHERE year <= 1996 AND admin < 3
  UNION ALL SELECT year, nation, admin, 'assets', CAST(price AS DOUBLE), 'ssxl' FROM levels WHERE year = 1998
  UNION ALL SELECT year, nation, admin, 'eec', CAST(n AS DOUBLE), 'ssxl' FROM levels WHERE year = 1998
  UNION ALL SELECT year, nation, admin, 'erc', CAST(n AS DOUBLE) / 2, 'ssxl' FROM levels WHERE year = 1998
  UNION ALL SELECT year, nation, admin, 'expend', CAST(n AS DOUBLE) / 4, 'ssxl' FROM levels WHERE year = 1998
  UNION ALL SELECT year, stabbr, type, vname, value, 'sysyearvar' FROM sysvar WHERE year >= 1999),
panel AS (SELECT year, stabbr, CAST(type AS INTEGER) AS type, CASE type WHEN 1 THEN 'State-local total' WHEN 2 THEN 'State' ELSE 'Local' END AS typef, vname, value, source FROM stacked)
"""


def _state_panel(spark, sf):
    levels = sheets.levels_of(spark, sf).select("year", F.col("nation").alias("stabbr"), F.col("admin").alias("type"),
                                             F.col("price").cast("double").alias("p"), F.col("n").cast("double").alias("n"))
    def long(pairs, name):
        cells = F.explode(F.array(*[F.struct(F.lit(k).alias(name), v.alias("value")) for k, v in pairs.items()])).alias("x")
        return levels.select("year", "stabbr", "type", cells).select("year", "stabbr", "type", f"x.{name}", "x.value")

    n, local = F.col("n"), F.col("type") == 3
    historical_long = long({"totercashsec": F.col("p"), "toterexp": F.when(~local, n)}, "variable")
    item_rows = long({11: F.col("p"), 2: n, 3: n / 2, 7: n / 4, 99: n}, "ItemID")
    names = code_table(spark, "assets, TotERCashSec, 11\nexpend, TotERExp, 7\neec, TotEmpContrb, 2\nerc, TotGovContrb, 3",
                       ["vname", "sasvarname", "itemnumber"])
    return states_over_time(historical_long, item_rows, _systems(spark, sf), names, PRECEDENCE)


@query(f"WITH {STATE_PANEL_SQL} SELECT * FROM panel")
def state_panel(spark, sf):
    """Three sources, one per year, in one vocabulary."""
    return _state_panel(spark, sf)


@query(f"""
WITH {STATE_PANEL_SQL}
SELECT v.variable, v.sources, (SELECT count(*) FROM panel) AS rows FROM (VALUES ('year', 'lineitem, orders'), ('stabbr', 'nation'),
  ('type', 'nation, orders'), ('typef', 'nation, orders'), ('vname', ''), ('value', 'lineitem, orders'), ('source', '')) AS v(variable, sources)
""")
def state_panel_sources(spark, sf):
    """What each column of the panel of three sources comes from, by its plan: notes stand
    on the given tables alone."""
    with noted_inputs():
        panel = _state_panel(spark, sf)
    found = sources_of(panel)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.lit(", ".join(found[c])).alias("sources")) for c in panel.columns]))
    return panel.agg(F.count(F.lit(1)).alias("rows")).select(cells.alias("c"), "rows").select("c.variable", "c.sources", "rows")


CASH_SQL = f"""
{STATE_PANEL_SQL},
wide AS (SELECT year, stabbr, type, typef, source, {', '.join(f"max(value) FILTER (WHERE vname = '{v}') AS {v}0" for v in PANEL_VARIABLES)} FROM panel GROUP BY 1, 2, 3, 4, 5),
flow AS (SELECT year, stabbr, type, typef, source, assets0 AS assets, coalesce(contrib0, eec0 + erc0) AS contrib, eec0 AS eec, erc0 AS erc, expend0 AS expend FROM wide),
flows AS (SELECT *, contrib - expend AS xcf, contrib / nullif(assets, 0) * 100 AS contrib_pct, expend / nullif(assets, 0) * 100 AS expend_pct, (contrib - expend) / nullif(assets, 0) * 100 AS xcf_pct FROM flow),
cash AS (SELECT year, stabbr, type, typef, source, variable, value FROM flows UNPIVOT INCLUDE NULLS (value FOR variable IN (assets, contrib, eec, erc, expend, xcf, contrib_pct, expend_pct, xcf_pct)))
"""


@query(f"WITH {CASH_SQL} SELECT * FROM cash")
def cash_flow_panel(spark, sf):
    return cash_flows(_state_panel(spark, sf), PANEL_VARIABLES)


@query(f"""
WITH {CASH_SQL},
pop AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, n_name AS stabbr, count(DISTINCT o_custkey) AS pop FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2),
prices AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY 1)
SELECT c.*, CAST(p.pop AS BIGINT) AS pop, c.value / p.pop AS valpc, c.value * (SELECT value FROM prices WHERE year = 2000) / d.value AS rvalue,
  c.value * (SELECT value FROM prices WHERE year = 2000) / d.value / p.pop AS rvalpc
FROM cash AS c LEFT JOIN pop AS p ON p.year = c.year AND p.stabbr = c.stabbr LEFT JOIN prices AS d ON d.year = c.year
""")
def real_per_capita(spark, sf):
    pairs = table(spark, sf, "orders").select("o_custkey", order_year()).distinct()
    homes = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("stabbr"))
    population = pairs.join(homes, "o_custkey").groupBy("year", "stabbr").agg(F.count(F.lit(1)).alias("pop"))
    prices = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("value"))
    return real_values(cash_flows(_state_panel(spark, sf), PANEL_VARIABLES), population, prices, base=2000)


@query(f"""
WITH {SUPPLIER_FLOWS_SQL},
pop AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, n_name AS stabbr, count(*) AS pop FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2)
SELECT b.year, b.variable, b.stabbr, b.value, CAST(pop AS BIGINT) AS pop, b.value / pop AS valpc FROM by_state AS b LEFT JOIN pop USING (year, stabbr)
""")
def state_per_capita(spark, sf):
    per_customer = table(spark, sf, "orders").groupBy("o_custkey", order_year()).agg(F.count(F.lit(1)).alias("n"))
    homes = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("stabbr"))
    population = per_customer.join(homes, "o_custkey").groupBy("year", "stabbr").agg(F.sum("n").alias("pop"))
    return per_head(flows_by_state(spark, sf), population)


DECILE_SQL = ", ".join(f"round(quantile_cont(assets, {i / 10}), 4) AS d{i}" for i in range(11))


@query(f"WITH {sheets.PLAN_UNITS_SQL} SELECT ptype, count(*) AS n, {DECILE_SQL} FROM sized GROUP BY 1")
def asset_deciles(spark, sf):
    out = quantiles(settled(_plans(spark, sf).select("ptype", "assets")), "assets", {f"d{i}": i / 10 for i in range(11)}, ["ptype"])
    return out.withColumns({f"d{i}": F.round(f"d{i}", 4) for i in range(11)})
