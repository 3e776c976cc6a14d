"""The given tables written the way the yearly source files look, so that the
panel plans can be run on data of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reshape import values_of
from ..plans.survey import LAYOUTS, PLAIN, layout_table
from ..session import settled
from .base import customer_levels, money, nation_levels, orders_by_nation, table

HIST_SHIFT, ITEM_SHIFT, SURVEY_SHIFT = -10, 9, 17
SURVEY_LAYOUTS = [*LAYOUTS, (2018, PLAIN, None, None, None)]


def text(c: Column) -> Column:
    return c.cast("decimal(28,2)").cast("string")


def literal_row(spark: SparkSession, file: str, row_no: int, cells: list, **extra) -> DataFrame:
    """One fixed row, such as a header."""
    more = "".join(f", {v} AS {k}" for k, v in extra.items())
    inside = ", ".join("CAST(NULL AS STRING)" if c is None else f"'{c}'" for c in cells)
    return spark.sql(f"SELECT {file} AS file, CAST({row_no} AS BIGINT) AS row_no, array({inside}) AS cells{more}")


def levels_of(spark: SparkSession, sf: str) -> DataFrame:
    """Sums by year, nation and level, kept once: a sheet reads them several times."""
    return settled(nation_levels(spark, sf).withColumn("at", F.col("nationkey")))


def levels_at_size(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a row for every customer, for sheets with as many rows."""
    return settled(customer_levels(spark, sf))


def historical_sheets(spark: SparkSession, sf: str, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Finance and membership sheets: names in row 12, levels 1 to 3 and other types."""
    levels = facts.select("year", "nationkey", F.col("admin").cast("string").alias("type"), "price", "n")
    other = orders_by_nation(spark, sf, ("P",)).select("year", "nationkey", F.lit("x").alias("type"), "price", "n")
    whole = levels.groupBy("year", "type").agg(F.sum("price").alias("price"), F.sum("n").alias("n"))
    rows = levels.unionByName(other).withColumn("id", F.concat(F.lpad((F.col("nationkey") + 1).cast("string"), 2, "0"), F.lit("0000")))
    rows = rows.drop("nationkey").unionByName(whole.withColumn("id", F.lit("520000")))
    stadmin = F.when(F.col("type") == "1", "N State Total").when(F.col("type") == "2", "State-Admin").when(
        F.col("type") == "3", "Local-Admin").otherwise("Other")
    local = F.col("type") == "3"

    def sheet(kind: str, ids: list[Column], names: list[str], measures: dict[str, Column]) -> DataFrame:
        cells = F.array(*ids, stadmin, F.concat(F.lit(" "), F.col("type")), (F.col("year") + HIST_SHIFT).cast("string"), *measures.values())
        body = rows.select(F.lit(kind).alias("file"), F.lit(100).cast("long").alias("row_no"), cells.alias("cells"))
        header = [*names, "SAS VAR NAME>", "Type", "Year", *measures]
        return literal_row(spark, f"'{kind}'", 12, header).unionByName(body)

    blank = F.lit("0")
    id_ = F.concat(F.lit(" "), F.col("id"))
    finance = sheet("finance", [blank, id_, blank, blank, blank], ["SortCode", "ID", "State", "FIPS", "Pasis"], {
        "TotERCashSec": text(F.col("price")),
        "TotEmpContrb": F.when(local, "-11111").otherwise(F.col("n").cast("string")),
    })
    membership = sheet("membership", [blank, id_, blank, blank], ["SortCode", "ID", "State", "FIPS"], {
        "Systems": F.format_number(F.col("n"), 0),
        "TotMemb": F.when(local, F.lit("0")).otherwise(F.col("n").cast("string")),
    })
    return finance, membership


HIST_SQL = f"""
hist_rows AS (
  SELECT year + {HIST_SHIFT} AS year, 'N' || lpad(CAST(nationkey AS VARCHAR), 2, '0') AS stabbr, admin, price, n FROM levels
  UNION ALL SELECT year + {HIST_SHIFT}, 'NATL', admin, sum(price), sum(n) FROM levels GROUP BY 1, 3),
hist AS (
  SELECT year, stabbr, admin, 'totercashsec' AS variable, CAST(price AS DOUBLE) AS value, 'finance' AS source FROM hist_rows
  UNION ALL SELECT year, stabbr, admin, 'totempcontrb', CASE WHEN admin = 3 THEN NULL ELSE CAST(n AS DOUBLE) END, 'finance' FROM hist_rows
  UNION ALL SELECT year, stabbr, admin, 'systems', CAST(n AS DOUBLE), 'membership' FROM hist_rows
  UNION ALL SELECT year, stabbr, admin, 'totmemb', CASE WHEN admin = 3 THEN 0 ELSE CAST(n AS DOUBLE) END, 'membership' FROM hist_rows)
"""


def table_sheets(levels: DataFrame) -> dict[int, DataFrame]:
    """Tables 3, 4 and 5, one file per year and table, levels as indented rows."""
    admin, n = F.col("admin"), F.col("n")
    label = F.when(admin == 1, F.col("nation")).when(admin == 2, "   State").otherwise("   Local")
    place = (100 + F.col("at") * 3 + admin).cast("long")

    def level_sheet(*cells: Column) -> DataFrame:
        return levels.select(F.col("year").cast("string").alias("file"), place.alias("row_no"), F.array(label, *cells).alias("cells"), "year")

    count = F.format_number(n, 0)
    whole = levels.groupBy("year", "admin").agg(F.sum("n").alias("n"))
    wide_label = F.when(admin == 1, "United States").when(admin == 2, "  State-administered").otherwise("  Locals, Local-administered")
    notes = whole.where(admin == 1).select("year", F.lit(1).cast("long").alias("row_no"), F.array(F.lit("Table 5"), F.lit("not a number")).alias("cells"))
    nation_rows = whole.select("year", (F.lit(10) + admin).cast("long").alias("row_no"), F.array(wide_label, count).alias("cells"))
    towns = whole.where(admin == 3).select("year", F.lit(20).cast("long").alias("row_no"), F.array(F.lit("Townships"), count).alias("cells"))
    states = levels.where(admin == 1).select("year", place.alias("row_no"), F.array(F.col("nation"), count).alias("cells"))
    members = notes.unionByName(nation_rows).unionByName(towns).unionByName(states)
    return {
        3: level_sheet(text(F.col("price")), count, F.lit("(Z)"), F.lit("0")),
        4: level_sheet(F.format_number(F.col("price"), 2)),
        5: members.withColumn("file", F.col("year").cast("string")),
    }


TABLES_SQL = """
tab_rows AS (SELECT year, 'N' || lpad(CAST(nationkey AS VARCHAR), 2, '0') AS stabbr, CASE admin WHEN 1 THEN 'Total' WHEN 2 THEN 'State' ELSE 'Local' END AS admin, price, n FROM levels),
tab5 AS (SELECT year, stabbr, admin, n FROM tab_rows WHERE admin = 'Total'
  UNION ALL SELECT year, 'US', CASE admin WHEN 1 THEN 'Total' WHEN 2 THEN 'State' ELSE 'Local' END, sum(n) FROM levels GROUP BY 1, 3
  UNION ALL SELECT year, 'US', 'Township', sum(n) FROM levels WHERE admin = 3 GROUP BY 1),
tables AS (
  SELECT stabbr, admin, year, 'totpay' AS variable, CAST(price AS DOUBLE) AS value FROM tab_rows
  UNION ALL SELECT stabbr, admin, year, 'benefits', CAST(n AS DOUBLE) FROM tab_rows
  UNION ALL SELECT stabbr, admin, year, 'withdraw', NULL FROM tab_rows
  UNION ALL SELECT stabbr, admin, year, 'otherpay', 0 FROM tab_rows
  UNION ALL SELECT stabbr, admin, year, 'assets', CAST(price AS DOUBLE) FROM tab_rows
  UNION ALL SELECT stabbr, admin, year, 'nsystems', CAST(n AS DOUBLE) FROM tab5
  UNION ALL SELECT stabbr, admin, year, v, NULL FROM tab5, (VALUES ('totmem'), ('actives'), ('inactives'), ('beneficiaries')) AS x(v))
"""


def item_sheets(levels: DataFrame) -> DataFrame:
    """Item files of two layouts: the header's row and spelling and an extra column differ."""
    year = (F.col("year") + ITEM_SHIFT).alias("year")
    code = F.concat((F.col("nationkey") + 1).cast("string"), F.lit(".0"))
    level = F.col("admin").cast("string")
    body = levels.select(
        "year", F.explode(F.array(
            F.struct(code.alias("s"), F.lit("11").alias("i"), level.alias("l"), F.lit("TOTAL CASH AND DEPOSITS").alias("t"), text(F.col("price")).alias("v")),
            F.struct(code.alias("s"), F.lit("32").alias("i"), level.alias("l"), F.lit("Number of systems").alias("t"), F.format_number("n", 0).alias("v")),
            F.struct(code.alias("s"), F.lit("note").alias("i"), level.alias("l"), F.lit("no item").alias("t"), F.lit("").alias("v")),
        )).alias("r"))
    late = F.col("year") > 1998
    cells = F.when(late, F.array("r.s", "r.i", "r.l", "r.t", F.lit("1.5"), "r.v")).otherwise(F.array("r.s", "r.i", "r.l", "r.t", "r.v"))
    rows = body.select("year", F.lit(50).cast("long").alias("row_no"), cells.alias("cells"))
    names = F.when(late, F.array(*map(F.lit, ["State ID", "Item ID", "Level", "Item Name", "CV", "Amount"]))).otherwise(
        F.array(*map(F.lit, ["State_ID", "Item_ID", "Level", "Item_Name", "Amount"])))
    headers = levels.select("year").distinct().select(
        "year", F.when(late, 5).otherwise(3).cast("long").alias("row_no"), names.alias("cells"))
    out = headers.unionByName(rows)
    return out.select(F.concat(year.cast("string"), F.lit("retest_data")).alias("file"), "row_no", "cells", year)


ITEMS_SQL = f"""
items AS (
  SELECT year + {ITEM_SHIFT} AS year, 'N' || lpad(CAST(nationkey AS VARCHAR), 2, '0') AS stabbr, i.id AS ItemID, i.name AS ItemName, admin AS type,
    CASE admin WHEN 1 THEN 'State-local' WHEN 2 THEN 'State' ELSE 'Local' END AS typef, CAST(CASE i.id WHEN 11 THEN price ELSE n END AS DOUBLE) AS value
  FROM levels, (VALUES (11, 'Total Cash And Short-Term Investments'), (32, 'Number Of Systems')) AS i(id, name))
"""

SURVEY_TEXTS = {"assets": "Total assets", "nsystems": "Number of systems", "payroll": "Total payroll"}


def survey_crosswalk(spark: SparkSession) -> DataFrame:
    """Text of each variable by year; the text for assets changes in 2015."""
    years = [y for y, *_ in SURVEY_LAYOUTS]
    rows = ", ".join(
        f"('{v}', " + ", ".join(f"'{t + (', at market' if v == 'assets' and y > 2014 else '')}'" for y in years) + ")"
        for v, t in SURVEY_TEXTS.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(vname, {', '.join(f'year{y}' for y in years)})")


def survey_sheets(spark: SparkSession, sf: str, levels: DataFrame) -> DataFrame:
    """Summary sheets: one group of columns per nation, which only its first names.

    A sheet has as many columns as nations and levels; the facts are already summed
    to them when the cells of a row are put in order."""
    layouts = layout_table(spark, SURVEY_LAYOUTS)
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("nation"))
    years = F.explode(F.lit([y for y, *_ in SURVEY_LAYOUTS])).alias("year")
    slots = nations.select("*", years).join(layouts, "year").select("*", F.posexplode("levels").alias("j", "code"))
    slots = slots.withColumn("at", F.col("nationkey") * F.size("levels") + F.col("j"))
    facts = levels.select((F.col("year") + SURVEY_SHIFT).alias("year"), "nationkey", F.col("admin").alias("code"), "price", "n")
    full = slots.join(facts, ["year", "nationkey", "code"], "left")
    cv = F.col("code") > 3
    payroll = F.when(F.col("code") == 3, "0").otherwise(text(F.col("price")))
    asset_text = F.when(F.col("year") > 2014, "Total assets, at market").otherwise("Total assets")
    lines = F.explode(F.array(
        F.struct(asset_text.alias("t"), F.when(cv, "2.5").otherwise(text(F.col("price"))).alias("v")),
        F.struct(F.lit("Number of systems").alias("t"), F.when(cv, "2.5").otherwise(F.format_number("n", 0)).alias("v")),
        F.struct(F.lit("Total payroll").alias("t"), F.when(cv, "2.5").otherwise(payroll).alias("v")),
        F.struct(F.lit("A text no variable uses").alias("t"), F.lit("1").alias("v")),
    )).alias("line")

    def in_order(value: Column) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct("at", value.alias("v")))), lambda s: s["v"])

    body = full.select("year", "at", lines).groupBy("year", F.col("line.t").alias("t")).agg(in_order(F.col("line.v")).alias("cells"))
    body = body.select("year", F.lit(2).cast("long").alias("row_no"), F.concat(F.array("t"), F.col("cells")).alias("cells"))
    name = F.when((F.col("j") == 0) & ((F.col("year") != 2014) | (F.col("nationkey") > 0)), F.col("nation"))
    heads = slots.groupBy("year").agg(in_order(name).alias("names"))
    shifted = F.concat(F.slice("names", 1, 6), F.array(F.lit("NATION_0")), F.slice("names", F.lit(7), F.greatest(F.size("names") - 6, F.lit(0))))
    heads = heads.select("year", F.lit(1).cast("long").alias("row_no"), F.concat(
        F.array(F.lit("text")), F.when(F.col("year") == 2013, shifted).otherwise(F.col("names"))).alias("cells"))
    # The 2014 repair names the first group; here that is the first nation.
    return heads.unionByName(body).withColumn("file", F.concat(F.col("year").cast("string"), F.lit("Summary")))


def survey_layouts(spark: SparkSession) -> DataFrame:
    rows = [(y, lv, d, s, "NATION_0" if s else None) for y, lv, d, s, _ in SURVEY_LAYOUTS]
    return layout_table(spark, rows)


SURVEY_SQL = f"""
survey AS (
  SELECT stabbr, year, admin, vname, value FROM (
    SELECT 'N' || lpad(CAST(nationkey AS VARCHAR), 2, '0') AS stabbr, year + {SURVEY_SHIFT} AS year, admin, v.vname,
      CAST(CASE v.vname WHEN 'nsystems' THEN n WHEN 'assets' THEN price ELSE CASE WHEN admin = 3 THEN NULL ELSE price END END AS DOUBLE) AS value
    FROM levels, (VALUES ('assets'), ('nsystems'), ('payroll')) AS v(vname)) WHERE value IS NOT NULL)
"""


def aff_sheets(levels: DataFrame) -> DataFrame:
    """Older download: a column per level and measure, plus sampling errors from 2013."""
    wide = levels.groupBy((F.col("year") + SURVEY_SHIFT).alias("year"), "nation").agg(
        *[F.max(F.when(F.col("admin") == a, F.col(m))).cast("string").alias(f"{m}{a}") for a in (1, 2, 3) for m in ("price", "n")])
    plain, with_cv = ["lvl0", "lvl1", "lvl2"], ["lvl0a", "lvl0b", "lvl1", "lvl2b", "lvl2a"]
    texts = {"C015": "Total assets", "C036": "Number of systems"}
    source = {"lvl0": 1, "lvl0a": 1, "lvl1": 2, "lvl2": 3, "lvl2b": 3}

    def columns(levels):
        return [(lv, c) for c in texts for lv in levels]

    def by_year(early, late):
        return F.when(F.col("year") == 2012, F.array(*early)).otherwise(F.array(*late))

    def values(levels):
        return [F.col(("price" if c == "C015" else "n") + str(source[lv])) if lv in source else F.lit("9.9") for lv, c in columns(levels)]

    ids = [F.lit("GEO.id"), F.lit("GEO.id2"), F.lit("GEO.display-label")]
    names = by_year(ids + [F.lit(f"{lv}_{c}") for lv, c in columns(plain)], ids + [F.lit(f"{lv}_{c}") for lv, c in columns(with_cv)])
    described = by_year(ids + [F.lit(f"{lv}; {texts[c]}") for lv, c in columns(plain)], ids + [F.lit(f"{lv}; {texts[c]}") for lv, c in columns(with_cv)])
    place = [F.lit("id"), F.lit("id2"), F.col("nation")]
    body = wide.select("year", F.lit(3).cast("long").alias("row_no"), by_year(place + values(plain), place + values(with_cv)).alias("cells"))
    years = wide.select("year").distinct()
    top = years.select("year", F.lit(1).cast("long").alias("row_no"), names.alias("cells"))
    second = years.select("year", F.lit(2).cast("long").alias("row_no"), described.alias("cells"))
    return top.unionByName(second).unionByName(body).withColumn("file", F.concat(F.lit("PP_"), F.col("year").cast("string"), F.lit("_x")))


def unit_lines(spark: SparkSession, sf: str) -> DataFrame:
    """35-character unit records: suppliers as systems, line numbers as items."""
    homes = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    ids = homes.select(F.col("s_suppkey").alias("l_suppkey"), system_id().alias("id"))
    item = F.when(F.col("l_linenumber") == 6, "Z13").when(F.col("l_linenumber") == 7, "Q07").otherwise(
        F.concat(F.lit("Z0"), F.col("l_linenumber").cast("string")))
    sums = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year"), item.alias("ic")).agg(
        F.sum(money("l_quantity")).cast("long").alias("v"))
    two = F.substring(F.col("year").cast("string"), 3, 2)
    record = F.concat("id", "ic", F.lpad(F.col("v").cast("string"), 12, " "), two, two, F.lit("12"))
    return sums.join(ids, "l_suppkey").select("year", record.alias("value"))


def system_id() -> Column:
    return F.concat(F.lpad((F.col("s_nationkey") + 1).cast("string"), 2, "0"), F.col("n_regionkey").cast("string"),
                    F.lpad(F.col("s_suppkey").cast("string"), 11, "0"))


def name_lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Id files: one per year to 1998, then one for the later years."""
    homes = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    public = F.when(F.col("s_acctbal") > 0, F.concat(F.lit("Public "), F.col("s_name"))).otherwise("")
    record = F.concat(system_id(), F.lit(" "), F.rpad("s_name", 85, " "), public)
    later = homes.select(F.rtrim(record).alias("value"))
    first = [y for y in ship_years(spark, sf) if y <= LAST_YEARLY]
    yearly = homes.select(F.rtrim(record).alias("value"), F.explode(F.lit(first).cast("array<int>")).alias("year"))
    return yearly, later


LAST_YEARLY = 1998


def ship_years(spark: SparkSession, sf: str) -> list[int]:
    """The years of the data, as many as there are files."""
    return values_of(table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year")), "year")


def later_years(spark: SparkSession, sf: str) -> list[int]:
    return [y for y in ship_years(spark, sf) if y > LAST_YEARLY]


def plan_id(key: Column) -> Column:
    """Nine characters for a key: its digits in base 36, which is enough for 1e14 keys."""
    return F.lpad(F.conv(key.cast("string"), 10, 36), 9, "0")


def plan_lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """39-character unit records and id records: orders as plans, line numbers 1 to 5
    as member items, the order total as assets in thousands."""
    pid = plan_id(F.col("pid"))

    def record(item: Column, value: Column) -> Column:
        return F.concat(pid, F.rpad(item, 8, " "), F.lpad(value.cast("string"), 15, " "), F.lit("17"), F.lit("16"), F.lit("12"), F.lit("R")).alias("value")

    items = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("pid"), F.col("l_linenumber").alias("k")).agg(
        F.sum(money("l_quantity")).cast("long").alias("v"))
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "pid")
    units = items.select(record(F.concat(F.lit("Z0"), F.col("k").cast("string")), F.col("v"))).unionByName(
        orders.select(record(F.lit("Z81"), F.floor("o_totalprice"))))
    homes = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    kind = F.when(F.col("o_orderstatus") == "F", "0").when(F.col("o_orderstatus") == "O", "1").otherwise("5")
    ids = orders.join(homes, "o_custkey", "left").select(F.concat(
        pid, F.lit(" "), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), kind, F.lit("001"), F.lit("002"), F.lit("000"), F.lit("00"),
        F.lit(" "), F.lit("Plan "), F.col("pid").cast("string")).alias("value"))
    return units, ids


PLAN_UNITS_SQL = """
members AS (SELECT l_orderkey AS k, CAST(sum(l_quantity) FILTER (WHERE l_linenumber = 1) + sum(l_quantity) FILTER (WHERE l_linenumber = 2) AS DOUBLE) AS members,
  CAST(sum(l_quantity) FILTER (WHERE l_linenumber = 3) + sum(l_quantity) FILTER (WHERE l_linenumber = 4) + sum(l_quantity) FILTER (WHERE l_linenumber = 5) AS DOUBLE) AS beneficiaries
  FROM lineitem GROUP BY 1),
sized AS (SELECT to_base(o_orderkey, 36, 9) AS pid, CASE o_orderstatus WHEN 'F' THEN 'State' WHEN 'O' THEN 'County' ELSE 'Schools' END AS ptype,
  'Plan ' || o_orderkey AS uname, 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS stabbr, n_name AS stname, floor(o_totalprice) / 1e6 AS assets,
  members, beneficiaries, members + beneficiaries AS participants
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN members ON k = o_orderkey
  WHERE members + beneficiaries >= 1)
"""
