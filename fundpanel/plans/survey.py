"""Survey summary sheets (2012 on), one group of columns per state, and the older
download with one column per level and measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import label, part, to_number
from ..operators.grid import expand_grouped_header, header_at, named_cell, promote_header, zero_as_missing
from ..operators.lookup import lookup
from ..operators.reshape import wide_to_long

# Columns per state and what they hold, by vintage (19, 29 and 39
# are the sampling errors of levels 1 to 3), the two header repairs (counted
# without the text column), and the variables whose zeros mean missing.
PLAIN = [1, 2, 3]
WITH_CV = [1, 19, 2, 29, 3, 39]
LAYOUTS = [
    # year, levels, drop header name at, set header name at, set to
    (2012, PLAIN, None, None, None),
    (2013, WITH_CV, 7, None, None),
    (2014, WITH_CV, None, 1, "United States"),
    (2015, WITH_CV, None, None, None),
    (2016, WITH_CV, None, None, None),
    (2017, PLAIN, None, None, None),
]
ZERO_IS_MISSING = ["payroll", "penob"]


def layout_table(spark: SparkSession, layouts=LAYOUTS) -> DataFrame:
    values = ", ".join(
        f"({y}, array({', '.join(map(str, lv))}), {_sql(d)}, {_sql(s)}, {_sql(t)})" for y, lv, d, s, t in layouts
    )
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t(year, levels, drop_at, set_at, set_to)")
    return table.withColumns({c: F.col(c).cast("int") for c in ("drop_at", "set_at")}).withColumn(
        "set_to", F.col("set_to").cast("string"))


def _sql(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


def variable_crosswalk(wide: DataFrame) -> DataFrame:
    """Crosswalk with one column per year (``year2012`` and so on) to rows."""
    long = wide_to_long(wide, ["vname"], variable="year", value="vartext", type="string")
    return long.select(F.substring("year", 5, 99).cast("int").alias("year"), "vartext", "vname").where(
        F.col("vname").isNotNull() & F.col("vartext").isNotNull())


def survey_panel(grid: DataFrame, crosswalk: DataFrame, layouts: DataFrame, states: DataFrame,
                 header_row: int = 1) -> DataFrame:
    """(stabbr, year, admin, vname, value). One plan for all layouts: the layout of
    a vintage is a row of ``layouts`` beside its header, on which the entity and level
    of every column are worked out once per file."""
    years = grid.where(F.col("row_no") == header_row).groupBy("file").agg(F.min("year").alias("year"))
    header = header_at(grid, header_row).join(years, "file").join(layouts, "year").drop("year")
    width = F.size("levels")
    names = F.slice("names", 2, F.size("names") - 1)
    entities = expand_grouped_header(names, width, F.col("drop_at"), F.col("set_at"), F.col("set_to"))
    columns = F.transform(entities, lambda e, i: F.struct(e.alias("entity"), F.get("levels", (i % width).cast("int")).alias("level")))
    header = header.select("file", "header_row", columns.alias("columns"))
    rows = promote_header(grid, header).select(
        "year", F.trim(F.get("cells", F.lit(0))).alias("vartext"),
        F.explode(F.arrays_zip("columns", F.slice("cells", 2, F.size("cells") - 1).alias("cell"))).alias("v"),
    ).select(
        "year", "vartext", F.col("v.columns.entity").alias("stname"), F.col("v.columns.level").alias("admin"),
        to_number(F.col("v.cell")).alias("value"),
    )
    rows = rows.where(F.col("admin").isin(1, 2, 3) & F.col("value").isNotNull())
    rows = zero_as_missing(rows.join(crosswalk, ["year", "vartext"]), ZERO_IS_MISSING, "vname")
    rows = lookup(rows, states, {"stname": "stname"}, {"stabbr": "stabbr"})
    return rows.select("stabbr", "year", "admin", "vname", "value")


# Level digits of the older download and its sampling-error columns.
AFF_LEVELS = ["0", "1", "2"]
AFF_LABELS = ["Total", "State", "Local"]
AFF_CV = ["lvl0b", "lvl2a"]
AFF_IDS = ["GEO.id", "GEO.id2", "GEO.display-label"]


def aff_panel(grid: DataFrame, states: DataFrame) -> DataFrame:
    """(stabbr, admin, col, description, year, value); row 1 names level and
    measure, row 2 describes them."""
    texts = header_at(grid, 2).select("file", F.col("names").alias("texts"))
    header = header_at(grid, 1).join(texts, "file")
    rows = promote_header(grid, header, [AFF_IDS[2]], names=True).where(F.col("row_no") > 2)
    rows = rows.withColumn("stname", named_cell(AFF_IDS[2])).select(
        "year", "stname", F.explode(F.arrays_zip("names", "texts", "cells")).alias("v"))
    rows = rows.where(~F.col("v.names").isin(AFF_IDS)).select(
        "year", "stname", part(F.col("v.names"), "_", 1).alias("lvl"), part(F.col("v.names"), "_", 2).alias("col"),
        F.trim(part(F.col("v.texts"), ";", 2)).alias("description"), to_number(F.col("v.cells")).alias("value"))
    rows = rows.where(~F.col("lvl").isin(AFF_CV)).withColumn(
        "admin", label(F.substring("lvl", 4, 1), AFF_LEVELS, AFF_LABELS))
    rows = lookup(rows, states, {"stname": "stname"}, {"stabbr": "stabbr"}).where(F.col("stabbr").isNotNull())
    return rows.select("stabbr", "admin", "col", "description", "year", "value")
