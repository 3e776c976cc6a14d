"""Published panels: the unified one over all eras, and two single-source ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import label, ordinal, rescale, to_number
from ..operators.combine import served_by, stack
from ..operators.lookup import lookup, map_variables
from ..operators.reshape import wide_to_long
from ..sources.code_tables import code_table

# Levels of the unified panel, and the native name of each unified
# variable in the historical (df1), table (df2), item (df3) and older download
# (df4) sources.
LEVELS = [1, 2, 3]
LEVEL_LABELS = ["State-local", "State", "Local"]
TABLE_LEVELS = ["Total", "State", "Local"]
CROSSWALK = """
nsystems, df1, systems
nsystems, df2, nsystems
nsystems, df3, 32
nsystems, df4, C036
members, df1, totmemb
members, df2, totmem
members, df3, 28
members, df4, C038
actives, df1, active
actives, df2, actives
actives, df3, 29
actives, df4, C039
inactives, df1, inactive
inactives, df2, inactives
inactives, df3, 30
inactives, df4, C040
beneficiaries, df1, totbenef
beneficiaries, df2, beneficiaries
beneficiaries, df3, 31
beneficiaries, df4, C042
payroll, df4, C044
eec, df1, totempcontrb
eec, df2, eec
eec, df3, 2
eec, df4, C003
erc, df1, totgovcontrb
erc, df2, erc
erc, df3, 3
erc, df4, C004
erc.sg, df1, contrbstate
erc.sg, df2, erc.sg
erc.sg, df3, 4
erc.sg, df4, C005
erc.lg, df1, contrblocal
erc.lg, df2, erc.lg
erc.lg, df3, 5
erc.lg, df4, C006
invinc, df1, totalearns
invinc, df2, invinc
invinc, df3, 6
invinc, df4, C008
totexpend, df1, toterexp
totexpend, df2, totpay
totexpend, df3, 7
totexpend, df4, C010
benefits, df1, benefits
benefits, df2, benefits
benefits, df3, 8
benefits, df4, C011
assets, df1, totercashsec
assets, df2, assets
assets, df3, 11
assets, df4, C015
"""


class Source(NamedTuple):
    """A source of the unified panel: its key in the crosswalk, its native variable
    column (None when the names are unified already) and the years it serves."""

    file: str
    df: DataFrame
    native: str | None = "variable"
    first: int | None = None
    last: int | None = None


def crosswalk(spark: SparkSession) -> DataFrame:
    return code_table(spark, CROSSWALK, ["uvname", "file", "fvalue"])


def unified_panel(sources: Sequence[Source], walk: DataFrame, entity: str = "stabbr") -> DataFrame:
    """(year, entity, admin, adminf, variable, value): each source limited to its
    years and to levels 1 to 3, renamed, stacked and labelled. No shuffle; the
    caller sorts if an order is wanted."""
    parts = []
    for s in sources:
        rows = s.df.where(F.col("admin").isin(LEVELS))
        if s.first is not None:
            rows = rows.where(F.col("year") >= s.first)
        if s.last is not None:
            rows = rows.where(F.col("year") <= s.last)
        if s.native is None:
            rows = rows.withColumnRenamed("vname", "variable")
        else:
            rows = map_variables(rows, walk, s.file, s.native)
        parts.append(rows.select(F.col("year").cast("int"), entity, F.col("admin").cast("int"), "variable", "value"))
    panel = stack(*parts).withColumn("adminf", label(F.col("admin"), LEVELS, LEVEL_LABELS))
    return panel.select("year", entity, "admin", "adminf", "variable", "value")


def unified_from_tagged(df: DataFrame, walk: DataFrame, precedence, entity: str = "stabbr") -> DataFrame:
    """The same from one table whose ``file`` column names the source of each row:
    years by precedence, then one join with the whole crosswalk."""
    rows = df.where(F.col("admin").isin(LEVELS) & served_by(precedence, "file"))
    names = walk.select("file", F.col("fvalue").alias("variable"), "uvname")
    rows = rows.join(names, ["file", "variable"]).withColumn("adminf", label(F.col("admin"), LEVELS, LEVEL_LABELS))
    return rows.select(F.col("year").cast("int").alias("year"), entity, F.col("admin").cast("int").alias("admin"), "adminf",
                       F.col("uvname").alias("variable"), "value")


def census_panel(historical: DataFrame, tables: DataFrame, items: DataFrame, survey: DataFrame,
                 walk: DataFrame) -> DataFrame:
    """The unified panel of the four eras; the historical source ends before 1993."""
    tables = tables.withColumn("admin", ordinal(F.col("admin"), TABLE_LEVELS))
    items = items.withColumnRenamed("type", "admin")
    return unified_panel([
        Source("df1", historical, last=1992),
        Source("df2", tables),
        Source("df3", items, native="ItemID"),
        Source("df5", survey, native=None),
    ], walk).orderBy("stabbr", "admin", "adminf", "variable", "year")


# The eight columns of the yearly balance table, by position.
BALANCE_COLUMNS = ["year", "stname", "assets", "liabilities", "ufl", "fr", "ufl.gdp", "ufl.staterev"]


def balance_panel(table: DataFrame, states: DataFrame, unit: str | None = None) -> DataFrame:
    """(stabbr, vname, vdesc, year, value[, unit]) from the eight-column table; the
    column's own header becomes the description. Amounts are not rescaled."""
    described = dict(zip(BALANCE_COLUMNS, table.columns, strict=True))
    df = table.toDF(*BALANCE_COLUMNS)
    text = df.select("year", "stname", *[F.col(f"`{c}`").cast("string").alias(c) for c in BALANCE_COLUMNS[2:]])
    long = wide_to_long(text, ["year", "stname"], variable="vname", type="string")
    long = long.withColumn("value", to_number(F.col("value"))).withColumn(
        "vdesc", label(F.col("vname"), list(described), list(described.values())))
    long = lookup(long, states, {"stname": "stname"}, {"stabbr": "stabbr"})
    out = long.select("stabbr", "vname", "vdesc", F.col("year").cast("int").alias("year"), "value")
    return out if unit is None else out.withColumn("unit", F.lit(unit))


def yearly_sheets_panel(sheets: Mapping[str, DataFrame], states: DataFrame) -> DataFrame:
    """(stabbr, vname, year, value) from sheets with one column per year after
    ``fips`` and ``stname``; thousands become millions, empty cells drop."""
    long = stack(*[
        wide_to_long(sheet.drop("fips"), ["stname"], variable="year").withColumn("vname", F.lit(v))
        for v, sheet in sheets.items()
    ]).where(F.col("value").isNotNull())
    long = lookup(long, states, {"stname": "stname"}, {"stabbr": "stabbr"})
    return long.select("stabbr", "vname", F.col("year").cast("int").alias("year"),
                       rescale(F.col("value"), 1000).alias("value"))
