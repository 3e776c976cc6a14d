"""Plan-level unit files: 35-character records (2007 to 2013) and the 39-character
ones of 2017, with their id files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import display_name, drop_chars, label, rescale
from ..operators.combine import replicate, stack
from ..operators.grid import trim_all
from ..operators.lookup import lookup
from ..operators.metrics import member_counts
from ..sources.fixed_width import by_positions, by_widths, parse_fixed, parse_ragged

# Record layouts, government types and the total-assets item.
UNIT35 = by_widths([14, 3, 12, 2, 2, 2], ["id", "ic", "value", "syear", "dyear", "source"],
                   ["string", "string", "double", "int", "int", "string"])
UNIT35_SPLIT = by_widths(
    [2, 1, 3, 3, 3, 2, 3, 12, 2, 2, 2],
    ["stcode", "admin", "cocode", "id", "suppcode", "subcode", "ic", "value", "syear", "dyear", "source"],
    ["string", "int", "string", "string", "string", "string", "string", "double", "int", "int", "string"])
UNIT35_NO_SURVEY_YEAR = by_widths([14, 3, 12, -2, 2, 2], ["govid", "ic", "value", "datayear", "source"])
NAMES_2007 = [("id", 1, 14), ("idname", 16, 100), ("pubname", 101, 200)]
NAMES_2012 = [("id", 1, 14), ("idname", 16, 100), ("pubname", 101, None)]
UNIT39 = by_positions([
    ("pid", 1, 9), ("ic", 10, 17), ("value", 18, 32, "double"), ("survyear", 33, 34), ("datayear", 35, 36),
    ("source", 37, 38), ("reptimpflag", 39, 39)])
IDS2017 = by_positions([
    ("pid", 1, 9), ("stcode", 11, 12), ("type", 13, 13, "int"), ("cntycode", 14, 16), ("unitid", 17, 19),
    ("suppcode", 20, 22), ("subcode", 23, 24), ("uname", 26, 110)])
GOV_TYPES = [0, 1, 2, 3, 4, 5]
GOV_LABELS = ["State", "County", "City", "Municipal/town", "Special District", "School"]
PLAN_LABELS = ["State", "County", "City", "Municipalities and Townships", "Special Districts", "Schools"]
TOTAL_ASSETS = "Z81"
CASH_AND_SECURITIES = ["X21", "X30", "Z77", "Z78", "X42", "X44", "X47"]
OTHER_INVESTMENTS = ["X46", "X47"]
INVESTMENTS = list(dict.fromkeys(CASH_AND_SECURITIES + OTHER_INVESTMENTS))


def system_names(yearly: DataFrame, later: DataFrame, later_years=(2012, 2013)) -> DataFrame:
    """(year, id, idname, pubname) from id lines: ``yearly`` has one file per year,
    ``later`` one messy file for several. A blank public name is the id name."""
    first = parse_ragged(yearly, NAMES_2007)
    last = replicate(parse_ragged(later, NAMES_2012), later_years)
    names = trim_all(stack(first, last).select("year", "id", "idname", "pubname"))
    return names.withColumn("pubname", display_name(F.col("pubname"), F.col("idname")))


def unit_rows(lines: DataFrame, names: DataFrame, codes: DataFrame, states: DataFrame) -> DataFrame:
    """Unit records of several years with state, item and system names. The names
    table has one row per system and year, which keeps the join from adding rows."""
    rows = parse_fixed(lines, UNIT35).withColumn("type", F.substring("id", 3, 1).try_cast("int"))
    rows = rows.withColumn("stcen", F.substring("id", 1, 2)).withColumn(
        "typef", label(F.col("type"), GOV_TYPES, GOV_LABELS))
    rows = lookup(rows, states, {"stcen": "stcen"}, {"stabbr": "stabbr"})
    rows = lookup(rows, codes, {"ic": "ic"}, {"icdesc": "icf"})
    rows = lookup(rows, names, {"id": "id", "year": "year"}, {"idname": "idname", "pubname": "pubname"})
    return rows.select("year", "id", "stabbr", "type", "typef", "ic", "icf", "value", "syear", "dyear", "source",
                       "idname", "pubname")


def units_2017(lines: DataFrame) -> DataFrame:
    return parse_fixed(lines, UNIT39)


def ids_2017(lines: DataFrame) -> DataFrame:
    rows = parse_fixed(lines, IDS2017)
    return rows.withColumn("ptype", label(F.col("type"), GOV_TYPES, PLAN_LABELS))


def plan_assets(units: DataFrame, ids: DataFrame, states: DataFrame) -> DataFrame:
    """Total assets of each plan in billions, with its name, type and state."""
    rows = units.where(F.col("ic") == TOTAL_ASSETS).select("pid", rescale(F.col("value"), 1e6).alias("assets"))
    return _places(rows, ids, states).select("pid", "ptype", "uname", "stabbr", "stname", "assets")


def _places(rows: DataFrame, ids: DataFrame, states: DataFrame) -> DataFrame:
    rows = lookup(rows, ids, {"pid": "pid"}, ["stcode", "uname", "ptype"])
    return lookup(rows, states, {"stcode": "stcen"}, {"stabbr": "stabbr", "stname": "stname"})


def plans_with_members(units: DataFrame, ids: DataFrame, states: DataFrame, least: float = 1) -> DataFrame:
    """Assets beside member counts, for plans with at least so many participants. All
    items of a plan come from one pivot of the units."""
    wide = member_counts(units, more={TOTAL_ASSETS: "value"}).where((F.col("participants") >= least) & F.col("value").isNotNull())
    plans = wide.select("pid", rescale(F.col("value"), 1e6).alias("assets"), "members", "beneficiaries", "participants")
    plans = _places(plans, ids, states)
    return plans.select("pid", "ptype", "uname", "stabbr", "stname", "assets", "members", "beneficiaries", "participants")


def item_codes(sheet: DataFrame, supplement: DataFrame) -> DataFrame:
    """Item codes with their description: marks and blanks removed, header and empty
    rows dropped, and the codes the sheet lacks added. A code of both keeps the sheet's."""
    own = sheet.where(F.col("ic").isNotNull() & F.col("icdesc").isNotNull() & (F.col("ic") != "Item code"))
    own = own.select(F.trim("ic").alias("ic"), F.trim(drop_chars(F.col("icdesc"), "*'")).alias("icdesc"))
    more = supplement.select("ic", "icdesc").join(own, "ic", "left_anti")
    return own.unionByName(more)


# Item codes that occur in the unit files but not in the code sheet.
SUPPLEMENT = """
Z13, Retirement Benefits
Z14, Disability Benefits
Z15, Survivor Benefits
Z16, Other Benefits
"""
