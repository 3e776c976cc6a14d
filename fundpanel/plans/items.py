"""Item files (2004 to 2011): one row per state, item and level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import label, norm_code, pad_code, relabel, title_case, to_number
from ..operators.grid import find_header, named_cell, promote_header, tidy_names
from ..operators.lookup import lookup

# Level codes of these files, and item names to conform.
LEVEL_CODES = [1, 2, 3, 4, 5, 6, 7, 8]
LEVEL_LABELS = ["State-local", "State", "Local", "County", "Municipal", "Township", "Special district",
                "School district"]
ITEM_NAMES = {
    "From State Government": "State Government Contributions",
    "From Local Government": "Local Government Contributions",
    "Earnings On Investment": "Earnings On Investments",
    "Withdrawal": "Withdrawals",
    "Total Cash And Deposits": "Total Cash And Short-Term Investments",
    "Time, Savings Deposits, And Nonfederal Short-Term Investment":
        "Time, Savings Deposits And Nonfederal Short-Term Investments",
    "Other Securities": "Other Nongovernmental Securities",
}


def items_panel(grid: DataFrame, states: DataFrame) -> DataFrame:
    """(year, stabbr, ItemID, ItemName, type, typef, value); the header is the row of
    each file whose third cell names the level."""
    header = tidy_names(find_header(grid, 3, "Level"), {"Amount": "value"}, clean=True)
    rows = promote_header(grid, header, ["StateID", "ItemID", "ItemName", "Level", "value"]).select(
        "year",
        pad_code(norm_code(named_cell("StateID")).cast("string"), 2).alias("StateID"),
        norm_code(named_cell("ItemID")).alias("ItemID"),
        relabel(title_case(named_cell("ItemName")), ITEM_NAMES).alias("ItemName"),
        norm_code(named_cell("Level")).alias("type"),
        to_number(named_cell("value")).alias("value"),
    )
    rows = rows.where(F.col("ItemID").isNotNull())
    rows = rows.withColumn("typef", label(F.col("type"), LEVEL_CODES, LEVEL_LABELS))
    rows = lookup(rows, states, {"StateID": "stcen"}, {"stabbr": "stabbr"})
    return rows.select("year", "stabbr", "ItemID", "ItemName", "type", "typef", "value")
