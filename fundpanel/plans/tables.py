"""State tables 2 to 5 (1993 to 2003), sheets with indented level rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import relabel_regex, to_number
from ..operators.combine import stack
from ..operators.grid import context_fill, slice_from_marker
from ..operators.lookup import lookup
from ..operators.reshape import wide_to_long

# Measures by position in each table, level rows and their distance
# from the row that names the state, and the level names of table 5.
TABLE_MEASURES = {
    2: ["totrev", "eec", "erc", "erc.sg", "erc.lg", "invinc"],
    3: ["totpay", "benefits", "withdraw", "otherpay"],
    4: ["assets"],
    5: ["nsystems", "totmem", "actives", "inactives", "beneficiaries"],
}
LEVEL_ROWS = {"State": 1, "Local": 2}
MARKER = "United States"
LEVEL_RULES = [
    ("State", "State"), ("Local", "Local"), ("Municipal", "Municipality"), ("Count", "County"),
    ("School", "School district"), ("Special", "Special district"), ("Town", "Township"),
]


def _measures(grid: DataFrame, names: Sequence[str]) -> DataFrame:
    """Label and measures by position; what lies further right is not read."""
    return grid.select(
        "file", "row_no", "year", F.trim(F.get("cells", F.lit(0))).alias("label"),
        *[to_number(F.get("cells", F.lit(i))).alias(n) for i, n in enumerate(names, start=1)],
    )


def level_table(grid: DataFrame, names: Sequence[str], states: DataFrame) -> DataFrame:
    """Tables 2 to 4: (stabbr, admin, year, variable, value)."""
    rows = context_fill(_measures(grid, names), "label", LEVEL_ROWS, "stname", "admin")
    rows = lookup(rows, states, {"stname": "stname"}, {"stabbr": "stabbr"}).where(F.col("stabbr").isNotNull())
    return wide_to_long(rows.select("stabbr", "admin", "year", *names), ["stabbr", "admin", "year"], names)


def membership_table(grid: DataFrame, names: Sequence[str], states: DataFrame) -> DataFrame:
    """Table 5: rows from the first marker on; levels are named for the nation only."""
    rows = slice_from_marker(_measures(grid, names), "label", MARKER)
    rows = lookup(rows, states, {"label": "stname"}, {"stabbr": "stabbr", "stname": "stname"})
    level = F.when(F.col("stname").isNotNull(), F.lit("Total")).otherwise(
        relabel_regex(F.col("label"), LEVEL_RULES))
    rows = rows.withColumn("admin", level).withColumn("stname", F.coalesce("stname", F.lit(MARKER)))
    rows = lookup(rows, states, {"stname": "stname"}, {"stabbr": "stabbr"})
    return wide_to_long(rows.select("stabbr", "admin", "year", *names), ["stabbr", "admin", "year"], names)


def tables_panel(tables: dict[int, DataFrame], states: DataFrame) -> DataFrame:
    """All tables stacked; each grid carries the year of its file."""
    return stack(*[
        (membership_table if t == 5 else level_table)(grid, TABLE_MEASURES[t], states) for t, grid in tables.items()
    ])
