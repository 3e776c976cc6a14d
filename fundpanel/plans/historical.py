"""Finance and membership sheets of the historical data base (1957 to 1992)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import label, norm_code, override_code, relabel_regex, sentinel_null, to_number, whole_number
from ..operators.combine import stack_tagged
from ..operators.grid import cells_to_long, drop_empty, header_at, named_cell, promote_header, tidy_names
from ..operators.lookup import lookup
from ..operators.reshape import long_to_wide_sum

# Place and names of the id columns, and the administration codes.
HEADER_ROW = 12
STADMIN_TOKEN = "SAS VAR NAME>"
ID_COLUMNS = ["sortcode", "id", "state", "fips", "pasis", "stadmin", "type", "year"]
ADMIN_CODES = ["0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "x"]
ADMIN_LABELS = ["National total", "State-local total", "State", "Local", "Fed govt", "County", "Municipal",
                "Township", "Special district", "School district", "Other"]
NATIONAL = {"52": "NATL"}


def historical_long(grid: DataFrame, states: DataFrame, header_row: int = HEADER_ROW) -> DataFrame:
    """(year, stabbr, admin, adminf, variable, value) of one sheet, levels 1 to 3."""
    header = tidy_names(header_at(grid, header_row), {STADMIN_TOKEN: "stadmin"}, lower=True)
    rows = promote_header(grid, header, ["year", "type", "id", "stadmin"], names=True).select(
        whole_number(named_cell("year")).alias("year"),
        norm_code(named_cell("type")).alias("admin"),
        F.substring(F.trim(named_cell("id")), 1, 2).alias("stcen"),
        F.trim(named_cell("stadmin")).alias("stadmin"),
        "names", "cells",
    )
    rows = rows.where(F.col("admin").isin(1, 2, 3) & F.col("year").isNotNull())
    rows = lookup(rows, states, {"stcen": "stcen"}, {"stabbr": "stabbr"})
    rows = rows.withColumn("stabbr", override_code(F.col("stabbr"), F.col("stcen"), NATIONAL))
    rows = rows.withColumn("adminf", label(F.col("admin").cast("string"), ADMIN_CODES, ADMIN_LABELS))
    long = cells_to_long(rows, ["year", "stabbr", "admin", "adminf", "stadmin"], ID_COLUMNS)
    return long.withColumn("value", to_number(sentinel_null(F.col("value"))))


def historical_panel(finance: DataFrame, membership: DataFrame, states: DataFrame,
                     header_row: int = HEADER_ROW) -> DataFrame:
    """Both sheets, tagged by source."""
    return stack_tagged({
        "finance": historical_long(finance, states, header_row).drop("stadmin"),
        "membership": historical_long(membership, states, header_row).drop("stadmin"),
    })


# How the sheet's own level text is reduced.
STADMIN_RULES = [("Total", "Total"), ("State-Admin", "State"), ("Local-Admin", "Local")]


def historical_wide(finance: DataFrame, membership: DataFrame, states: DataFrame, finance_vars: Sequence[str],
                    membership_vars: Sequence[str], header_row: int = HEADER_ROW) -> DataFrame:
    """Measures of both sheets across, for state, year and level met in both; zeros
    count as missing and missing cells become zero."""
    keys = ["stabbr", "year", "admin"]

    def wide(grid: DataFrame, variables: Sequence[str]) -> DataFrame:
        long = drop_empty(historical_long(grid, states, header_row), zero=True, sentinel=-11111.0)
        long = long.withColumn("admin", relabel_regex(F.col("stadmin"), STADMIN_RULES))
        # a place and year that has other measures only has zeros in these
        wanted = F.col("variable").isin(list(variables))
        long = long.withColumns({"value": F.when(wanted, F.col("value")), "variable": F.when(wanted, F.col("variable")).otherwise(variables[0])})
        return long_to_wide_sum(long, keys, "variable", variables)

    return wide(finance, finance_vars).join(wide(membership, membership_vars), keys)
