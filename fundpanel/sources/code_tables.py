"""Code tables written inline; each has a fixed, small number of rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Postal abbreviation and name, in the alphabetical order of names
# that also numbers the survey's own state codes (01 to 51); 00 is the nation.
STATE_NAMES = """
US United States
AL Alabama
AK Alaska
AZ Arizona
AR Arkansas
CA California
CO Colorado
CT Connecticut
DE Delaware
DC District of Columbia
FL Florida
GA Georgia
HI Hawaii
ID Idaho
IL Illinois
IN Indiana
IA Iowa
KS Kansas
KY Kentucky
LA Louisiana
ME Maine
MD Maryland
MA Massachusetts
MI Michigan
MN Minnesota
MS Mississippi
MO Missouri
MT Montana
NE Nebraska
NV Nevada
NH New Hampshire
NJ New Jersey
NM New Mexico
NY New York
NC North Carolina
ND North Dakota
OH Ohio
OK Oklahoma
OR Oregon
PA Pennsylvania
RI Rhode Island
SC South Carolina
SD South Dakota
TN Tennessee
TX Texas
UT Utah
VT Vermont
VA Virginia
WA Washington
WV West Virginia
WI Wisconsin
WY Wyoming
"""


def code_table(spark: SparkSession, rows: str | Sequence[Sequence], names: Sequence[str]) -> DataFrame:
    """Inline table as a local relation, whose exact size lets Catalyst broadcast it.

    Text rows are comma separated; outer blanks and blank lines go."""
    if isinstance(rows, str):
        rows = [[c.strip() for c in r.split(",")] for r in rows.splitlines() if r.strip()]
    columns = list(zip(*rows, strict=True))
    return spark.createDataFrame(pa.table({n: list(c) for n, c in zip(names, columns, strict=True)}))


def states(spark: SparkSession) -> DataFrame:
    """(stabbr, stname, stcen) for the states, the capital district and the nation."""
    lines = [r.split(" ", 1) for r in STATE_NAMES.splitlines() if r]
    return code_table(spark, [(a, n, f"{i:02d}") for i, (a, n) in enumerate(lines)],
                      ["stabbr", "stname", "stcen"])
