"""Yearly files whose name and layout change by vintage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import year_from_name


def tag_vintage(df: DataFrame) -> DataFrame:
    """Add ``year`` and ``source_file`` from the file each row was read from."""
    name = F.col("_metadata.file_name")
    return df.select("*", year_from_name(name).alias("year"), name.alias("source_file"))


def read_vintages(read: Callable[..., DataFrame], paths: Sequence[str], **options) -> DataFrame:
    """All yearly files of one layout in one scan, tagged by year."""
    return tag_vintage(read(list(paths), **options))


def layout_for(year: int, rules: Sequence[tuple[int, int, str]]) -> str:
    """File-name pattern or layout of a vintage, from (first year, last year, rule) rows."""
    for first, last, rule in rules:
        if first <= year <= last:
            return rule.format(year=year, yy=f"{year % 100:02d}")
    raise ValueError(f"no rule for the files of {year}")


# Names of the yearly files.
UNIT_FILES = [
    (1993, 2002, "{yy}ret35.txt"),
    (2003, 2005, "{year}ret35noimputes.txt"),
    (2006, 2006, "{year}ret35imputes.txt"),
    (2007, 2013, "{year}indiv_unit_reported_data.txt"),
]
TABLE_FILES = [(1993, 2002, "ret{yy}t"), (2003, 2003, "{year}Ret0")]
ITEM_FILES = [(2004, 2011, "{year}retest_data")]
SURVEY_FILES = [(2012, 2016, "{year}ASPPSummary"), (2017, 2017, "{year}asppsummary")]
