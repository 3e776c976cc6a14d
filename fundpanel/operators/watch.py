"""Who came, stayed, left and came back between years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Years that fit one bitmap.
MOST_YEARS = 63


def year_bitmaps(df: DataFrame, keys: Sequence[str], system: str, year: str, first: int) -> DataFrame:
    """(keys, system, years): bit k is set where the system has a row in the year first + k.
    Partial bitmaps are merged by ``bit_or``, so rows shrink before the one shuffle, and
    bitmaps of further vintages can be merged in later."""
    at = F.col(year) - first
    bit = F.when((at >= 0) & (at < MOST_YEARS), F.expr(f"shiftleft(1L, CAST({year} - {int(first)} AS INT))")).otherwise(
        F.when(F.col(year).isNotNull(), F.raise_error(F.concat(F.lit(f"outside {first} and the {MOST_YEARS} years from it: "), F.col(year).cast("string")))))
    return df.where(F.col(system).isNotNull()).groupBy(*keys, system).agg(F.bit_or(bit).alias("years")).where("years is not null")


def change_watch(bitmaps: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """(keys, year, present, entered, returned, stayed, left) for every year from first to
    last: systems with a row; those new in it; those back after years without; those
    that were there the year before; those that were there the year before and are not
    now. Only bit operations, and counts by key and year that add up before they move."""
    if not 0 <= last - first < MOST_YEARS:
        raise ValueError(f"{first} to {last} does not fit {MOST_YEARS} years")
    bit = F.explode(F.sequence(F.lit(0), F.lit(last - first))).alias("k")
    rows = bitmaps.select(*keys, "years", bit)
    now = F.expr("(shiftright(years, k) & 1L) = 1")
    before = F.expr("k > 0 AND (shiftright(years, greatest(k - 1, 0)) & 1L) = 1")
    ever = F.expr("(years & (shiftleft(1L, k) - 1L)) <> 0")
    kinds = {"present": now, "entered": now & ~ever, "returned": now & ever & ~before, "stayed": now & before, "left": before & ~now}
    out = rows.select(*keys, (F.col("k") + first).alias("year"), *[c.alias(n) for n, c in kinds.items()])
    return out.groupBy(*keys, "year").agg(*[F.count_if(n).alias(n) for n in kinds])


def survivors(bitmaps: DataFrame, keys: Sequence[str], first: int, a: int, b: int) -> DataFrame:
    """(keys, both, only_a, only_b, gaps): systems of two years, and how many have a row in
    both but not in every year between."""
    at, to = (F.expr(f"(shiftright(years, {y - first}) & 1L) = 1") for y in (a, b))
    span = ((1 << (b - a + 1)) - 1) << (a - first)
    whole = F.expr(f"(years & {span}L) = {span}L")
    return bitmaps.groupBy(*keys).agg(F.count_if(at & to).alias("both"), F.count_if(at & ~to).alias("only_a"),
                                      F.count_if(~at & to).alias("only_b"), F.count_if(at & to & ~whole).alias("gaps"))
