"""Coverage, gaps and agreement of the sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from .aggregate import count_by, sum_known
from .combine import stack


def coverage(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Rows and known values per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count(value).alias("known"))


def missing_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows per key where a measure is missing and where it is there."""
    return count_by(df, key, F.col(value).isNull().alias("missing"))


def reconcile(units: DataFrame, published: DataFrame, keys: Sequence[str], value: str = "value",
              tolerance: float = 0.0005, doubtful: float = 0.003) -> DataFrame:
    """Totals of the units beside the published ones, with a verdict.

    The units are summed per key before the join. ``yes`` is a difference within
    the tolerance, ``undecided`` one where a total is missing, the units exceed the
    published total or lack no more than the doubtful share of it, ``no`` the rest."""
    ours = units.groupBy(*keys).agg(sum_known(F.col(value)).alias("unit_total"))
    theirs = published.groupBy(*keys).agg(sum_known(F.col(value)).alias("published_total"))
    both = ours.join(theirs, list(keys), "full")
    gap = ratio(F.col("unit_total") - F.col("published_total"), F.col("published_total"))
    return both.withColumn("gap", gap).withColumn(
        "use_units",
        F.when(F.abs("gap") <= tolerance, "yes").when(F.col("gap").isNull() | (F.col("gap") > 0) | (F.abs("gap") <= doubtful), "undecided")
        .otherwise("no"),
    )


def findings(df: DataFrame, rules: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """Every row that breaks a rule, once per rule. One scan for all rules."""
    hits = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return df.select(*keep, F.explode(hits).alias("finding"))


def code_as_year(df: DataFrame, column: str, code: str, keys: Sequence[str]) -> DataFrame:
    """Rows per plan that hold a code where a year is expected."""
    return count_by(df.where(F.col(column) == code), *keys)


def systems(df: DataFrame, keys: Sequence[str], system: str, name: str = "systems") -> DataFrame:
    """Number of different systems per key; rows shrink to distinct pairs first."""
    return df.select(*keys, system).distinct().groupBy(*keys).agg(F.count(system).alias(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys met more than once, which a published panel must not have."""
    return count_by(df, *keys).where(F.col("n") > 1)


def source_years(sources: Mapping[str, DataFrame], year: str = "year") -> DataFrame:
    """First and last year and row count of each source."""
    each = [
        df.agg(F.min(year).alias("first"), F.max(year).alias("last"), F.count(F.lit(1)).alias("rows"))
        .withColumn("source", F.lit(n))
        for n, df in sources.items()
    ]
    return stack(*each)
