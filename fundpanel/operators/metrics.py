"""Derived measures of the panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import pct, ratio
from .aggregate import sum_known, sum_strict
from .lookup import lookup
from .reshape import long_to_wide

# Member items of the plan files and their names.
MEMBER_ITEMS = {"Z01": "actives", "Z02": "inactives", "Z03": "retnorm", "Z04": "retdisb", "Z05": "survivors"}


def cash_flow(df: DataFrame) -> DataFrame:
    """Contributions given or else the sum of their parts, external cash flow, and
    each as a percentage of assets."""
    contrib = F.coalesce(F.col("contrib"), F.col("eec") + F.col("erc"))
    df = df.withColumn("contrib", contrib).withColumn("xcf", F.col("contrib") - F.col("expend"))
    return df.withColumns({f"{m}_pct": pct(F.col(m), F.col("assets")) for m in ("contrib", "expend", "xcf")})


def per_capita(df: DataFrame, population: DataFrame, entity: str = "stabbr", value: str = "value") -> DataFrame:
    """Value per head, by (year, entity)."""
    df = lookup(df, population, {"year": "year", entity: entity}, {"pop": "pop"})
    return df.withColumn("valpc", ratio(F.col(value), F.col("pop")))


def real_value(df: DataFrame, deflator: DataFrame, base: int, value: str = "value") -> DataFrame:
    """Value at the prices of the base year, and per head where ``pop`` is known. The
    deflator has one row per year, to which its base is added in place."""
    at_base = F.max(F.when(F.col("year") == base, F.col("value"))).over(Window.partitionBy())
    prices = deflator.select("year", F.col("value").alias("_index"), at_base.alias("_base"))
    out = lookup(df, prices, {"year": "year"}, {"_index": "_index", "_base": "_base"})
    out = out.withColumn("rvalue", ratio(F.col(value) * F.col("_base"), F.col("_index"))).drop("_index", "_base")
    return out.withColumn("rvalpc", ratio(F.col("rvalue"), F.col("pop"))) if "pop" in out.columns else out


def rebased_index(df: DataFrame, entity: Sequence[str], base: int, value: str = "value", year: str = "year") -> DataFrame:
    """Value as a percentage of the entity's own value in the base year.

    Rows are one per entity and year, so an entity is a few rows; a null entity has a
    base too."""
    at_base = F.max(F.when(F.col(year) == base, F.col(value))).over(Window.partitionBy(*entity))
    return df.withColumn("ivalue", pct(F.col(value), at_base))


def share_of(a: str, b: str) -> Column:
    """a as a percentage of a + b."""
    return pct(F.col(a), F.col(a) + F.col(b))


def member_counts(units: DataFrame, plan: str = "pid", code: str = "ic", value: str = "value",
                  more: Mapping[str, str] | None = None) -> DataFrame:
    """Member items across, with beneficiaries, members and participants; a plan
    that lacks an item has null sums. Further items may come along in the same pass."""
    wanted = {**MEMBER_ITEMS, **(more or {})}
    items = units.where(F.col(code).isin(list(wanted)))
    wide = long_to_wide(items, [plan], code, list(wanted), value).withColumnsRenamed(wanted)
    return (
        wide.withColumn("beneficiaries", F.col("retnorm") + F.col("retdisb") + F.col("survivors"))
        .withColumn("members", F.col("actives") + F.col("inactives"))
        .withColumn("participants", F.col("members") + F.col("beneficiaries"))
    )


def small_and_big(plans: DataFrame, plan: str, size: str, limit: float) -> DataFrame:
    """Plans, assets and participants for all, small and big plans, and their share
    of all. Big is what small leaves, whatever the reason, null sizes too. A sum with a
    null is null. One pass, by grouping sets."""
    small = F.coalesce(F.col(size) <= limit, F.lit(False))
    rows = plans.select(F.when(small, "small").otherwise("big").alias("which"), "assets", F.col(size).alias("parts"))
    out = rows.groupingSets([[F.col("which")], []], "which").agg(
        F.count(F.lit(1)).cast("double").alias("n"), sum_strict(F.col("assets")).alias("assets"), sum_strict(F.col("parts")).alias("parts"))
    out = out.withColumn("which", F.coalesce("which", F.lit("all")))
    whole = Window.partitionBy()  # at most three rows
    return out.withColumns({
        f"{m}_share": ratio(F.col(m), F.max(F.when(F.col("which") == "all", F.col(m))).over(whole))
        for m in ("n", "assets", "parts")
    })


def not_small(plans: DataFrame, plan: str, size: str, limit: float) -> DataFrame:
    """The plans that are not among the small ones. The list is of the same table, one
    row per plan, so the anti join is its null-safe complement; against a list from
    elsewhere use ``drop_known``."""
    return plans.where(~F.coalesce(F.col(size) <= limit, F.lit(False)))


def rank_states(df: DataFrame, metric: str, top: int | None = None) -> DataFrame:
    """Descending order of a metric, nulls last."""
    out = df.orderBy(F.desc_nulls_last(metric))
    return out if top is None else out.limit(top)


def compare_sources(a: DataFrame, b: DataFrame, keys: Sequence[str], names: Mapping[str, str], value: str) -> DataFrame:
    """One measure from two sources side by side, with a as a percentage of b."""
    (na, nb) = names.values()
    left = a.groupBy(*keys).agg(sum_known(F.col(value)).alias(na))
    right = b.groupBy(*keys).agg(sum_known(F.col(value)).alias(nb))
    return left.join(right, list(keys), "full").withColumn("pct", pct(F.col(na), F.col(nb)))


def state_table(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Row count and strict sums per state, most plans first."""
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[sum_strict(F.col(c)).alias(o) for o, c in measures.items()]
    )
    return out.orderBy(F.desc("n"), *keys)
