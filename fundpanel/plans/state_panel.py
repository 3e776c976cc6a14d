"""Unit items rolled up to states, one panel over three sources, and what is
derived from it per head and in real terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fold_key, label
from ..operators.aggregate import add_totals, exact_sum, sum_known
from ..operators.combine import served_by, stack
from ..operators.lookup import lookup, recipe_rows
from ..operators.metrics import cash_flow, per_capita, real_value, share_of
from ..operators.reshape import long_to_wide, long_to_wide_sum, wide_to_long

# Which source serves which years, and the level labels.
PRECEDENCE = [("sshistdb", None, 2002), ("ssxl", 2004, 2006), ("sysyearvar", 2007, None)]
LEVELS = [1, 2, 3]
LEVEL_LABELS = ["State-local total", "State", "Local"]
NATION = {"stabbr": "US", "id": "US Total", "pubname": "US Total"}


def recipe_rollup(units: DataFrame, recipe: DataFrame) -> DataFrame:
    """(year, id, stabbr, type, pubname, variable, value): recipe variables of each
    system, and of the nation. Facts shrink to system and item before the recipe
    repeats them."""
    keys = ["year", "id", "stabbr", "type", "pubname"]
    facts = add_totals(units.withColumn("value", F.col("value").cast("double")), [*keys, "ic"], NATION, ["value"])
    out = recipe_rows(facts, recipe, "ic").groupBy(*keys, "variable").agg(sum_known(F.col("value")).alias("value"))
    return out


def levels_from_systems(systems: DataFrame) -> DataFrame:
    """(stabbr, year, type, vname, value): level 2 is the state's own systems, level
    3 all others, level 1 their sum. Rows without a state drop."""
    type_ = F.when(F.col("type").isNull(), None).when(F.col("type") == 0, 2).otherwise(3)
    rows = systems.where(F.col("stabbr").isNotNull()).select(
        "stabbr", "year", type_.alias("type"), F.col("variable").alias("vname"), F.col("value").cast("double").alias("value"))
    return add_totals(rows, ["stabbr", "year", "type", "vname"], {"type": 1}, ["value"])


def rename_by(df: DataFrame, names: DataFrame, native: str, name_column: str, drop_null_value: bool = False) -> DataFrame:
    """Native variable names to ``vname`` by a name table, in any case; unmapped drop."""
    table = names.select(fold_key(F.col(name_column).cast("string")).alias("_k"), "vname")
    out = lookup(df.withColumn("_k", fold_key(F.col(native).cast("string"))), table, {"_k": "_k"}, {"vname": "vname"})
    out = out.drop("_k", native).where(F.col("vname").isNotNull())
    return out.where(F.col("value").isNotNull()) if drop_null_value else out


def state_panel(historical: DataFrame, items: DataFrame, systems: DataFrame, names: DataFrame,
                precedence=PRECEDENCE) -> DataFrame:
    """(year, stabbr, type, typef, vname, value, source) with one source per year."""
    df1 = rename_by(historical.where(F.col("type").isin(LEVELS)), names, "variable", "sasvarname", True)
    df2 = rename_by(items.where(F.col("type").isin(LEVELS)), names, "ItemID", "itemnumber")
    df3 = levels_from_systems(systems)
    parts = [df.withColumn("source", F.lit(s)) for s, df in (("sshistdb", df1), ("ssxl", df2), ("sysyearvar", df3))]
    stacked = stack(*[p.where(served_by(precedence)) for p in parts])
    return stacked.withColumn("typef", label(F.col("type"), LEVELS, LEVEL_LABELS)).select(
        "year", "stabbr", "type", "typef", "vname", "value", "source")


def cash_flow_panel(panel: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Panel widened, contributions and cash flow derived, and made long again."""
    keys = ["year", "stabbr", "type", "typef", "source"]
    return wide_to_long(cash_flow(long_to_wide(panel, keys, "vname", variables)), keys)


def real_per_capita(panel: DataFrame, population: DataFrame, deflator: DataFrame, base: int = 2014) -> DataFrame:
    """Panel with value per head, real value and real value per head."""
    return real_value(per_capita(panel, population), deflator, base)


def rank_by_real(panel: DataFrame, year: int, variables: Sequence[str], by: str) -> DataFrame:
    """States in one year with real values per head across, highest first."""
    rows = panel.where((F.col("year") == year) & (F.col("type") == 1) & F.col("variable").isin(list(variables)))
    wide = long_to_wide(rows, ["stabbr", "year", "type"], "variable", variables, "rvalpc")
    return wide.orderBy(F.desc_nulls_last(by), "stabbr")


def state_per_capita(systems: DataFrame, population: DataFrame) -> DataFrame:
    """(year, variable, stabbr, value, pop, valpc) over all systems of a state."""
    sums = systems.groupBy("year", "variable", "stabbr").agg(sum_known(F.col("value")).alias("value"))
    return per_capita(sums, population)


def employee_share(states: DataFrame, year: int) -> DataFrame:
    """Employee contributions as a percentage of all contributions, highest first."""
    rows = states.where((F.col("year") == year) & F.col("variable").isin("eec", "erc"))
    wide = long_to_wide(rows, ["stabbr"], "variable", ["eec", "erc"])
    return wide.withColumn("eecpct", share_of("eec", "erc")).orderBy(F.desc_nulls_last("eecpct"), "stabbr")


def reported_share(a: DataFrame, b: DataFrame, code: str = "ic") -> DataFrame:
    """Item totals of a file without imputations and one with them, and the percentage."""
    both = stack(a.withColumn("src", F.lit("noimp")), b.withColumn("src", F.lit("imp")))
    wide = long_to_wide_sum(both, [code], "src", ["noimp", "imp"], add=exact_sum)
    wide = wide.select(code, F.col("noimp").cast("double").alias("noimp"), F.col("imp").cast("double").alias("imp"))
    return wide.withColumn("pct", F.try_divide("noimp", "imp") * 100)
