"""Counts, sums, bins and totals rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import pct
from .reshape import long_to_wide_sum, wide_to_long

EXACT = "decimal(38,18)"  # all digits that a double prints, for amounts below 1e20

# Edges and labels of the plan-size bins, closed on the right.
SIZE_EDGES = [0, 1, 2, 3, 4, 5, 10, 20, 50, 100, 1_000, 10_000, 100_000]
SIZE_LABELS = ["(0,1]", "(1,2]", "(2,3]", "(3,4]", "(4,5]", "(5,10]", "(10,20]", "(20,50]", "(50,100]",
               "(100,1e+03]", "(1e+03,1e+04]", "(1e+04,1e+05]", "(1e+05,Inf]"]


def exact_sum(c: Column) -> Column:
    """Sum as double that does not depend on row order: exact inside, to 18 decimals.
    Values or sums from 1e20 on are added as doubles."""
    exact = c.try_cast(EXACT)
    return F.when(F.count(c) == F.count(exact), F.coalesce(F.try_sum(exact).cast("double"), F.sum(c.cast("double")))).otherwise(
        F.sum(c.cast("double")))


class Parts:
    """What a sum of amounts of any size is made of, so that sums of sums (over ranges,
    bins or windows) follow the rule of ``exact_sum``: decimals while all amounts and
    their sum fit, else doubles. Columns are named with a prefix; ``z`` counts nulls."""

    def __init__(self, prefix: str) -> None:
        self.exact, self.rough, self.odd, self.nulls = (f"{prefix}{k}" for k in "sxuz")
        self.names = [self.exact, self.rough, self.odd, self.nulls]

    def of_row(self, c: Column) -> dict[str, Column]:
        exact = c.try_cast(EXACT)
        return dict(zip(self.names, [F.coalesce(exact, F.lit(0).cast(EXACT)), F.coalesce(c.cast("double"), F.lit(0.0)),
                                     (c.isNotNull() & exact.isNull()).cast("long"), c.isNull().cast("long")], strict=True))

    def summed(self, over: WindowSpec | None = None) -> dict[str, Column]:
        """Sums of the parts, of a group or over a window; nothing is 0."""
        def add(c: Column) -> Column:
            return c if over is None else c.over(over)

        exact = add(F.try_sum(self.exact))
        lost = (exact.isNull() & (add(F.count(F.lit(1))) > 0)).cast("long")
        return dict(zip(self.names, [F.coalesce(exact, F.lit(0).cast(EXACT)), F.coalesce(add(F.sum(self.rough)), F.lit(0.0)),
                                     F.coalesce(add(F.sum(self.odd)), F.lit(0)) + lost, F.coalesce(add(F.sum(self.nulls)), F.lit(0))], strict=True))

    def value(self, strict: bool = True) -> Column:
        """The sum as double; with ``strict`` a null among the amounts makes it null."""
        total = F.when(F.col(self.odd) == 0, F.col(self.exact).cast("double")).otherwise(F.col(self.rough))
        return F.when(F.col(self.nulls) == 0, total) if strict else total


def sum_known(c: Column) -> Column:
    """Sum that skips nulls; zero when all are null."""
    return F.coalesce(exact_sum(c), F.lit(0.0))


def sum_strict(c: Column, where: Column | None = None) -> Column:
    """Sum that is null when any value is; of the rows that meet a condition, if given."""
    if where is None:
        return F.when(F.count(F.lit(1)) == F.count(c), exact_sum(c))
    return F.when(F.count_if(where) == F.count_if(where & c.isNotNull()), exact_sum(F.when(where, c)))


def count_by(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    """Rows per key; a null key is a group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def numeric_columns(df: DataFrame, but: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in but]


def sum_columns(df: DataFrame, but: Sequence[str] = ()) -> DataFrame:
    """Sum of every numeric column, null when the column has a null."""
    return df.agg(*[sum_strict(F.col(c)).alias(c) for c in numeric_columns(df, but)])


def totals(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Row count and strict sums, over the keys or over all rows."""
    aggs = [F.count(F.lit(1)).alias("n"), *[sum_strict(F.col(c)).alias(o) for o, c in measures.items()]]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def add_totals(df: DataFrame, keys: Sequence[str], over: Mapping[str, object], measures: Sequence[str],
               null_total: bool = False) -> DataFrame:
    """Measures summed by the keys, plus rows over all ``over`` columns, which hold
    fixed labels there. Grouping sets: one read and one shuffle of partial sums. Doubles
    are summed by ``exact_sum``."""
    rough = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def add(m: str) -> Column:
        total = exact_sum(F.col(m)) if m in rough else F.sum(m)
        return total if null_total else F.coalesce(total, F.lit(0))

    rest = [k for k in keys if k not in over]
    sums = df.groupingSets([[F.col(k) for k in keys], [F.col(k) for k in rest]], *keys).agg(
        *[add(m).alias(f"_s_{m}") for m in measures], F.grouping(next(iter(over))).alias("_top"))
    top = F.col("_top") == 1
    return sums.select(
        *[F.when(top, F.lit(over[k])).otherwise(F.col(k)).alias(k) if k in over else F.col(k) for k in keys],
        *[F.col(f"_s_{m}").alias(m) for m in measures],
    )


def size_bin(c: Column, edges: Sequence[float] = SIZE_EDGES) -> Column:
    """Number (from 1) of the right-closed bin; null at or below the first edge."""
    out = F.when(c <= edges[0], F.lit(None).cast("int"))
    for i, e in enumerate(edges[1:], start=1):
        out = out.when(c <= e, i)
    return out.when(c > edges[-1], len(edges))


def bin_label(b: Column, labels: Sequence[str] = SIZE_LABELS) -> Column:
    return F.get(F.lit(list(labels)), b - 1)


def size_distribution(df: DataFrame, size: str, measures: Mapping[str, str]) -> DataFrame:
    """Plans by size bin with cumulative sums, percent and cumulative percent.

    A bin with a null has a null sum, a cumulative sum is null from there on, and where
    the whole has a null there are no percentages. The windows see one row per bin, at
    most one more than the edges."""
    parts = {o: Parts(f"_{o}_") for o in measures}
    rows = df.select(size_bin(F.col(size)).alias("bin"), *[v.alias(n) for o, c in measures.items() for n, v in parts[o].of_row(F.col(c)).items()])
    bins = rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), *[v.alias(n) for o in measures for n, v in parts[o].summed().items()])
    upto = Window.orderBy(F.asc_nulls_last("bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    sides = {"cum": upto, "all": whole}
    beside = {f"_{side}{n}": v for side, over in sides.items() for o in measures for n, v in parts[o].summed(over).items()}
    bins = bins.withColumns({"n_cum": F.sum("n").over(upto), "n_all": F.sum("n").over(whole), **beside})
    for o in measures:
        bins = bins.withColumns({o: parts[o].value(), **{f"{o}_{side}": Parts(f"_{side}_{o}_").value() for side in sides}})
    for m in ["n", *measures]:
        total = F.col(f"{m}_all").cast("double")
        bins = bins.withColumns({f"{m}_pct": pct(F.col(m).cast("double"), total), f"{m}_cumpct": pct(F.col(f"{m}_cum").cast("double"), total)})
    out = [f"{m}{k}" for m in ["n", *measures] for k in ("", "_cum", "_pct", "_cumpct")]
    return bins.select("bin", *out, bin_label(F.col("bin")).alias("size"))


def histogram(df: DataFrame, value: str, width: float) -> DataFrame:
    """Counts in equal bins centred on multiples of the width, closed on the right."""
    centre = F.ceil(F.col(value) / width - 0.5) * width
    return df.where(F.col(value).isNotNull()).groupBy(centre.cast("double").alias("centre")).agg(F.count(F.lit(1)).alias("n"))


def shares(df: DataFrame, keys: Sequence[str], name: str, values: Sequence, value: str) -> DataFrame:
    """Sums across the values of one column, each with its percentage of the row. A value
    that is not listed is an error, as it would be missing from the row's total."""
    wide = long_to_wide_sum(df, keys, name, values, value, add=exact_sum)
    wide = wide.select(*keys, *[F.col(f"`{v}`").cast("double").alias(str(v)) for v in values])
    total = sum((F.col(f"`{v}`") for v in values[1:]), F.col(f"`{values[0]}`"))
    return wide.withColumns({f"{v}_pct": pct(F.col(f"`{v}`"), total) for v in values})


def value_range(df: DataFrame, columns: Sequence[str], type: str = "date") -> DataFrame:
    """Smallest and largest value of each column."""
    long = wide_to_long(df, [], columns, type=type)
    return long.groupBy("variable").agg(F.min("value").alias("min"), F.max("value").alias("max"))
