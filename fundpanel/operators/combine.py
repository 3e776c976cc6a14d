"""Stacking and the choice of sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stack(*dfs: DataFrame) -> DataFrame:
    """Stack by name; a column a source lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def stack_tagged(sources: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """Stack with the name of the source."""
    return stack(*[df.withColumn(tag, F.lit(name)) for name, df in sources.items()])


def replicate(df: DataFrame, years: Sequence[int], year: str = "year") -> DataFrame:
    """One vintage that serves several years."""
    return df.withColumn(year, F.explode(F.lit(list(years))))


def served_by(precedence: Sequence[tuple[str, int | None, int | None]], source: str = "source",
              year: str = "year") -> Column:
    """Condition that keeps, for each (source, first year, last year), that source
    in those years. A plain filter, so it reaches the scan of each source."""
    rules = []
    for name, first, last in precedence:
        cond = F.col(source) == name
        if first is not None:
            cond &= F.col(year) >= first
        if last is not None:
            cond &= F.col(year) <= last
        rules.append(cond)
    return reduce(lambda a, b: a | b, rules)


def uncovered_years(precedence: Sequence[tuple[str, int | None, int | None]], first: int, last: int) -> list[int]:
    """Years no source serves."""
    return [y for y in range(first, last + 1)
            if not any((a is None or y >= a) and (b is None or y <= b) for _, a, b in precedence)]


def series(df: DataFrame, where: Mapping[str, Sequence], columns: Sequence[str]) -> DataFrame:
    """A named series: rows with the listed values, and some columns."""
    conds = [F.col(c).isin(list(v)) for c, v in where.items()]
    return df.where(reduce(lambda a, b: a & b, conds)).select(*columns)


def local_only(df: DataFrame, type: str = "type") -> DataFrame:
    """Plans of local governments: a type code other than 0 (null drops)."""
    return df.where(F.col(type) != 0)


def serve(df: DataFrame, precedence: DataFrame, source: str = "source", year: str = "year") -> DataFrame:
    """Rows that a precedence table (source, first, last) lets in: those of a source in
    its years, an open end being null. An interval join in which the table, one row per
    source and span, never multiplies rows."""
    rules = precedence.select(F.col("source").alias("_source"), F.col("first").alias("_first"), F.col("last").alias("_last"))
    inside = (F.col(year) >= F.coalesce("_first", F.lit(-(2**31)))) & (F.col(year) <= F.coalesce("_last", F.lit(2**31 - 1)))
    return df.join(rules, (F.col(source) == F.col("_source")) & inside, "left_semi")


def spans_of(precedence: DataFrame, first: int, last: int) -> DataFrame:
    """(first, last, sources): runs of years from first to last that the same sources
    serve, none of them included. The table is cut at the ends of its spans, so that a
    span of any length is two rows."""
    years = precedence.select("source", F.greatest(F.coalesce("first", F.lit(first)), F.lit(first)).alias("a"),
                              F.least(F.coalesce("last", F.lit(last)), F.lit(last)).alias("b")).where("a <= b")
    cuts = years.select(F.explode(F.array(F.col("a"), F.col("b") + 1)).alias("first")).where(F.col("first") <= last)
    edge = precedence.sparkSession.sql(f"SELECT {int(first)} AS first")
    order = Window.orderBy("first")  # a row per end of a span
    pieces = cuts.unionByName(edge).distinct().withColumn("last", F.coalesce(F.lead("first").over(order) - 1, F.lit(last)))
    held = pieces.join(years.distinct(), (F.col("a") <= F.col("first")) & (F.col("b") >= F.col("last")), "left")
    spans = held.groupBy("first", "last").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    fresh = F.coalesce(F.col("sources") != F.lag("sources").over(order), F.lit(True)).cast("int")
    runs = spans.withColumn("run", fresh).withColumn("run", F.sum("run").over(order))
    return runs.groupBy("run").agg(F.min("first").cast("int").alias("first"), F.max("last").cast("int").alias("last"), F.first("sources").alias("sources")).drop("run")


def precedence_findings(precedence: DataFrame, first: int, last: int) -> DataFrame:
    """(first, last, finding, sources): years that no source serves (``gap``) and years
    that several serve (``overlap``)."""
    finding = F.when(F.size("sources") == 0, "gap").when(F.size("sources") > 1, "overlap")
    return spans_of(precedence, first, last).withColumn("finding", finding).where(F.col("finding").isNotNull()).select(
        "first", "last", "finding", F.array_join("sources", ", ").alias("sources"))

