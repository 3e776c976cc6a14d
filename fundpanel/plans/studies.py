"""Studies of plan size and of how concentrated assets and members are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pct
from ..operators.aggregate import size_distribution, sum_strict
from ..operators.combine import stack
from ..operators.metrics import small_and_big
from ..operators.running import quantiles, ranked_rows, running_totals
from ..session import settled

# Probabilities of the size study, the ranks shown, and the size up
# to which a plan is small.
PROBS = {"p0": 0.0, "p5": 0.05, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p100": 1.0}
DECILES = {f"d{i}": i / 10 for i in range(11)}
SHOWN_RANKS = [100, 200, 250, 300]
SMALL_UP_TO = 1e4


def size_study(plans: DataFrame, plan: str = "pid", size: str = "participants", limit: float = SMALL_UP_TO):
    """Quantiles, size distribution and small-and-big shares of one set of plans."""
    plans = settled(plans)
    return {
        "quantiles": quantiles(plans, size, PROBS),
        "sizes": size_distribution(plans, size, {"parts": size, "assets": "assets"}),
        "shares": small_and_big(plans, plan, size, limit),
    }


def size_study_table(plans: DataFrame, plan: str = "pid", size: str = "participants", limit: float = SMALL_UP_TO) -> DataFrame:
    """The whole study as one table (part, item, measure, value)."""
    study = size_study(plans, plan, size, limit)
    names = {"quantiles": F.lit("all"), "sizes": F.coalesce("size", F.lit("none")), "shares": F.col("which")}
    parts = []
    for part, df in study.items():
        measures = [c for c in df.columns if c not in ("size", "bin", "which")]
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in measures]))
        parts.append(df.select(F.lit(part).alias("part"), names[part].alias("item"), cells.alias("c")).select("part", "item", "c.measure", "c.value"))
    return stack(*parts)


def groups_and_median(plans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of groups and the median count of a group."""
    counts = settled(plans.groupBy(*keys).agg(F.count(F.lit(1)).alias("plans")))
    return quantiles(counts, "plans", {"n_mdn": 0.5}).withColumnRenamed("n", "n_sum")


def concentration(plans: DataFrame, value: str, tie: str, measures: Mapping[str, str],
                  directions: Sequence[str] = ("up", "down"), ranges: int | None = None) -> DataFrame:
    """Rank, running sum, total and running percent of each measure, from the
    smallest plan up and from the largest down."""
    curve = running_totals(plans, value, tie, measures, directions=directions, ranges=ranges)
    return _percentages(curve, measures, directions)


def _percentages(curve: DataFrame, measures: Mapping[str, str], directions: Sequence[str]) -> DataFrame:
    return curve.withColumns({
        f"{o}_{d}pct": pct(F.col(f"{o}_{d}").cast("double"), F.col(f"{o}_sum").cast("double"))
        for d in directions for o in ["n", *measures]})


def beside_totals(plans: DataFrame, keep, measures: Mapping[str, str]) -> DataFrame:
    """Totals of all plans beside those of the plans that meet a condition, in one
    pass and one row. A total with a null is null."""
    kept = F.coalesce(keep, F.lit(False))
    aggs = {"n_all": F.count(F.lit(1)), "n_sum": F.count_if(kept)}
    for o, c in measures.items():
        aggs[f"{o}_all"] = sum_strict(F.col(c))
        aggs[f"{o}_sum"] = sum_strict(F.col(c), kept)
    return plans.agg(*[v.alias(k) for k, v in aggs.items()])


def at_ranks(plans: DataFrame, value: str, tie: str, measures: Mapping[str, str], ranks: Sequence[int] = SHOWN_RANKS,
             direction: str = "down", ranges: int | None = None) -> DataFrame:
    """Rows of the concentration curve at some ranks, without the rest of the curve."""
    few = ranked_rows(plans, value, tie, measures, ranks, direction, ranges)
    return _percentages(few, measures, [direction])
