"""Running sums and exact quantiles over data of any size.

An ordered window without a partition puts all rows in one task. Here rows are
range-partitioned by the whole order, tie-break key included, so that a value held by a
third of the rows spans as many ranges as it needs. They are kept in the shared folder
with the number of their range, after which every evaluation sees the same ranges. Each
range is ordered by itself and starts from the sums of the ranges before it. There is
one path for all sizes, and no answer depends on where the ranges begin.

Where only some ranks are wanted, as in quantiles, most rows are never moved. A mergeable
sketch of the values gives two bounds around each wanted rank, as far apart as its error
asks for. In a second pass rows inside the bounds are kept (equal ones as a count), and
all others shrink to one count, or sum, for each stretch between bounds. What is ordered
are the rows inside bounds, and stretches as if they were one row. That a wanted rank
falls on a kept row is checked when it is read off."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..session import settled
from .aggregate import Parts, exact_sum
from .reshape import wide_to_long

#: The sketch errs by up to a rank in so many.
ACCURACY = 2000
#: Bounds around the ranks of a single order are taken from so many steps.
STEPS = 1000


def in_ranges(df: DataFrame, order: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """Rows in ranges of an order, kept, with the number ``_b`` of their range. There are
    as many ranges as shuffle partitions, which a cluster sizes to its data."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settled(df.repartitionByRange(n, *order).withColumn("_b", F.spark_partition_id()))


def running_totals(df: DataFrame, key: str, tie: str, measures: Mapping[str, str], groups: Sequence[str] = (),
                   directions: Sequence[str] = ("up",), ranges: int | None = None) -> DataFrame:
    """Row number ``n_<direction>`` and running sum ``<name>_<direction>`` of each
    measure, in ascending (up) or descending (down) order of the key, beside the
    total (``n_sum``, ``<name>_sum``).

    Ties go by ascending tie-break key and null keys come last, both ways. A running
    sum is null from its first null on, and a total with a null is null. Sums are doubles
    by the rule of ``exact_sum``. Rows shuffle once for each direction."""
    out = df.withColumns({"_n": F.lit(1).cast("long"), **{n: v for o, c in measures.items() for n, v in Parts(f"_{o}_").of_row(F.col(c)).items()}})
    for i, d in enumerate(directions):
        order = _order(key, tie, d)
        rows = in_ranges(out, [*[F.asc(g) for g in groups], *order], ranges)
        out = _inside(rows, _starts(rows, measures, groups, whole=i == 0), order, measures, groups, d)
    return out.drop(*_parts(measures))


def _order(key: str, tie: str, d: str) -> list[Column]:
    return [F.asc_nulls_last(key) if d == "up" else F.desc_nulls_last(key), F.asc(tie)]


def _parts(measures: Mapping[str, str]) -> list[str]:
    return ["_n", *[n for o in measures for n in Parts(f"_{o}_").names]]


def _starts(rows: DataFrame, measures: Mapping[str, str], groups: Sequence[str], whole: bool) -> DataFrame:
    """Rows and parts of sums before each range, one row per range and group that meet: at
    most ranges + groups of them. With the totals, if asked for."""
    at = [*groups, "_b"]
    parts = {o: Parts(f"_{o}_") for o in measures}
    sums = rows.groupBy(*at).agg(F.sum("_n").alias("_n"), *[v.alias(n) for p in parts.values() for n, v in p.summed().items()])
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*groups)
    found = sums.select(
        *[F.col(c).alias(f"_at_{c}") for c in at], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from_n"), F.sum("_n").over(every).alias("n_sum"),
        *[v.alias(f"_from{n}") for p in parts.values() for n, v in p.summed(before).items()],
        *[v.alias(f"_all{n}") for p in parts.values() for n, v in p.summed(every).items()])
    totals = ["n_sum", *[Parts(f"_all_{o}_").value().alias(f"{o}_sum") for o in measures]]
    return found.select(*[c for c in found.columns if not c.startswith("_all") and c != "n_sum"], *(totals if whole else []))


def _inside(rows: DataFrame, starts: DataFrame, order: Sequence[Column], measures: Mapping[str, str],
            groups: Sequence[str], d: str) -> DataFrame:
    at = [*groups, "_b"]
    joined = rows.join(starts, [rows[c].eqNullSafe(starts[f"_at_{c}"]) for c in at])
    upto = Window.partitionBy(*at).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = {f"n_{d}": F.col("_from_n") + F.sum("_n").over(upto)}
    for o in measures:
        p, start = Parts(f"_{o}_"), Parts(f"_from_{o}_")
        here = dict(zip(("exact", "rough", "odd", "nulls"), p.summed(upto).values(), strict=True))
        exact = F.try_add(F.col(start.exact), here["exact"])
        odd = F.col(start.odd) + here["odd"]
        total = F.when((odd == 0) & exact.isNotNull(), exact.cast("double")).otherwise(F.col(start.rough) + here["rough"])
        sums[f"{o}_{d}"] = F.when(F.col(start.nulls) + here["nulls"] == 0, total)
    done = joined.withColumns(sums)
    return done.drop(*[f"_at_{c}" for c in at], *[c for c in done.columns if c.startswith("_from_")], "_b")


def ranked_rows(df: DataFrame, key: str, tie: str, measures: Mapping[str, str], ranks: Sequence[int],
                direction: str = "down", ranges: int | None = None) -> DataFrame:
    """The rows of ``running_totals`` at some ranks. ``df`` is read three times: for the
    sketch, for the rows inside the bounds, which alone are moved, and for the sums of the
    stretches between them."""
    parts = {o: Parts(f"_{o}_") for o in measures}
    v = F.col(key).cast("double")
    known = ~F.isnan(v)
    seen = df.agg(F.count(v).alias("n"), F.count_if(~known).alias("odd"),
                  F.percentile_approx(F.when(known, v), [i / STEPS for i in range(STEPS + 1)], ACCURACY).alias("steps")).first()
    bounds = _bounds_of_ranks(seen, ranks, direction)
    inside = reduce(lambda a, b: a | b, [(v >= lo) & (v <= hi) for lo, hi in bounds], F.lit(False))
    inside = F.coalesce(inside, F.lit(any(r > seen["n"] for r in ranks)))  # null keys come last
    stretch = sum((F.when(v > hi, 1).otherwise(0) for _, hi in bounds), F.when(v.isNull(), -1).otherwise(0))
    row = {"_n": F.lit(1).cast("long"), **{n: x for o, c in measures.items() for n, x in parts[o].of_row(F.col(c)).items()}}
    few = df.where(inside).withColumns({**row, "_whole": F.lit(True)})
    rest = df.where(~inside).select(F.col(key), stretch.alias("_stretch"), *[x.alias(n) for n, x in row.items()]).groupBy("_stretch").agg(
        F.min(key).alias(key), F.sum("_n").alias("_n"), *[x.alias(n) for p in parts.values() for n, x in p.summed().items()])
    order = _order(key, tie, direction)
    rows = in_ranges(few.unionByName(rest.drop("_stretch"), allowMissingColumns=True), order, ranges)
    done = _inside(rows, _starts(rows, measures, (), True), order, measures, (), direction)
    n = F.col(f"n_{direction}")
    missed = F.exists(F.lit(list(ranks)), lambda r: (r <= n) & (r > n - F.col("_n")))
    done = done.where(F.when(F.col("_whole").isNull() & missed, F.raise_error(F.lit("a rank lies outside its bounds"))).otherwise(n.isin(list(ranks)) & F.col("_whole")))
    return done.drop("_whole", *_parts(measures))


def _bounds_of_ranks(seen, ranks: Sequence[int], direction: str) -> list[tuple[float, float]]:
    """Merged bounds, in order. The step below a rank and the one above it may both be off
    by the error of the sketch, so a step more is taken on each side."""
    n, steps = seen["n"], seen["steps"]
    if not n or seen["odd"]:
        return [(float("-inf"), float("nan"))]  # nothing is known of the order; NaN is the largest
    out: list[tuple[float, float]] = []
    places = sorted(r - 1 if direction == "up" else n - r for r in ranks if r <= n)
    slack = 2 + STEPS * 2 // ACCURACY
    for k in places:
        lo, hi = max(k * STEPS // n - slack, 0), min(-(-k * STEPS // n) + slack, STEPS)
        lo, hi = (steps[lo] if lo else float("-inf")), (steps[hi] if hi < STEPS else float("inf"))
        if n <= 2 * STEPS:
            lo, hi = float("-inf"), float("inf")
        if out and lo <= out[-1][1]:
            lo, hi = out[-1][0], max(hi, out.pop()[1])
        out.append((lo, hi))
    return out or [(float("inf"), float("inf"))]


def _sketched(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str], more: Mapping[str, Column] | None = None) -> DataFrame:
    """By group: bounds ``_lo_<i>`` and ``_hi_<i>`` around the wanted ranks of each
    probability. Groups that are too small for the sketch, or hold values that are not
    numbers, are kept as a whole."""
    v = F.col(value).cast("double")
    apart = 2 / ACCURACY
    wanted = [max(p - apart, 0.0) for p in probs] + [min(p + apart, 1.0) for p in probs]
    seen = df.groupBy(*groups).agg(
        F.count(v).alias("_known"), F.count_if(F.isnan(v)).alias("_odd"),
        F.percentile_approx(F.when(~F.isnan(v), v), wanted, ACCURACY).alias("_at"), *[c.alias(n) for n, c in (more or {}).items()])
    whole = (F.col("_known") <= 2 * ACCURACY) | (F.col("_odd") > 0)

    def bound(i: int, open_end: bool, end: float) -> Column:
        return F.when(whole | F.lit(open_end), F.lit(end)).otherwise(F.get("_at", F.lit(i)))

    k = len(probs)
    bounds = {f"_lo_{i}": bound(i, wanted[i] == 0, float("-inf")) for i in range(k)}
    bounds |= {f"_hi_{i}": bound(k + i, wanted[k + i] == 1, float("nan")) for i in range(k)}
    return settled(seen.select(*groups, *(more or {}), *[c.alias(n) for n, c in bounds.items()]))


def _frequencies(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str], sketched: DataFrame, ranges: int | None) -> DataFrame:
    """What quantiles need of the values, in ranges: each value (``_v``) inside a group's
    bounds once, with its count ``_n``, and the stretches between the bounds as one row
    (``_whole`` is false), with a value from among them. A frequent value is a single row."""
    v = F.col("_value")
    rows = df.select(*groups, F.col(value).cast("double").alias("_value")).where(v.isNotNull())
    bounds = sketched.select(*[F.col(g).alias(f"_of_{g}") for g in groups], *[c for c in sketched.columns if c.startswith(("_lo_", "_hi_"))])
    if groups:
        rows = rows.join(bounds, [rows[g].eqNullSafe(bounds[f"_of_{g}"]) for g in groups])
    else:
        rows = rows.withColumns({c: F.lit(x).cast("double") for c, x in zip(bounds.columns, bounds.first() or [None] * len(bounds.columns), strict=True)})
    inside = reduce(lambda a, b: a | b, [(v >= F.col(f"_lo_{i}")) & (v <= F.col(f"_hi_{i}")) for i in range(len(probs))])
    stretch = sum((F.when(v > F.col(f"_hi_{i}"), 1).otherwise(0) for i in range(len(probs))), F.lit(0))
    keyed = rows.select(*groups, F.when(inside, v).alias("_key"), F.when(inside, -1).otherwise(stretch).alias("_stretch"), "_value")
    freq = keyed.groupBy(*groups, "_key", "_stretch").agg(F.count(F.lit(1)).alias("_n"), F.min("_value").alias("_v"))
    freq = freq.select(*groups, "_v", "_n", (F.col("_stretch") < 0).alias("_whole"))
    return in_ranges(freq, [*[F.asc(g) for g in groups], F.asc_nulls_last("_v")], ranges)


def _at_probabilities(freq: DataFrame, probs: Mapping[str, float], groups: Sequence[str]) -> DataFrame:
    """Quantiles from frequencies. Range counts show which ranges hold the wanted ranks;
    only those are ordered."""
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = freq.groupBy(*groups, "_b").agg(F.sum("_n").alias("_m")).select(
        *groups, "_b", "_m",
        F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_before"),
        F.sum("_m").over(whole).alias("n"),
    )
    wanted = F.lit([float(p) for p in probs.values()])

    def rank(p: Column) -> Column:
        return (F.col("n") - 1) * p

    def whole_rank(f, p: Column) -> Column:
        return f(rank(p)).cast("long")

    ranks = F.array_distinct(F.flatten(
        F.transform(wanted, lambda p: F.array(whole_rank(F.floor, p), whole_rank(F.ceil, p)))))
    here = F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_m")))
    chosen = counts.withColumn("_ranks", here).where(F.size("_ranks") > 0).drop("_m")
    chosen = chosen.withColumnsRenamed({c: f"_at_{c}" for c in [*groups, "_b"]})
    rows = freq.join(chosen, [freq[c].eqNullSafe(chosen[f"_at_{c}"]) for c in [*groups, "_b"]])
    inside = Window.partitionBy(*groups, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("_before") + F.sum("_n").over(inside)
    rows = rows.withColumn("_last", last).withColumn(
        "_r", F.explode(F.filter("_ranks", lambda r: (r >= F.col("_last") - F.col("_n")) & (r < F.col("_last")))))
    kept = F.when(F.col("_whole"), F.col("_v")).otherwise(F.raise_error(F.lit("a rank lies outside its bounds")))
    # At most two order statistics per probability and group.
    found = rows.select(*groups, "n", "_r", kept.alias("_v")).groupBy(*groups).agg(
        F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_at"))

    def between(p: Column) -> Column:
        lo, hi = (F.element_at("_at", whole_rank(f, p)) for f in (F.floor, F.ceil))
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (rank(p) - F.floor(rank(p))))

    found = found.withColumn("_q", F.transform(wanted, between))
    return found.select(*groups, "n", *[F.get("_q", F.lit(i)).alias(q) for i, q in enumerate(probs)])


def quantiles(df: DataFrame, value: str, probs: Mapping[str, float], groups: Sequence[str] = (),
              ranges: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics, one
    column per named probability, and the count ``n``; nulls are left out. The data
    are read twice, for the sketch and for the values inside its bounds."""
    known = df.where(F.col(value).isNotNull())
    bounds = _sketched(known, value, list(probs.values()), groups)
    return _at_probabilities(_frequencies(known, value, list(probs.values()), groups, bounds, ranges), probs, groups)


def quantile_profile(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Mapping[str, float],
                     ranges: int | None = None) -> DataFrame:
    """Quantiles of several columns by (variable, keys), from unpivoted passes."""
    long = wide_to_long(df, list(keys), columns)
    return quantiles(long, "value", probs, ["variable", *keys], ranges)


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def column_summary(df: DataFrame, columns: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Minimum, quartiles, mean, maximum and null count of each column. All but the
    quartiles come with the sketch, in the first of two passes. The mean is that of
    ``exact_sum``, so values of any size and values that are not numbers count."""
    long, v = wide_to_long(df, [], columns), F.col("value")
    more = {"min": F.min(v), "mean": ratio(exact_sum(v), F.count(v).cast("double")), "max": F.max(v), "nulls": F.count_if(v.isNull())}
    probs = list(QUARTILES.values())
    seen = _sketched(long, "value", probs, ["variable"], more)
    parts = _at_probabilities(_frequencies(long, "value", probs, ["variable"], seen, ranges), QUARTILES, ["variable"])
    return seen.select("variable", *more).join(parts.drop("n"), "variable", "left")
