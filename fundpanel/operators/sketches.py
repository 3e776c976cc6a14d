"""Distinct counts that can be kept and merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch, as a power of two: 64 KB, and a standard error of 0.4 percent.
BUCKETS = 16


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, buckets: int = BUCKETS) -> DataFrame:
    """(keys, sketch): one HyperLogLog sketch of a column per key. Nulls do not count. A
    vintage's sketches are written with it, and later vintages are merged in without
    reading its rows again."""
    cells = F.col(column).cast("string") if dict(df.dtypes)[column] not in ("int", "bigint", "string", "binary") else F.col(column)
    return df.groupBy(*keys).agg(F.hll_sketch_agg(cells, F.lit(buckets)).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: Sequence[str] = (), name: str = "distinct") -> DataFrame:
    """Estimated distinct values by fewer keys, or of all, from kept sketches."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name)
    return sketches.groupBy(*keys).agg(merged) if keys else sketches.agg(merged)
