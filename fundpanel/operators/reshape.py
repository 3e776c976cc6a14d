"""Between long and wide."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wide_to_long(df: DataFrame, ids: Sequence[str], measures: Sequence[str] | None = None,
                 variable: str = "variable", value: str = "value", type: str = "double") -> DataFrame:
    """Unpivot to one type; null cells are kept. An expansion in the scan stage,
    without a shuffle."""
    measures = list(measures or [c for c in df.columns if c not in ids])
    cast = df.select(*ids, *[F.col(f"`{m}`").cast(type).alias(m) for m in measures])
    return cast.unpivot([f"`{i}`" for i in ids], [f"`{m}`" for m in measures], variable, value)


def _unlisted(name: str, values: Sequence) -> Column:
    """Count of rows whose value has no column; null is a value too."""
    return F.count_if(~F.coalesce(F.col(name).isin(list(values)), F.lit(False)))


def _all_listed(name: str, values: Sequence, cells: list[tuple[str, Column]]) -> list[Column]:
    """The cells; an unlisted value, whose rows would be lost, is an error."""
    error = F.raise_error(F.concat(F.lit(f"values of {name} beside {list(values)}: "), F.to_json(F.collect_set(F.struct(name)))))
    return [(F.when(_unlisted(name, values) > 0, error).otherwise(c) if i == 0 else c).alias(n) for i, (n, c) in enumerate(cells)]


def long_to_wide(df: DataFrame, keys: Sequence[str], name: str, values: Sequence, value: str = "value",
                 prefix: str = "") -> DataFrame:
    """Pivot; a missing cell is null, and a second value for one cell is an error, as is
    a value without a column: filter first where some are not wanted.

    The cells are conditional aggregates of one group-by: a single shuffle after
    a partial aggregation, and no job to look for the values."""

    def cell(v) -> Column:
        here = F.col(name) == F.lit(v)
        found = F.max(F.when(here, F.col(value)))
        many = F.count(F.when(here, F.lit(1))) > 1
        return F.when(many, F.raise_error(F.lit(f"several rows for the cell {name}={v}"))).otherwise(found)

    return df.groupBy(*keys).agg(*_all_listed(name, values, [(f"{prefix}{v}", cell(v)) for v in values]))


def long_to_wide_sum(df: DataFrame, keys: Sequence[str], name: str, values: Sequence, value: str = "value",
                     prefix: str = "", add: Callable[[Column], Column] = F.sum) -> DataFrame:
    """Pivot with sums, by ``add``; a missing cell is zero, and a value without a column an
    error."""
    return df.groupBy(*keys).agg(*_all_listed(name, values, [
        (f"{prefix}{v}", F.coalesce(add(F.when(F.col(name) == F.lit(v), F.col(value))), F.lit(0))) for v in values]))


def count_matrix(df: DataFrame, keys: Sequence[str], name: str, values: Sequence, prefix: str = "n_") -> DataFrame:
    """Rows counted by keys (down) and the values of one column (across); a value without
    a column is an error."""
    return df.groupBy(*keys).agg(*_all_listed(name, values, [
        (f"{prefix}{v}", F.count(F.when(F.col(name) == F.lit(v), F.lit(1)))) for v in values]))


def values_of(df: DataFrame, name: str) -> list:
    """The values that a pivot needs columns for, in order; a few, as they become columns."""
    return [r[0] for r in df.select(name).where(F.col(name).isNotNull()).distinct().orderBy(name).collect()]


def split_column(df: DataFrame, column: str, into: Sequence[str], sep: str, keep: bool = False) -> DataFrame:
    """Split on a separator pattern; extra pieces go, missing ones are null."""
    pieces = F.split(F.col(column), sep)
    out = df.withColumns({n: F.get(pieces, F.lit(i)) for i, n in enumerate(into)})
    return out if keep else out.drop(column)


def transpose_rows(grid: DataFrame, rows: dict[int, str]) -> DataFrame:
    """Chosen rows of a grid become columns: one output row per file and position."""
    cells = grid.where(F.col("row_no").isin(list(rows))).select(
        "file", "row_no", F.posexplode("cells").alias("position", "cell")
    )
    return cells.groupBy("file", "position").agg(
        *[F.max(F.when(F.col("row_no") == r, F.col("cell"))).alias(n) for r, n in rows.items()]
    )
