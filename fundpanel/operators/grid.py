"""Steps that turn a raw grid (file, row_no, cells) into named rows.

Headers stay data: one row per file carries its column names, and each cell is
picked by name, so files with different layouts go through one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settled


def trim_all(df: DataFrame) -> DataFrame:
    """Trim every text column."""
    return df.select(
        *[F.trim(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
          for f in df.schema.fields]
    )


def clean_name(c: Column) -> Column:
    """Column name without blanks and underscores, as text spelled both ways."""
    return F.regexp_replace(c, "[ _]", "")


def find_header(grid: DataFrame, cell: int, pattern: str) -> DataFrame:
    """(file, header_row, names) of the first row of each file whose cell matches."""
    return _first_row(grid.where(F.get("cells", F.lit(cell - 1)).rlike(pattern)))


def header_at(grid: DataFrame, row_no: int) -> DataFrame:
    """(file, header_row, names) from a fixed row."""
    return _first_row(grid.where(F.col("row_no") == row_no))


def _first_row(rows: DataFrame) -> DataFrame:
    first = F.min_by(F.struct("row_no", "cells"), F.col("row_no"))
    return rows.groupBy("file").agg(first.alias("h")).select(
        "file", F.col("h.row_no").alias("header_row"), F.col("h.cells").alias("names")
    )


def tidy_names(header: DataFrame, rename: Mapping[str, str] | None = None, lower: bool = False,
               clean: bool = False) -> DataFrame:
    """Rename special tokens, then clean or lower the names of each file."""

    def one(n: Column) -> Column:
        for old, new in (rename or {}).items():
            n = F.when(n == old, F.lit(new)).otherwise(n)
        n = clean_name(n) if clean else n
        return F.lower(n) if lower else n

    return header.withColumn("names", F.transform("names", one))


def promote_header(grid: DataFrame, header: DataFrame, columns: Sequence[str] = (), names: bool = False) -> DataFrame:
    """Rows below the header. Names are looked up on the header row, once per file: each
    data row gets the places of the named columns (``at``), and the array of all names
    only where asked for. The join is on the file, one header row each; the headers are
    kept first, so that Catalyst knows their size and broadcasts or splits by it."""
    if columns:
        place = [(F.array_position("names", F.lit(n)) - 1).cast("int").alias(n) for n in columns]
        header = header.withColumn("at", F.struct(*place))
    header = settled(header if names else header.drop("names"))
    return grid.join(header, "file").where(F.col("row_no") > F.col("header_row")).drop("header_row")


def named_cell(name: str) -> Column:
    """Cell of the first column with that name, null when the file has none."""
    return F.get("cells", F.col("at").getField(name))


def cells_to_long(rows: DataFrame, ids: Sequence[str], not_measures: Sequence[str] = ()) -> DataFrame:
    """Unpivot named cells: ``ids`` are columns to keep, all other names measures."""
    kept = list(ids)
    pairs = F.explode(F.arrays_zip("names", "cells")).alias("p")
    return (
        rows.select(*kept, pairs)
        .select(*kept, F.col("p.names").alias("variable"), F.col("p.cells").alias("value"))
        .where(F.col("variable").isNotNull() & ~F.col("variable").isin(list(not_measures)))
    )


def context_fill(df: DataFrame, label: str, back: Mapping[str, int], entity: str = "entity",
                 level: str = "level", default: str = "Total", file: str = "file",
                 row_no: str = "row_no", block: int = 100_000) -> DataFrame:
    """Give indented rows the entity named ``back[label]`` rows above them.

    A file is cut into blocks of row numbers, so that a long one is many tasks; the
    last rows of a block are also put at the head of the next, which looks up to them."""
    reach = max(back.values())
    own = F.floor(F.col(row_no) / block)
    edge = F.pmod(F.col(row_no), F.lit(block)) >= block - reach
    rows = df.withColumn("_own", own).withColumn(
        "_block", F.explode(F.when(edge, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
    text, filled, order = F.col(label), F.col(label), Window.partitionBy(file, "_block").orderBy(row_no)
    for name, n in back.items():
        above = F.first(label).over(order.rangeBetween(-n, -n))
        filled = F.when(text == name, above).otherwise(filled)
    rows = rows.withColumn(level, F.when(text.isin(list(back)), text).otherwise(default)).withColumn(entity, filled)
    return rows.where(F.col("_own") == F.col("_block")).drop("_own", "_block")


def slice_from_marker(df: DataFrame, label: str, marker: str, file: str = "file",
                      row_no: str = "row_no") -> DataFrame:
    """Rows of each file from its first marker row on."""
    start = settled(df.where(F.col(label) == marker).groupBy(file).agg(F.min(row_no).alias("_from")))
    return df.join(start, file).where(F.col(row_no) >= F.col("_from")).drop("_from")


def expand_grouped_header(names: Column, width: Column, drop_at: Column, set_at: Column,
                          set_to: Column) -> Column:
    """Entity of each value column, when only every ``width``-th one names it.

    ``names`` holds the header without its first (text) column. Repairs come as
    data: a name to take out (the later ones move up) and a name to set; null
    means no repair."""
    moved = F.when(
        drop_at.isNotNull(),
        F.concat(F.slice(names, 1, drop_at - 1),
                 F.slice(names, drop_at + 1, F.greatest(F.size(names) - drop_at, F.lit(0)))),
    ).otherwise(names)
    return F.transform(
        F.sequence(F.lit(0), F.size(names) - 1),
        lambda i: F.when(F.floor(i / width) * width + 1 == set_at, set_to).otherwise(
            F.get(moved, (F.floor(i / width) * width).cast("int"))
        ),
    )


def drop_empty(df: DataFrame, value: str = "value", zero: bool = False, sentinel: float | None = None) -> DataFrame:
    """Drop null facts, and on request zero and sentinel ones."""
    keep = F.col(value).isNotNull()
    if zero:
        keep &= F.col(value) != 0
    if sentinel is not None:
        keep &= F.col(value) != sentinel
    return df.where(keep)


def zero_as_missing(df: DataFrame, variables: Sequence[str], variable: str = "variable",
                    value: str = "value") -> DataFrame:
    """Zero means not reported for some variables: null it, then drop null facts."""
    hole = F.col(variable).isin(list(variables)) & (F.col(value) == 0)
    return df.withColumn(value, F.when(~F.coalesce(hole, F.lit(False)), F.col(value))).where(F.col(value).isNotNull())
