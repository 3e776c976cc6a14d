"""Types of an all-text table, and columns chosen by type or name."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import to_date, to_number
from .reshape import wide_to_long

# The spellings of a logical cell.
LOGICAL = ["T", "F", "TRUE", "FALSE", "true", "false"]


def _candidates(c: Column) -> dict[str, Column]:
    bare = F.nullif(F.trim(c), F.lit(""))
    bare = F.when(bare != "NA", bare)
    return {
        "known": bare,
        "boolean": F.when(bare.isin(LOGICAL), bare),
        "double": to_number(bare),
        "date": to_date(bare),
    }


def type_counts(df: DataFrame) -> DataFrame:
    """One row per column: cells known, and how many fit each type. One pass; the
    columns are spread inside the scan stage and counted before the shuffle."""
    long = wide_to_long(df, [], df.columns, type="string")
    return long.groupBy("variable").agg(
        *[F.count(c).alias(n) for n, c in _candidates(F.col("value")).items()]
    )


def infer_types(df: DataFrame) -> dict[str, str]:
    """Narrowest type that fits every known cell; an empty column is logical."""
    counts = {r["variable"]: r for r in type_counts(df).collect()}  # one row per column
    return {c: _narrowest(counts.get(c)) for c in df.columns}


def _narrowest(r) -> str:
    if r is None:
        return "boolean"
    return next((t for t in ("boolean", "double", "date") if r[t] == r["known"]), "string")


#: Types a column may have, narrowest first, each with its bit; any cell is a string.
LATTICE = {"boolean": 1, "double": 2, "date": 4, "string": 8}


def type_masks(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, variable, known, types): the types that every known cell of a column fits, as
    bits, for each vintage or file. Masks are merged by ``bit_and``: in the scan stage, over
    vintages (``merged_masks``), and with masks kept from earlier runs."""
    columns = [c for c in df.columns if c not in by]
    cells = wide_to_long(df, list(by), columns, type="string")
    fits = _candidates(F.col("value"))
    mask = sum((F.when(fits[t].isNotNull(), F.lit(b)).otherwise(F.lit(0)) for t, b in LATTICE.items() if t != "string"), F.lit(LATTICE["string"]))
    known = fits["known"].isNotNull()
    everything = F.lit(sum(LATTICE.values()))
    return cells.groupBy(*by, "variable").agg(
        F.count_if(known).alias("known"), F.coalesce(F.bit_and(F.when(known, mask)), everything).alias("types"))


def merged_masks(masks: DataFrame) -> DataFrame:
    """(variable, known, types) over all vintages."""
    return masks.groupBy("variable").agg(F.sum("known").alias("known"), F.bit_and("types").alias("types"))


def narrowest(mask: Column) -> Column:
    """Name of the narrowest type in a mask; a column without cells is logical."""
    out = F.when(mask.bitwiseAND(1) != 0, "boolean")
    for t, b in list(LATTICE.items())[1:]:
        out = out.when(mask.bitwiseAND(b) != 0, t)
    return out


def types_by_vintage(masks: DataFrame, vintage: str) -> DataFrame:
    """(vintage, variable, own, upto, overall, breaks): a column's type in each vintage, in
    all up to it, and in all; ``breaks`` where the vintage itself rules out the type that
    all earlier ones had. A window sees one row per vintage of a column."""
    order = Window.partitionBy("variable").orderBy(vintage)
    earlier = F.bit_and("types").over(order.rowsBetween(Window.unboundedPreceding, -1))
    upto = F.bit_and("types").over(order.rowsBetween(Window.unboundedPreceding, 0))
    overall = F.bit_and("types").over(Window.partitionBy("variable"))
    breaks = F.coalesce(narrowest(earlier) != narrowest(upto), F.lit(False))
    return masks.select(vintage, "variable", narrowest(F.col("types")).alias("own"), narrowest(upto).alias("upto"), narrowest(overall).alias("overall"), breaks.alias("breaks"))


def types_of(masks: DataFrame) -> dict[str, str]:
    """One type per column over all vintages, for ``convert``."""
    return {r["variable"]: r["t"] for r in merged_masks(masks).select("variable", narrowest(F.col("types")).alias("t")).collect()}  # one row per column


def convert(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast an all-text table to the inferred types in one projection."""

    def one(name: str) -> Column:
        cells = _candidates(F.col(f"`{name}`"))
        kind = types[name]
        if kind == "boolean":
            return cells["boolean"].try_cast("boolean")
        return cells["known"] if kind == "string" else cells[kind]

    return df.select(*[one(c).alias(c) for c in df.columns])


def type_census(df: DataFrame) -> dict[str, str]:
    """Type of every column, from the schema."""
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def types_counted(df: DataFrame) -> dict[str, int]:
    """Number of columns of each type."""
    return dict(Counter(type_census(df).values()))


def select_type(df: DataFrame, *kinds: type[T.DataType], invert: bool = False) -> DataFrame:
    """Columns of (or not of) the given types."""
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, kinds) != invert])


def logical_to_text(df: DataFrame) -> DataFrame:
    """Logical columns to upper-case text, as a table of values prints them."""
    return df.select(*[
        F.upper(F.col(f"`{f.name}`").cast("string")).alias(f.name) if isinstance(f.dataType, T.BooleanType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """Column names that hold a pattern, in any case."""
    return [c for c in df.columns if re.search(pattern, c, re.IGNORECASE)]


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct (variable, value) over some columns, in one job."""
    return wide_to_long(df, [], columns, type="string").distinct()
