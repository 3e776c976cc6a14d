"""Fixed-width records, cut by widths or by positions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import to_number, whole_number
from .vintages import tag_vintage


class Field(NamedTuple):
    name: str
    start: int
    length: int
    type: str = "string"


def by_widths(widths: Sequence[int], names: Sequence[str], types: Sequence[str] | None = None) -> list[Field]:
    """Fields from column widths; a negative width skips and takes no name."""
    types = list(types or ["string"] * len(names))
    spec, start, k = [], 1, 0
    for w in widths:
        if w > 0:
            spec.append(Field(names[k], start, w, types[k]))
            k += 1
        start += abs(w)
    if k != len(names):
        raise ValueError("as many names as positive widths are needed")
    return spec


def by_positions(fields: Sequence[tuple]) -> list[Field]:
    """Fields from (name, start, end[, type]), both ends counted from 1."""
    return [Field(f[0], f[1], f[2] - f[1] + 1, f[3] if len(f) > 3 else "string") for f in fields]


def parse_fixed(lines: DataFrame, spec: Sequence[Field], line: str = "value") -> DataFrame:
    """Cut each line into typed, trimmed columns; blank and unreadable cells are null."""
    rest = [c for c in lines.columns if c != line]
    return lines.select(*rest, *[_cell(F.col(line), f).alias(f.name) for f in spec])


def _cell(line: Column, f: Field) -> Column:
    text = F.trim(F.substring(line, f.start, f.length))
    if f.type == "string":
        return F.nullif(text, F.lit(""))
    if f.type in ("int", "bigint", "long"):
        return whole_number(text, f.type)
    return to_number(text).try_cast(f.type)


def read_fixed(spark: SparkSession, paths, spec: Sequence[Field], year: bool = False) -> DataFrame:
    """Fixed-width files, with the vintage year from the file name when asked."""
    lines = tag_vintage(spark.read.text(paths)) if year else spark.read.text(paths)
    return parse_fixed(lines, spec)


def parse_ragged(lines: DataFrame, fields: Sequence[tuple], line: str = "value") -> DataFrame:
    """Cut messy lines; a field with end None runs to the end of the line. Cells stay text."""
    c = F.col(line)
    rest = [n for n in lines.columns if n != line]
    cut = [
        F.trim(F.substring(c, start, 2**31 - 1 if end is None else end - start + 1)).alias(name)
        for name, start, end in fields
    ]
    return lines.select(*rest, *cut)


def read_lines_sliced(spark: SparkSession, paths, fields: Sequence[tuple]) -> DataFrame:
    return parse_ragged(spark.read.text(paths), fields)
