"""Delimited text: typed, all text, and raw grids without a trusted header."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.infer import convert, infer_types
from ..session import settled
from .lines import numbered_lines, numbered_records

QUOTED = {"quote": '"', "escape": '"', "multiLine": "true"}


def read_csv(spark: SparkSession, paths, schema: T.StructType | str, header: bool = True, line_breaks: bool = True) -> DataFrame:
    """CSV with a declared schema; a cell that does not fit its type is null. Quoted cells
    may hold line breaks, and a file is many tasks all the same (``numbered_records``).
    Without ``line_breaks`` every line is a row, and quotes may stand anywhere."""
    if not line_breaks:
        return spark.read.schema(schema).csv(paths, header=header, quote='"', escape='"')
    rows = _filled(numbered_records(spark, paths))
    return _parsed(rows.where("row_no > 1") if header else rows, schema).select("_row.*")


def read_text_table(spark: SparkSession, paths, line_breaks: bool = True, file: str | None = None) -> DataFrame:
    """CSV with a header and every column kept as text. Columns are those of the first
    file; ``file`` names a column for the file a row comes from."""
    rows = numbered_records(spark, paths) if line_breaks else numbered_lines(spark, paths)
    first = rows.where("row_no = 1").orderBy("file").limit(1).select("line").collect()  # one header line
    names = _names(next(csv.reader([first[0]["line"]])) if first else [])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if not names:
        return spark.createDataFrame([], T.StructType([T.StructField(file, T.StringType())] if file else []))
    out = _parsed(_filled(rows).where("row_no > 1"), schema)
    return out.select("_row.*", *([F.col("file").alias(file)] if file else []))


def infer_then_convert(spark: SparkSession, paths, line_breaks: bool = True) -> DataFrame:
    """CSV with the types its cells have. The text is read once: a copy in columns serves
    inference and conversion."""
    df = settled(read_text_table(spark, paths, line_breaks))
    return convert(df, infer_types(df))


def _filled(rows: DataFrame) -> DataFrame:
    return rows.where(F.trim("line") != "")


def _parsed(rows: DataFrame, schema: T.StructType | str) -> DataFrame:
    if isinstance(schema, T.StructType):
        schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select("file", F.from_csv("line", schema, QUOTED).alias("_row"))


def _names(cells: list[str]) -> list[str]:
    """Column names of a header: a blank one is named by its place, repeated ones get
    their place behind them."""
    folded = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if folded.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def read_grid(spark: SparkSession, paths, width: int, skip: int = 0, line_breaks: bool = True) -> DataFrame:
    """Sheets delivered as CSV: (file, row_no, cells), no header assumed. A row is a
    record, which may hold line breaks in quoted cells."""
    rows = numbered_records(spark, paths) if line_breaks else numbered_lines(spark, paths)
    return to_grid(rows, width).where(F.col("row_no") > skip)


def to_grid(lines: DataFrame, width: int, line: str = "line") -> DataFrame:
    """Split CSV records into an array of trimmed text cells; blanks are null. Rows are
    filled up to ``width`` cells; a row with more keeps them all."""
    found = F.regexp_extract_all(F.col(line), F.lit(r'(?:^|,)(\s*"[^"]*(?:""[^"]*)*"[^,]*|[^,]*)'), F.lit(1))
    cells = F.transform(found, _bare)
    rest = [c for c in lines.columns if c != line]
    rows = lines.select(*rest, cells.alias("cells"))
    short = F.greatest(F.lit(width) - F.size("cells"), F.lit(0))
    return rows.withColumn("cells", F.concat("cells", F.array_repeat(F.lit(None).cast("string"), short)))


def _bare(cell: Column) -> Column:
    """A cell without its quotes and outer blanks."""
    text = F.trim(cell)
    inner = F.replace(F.regexp_extract(text, r'(?s)^"(.*)"$', 1), F.lit('""'), F.lit('"'))
    return F.nullif(F.trim(F.when(text.rlike(r'(?s)^".*"$'), inner).otherwise(text)), F.lit(""))
