"""Which layout a yearly file has, from a table of rules over the file listing.

A rule is a row (first, last, pattern, layout): files of the years from first to last are
named by the pattern, in which ``{year}`` stands for four digits, ``{yy}`` for two and
``*`` for anything. Rules are data: a new vintage is a new row. A file that no rule knows,
or that two know, is a row of ``manifest_problems`` and stops ``read_manifest``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import numbered_lines, numbered_records
from .vintages import ITEM_FILES, SURVEY_FILES, TABLE_FILES, UNIT_FILES

#: Files named in an error; all of them are rows of ``manifest_problems``.
NAMED = 10


def known_rules(spark: SparkSession) -> DataFrame:
    """The rules of the yearly files; names may go on behind what a rule says, such as by a
    table's number or an ending."""
    layouts = {"unit": UNIT_FILES, "table": TABLE_FILES, "item": ITEM_FILES, "survey": SURVEY_FILES}
    rows = [(first, last, f"{pattern}*", layout) for layout, rules in layouts.items() for first, last, pattern in rules]
    return spark.createDataFrame(rows, "first int, last int, pattern string, layout string")


def listed_files(spark: SparkSession, paths) -> DataFrame:
    """(file, name, size, changed) of all files below some paths; no content is read, and
    files without content are not listed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.select(
        F.col("_metadata.file_path").alias("file"), _decoded(F.col("_metadata.file_name")).alias("name"),
        F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("changed"))


def _decoded(c: Column) -> Column:
    """A name as it is in the folder: Spark's metadata writes it as part of an address."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def _expression(pattern: Column) -> Column:
    """A name pattern as a regular expression with the year's digits as its group."""
    plain = F.regexp_replace(pattern, r"([.\\+?()\[\]^$|])", r"\\$1")
    free = F.replace(plain, F.lit("*"), F.lit(".*"))
    year = F.replace(F.replace(free, F.lit("{year}"), F.lit("([0-9]{4})")), F.lit("{yy}"), F.lit("([0-9]{2})"))
    return F.concat(F.lit("^"), year, F.lit("$"))


def _year(digits: Column, first: Column, last: Column) -> Column:
    """Two digits are the year of that ending between first and last."""
    number = digits.try_cast("int")
    century = F.floor(first / 100) * 100 + number
    short = F.when(century < first, century + 100).otherwise(century)
    year = F.when(F.length(digits) == 4, number).otherwise(short).cast("int")
    return F.when((year >= first) & (year <= last), year)


def matched(files: DataFrame, rules: DataFrame) -> DataFrame:
    """(file, name, size, changed, year, layout): a row for every rule that knows a file,
    and one with null year and layout for a file that none knows. The rules, a handful of
    rows, meet every name."""
    rules = rules.select(
        F.col("first").cast("int").alias("_first"), F.coalesce(F.col("last").cast("int"), F.lit(9999)).alias("_last"),
        _expression(F.col("pattern")).alias("_expression"), "layout")
    digits = F.call_function("regexp_extract", F.col("name"), F.col("_expression"), F.lit(1))
    year = _year(digits, F.col("_first"), F.col("_last"))
    hits = F.rlike(F.col("name"), F.col("_expression")) & year.isNotNull()
    return files.join(rules, hits, "left").withColumn("year", F.when(F.col("_first").isNotNull(), year)).drop("_first", "_last", "_expression").select(
        *files.columns, "year", "layout")


def manifest_problems(found: DataFrame) -> DataFrame:
    """(file, name, problem, layouts) of files that no rule or several rules know."""
    own = found.groupBy("file", "name").agg(F.count("layout").alias("n"), F.sort_array(F.collect_list("layout")).alias("layouts"))
    problem = F.when(F.col("n") == 0, "no rule").when(F.col("n") > 1, "several rules")
    return own.withColumn("problem", problem).where(F.col("problem").isNotNull()).select("file", "name", "problem", "layouts")


def read_manifest(spark: SparkSession, paths, rules: DataFrame, layouts: Mapping[str, Callable[[DataFrame], DataFrame]],
                  records: bool = False) -> DataFrame:
    """All files below some paths, each read by its layout: a function of the lines (file,
    year, row_no, line) that returns columns. Results are stacked by name; a column that a
    layout lacks is null. One scan for each layout, with the year of a line from the
    manifest. ``records``: quoted cells may hold line breaks."""
    found = matched(listed_files(spark, paths), rules).cache()
    try:
        wrong = manifest_problems(found).orderBy("name").limit(NAMED).collect()
        if wrong:
            raise ValueError("; ".join(f"{r['name']}: {r['problem']} {r['layouts']}" for r in wrong))
        files = found.select("file", _decoded(F.col("file")).alias("path"), "year", "layout").orderBy("layout", "file").collect()  # one row per yearly file
    finally:
        found.unpersist()
    unread = {f["layout"] for f in files} - set(layouts)
    if unread:
        raise ValueError(f"no reader for the layouts {sorted(unread)}")
    out = None
    for layout, read in layouts.items():
        own = [f for f in files if f["layout"] == layout]
        if not own:
            continue
        years = spark.createDataFrame([(f["file"], f["year"]) for f in own], "file string, year int")
        names = [f["path"] for f in own]
        lines = numbered_records(spark, names) if records else numbered_lines(spark, names)
        part = read(lines.join(years, "file"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no files below {paths}")
    return out
