"""Readers and sinks: given tables written as files to the shared folder and read back."""

import uuid

from pyspark.sql import functions as F

from ..operators.infer import type_census, types_counted
from ..session import shared_dir
from ..sources import infer_then_convert, read_csv, read_fixed, read_grid, read_lines_sliced, read_text_table, read_vintages
from ..sources.fixed_width import by_widths
from ..sources.sinks import note_of, publish, publish_vintages, stage, with_note
from .base import order_year, query, table


def _folder(spark, name: str) -> str:
    return shared_dir(spark, f"settled-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}")


def _written(df, name: str, **options) -> str:
    path = _folder(df.sparkSession, name)
    (df.write.options(**options).csv if len(df.columns) > 1 or options else df.write.text)(path)
    return path


def _yearly_files(df, pattern) -> list[str]:
    """Text files per year (column ``year``) named like the yearly files, by a pattern or a
    function of the year that gives one. A large year is several files; the driver only
    renames them."""
    spark, folder = df.sparkSession, _folder(df.sparkSession, "years")
    pattern = pattern if callable(pattern) else lambda year, fixed=pattern: fixed
    df.hint("rebalance", "year").write.partitionBy("year").text(folder)
    jvm = spark._jvm
    home = jvm.org.apache.hadoop.fs.Path(folder)
    fs = home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for i, f in enumerate(fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/year=*/part-*"))):
        year = int(f.getPath().getParent().getName().removeprefix("year="))
        out.append(f"{folder}/{pattern(year).format(year=year, yy=f'{year % 100:02d}', i=i)}")
        fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(out[-1]))
    return out


CUSTOMER_SQL = "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment || ', \"quoted\"' END AS remark FROM customer"


def _customers(spark, sf):
    remark = F.when(F.col("c_acctbal") >= 0, F.concat("c_mktsegment", F.lit(', "quoted"')))
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", remark.alias("remark"))


@query(f"{CUSTOMER_SQL}")
def csv_read_back(spark, sf):
    path = _written(_customers(spark, sf), "csv", header="true", quote='"', escape='"')
    return read_csv(spark, path, "c_custkey bigint, c_name string, c_acctbal double, remark string")


@query("SELECT c_custkey, c_name || chr(10) || c_mktsegment AS lines FROM customer")
def csv_with_line_breaks(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit("\n"), "c_mktsegment").alias("lines"))
    return read_csv(spark, _written(rows, "csv", header="true", quote='"', escape='"'), "c_custkey bigint, lines string")


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, remark FROM ({CUSTOMER_SQL})")
def text_table_read_back(spark, sf):
    path = _written(_customers(spark, sf).drop("c_acctbal"), "text", header="true", quote='"', escape='"')
    return read_text_table(spark, path)


@query("SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, c_acctbal > 0 AS positive, CAST(DATE '2001-06-30' AS DATE) AS day FROM customer")
def inferred_read_back(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, "TRUE").otherwise("F").alias("positive"), F.lit("2001/6/30").alias("day"))
    return infer_then_convert(spark, _written(rows, "typed", header="true"))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_orderpriority AS priority FROM orders")
def vintages_read_back(spark, sf):
    """Yearly files of one layout in one scan; the year comes from the file's name."""
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderpriority")
    paths = _yearly_files(table(spark, sf, "orders").select(line.alias("value"), order_year()), "{year}indiv_unit_reported_data-{i}.txt")
    rows = read_vintages(spark.read.text, paths)
    cut = F.split("value", r"\|")
    return rows.select("year", F.get(cut, F.lit(0)).cast("long").alias("o_orderkey"), F.get(cut, F.lit(1)).alias("priority"))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, CAST(floor(o_totalprice) AS INTEGER) AS price FROM orders")
def fixed_width_read_back(spark, sf):
    line = F.concat(F.rpad(F.col("o_orderkey").cast("string"), 14, " "), F.lpad(F.floor("o_totalprice").cast("string"), 12, " "))
    paths = _yearly_files(table(spark, sf, "orders").select(line.alias("value"), order_year()), "{yy}ret35-{i}.txt")
    rows = read_fixed(spark, paths, by_widths([14, 12], ["key", "price"], ["string", "int"]), year=True)
    return rows.select("year", F.col("key").cast("long").alias("o_orderkey"), "price")


@query("""
SELECT CAST(s_suppkey // 500 AS BIGINT) AS sheet, CAST(row_number() OVER (PARTITION BY s_suppkey // 500 ORDER BY s_suppkey) + 2 AS BIGINT) AS row_no,
  CAST(s_suppkey AS VARCHAR) AS key, s_name || ', x' AS name, CASE WHEN s_acctbal > 0 THEN 'up' || chr(10) || 'and on' END AS side, CASE WHEN s_suppkey % 7 = 0 THEN 'more' END AS extra
FROM supplier
""")
def grid_read_back(spark, sf):
    """Sheets of 500 rows as CSV with row numbers, after two lines of notes. Cells hold
    commas and line breaks, and some rows have a cell more than the sheet is wide."""
    side = F.when(F.col("s_acctbal") > 0, '" up\nand on "').otherwise(" ")
    more = F.when(F.col("s_suppkey") % 7 == 0, ",more").otherwise("")
    sheet = F.floor(F.col("s_suppkey") / 500).alias("sheet")
    rows = table(spark, sf, "supplier").select(sheet, F.col("s_suppkey").alias("at"), F.concat(
        F.col("s_suppkey").cast("string"), F.lit(',"'), "s_name", F.lit(', x", '), side, more).alias("value"))
    notes = rows.select("sheet").distinct().select("sheet", F.explode(F.array(*[
        F.struct(F.lit(k).cast("long").alias("at"), F.lit(v).alias("value")) for k, v in ((-2, "note"), (-1, "key,name,side"))])).alias("n")).select("sheet", "n.*")
    path = _folder(spark, "grid")
    every = notes.unionByName(rows).repartition("sheet").sortWithinPartitions("sheet", "at")
    every.select("sheet", "value").write.partitionBy("sheet").text(path)
    return read_grid(spark, path, width=3, skip=2).select(
        F.regexp_extract("file", "sheet=([0-9]+)", 1).cast("long").alias("sheet"), "row_no",
        *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(("key", "name", "side", "extra"))])


@query("SELECT c_custkey, c_name AS idname, CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '' END AS pubname FROM customer")
def sliced_lines_read_back(spark, sf):
    public = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise("")
    line = F.concat(F.rpad(F.col("c_custkey").cast("string"), 15, " "), F.rpad("c_name", 85, " "), public)
    path = _written(table(spark, sf, "customer").select(F.rtrim(line).alias("value")), "lines")
    rows = read_lines_sliced(spark, path, [("id", 1, 14), ("idname", 16, 100), ("pubname", 101, None)])
    return rows.select(F.col("id").cast("long").alias("c_custkey"), "idname", "pubname")


YEARLY_SQL = "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice AS price FROM orders"


def _yearly(spark, sf):
    return table(spark, sf, "orders").select(order_year(), "o_orderkey", F.col("o_totalprice").alias("price"))


@query(f"SELECT *, 'orders by year' AS note FROM ({YEARLY_SQL})")
def published_read_back(spark, sf):
    """A published table, with the provenance note that its columns carry."""
    path = _folder(spark, "published")
    publish(_yearly(spark, sf), path, note="orders by year")
    out = spark.read.parquet(path)
    return out.withColumn("note", F.lit(note_of(out.drop("year")))).select("year", "o_orderkey", "price", "note")


@query(f"SELECT year, o_orderkey, CASE WHEN year = 1997 THEN -price ELSE price END AS price FROM ({YEARLY_SQL})")
def vintages_published_again(spark, sf):
    """Only the years that come are overwritten."""
    path = _folder(spark, "vintages")
    publish(_yearly(spark, sf), path)
    publish_vintages(_yearly(spark, sf).where(F.col("year") == 1997).withColumn("price", -F.col("price")), path)
    return spark.read.parquet(path).select("year", "o_orderkey", "price")


@query(f"SELECT year, count(*) AS n, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS price FROM ({YEARLY_SQL}) GROUP BY 1")
def staged_read_back(spark, sf):
    rows = stage(_yearly(spark, sf), f"stage-{uuid.uuid4().hex}", _folder(spark, "stage"))
    return rows.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("price"))


@query("""
SELECT v.variable, v.type, CAST(v.n AS INTEGER) AS of_type, CAST('from customers' AS VARCHAR) AS note, (SELECT count(*) FROM customer) AS rows
FROM (VALUES ('c_custkey', 'bigint', 1), ('c_name', 'string', 2), ('c_acctbal', 'double', 1), ('remark', 'string', 2)) AS v(variable, type, n)
""")
def column_types(spark, sf):
    """Type and note of every column, and how many columns have that type."""
    df = with_note(_customers(spark, sf), "from customers")
    counts, rows = types_counted(df), df.agg(F.count(F.lit(1)).alias("rows"))
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.lit(t).alias("type"), F.lit(counts[t]).alias("of_type")) for c, t in type_census(df).items()]))
    return rows.select(kinds.alias("k"), "rows").select("k.variable", "k.type", "k.of_type", F.lit(note_of(df)).alias("note"), "rows")
