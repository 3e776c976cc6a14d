"""Text lines and quoted records that keep their place in the file.

A large file is read as many blocks. The place of a line in its file is its place in its
block plus the lines of earlier blocks, so one pass makes an index with one row per block,
and the pass that reads the text meets that index: the text itself is written nowhere and
moved nowhere. Both passes have to cut the files alike, so the number of splits is fixed
for the session before the first, and a block that the index does not know is an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settled

BLOCK = ["file", "block", "length", "part"]
#: Blocks up to which the index goes to every task (some 100 bytes each).
MOST_BLOCKS = 1_000_000


def fix_splits(spark: SparkSession) -> None:
    """Keep the way files are split as it is now: by default it follows the number of
    executors, which may change between two passes."""
    name = "spark.sql.files.minPartitionNum"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism))


def _raw(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Lines of a block share a task, and ``at`` ascends there."""
    fix_splits(spark)
    return spark.read.text(paths, **options).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("length"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )


def _with_index(raw: DataFrame, index: DataFrame, rows: int) -> DataFrame:
    """Lines with the index row of their block. The index is sent to all tasks where its
    size, which is known, allows it."""
    found = raw.join(F.broadcast(index) if rows <= MOST_BLOCKS else index, BLOCK, "left")
    moved = F.raise_error(F.lit("a file was split otherwise than when its lines were counted"))
    return found.withColumn("before", F.when(F.col("before").isNull(), moved).otherwise(F.col("before")))


def _earlier(c: Column) -> Column:
    return F.coalesce(F.sum(c).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, row_no, line) with row_no from 1 in file order."""
    raw = _raw(spark, paths)
    blocks = raw.groupBy(*BLOCK).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("lines"))
    index = settled(blocks.withColumn("before", _earlier(F.col("lines"))).drop("lines"))
    return _with_index(raw, index, index.count()).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("row_no"), "line")


def _record_index(raw: DataFrame, odd: Column) -> DataFrame:
    """One row per block: whether it starts inside a quoted cell (``inside``), whether it
    ends in one, the records that start in it and in earlier blocks.

    A line with an odd number of quotes opens or closes a cell with line breaks. Which of
    them, is not known inside a block, so both cases are counted: ``rest_0`` lines do not
    start a record if the block starts outside, ``rest_1`` if it starts inside. From the
    places of the odd lines, taken in turn as opening and closing, both follow."""
    blocks = raw.groupBy(*BLOCK).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("lines"))
    turn = F.row_number().over(Window.partitionBy(*BLOCK).orderBy("at")) % 2
    odds = raw.where(odd).select(*BLOCK, "at", turn.alias("turn")).groupBy(*BLOCK).agg(
        F.count(F.lit(1)).alias("odds"), F.sum(F.when(F.col("turn") == 1, F.col("at"))).alias("firsts"),
        F.sum(F.when(F.col("turn") == 0, F.col("at"))).alias("seconds"))
    both = blocks.join(odds, BLOCK, "left").na.fill(0, ["odds", "firsts", "seconds"])
    uneven = F.col("odds") % 2
    apart = F.col("seconds") - F.col("firsts") + uneven * F.col("first")  # places count from the block's first line
    both = both.withColumn("rest_0", apart + uneven * (F.col("lines") - 1)).withColumn("rest_1", 1 - apart + (1 - uneven) * (F.col("lines") - 1))
    both = both.withColumn("inside", _earlier(F.col("odds")) % 2).withColumn("starts", F.col("lines") - F.when(F.col("inside") == 1, F.col("rest_1")).otherwise(F.col("rest_0")))
    return both.select(*BLOCK, "first", "odds", "inside", "starts", ((F.col("inside") + F.col("odds")) % 2).alias("open"), _earlier(F.col("starts")).alias("before"))


def numbered_records(spark: SparkSession, paths: str | Sequence[str], quote: str = '"') -> DataFrame:
    """(file, row_no, line): the records of delimited text, from 1 in file order. A record
    is a line, or several where a quoted cell holds line breaks, which are kept. Quotes
    stand around cells, and twice inside them; a file that ends inside a cell is an error.

    Records are put together inside their block. Blocks without such cells are read as
    they are; only the pieces of a record that runs over the edge of a block are moved to
    each other, so any split of a file gives the same records."""
    raw = _raw(spark, paths, lineSep="\n")
    odd = (F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))) % 2 == 1
    index = settled(_record_index(raw, odd))
    cut = index.groupBy("file").agg(F.sum("odds").alias("odds")).where("odds % 2 = 1").limit(1).collect()
    if cut:
        raise ValueError(f"{cut[0]['file']} ends inside a quoted cell")
    about = index.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("odds"), F.lit(0)).alias("odds")).first()
    rows = _with_index(raw, index, about["blocks"])
    whole = rows.where("odds = 0 and inside = 0").select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("row_no"), "line")
    return _trimmed(whole if not about["odds"] else whole.unionByName(_joined(rows.where("odds > 0 or inside = 1"), odd)))


def _joined(rows: DataFrame, odd: Column) -> DataFrame:
    order = Window.partitionBy("file", "block").orderBy("at")
    earlier = F.coalesce(F.sum(odd.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("starting", ((F.col("inside") + earlier) % 2 == 0).cast("int"))
    rows = rows.withColumn("row_no", F.col("before") + F.sum("starting").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = (F.col("row_no") == F.col("before") + F.col("starts")) & (F.col("open") == 1)
    edge = ((F.col("row_no") == F.col("before")) | last).alias("edge")

    def put_together(by: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, "line"))), lambda x: x["line"]), "\n").alias("line")

    pieces = rows.select("file", "block", "row_no", edge, "at", "line").groupBy("file", "block", "row_no", "edge").agg(put_together("at"))
    over = pieces.where("edge").groupBy("file", "row_no").agg(put_together("block"))
    return pieces.where("not edge").select("file", "row_no", "line").unionByName(over)


def _trimmed(rows: DataFrame) -> DataFrame:
    """Without the other half of a line end, and without a mark of the byte order."""
    line = F.regexp_replace("line", "\r$", "")
    return rows.withColumn("line", F.when(F.col("row_no") == 1, F.ltrim(line, F.lit("﻿"))).otherwise(line))
