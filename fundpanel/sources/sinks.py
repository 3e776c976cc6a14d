"""Published and staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..provenance import carry_notes, note_of, with_note
from ..session import shared_dir

__all__ = ["note_of", "publish", "publish_vintages", "stage", "with_note"]


def publish(df: DataFrame, path: str, partition: str | None = "year", note: str | None = None) -> None:
    """Overwrite a published table. The rebalance splits a year that holds much of
    the data over several tasks and files, and merges small ones. Columns carry the notes
    of the inputs they come from, or the one that is given."""
    df = with_note(df, note) if note else carry_notes(df)
    if partition is None:
        df.write.mode("overwrite").parquet(path)
        return
    df.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(path)


def publish_vintages(df: DataFrame, path: str, partition: str = "year") -> None:
    """Overwrite only the years that are in the data; the others stay."""
    (carry_notes(df).hint("rebalance", partition).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back, which
    cuts the lineage at a place that outlives an executor."""
    spark: SparkSession = df.sparkSession
    path = path or shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
