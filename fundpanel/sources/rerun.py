"""Published sets of which only changed vintages are computed again.

A set is a folder with data folders, one for each run, and versions. A version is a small
table (vintage, folder, fingerprint) that says which folder holds a vintage and what its
input looked like. A run compares the input's fingerprints with those of the newest
version, computes the vintages that differ, writes them to a folder of their own, and only
then a new version. Readers take the newest version that was written to its end, so a run
that is lost at any point leaves the old set whole. Nothing is renamed or overwritten."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "vintage string, folder string, fingerprint string"


def row_fingerprints(df: DataFrame, vintage: str) -> DataFrame:
    """(vintage, fingerprint) of a table's rows, in any order and split: their number and
    the sums of two hashes."""
    hashes = [F.sum(F.xxhash64(*([F.lit(seed)] + df.columns)).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    mark = F.concat_ws(":", F.count(F.lit(1)).cast("string"), *hashes)
    return df.groupBy(F.col(vintage).cast("string").alias("vintage")).agg(mark.alias("fingerprint"))


def file_fingerprints(files: DataFrame, vintage: str = "year") -> DataFrame:
    """(vintage, fingerprint) of a manifest's files, from names, sizes and times."""
    one = F.xxhash64("file", "size", "changed").cast("decimal(38,0)")
    mark = F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(one).cast("string"))
    return files.groupBy(F.col(vintage).cast("string").alias("vintage")).agg(mark.alias("fingerprint"))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that were written to their end."""
    jvm = spark._jvm
    found = jvm.org.apache.hadoop.fs.Path(f"{path}/versions/*/_SUCCESS")
    fs = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(int(f.getPath().getParent().getName()) for f in fs.globStatus(found) or [])


def current(spark: SparkSession, path: str) -> DataFrame:
    """(vintage, folder, fingerprint) of the newest version; no rows where there is none."""
    numbers = _versions(spark, path)
    if not numbers:
        return spark.createDataFrame([], VERSION)
    return spark.read.schema(VERSION).parquet(f"{path}/versions/{numbers[-1]}")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The vintages of the newest version; those without rows have no folder."""
    folders = sorted(r["folder"] for r in current(spark, path).where("folder is not null").collect())  # one row per vintage
    if not folders:
        raise ValueError(f"nothing is published in {path}")
    return spark.read.parquet(*[f"{path}/{f}" for f in folders])


def rerun(spark: SparkSession, path: str, fingerprints: DataFrame, compute: Callable[[Sequence[str]], DataFrame], vintage: str) -> list[str]:
    """Compute the vintages whose input is new or changed, and publish them with the kept
    ones; vintages whose input is gone are left out. Returns what was computed.
    ``compute`` gets their names and returns their rows; rows of other vintages do not
    count."""
    numbers = _versions(spark, path)
    old = {r["vintage"]: r for r in current(spark, path).collect()}
    new = {r["vintage"]: r["fingerprint"] for r in fingerprints.collect()}  # one row per vintage
    changed = sorted(v for v, mark in new.items() if v not in old or old[v]["fingerprint"] != mark)
    if not changed and set(new) == set(old):
        return []
    run, filled = f"data/{uuid.uuid4().hex}", set()
    if changed:
        place = F.array_position(F.lit(changed), F.col(vintage).cast("string")).alias("_place")
        own = compute(changed).select("*", place).where("_place > 0")
        own.hint("rebalance", "_place").write.partitionBy("_place").parquet(f"{path}/{run}")
        filled = {r["_place"] for r in spark.read.parquet(f"{path}/{run}").select("_place").distinct().collect()}
    kept = [(v, old[v]["folder"], new[v]) for v in new if v not in changed]
    done = [(v, f"{run}/_place={k}" if k in filled else None, new[v]) for k, v in enumerate(changed, 1)]
    number = numbers[-1] + 1 if numbers else 1
    spark.createDataFrame([*kept, *done], VERSION).coalesce(1).write.parquet(f"{path}/versions/{number}")
    return changed
