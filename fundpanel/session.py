"""Session helpers shared by the readers and operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .provenance import kept_schema

_kept: set[str] = set()


def local_session(cpus: int | str = 8, app: str = "fundpanel") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # else each column expression asks the JVM for its place
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str | None:
    """The checkpoint folder the cluster names in its settings, or the one set on the
    context where it names none."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def on_one_machine(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")


def shared_dir(spark: SparkSession, name: str) -> str:
    """Folder below the shared checkpoint folder. Where none is set, as in tests, a
    session on one machine gets a temporary one; a cluster must name its own."""
    root = shared_root(spark)
    if not root:
        if not on_one_machine(spark):
            raise ValueError("spark.checkpoint.dir is not set; name a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fundpanel-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}"


def settled(df: DataFrame) -> DataFrame:
    """Input that several jobs or branches read: written once to the shared folder, and
    read from there. The copy outlives an executor, readers prune its columns, and
    Catalyst knows its size. Copies go with the application, or by ``clear_settled``."""
    spark = df.sparkSession
    folder = _folder(spark)
    if folder not in _kept:
        _kept.add(folder)
        atexit.register(_remove, spark, folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(kept_schema(df)).parquet(path)


def clear_settled(spark: SparkSession) -> None:
    """Remove all copies of this application; tables that read them are then gone."""
    _remove(spark, _folder(spark))


def _folder(spark: SparkSession) -> str:
    return shared_dir(spark, f"settled-{spark.sparkContext.applicationId}")


def _remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    if context._jsc is not None and not context._jsc.sc().isStopped():
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
