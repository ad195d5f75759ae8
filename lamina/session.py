"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def local_session(app: str = "lamina", cores: str = "8", shuffle_partitions: str = "8") -> SparkSession:
    """A local session for tests and benchmarks. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def make_active(spark: SparkSession) -> None:
    """Let Spark know the session of a new thread, where it looks up data sources registered in Python."""
    SparkSession._get_j_spark_session_class(spark._jvm).setActiveSession(spark._jsparkSession)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as named by ``spark.checkpoint.dir``.

    Only a local master may do without the setting: there a temporary folder is
    visible to every task.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="lamina-")
    return _local_folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/lamina/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result has no lineage behind it, so a lost executor costs a re-read and
    not a re-computation, and every reader sees the same rows.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder on the shared file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


@contextmanager
def temporary(df: DataFrame, label: str, compression: str | None = None) -> Iterator[DataFrame]:
    """``materialize`` for as long as the block runs."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    try:
        df.write.parquet(path, compression=compression)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        discard(spark, path)
