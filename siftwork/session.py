"""Sessions, the folder that driver and executors share, and tables that are staged there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "siftwork", **settings: str) -> SparkSession:
    """A session with adaptive execution and UTC; master and memory come from the caller or the cluster."""
    b = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    for key, value in settings.items():
        b = b.config(key.replace("__", "."), value)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset, a temporary folder of our own on a local master (tests).

    On a cluster a folder of the driver's machine would lose data, so there an unset folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="siftwork-")
        spark.sparkContext.setCheckpointDir(folder)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Spark's setting that has the shuffle files of a query go when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once as Parquet into the shared folder and returns what was written, with its lineage cut.

    The shuffle files of the write go when it ends: nothing but the written table is read afterwards. The table goes
    when the application ends, or before by ``discard``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/siftwork/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    drop_at_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Has ``path`` deleted when the application ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables that later staged tables have been made from and that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._staged_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
