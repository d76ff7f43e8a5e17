"""Session settings and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Settings the operators are tuned for.  All are plain Spark settings; none is required for right results.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Sessions of a busy entity are merged in each map task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Whether Spark deletes a query's shuffle files when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app: str = "millrace", **extra: str) -> SparkSession:
    """A session with SETTINGS; ``extra`` keys use ``__`` for dots, e.g. ``spark__ui__enabled='false'``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    On a cluster this is what ``spark.checkpoint.dir`` names, a file system all executors see.  Only a local
    session, where one machine runs everything, falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/millrace/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in this application's part of the shared folder."""
    return f"{_run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote for its own use; results that read from it are void afterwards."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def persist_table(df: DataFrame, label: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used where several passes must see exactly the same rows and row placement, also after executors are lost.  With
    ``tidy`` the shuffle files of the write go when it ends; else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEAN_UP, None)
    try:
        if tidy:
            spark.conf.set(CLEAN_UP, "true")
        df.write.parquet(path)
    finally:
        if tidy and before is None:
            spark.conf.unset(CLEAN_UP)
        elif tidy:
            spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the table that ``persist_table`` gave; results that are still to be computed from it are void afterwards."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if _run_folder(spark).split(":", 1)[-1].lstrip("/") in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship_with_tasks(module: str) -> None:
    """Send the functions of a module along with the tasks that use them, so executors need not install it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
