"""Reading files and generated rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_csv(spark: SparkSession, path: str, ddl: str, **options: str) -> DataFrame:
    """CSV without header under an explicit schema; fields that are missing or do not parse are null."""
    return spark.read.schema(ddl).options(header="false", mode="PERMISSIVE", **options).csv(path)


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """One row (column ``value``) per line."""
    return spark.read.text(path)


def scan_glob(
    spark: SparkSession, folder: str, prefix: str = "", suffix: str = "", fmt: str = "text", schema: str = "value string"
) -> DataFrame:
    """The files of a folder whose names start with ``prefix`` and end with ``suffix``.

    A folder that does not exist reads as empty.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return scan_empty(spark, schema)
    return spark.read.format(fmt).schema(schema).option("pathGlobFilter", f"{prefix}*{suffix}").load(folder)


def scan_range(spark: SparkSession, start: int, end: int, step: int = 1, partitions: int | None = None) -> DataFrame:
    """Ids from ``start`` up to but not including ``end``."""
    return spark.range(start, end, step, partitions)


def scan_empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def read_all(frames: list[DataFrame]) -> DataFrame:
    """Several inputs as one, matched by column name."""
    return reduce(DataFrame.unionByName, frames)
