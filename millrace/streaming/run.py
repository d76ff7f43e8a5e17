"""Running streams: file source, sinks in the shared folder, and state that is a table.

``fold_batches`` is for state that built-in streaming aggregates cannot hold.  Each micro-batch is an ordinary
DataFrame, combined with the state table the previous one left, so the batch operators and their handling of large
groups apply.  Output and state are written under the batch number: a batch that runs again after a failure
replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import scratch_path


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """The Parquet files ``name*.parquet`` of a folder as a stream; timestamps without zone are read as UTC."""
    schema = spark.read.option("pathGlobFilter", f"{name}*.parquet").parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Run an append-mode stream over all input there is and return what it wrote."""
    return drain_counted(stream, label)[0]


def drain_counted(stream: DataFrame, label: str) -> tuple[DataFrame, int]:
    """As ``drain``, with the number of rows that came after the watermark and were dropped by a stateful operator."""
    spark = stream.sparkSession
    base = scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    late = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    return spark.read.schema(stream.schema).parquet(f"{base}/out"), late


def latest(stream: DataFrame, label: str) -> DataFrame:
    """Run an aggregating stream over all input there is and return its last complete result."""
    spark = stream.sparkSession
    base = scratch_path(spark, label)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/{number}")
        _drop(batch.sparkSession, f"{base}/out/{number - 2}")

    query = (
        stream.writeStream.outputMode("complete").foreachBatch(keep)
        .option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return _last(spark, f"{base}/out", stream.schema)


Step = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def fold_batches(
    stream: DataFrame, step: Step, output: T.StructType | str, state: T.StructType | str, label: str
) -> tuple[DataFrame, DataFrame]:
    """Run ``step(batch, state) -> (output, new state)`` for every micro-batch of all input there is.

    Returns the output of all batches and the final state.
    """
    spark = stream.sparkSession
    base = scratch_path(spark, label)
    output, state = _schema(output), _schema(state)

    def handle(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        prior = _read(session, f"{base}/state/{number - 1}", state)
        batch.persist()
        out, after = step(batch, prior)
        _as(after, state).write.mode("overwrite").parquet(f"{base}/state/{number}")
        _as(out, output).write.mode("overwrite").parquet(f"{base}/out/{number}")
        batch.unpersist()
        _drop(session, f"{base}/state/{number - 2}")

    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{base}/progress")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return _read(spark, f"{base}/out/*", output, f"{base}/out"), _last(spark, f"{base}/state", state)


def _schema(ddl: T.StructType | str) -> T.StructType:
    parsed = ddl if isinstance(ddl, T.StructType) else T._parse_datatype_string(ddl)
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in parsed])


def _as(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _path(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _read(spark: SparkSession, path: str, schema: T.StructType, folder: str | None = None) -> DataFrame:
    where, system = _path(spark, folder or path)
    if not system.exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _last(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    where, system = _path(spark, folder)
    if not system.exists(where):
        return spark.createDataFrame([], schema)
    numbers = [int(s.getPath().getName()) for s in system.listStatus(where)]
    return _read(spark, f"{folder}/{max(numbers)}", schema)


def _drop(spark: SparkSession, path: str) -> None:
    where, system = _path(spark, path)
    if system.exists(where):
        system.delete(where, True)
