"""De-duplication against everything that ever came, however late."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming.run import _drop, _path, _read, _schema

# Buckets of the history; folders are joined up after so many micro-batches.
BUCKETS, JOIN_UP = 256, 16


class History:
    """A table of keys in buckets by hash: one folder per micro-batch, joined up from time to time.

    A folder is named by the first and last micro-batch it covers and counts once its writer has finished, so a
    micro-batch that runs again sees what it saw before and replaces what it wrote.
    """

    def __init__(self, spark: SparkSession, path: str, schema):
        self.spark, self.path = spark, path
        self.schema = schema

    def folders(self, before: int) -> list[tuple[int, int]]:
        """(first, last) of the fewest finished folders that hold all keys of the micro-batches below ``before``."""
        where, system = _path(self.spark, self.path)
        if not system.exists(where):
            return []
        names = [s.getPath().getName() for s in system.listStatus(where)]
        done = [n for n in names if system.exists(_path(self.spark, f"{self.path}/{n}/_SUCCESS")[0])]
        spans = sorted((tuple(int(x) for x in n.split("-")) for n in done), key=lambda s: (s[0], -s[1]))
        chosen, at = [], 0
        for first, last in spans:
            if first >= at and last < before:
                chosen.append((first, last))
                at = last + 1
        return chosen

    def read(self, before: int, buckets: list[int] | None = None) -> DataFrame:
        """The keys of earlier micro-batches, of some buckets only: other buckets' files are not opened."""
        parts = [self.spark.read.schema(self.schema).parquet(f"{self.path}/{a}-{b}") for a, b in self.folders(before)]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionAll(part)
        return whole if buckets is None else whole.where(F.col("_bucket").isin(buckets))

    def write(self, keys: DataFrame, first: int, last: int) -> None:
        # One file for each bucket that is met.
        keys.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/{first}-{last}")

    def join_up(self, before: int) -> None:
        """Write the folders of earlier micro-batches as one, then drop them."""
        old = self.folders(before)
        if len(old) > 1:
            first, last = old[0][0], old[-1][1]
            self.write(self.read(before), first, last)
            for a, b in old:
                _drop(self.spark, f"{self.path}/{a}-{b}")


def dedupe_ever(
    stream: DataFrame, keys: list[str], order: list[str] | None = None, buckets: int = BUCKETS, join_up: int = JOIN_UP
) -> DataFrame:
    """Each key once over all input there is, also if its row is older than any watermark would allow.

    Of a key's rows in one micro-batch the first by ``order`` is kept (any, if not given).  A micro-batch is compared with
    the history of the buckets its keys fall in.  Null keys are keys like others.
    """
    spark = stream.sparkSession
    base = scratch_path(spark, "dedupe")
    named = [f"_k{i}" for i in range(len(keys))]
    kinds = ", ".join(f"{n} {stream.schema[k].dataType.simpleString()}" for n, k in zip(named, keys, strict=True))
    history = History(spark, f"{base}/history", _schema(f"{kinds}, _bucket int"))
    output = _schema(stream.schema)

    def handle(batch: DataFrame, number: int) -> None:
        history.spark = batch.sparkSession
        placed = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        if order:
            least = F.min_by(F.struct(*batch.columns), F.struct(*order))
        else:
            least = F.first(F.struct(*batch.columns))
        once = placed.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)], "_bucket").agg(least.alias("_row")).persist()
        # At most ``buckets`` numbers.
        met = [r["_bucket"] for r in once.select("_bucket").distinct().collect()]
        seen = history.read(number, met).select(*[F.col(n).alias("_h" + n) for n in named], F.col("_bucket").alias("_h_bucket"))
        same = F.col("_bucket") == F.col("_h_bucket")
        for n in named:
            same = same & F.col(n).eqNullSafe(F.col("_h" + n))
        fresh = once.join(seen, same, "left_anti").persist()
        fresh.select("_row.*").write.mode("overwrite").parquet(f"{base}/out/{number}")
        history.write(fresh.select(*named, "_bucket"), number, number)
        fresh.unpersist()
        once.unpersist()
        if number % join_up == join_up - 1:
            history.join_up(number)

    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return _read(spark, f"{base}/out/*", output, f"{base}/out")
