"""Size checks that decide between two exact plans.

Nothing here changes a result: below a limit the short plan runs, above it the plan that splits the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import persist_table

# Rows of one group that a single task sorts and scans comfortably.
GROUP_ROWS = 4_000_000
# Bytes of one group that a single task sorts and scans: it may hold them several times.
GROUP_BYTES = 128 << 20
# Rows (ids and a few narrow columns) that may be copied to every executor.
BROADCAST_ROWS = 100_000
# Bytes of their values, at most.
BROADCAST_BYTES = 64 << 20


def group_row_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.millrace.groupRows", str(GROUP_ROWS)))


def group_byte_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.millrace.groupBytes", str(GROUP_BYTES)))


def broadcast_row_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.millrace.broadcastRows", str(BROADCAST_ROWS)))


def broadcast_byte_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.millrace.broadcastBytes", str(BROADCAST_BYTES)))


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: lengths of texts and binaries, the JSON text of nested values, the width of the others."""
    total = F.lit(0).cast("long")
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            width = F.octet_length(column)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            width = F.octet_length(F.to_json(F.struct(column)))
        else:
            width = F.lit(16 if isinstance(kind, T.DecimalType) else 8)
        total = total + F.coalesce(width.cast("long"), F.lit(0)) + 8
    return total


def width(column: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes in a row that is sorted, about; the fields of a struct are looked at one by one."""
    if isinstance(kind, T.StructType):
        return sum((width(column[f.name], f.dataType) for f in kind.fields), F.lit(8).cast("long"))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column).cast("long"), F.lit(0)) + 8
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))).cast("long"), F.lit(0)) + 8
    return F.lit(16 if isinstance(kind, T.DecimalType) else 8).cast("long")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is small in rows and in bytes; reads the widths of its first rows, as ``has_at_most`` reads rows."""
    rows, size = broadcast_row_limit(df.sparkSession), broadcast_byte_limit(df.sparkSession)
    widths = df.select(row_bytes(df)).take(rows + 1)
    return len(widths) <= rows and sum(w[0] for w in widths) <= size


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows.

    Spark takes rows from few partitions first and stops once the answer is known.
    """
    return len(df.select(F.lit(1)).take(rows + 1)) <= rows


def small_side(df: DataFrame, computed: bool = False) -> DataFrame:
    """``df`` with a broadcast hint if its rows and bytes are proven few, else unchanged (shuffle join, AQE skew handling).

    ``computed`` says that ``df`` is costly to derive: it is then written once, so the check does not run it twice.
    """
    if computed:
        df = persist_table(df, "side")
    return F.broadcast(df) if fits_broadcast(df) else df


def key_set(df: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys of ``df``, with a broadcast hint if ``df`` itself is small.

    The check reads the rows as they are: finding the distinct ones first would be a pass over all of them.
    """
    found = df.select(*keys)
    small = fits_broadcast(found)
    return F.broadcast(found.distinct()) if small else found.distinct()


def biggest_group(df: DataFrame, keys: list[str]) -> int:
    """Row count of the largest group; reads the key columns only and combines before the shuffle."""
    if not keys:
        return df.count()
    # The largest by a top-1, which needs no second shuffle.
    most = df.groupBy(*keys).count().orderBy(F.desc("count")).limit(1).collect()
    return most[0]["count"] if most else 0


def heaviest_group(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Row count of the group with the most rows, and bytes of the one with the most bytes, about; combines before the shuffle."""
    wide = sum((width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0).cast("long"))
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.sum(wide).alias("_bytes"))
    rows, size = groups.agg(F.max("_rows"), F.max("_bytes")).first()
    return rows or 0, size or 0
