"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(line: Column) -> Column:
    """Array of the words of a line split on single spaces.

    Empty words at the start and inside are kept, those at the end are dropped; a line of blanks has no words
    and an empty line has one empty word.
    """
    body = F.rtrim(line)
    return F.when((line != "") & (body == ""), F.array().cast("array<string>")).otherwise(F.split(body, " ", -1))


def crc32(payload: Column) -> Column:
    """CRC-32 checksum of the bytes (text is taken as UTF-8)."""
    return F.crc32(payload.cast("binary"))


def metric_name(col: Column) -> Column:
    """Dots and dashes as underscores; null as the empty text."""
    return F.coalesce(F.translate(col, ".-", "__"), F.lit(""))


def path_key(*cols: Column) -> Column:
    return F.concat_ws("/", *[c.cast("string") for c in cols])


def range_key(start: Column, end: Column) -> Column:
    return F.concat_ws("-", start.cast("string"), end.cast("string"))


def fmt_ts(epoch_ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC of epoch milliseconds, whatever the session time zone is."""
    seconds = (epoch_ms - F.pmod(epoch_ms, F.lit(1000))) / F.lit(1000)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).cast("string")


def hash_slot(key: Column, slots: Column | int) -> Column:
    """One of ``slots`` places, 0 first, by 60 bits of the MD5 of a text; other systems can compute the same place."""
    number = F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("long")
    return F.pmod(number, slots if isinstance(slots, Column) else F.lit(slots))
