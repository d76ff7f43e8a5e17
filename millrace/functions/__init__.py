from millrace.functions.ids import pack_attempt_id, pack_id, unpack_attempt, unpack_id
from millrace.functions.text import crc32, fmt_ts, hash_slot, metric_name, path_key, range_key, tokens
from millrace.functions.ranges import range_end, range_of, range_start

__all__ = [
    "crc32", "fmt_ts", "hash_slot", "metric_name", "pack_attempt_id", "pack_id", "path_key", "range_end", "range_key",
    "range_of", "range_start", "tokens", "unpack_attempt", "unpack_id",
]
