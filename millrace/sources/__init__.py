from millrace.sources.readers import read_all, scan_csv, scan_empty, scan_glob, scan_range, scan_text, table
from millrace.sources.writers import (
    hash_spread, range_layout, route_by_size, route_huge_groups, sink_ranges, sink_routed, sink_sorted_text,
)

__all__ = [
    "hash_spread", "range_layout", "read_all", "route_by_size", "route_huge_groups", "scan_csv", "scan_empty",
    "scan_glob", "scan_range", "scan_text", "sink_ranges", "sink_routed", "sink_sorted_text", "table",
]
