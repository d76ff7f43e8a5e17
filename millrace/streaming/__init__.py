from millrace.streaming.run import drain, drain_counted, fold_batches, latest, stream_table
from millrace.streaming.builtin import idle_stream, st_dedupe, split_rejected, totals
from millrace.streaming.folds import (
    counter_state, follow_quotas, quota, quota_admit, read_quotas, retry_counter, size_batches, with_list,
)
from millrace.streaming.history import dedupe_ever
from millrace.streaming.liveness import liveness, liveness_at

__all__ = [
    "counter_state", "dedupe_ever", "drain", "drain_counted", "fold_batches", "follow_quotas", "idle_stream", "latest", "liveness", "liveness_at", "quota",
    "quota_admit", "read_quotas", "retry_counter", "size_batches", "split_rejected", "st_dedupe", "stream_table",
    "totals", "with_list",
]
