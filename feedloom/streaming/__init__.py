"""Growing feeds."""

from feedloom.streaming.deltas import fold, read_merged, stream_deltas
from feedloom.streaming.refresh import (
    Days,
    daily_backfill,
    left_out,
    read_refreshed,
    run_until,
    stream_backfill,
    stream_dedupe,
    stream_dedupe_within,
    stream_files,
    stream_refresh,
)

__all__ = [
    "Days", "daily_backfill", "fold", "left_out", "read_merged", "read_refreshed", "run_until", "stream_backfill", "stream_dedupe",
    "stream_dedupe_within", "stream_deltas", "stream_files", "stream_refresh",
]
