"""Writing tables."""

from feedloom.sinks.merge import (
    insert_new,
    merge_upsert,
    replace_by_key,
    replace_by_window,
    replace_tail,
    replace_where,
    verify_unique,
)
from feedloom.sinks.tables import (
    append,
    export_delimited,
    fan_out,
    full_refresh,
    log_run,
    path_exists,
    read_if_there,
    replace_partitions,
    replace_window_in_place,
    rewrite,
    run_logged,
    swap_partitions,
)

__all__ = [
    "append", "export_delimited", "fan_out", "full_refresh", "insert_new", "log_run",
    "merge_upsert", "path_exists", "read_if_there", "replace_by_key", "replace_by_window", "replace_partitions",
    "replace_tail", "replace_where", "replace_window_in_place", "rewrite", "run_logged", "swap_partitions", "verify_unique",
]
