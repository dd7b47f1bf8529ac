from tickflow.streaming.job import start_ingest, start_job, start_serving
from tickflow.streaming.serving import (
    compact_log,
    display,
    read_counts,
    read_log,
    read_shown,
    refresh,
    result_stream,
    start_log,
    start_new_alerts,
)
from tickflow.streaming.seen import SeenStore
from tickflow.streaming.sinks import (
    append_files,
    await_any,
    newest_batch,
    publish,
    start_batches,
    start_console,
    start_fan_out,
    start_files,
    start_kafka,
    write_kafka,
)
from tickflow.streaming.state import held_windows, state_operators

__all__ = [
    "SeenStore",
    "append_files",
    "await_any",
    "compact_log",
    "display",
    "held_windows",
    "newest_batch",
    "publish",
    "read_counts",
    "read_log",
    "read_shown",
    "refresh",
    "result_stream",
    "start_batches",
    "start_console",
    "start_fan_out",
    "start_files",
    "start_ingest",
    "start_job",
    "start_kafka",
    "start_log",
    "start_new_alerts",
    "start_serving",
    "state_operators",
    "write_kafka",
]
