from tickflow.sources.files import messages_from_files
from tickflow.sources.kafka import (
    kafka_options,
    metrics_and_alerts,
    read_messages,
    stream_messages,
)

__all__ = [
    "kafka_options",
    "messages_from_files",
    "metrics_and_alerts",
    "read_messages",
    "stream_messages",
]
