from profile_lake.sinks.jsonl import to_jsonl
from profile_lake.sinks.table import (
    FallbackWriter,
    Sink,
    read_fallback,
    read_flush_log,
    sink_for,
    write_profiles,
    write_records,
)

__all__ = [
    "FallbackWriter",
    "Sink",
    "read_fallback",
    "read_flush_log",
    "sink_for",
    "to_jsonl",
    "write_profiles",
    "write_records",
]
