from profile_lake.functions.columns import (
    cap_bytes,
    duration_ms,
    epoch_micros,
    fingerprint,
    micros_to_ntz,
    partition_keys,
    period_start,
    period_text,
    rfc3339_from_millis,
    rfc3339_to_timestamp,
)
from profile_lake.functions.histogram import le_histogram
from profile_lake.functions.ordered import bucket_of, prefix_by_bucket, running_rank

__all__ = [
    "bucket_of",
    "cap_bytes",
    "duration_ms",
    "epoch_micros",
    "fingerprint",
    "le_histogram",
    "micros_to_ntz",
    "partition_keys",
    "period_start",
    "period_text",
    "prefix_by_bucket",
    "rfc3339_from_millis",
    "rfc3339_to_timestamp",
    "running_rank",
]
