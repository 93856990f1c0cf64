from profile_lake.sources.listing import decode_listings, parse_query_detail, split_bad
from profile_lake.sources.profiles import read_damaged, read_profiles, with_event_times
from profile_lake.sources.responses import (
    classify_response,
    parse_hosts,
    poll_log,
    polls,
    profile_texts,
    read_responses,
    resolve_attempts,
    stream_responses,
    union_hosts,
)

__all__ = [
    "classify_response",
    "decode_listings",
    "parse_hosts",
    "parse_query_detail",
    "poll_log",
    "polls",
    "profile_texts",
    "read_damaged",
    "read_profiles",
    "read_responses",
    "resolve_attempts",
    "split_bad",
    "stream_responses",
    "union_hosts",
    "with_event_times",
]
