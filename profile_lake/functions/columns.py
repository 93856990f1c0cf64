"""Column expressions. All are built-ins, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# TIMESTAMP_NTZ arithmetic and text only: date_format and timestampdiff go through the
# session time zone and move instants inside its daylight-saving gap.
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _epoch_plus(unit: str, amount: Column) -> Column:
    return F.timestamp_add(unit, amount, F.expr(_EPOCH))


def fingerprint(sql: Column | str) -> Column:
    """Lower-case hex MD5 of the UTF-8 statement; null for an empty statement."""
    text = _col(sql)
    return F.when(text != "", F.md5(text))


def rfc3339_from_millis(millis: Column | str) -> Column:
    """Epoch milliseconds as UTC text, cut to seconds; empty for values <= 0."""
    value = _col(millis)
    # A whole second prints as "yyyy-MM-dd HH:mm:ss".
    second = _epoch_plus("SECOND", F.floor(value / 1000)).cast("string")
    return F.when(value > 0, F.concat(F.translate(second, " ", "T"), F.lit("Z"))).otherwise("")


def rfc3339_to_timestamp(text: Column | str) -> Column:
    """UTC text back to a TIMESTAMP_NTZ; null for empty text."""
    value = _col(text)
    return F.when(value != "", F.substring(value, 1, 19).cast("timestamp_ntz"))


def duration_ms(latency: Column | str) -> Column:
    """Latency as a double, with the running marker (-1) and negatives as zero."""
    return F.greatest(_col(latency), F.lit(0).cast("long")).cast("double")


def epoch_micros(ts_ntz: Column | str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ taken as UTC."""
    seconds = (_col(ts_ntz) - F.expr(_EPOCH)).cast("interval second").cast("decimal(24,6)")
    return (seconds * 1_000_000).cast("long")


def micros_to_ntz(micros: Column | str) -> Column:
    return _epoch_plus("MICROSECOND", _col(micros))


# Leading characters of an RFC 3339 text that name its hour, day, month and minute.
_PERIOD_WIDTH = {"month": 7, "week": 10, "day": 10, "hour": 13, "minute": 16}
_PERIOD_REST = {"month": "-01 00:00:00", "week": " 00:00:00", "day": " 00:00:00", "hour": ":00:00"}


def period_text(rfc3339: Column | str, grain: str) -> Column:
    """The part of an RFC 3339 text that names its period; for weeks, the Monday."""
    if grain not in _PERIOD_WIDTH:
        raise ValueError(f"unknown grain {grain!r}: use {', '.join(_PERIOD_WIDTH)}")
    head = F.substring(_col(rfc3339), 1, _PERIOD_WIDTH[grain])
    return F.trunc(head.cast("date"), "week").cast("string") if grain == "week" else head


def period_start(period: Column | str, grain: str) -> Column:
    """The TIMESTAMP_NTZ a :func:`period_text` of hour, day, week or month begins at."""
    day_and_hour = F.translate(_col(period), "T", " ")
    return F.concat(day_and_hour, F.lit(_PERIOD_REST[grain])).cast("timestamp_ntz")


def partition_keys(flush_us: Column | str) -> list[Column]:
    """Zero-padded year, month, day and hour (UTC) of the flush time in µs."""
    text = micros_to_ntz(flush_us).cast("string")
    parts = (("year", 1, 4), ("month", 6, 2), ("day", 9, 2), ("hour", 12, 2))
    return [F.substring(text, start, width).alias(name) for name, start, width in parts]


def body_text(body: Column | str, max_bytes: int | None = None) -> Column:
    """A binary body as text: whole, or its first ``max_bytes`` bytes."""
    return F.make_valid_utf8(_col(body).cast("string")) if max_bytes is None else cap_bytes(body, max_bytes)


def cap_bytes(body: Column | str, max_bytes: int) -> Column:
    """The first ``max_bytes`` bytes of a binary body as text.

    A character cut in half becomes the replacement character instead of an error.
    """
    head = F.substring(_col(body), 1, max_bytes)
    return F.make_valid_utf8(head.cast("string"))
