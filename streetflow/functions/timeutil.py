"""Time helpers for TIMESTAMP_NTZ input (epoch-aligned buckets, epoch offsets)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ."""
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), ts)


def epoch_seconds(ts: Column) -> Column:
    """Seconds (double) since 1970-01-01 of a TIMESTAMP_NTZ."""
    return epoch_micros(ts) / F.lit(1_000_000.0)


def bucket_start(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned bucket of width ``seconds`` holding ``ts`` (NTZ in, NTZ out).

    Same alignment as ``window(ts, '<seconds> seconds')`` but a plain
    projection, so it can be a grouping key without the Expand of ``window``.
    """
    width = seconds * 1_000_000
    start = F.floor(epoch_micros(ts) / F.lit(width)) * F.lit(width)
    return F.timestamp_add("MICROSECOND", start, epoch_ntz())


def day_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")
