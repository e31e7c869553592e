"""Time helpers (H04): epoch conversions and text formats.

``unix_timestamp`` reads a ``TIMESTAMP_NTZ`` value as UTC wall time, so
epoch numbers computed here do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 (floor for positive times)."""
    return F.unix_timestamp(ts if isinstance(ts, Column) else F.col(ts))


def epoch_millis(ts: Column | str) -> Column:
    """Milliseconds since the epoch of a wall-clock (``TIMESTAMP_NTZ``) time.

    Computed as a difference of two NTZ values, so no zone is consulted.
    For zoned ``TIMESTAMP`` columns use ``F.unix_millis`` directly.
    """
    c = ts if isinstance(ts, Column) else F.col(ts)
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            c.cast("timestamp_ntz"))


def from_epoch_seconds(c: Column | str) -> Column:
    return F.timestamp_seconds(c if isinstance(c, Column) else F.col(c))


def from_epoch_millis(c: Column | str) -> Column:
    return F.timestamp_millis(c if isinstance(c, Column) else F.col(c))


def parse_time(text: Column | str, fmt: str) -> Column:
    """Text to timestamp; a malformed value gives null instead of failing."""
    return F.try_to_timestamp(text if isinstance(text, Column) else F.col(text), F.lit(fmt))


def format_time(ts: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(ts if isinstance(ts, Column) else F.col(ts), fmt)
