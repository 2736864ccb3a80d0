"""Timestamp column expressions for the 15-minute trading grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUARTER_HOUR_SECONDS = 15 * 60


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_utc_ts(c: str | Column) -> Column:
    """ISO text (``T`` or space separator, optional offset) → UTC timestamp; bad text → null.

    Columns that are already timestamps pass through a plain cast.
    """
    return F.try_to_timestamp(_col(c).cast("string"))


def quarter_hour_start(c: str | Column) -> Column:
    """Floor a timestamp to the start of its 15-minute bucket (epoch based, UTC)."""
    secs = F.unix_seconds(_col(c).cast("timestamp"))
    return F.timestamp_seconds(F.floor(secs / QUARTER_HOUR_SECONDS) * QUARTER_HOUR_SECONDS)


def quarter_hour_key(c: str | Column) -> Column:
    """``HH:mm`` label of a bucket start."""
    return F.date_format(_col(c), "HH:mm")
