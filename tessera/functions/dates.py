"""Texts of instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_iso(ts: Column | None = None) -> Column:
    """An instant as 2024-01-31T12:00:00Z; now if none is given. The session's time zone is to be UTC."""
    return F.date_format(F.current_timestamp() if ts is None else ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def file_stamp(ts: Column | None = None) -> Column:
    """An instant for a file name: 20240131_120000."""
    return F.date_format(F.current_timestamp() if ts is None else ts, "yyyyMMdd_HHmmss")
