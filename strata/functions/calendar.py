"""Calendar column helpers (GEN-3, GEN-4) and ISO text forms used by payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_bucket(ts: Column | str) -> Column:
    """GEN-3: truncate to the hour, keeping TIMESTAMP_NTZ (D10).

    ``date_trunc`` on an NTZ value returns a zoned TIMESTAMP, so cast back."""
    return F.date_trunc("hour", _col(ts)).cast("timestamp_ntz")


def day_label(ts: Column | str) -> Column:
    """GEN-4: lower-case English weekday name ('wednesday')."""
    return F.lower(F.date_format(_col(ts), "EEEE"))


def iso_date_text(d: Column | str) -> Column:
    """'YYYY-MM-DD' text of a date or timestamp."""
    return F.date_format(_col(d), "yyyy-MM-dd")


def iso_hour_text(ts: Column | str, with_seconds: bool = True) -> Column:
    """ISO text of the hour a timestamp falls in: '2026-04-22T10:00:00'
    (traffic records) or '2026-04-22T10:00' (weather hourly times)."""
    pattern = "yyyy-MM-dd'T'HH:00:00" if with_seconds else "yyyy-MM-dd'T'HH:00"
    return F.date_format(_col(ts), pattern)
