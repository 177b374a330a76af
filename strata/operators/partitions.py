"""Event-date partition columns (PRT-1, PRT-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# PRT-2: partition columns of every curated table, in directory order.
PARTITION_COLS = ("year", "month", "day")
EVENT_DATE_COL = "event_date"


def add_event_partitions(df: DataFrame, event_date_col: str | None = None) -> DataFrame:
    """PRT-1 (SCL-7): append int ``year, month, day`` taken from the event date column.

    A NULL date gives NULL parts, which a partitioned write files under the
    default (NULL) partition.
    """
    d = F.col(event_date_col or EVENT_DATE_COL)
    return df.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)})
