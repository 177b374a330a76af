"""What a curated table remembers about its raw zone (API-4, SRC-2).

Both records lie beside the table, in folders that readers of the table skip:

``_ledger``  (event_date, landing_day): that a day's rows also came from another
  day's folder. A run that replaces a day reads these folders as well, so that a
  rerun keeps the late rows which other folders brought. Pairs are only added: one
  that no longer holds costs a read, never a row.
``_landed``  (landed_until, recorded_at): up to which modification time, in
  microseconds, landed files have been taken in by incremental runs.
``_batches`` (stream, batch_id): the micro-batches of a stream that are merged.

Entries are written before the rows that they speak of (``_ledger``) or after
them (``_landed``, ``_batches``), so a run that fails in between leaves a table
that the next run completes: taking rows in twice changes nothing.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.paths import Location, exists

LEDGER = "_ledger"
LANDED = "_landed"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
PAIR = "event_date date, landing_day date"
MARK = "landed_until long, recorded_at timestamp"
BATCHES = "_batches"
BATCH = "stream string, batch_id long"


def pairs(spark: SparkSession, table: Location) -> DataFrame:
    """(event_date, landing_day) of a table; empty where there is no ledger."""
    place = table / LEDGER
    if not exists(spark, place):
        return spark.createDataFrame([], PAIR)
    return spark.read.schema(PAIR).parquet(place)


def record(new: DataFrame, table: Location) -> None:
    """Add the pairs that are not known yet."""
    spark = new.sparkSession
    known = pairs(spark, table)
    found = new.select("event_date", "landing_day").where("event_date is not null").distinct()
    unknown = found.join(known.distinct(), ["event_date", "landing_day"], "left_anti")
    unknown.coalesce(1).write.mode("append").parquet(table / LEDGER)


def feeding_days(spark: SparkSession, table: Location, first: date, last: date) -> list[date]:
    """The days outside [first, last] whose folders hold rows of days inside:
    at most one for each day of the calendar."""
    inside = lambda c: F.col(c).between(F.lit(first), F.lit(last))
    found = pairs(spark, table).where(inside("event_date") & ~inside("landing_day"))
    return sorted(r.landing_day for r in found.select("landing_day").distinct().collect())


def landed_until(spark: SparkSession, table: Location) -> datetime | None:
    """The high-water mark of incremental runs; None before the first."""
    place = table / LANDED
    if not exists(spark, place):
        return None
    micros = spark.read.schema(MARK).parquet(place).agg(F.max("landed_until")).first()[0]
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def advance(spark: SparkSession, table: Location, micros: int) -> None:
    """Move the mark; it never goes back, because readers take the largest."""
    row = spark.createDataFrame([(micros,)], "landed_until long").withColumn("recorded_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(table / LANDED)


def merged_batch(spark: SparkSession, table: Location, stream: str) -> int:
    """The last micro-batch of a stream that is merged; -1 before the first."""
    place = table / BATCHES
    if not exists(spark, place):
        return -1
    found = spark.read.schema(BATCH).parquet(place).where(F.col("stream") == stream)
    return int(found.agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0])


def record_batch(spark: SparkSession, table: Location, stream: str, batch_id: int) -> None:
    row = spark.createDataFrame([(stream, batch_id)], BATCH)
    row.coalesce(1).write.mode("append").parquet(table / BATCHES)
