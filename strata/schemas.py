"""Declared raw payload schemas (SRC-4, SRC-5, decisions D2, D3, D7).

Declaring every schema avoids an inference pass over the raw zone and keeps
edge documents (``states: null``, ``records: []``, a missing array) readable.
Traffic, weather and flights declare their scalar leaves as text and cast them
leniently afterwards; holidays keeps strict JSON typing, which is how that
source has always been read. Every schema carries ``_corrupt_record`` so a
malformed document is counted instead of vanishing silently.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

CORRUPT_COL = "_corrupt_record"


def _text(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


def _text_arrays(*names: str) -> list[StructField]:
    return [StructField(n, ArrayType(StringType(), True), True) for n in names]


TRAFFIC_RECORD = StructType(_text(
    "center_id", "timestamp", "visitors_count", "day_of_week",
    "is_holiday", "weather_condition", "temperature_c"))

TRAFFIC_RAW = StructType([
    StructField("records", ArrayType(TRAFFIC_RECORD, True), True),
    *_text("total_records", CORRUPT_COL),
])

WEATHER_HOURLY = StructType(_text_arrays(
    "time", "temperature_2m", "precipitation", "windspeed_10m", "weathercode"))

WEATHER_RAW = StructType([
    *_text("latitude", "longitude", "timezone"),
    StructField("hourly", WEATHER_HOURLY, True),
    *_text("source", "ingest_date", "total_records", CORRUPT_COL),
])

# Holidays: strict types, as declared by the source (SRC-4).
HOLIDAY_RECORD = StructType([
    StructField("date", StringType(), True),
    StructField("localName", StringType(), True),
    StructField("name", StringType(), True),
    StructField("countryCode", StringType(), True),
    StructField("fixed", BooleanType(), True),
    StructField("global", BooleanType(), True),
    StructField("counties", ArrayType(StringType(), True), True),
    StructField("launchYear", IntegerType(), True),
    StructField("types", ArrayType(StringType(), True), True),
])

HOLIDAYS_RAW = StructType([
    *_text("source", "country_code", "ingest_date"),
    StructField("total_records", IntegerType(), True),
    StructField("holidays", ArrayType(HOLIDAY_RECORD, True), True),
    *_text(CORRUPT_COL),
])

# Flights: ``states`` is an array of positional arrays whose slots mix JSON
# strings, numbers, booleans and nested arrays; read as text, decoded by slot.
FLIGHTS_RAW = StructType([
    *_text("time", "snapshot_time", "source", "ingest_date", "total_records"),
    StructField("states", ArrayType(ArrayType(StringType(), True), True), True),
    *_text(CORRUPT_COL),
])
