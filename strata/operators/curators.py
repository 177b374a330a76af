"""The four curated tables (CUR-1..4).

``project_<source>`` is explode + typed projection (no shuffle);
``curate_<source>`` adds the key dedupe (DED-1, the only shuffle) and the
event-date partitions (PRT-1). Column order is the curated table's order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import lenient_cast, parse_date, parse_timestamp, slot, trimmed_text
from strata.operators.dedupe import dedupe_by
from strata.operators.explode import explode_array, explode_struct_array, explode_zipped_arrays
from strata.operators.partitions import add_event_partitions

# Dedupe keys and survivor order per source (D5).
TRAFFIC_KEYS = ("center_id", "event_timestamp")
WEATHER_KEYS = ("event_timestamp", "latitude", "longitude")
HOLIDAYS_KEYS = ("event_date", "country_code", "name")
HOLIDAYS_NEWEST = ("ingest_date",)
FLIGHTS_KEYS = ("icao24", "snapshot_time")
FLIGHTS_NEWEST = ("last_contact",)


def project_traffic(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """CUR-1 projection: one row per traffic record; ``keep`` names columns of
    the document that each row carries besides."""
    rec = explode_struct_array(raw, "records", include_cols=keep)
    return rec.select(
        lenient_cast("center_id", "string").alias("center_id"),
        parse_timestamp("timestamp").alias("event_timestamp"),
        parse_date("timestamp").alias("event_date"),
        lenient_cast("visitors_count", "int").alias("visitors_count"),
        lenient_cast("day_of_week", "string").alias("day_of_week"),
        lenient_cast("is_holiday", "boolean").alias("is_holiday"),
        lenient_cast("weather_condition", "string").alias("weather_condition"),
        lenient_cast("temperature_c", "double").alias("temperature_c"),
        *keep,
    )


def curate_traffic(raw: DataFrame) -> DataFrame:
    """CUR-1: traffic records, one per (center_id, event_timestamp)."""
    return add_event_partitions(dedupe_by(project_traffic(raw), TRAFFIC_KEYS))


WEATHER_ARRAYS = ("hourly.time", "hourly.temperature_2m", "hourly.precipitation",
                  "hourly.windspeed_10m", "hourly.weathercode")


def project_weather(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """CUR-2 projection: one row per position of the parallel hourly arrays."""
    rows = explode_zipped_arrays(raw, WEATHER_ARRAYS,
                                 include_cols=("latitude", "longitude", "timezone", *keep))
    return rows.select(
        parse_timestamp("time").alias("event_timestamp"),
        parse_date("time").alias("event_date"),
        lenient_cast("temperature_2m", "double").alias("temperature_c"),
        lenient_cast("precipitation", "double").alias("precipitation_mm"),
        lenient_cast("windspeed_10m", "double").alias("wind_speed_kmh"),
        lenient_cast("weathercode", "int").alias("weather_code"),
        lenient_cast("latitude", "double").alias("latitude"),
        lenient_cast("longitude", "double").alias("longitude"),
        lenient_cast("timezone", "string").alias("timezone"),
        *keep,
    )


def curate_weather(raw: DataFrame) -> DataFrame:
    """CUR-2: hourly weather, one per (event_timestamp, latitude, longitude)."""
    return add_event_partitions(dedupe_by(project_weather(raw), WEATHER_KEYS))


def project_holidays(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """CUR-3 projection. ``country_code`` is the document's, not the record's;
    a record without a usable date falls back to the ingest date (SCL-6)."""
    rec = explode_struct_array(raw, "holidays", alias="holiday",
                               include_cols=("country_code", "ingest_date", *keep))
    return rec.select(
        F.coalesce(parse_date("date"), parse_date("ingest_date")).alias("event_date"),
        F.col("country_code").cast("string").alias("country_code"),
        F.col("localName").cast("string").alias("local_name"),
        F.col("name").cast("string").alias("name"),
        F.col("fixed").try_cast("boolean").alias("is_fixed"),
        F.col("global").try_cast("boolean").alias("is_global"),
        F.col("launchYear").try_cast("int").alias("launch_year"),
        F.col("types").alias("holiday_types"),
        parse_date("ingest_date").alias("ingest_date"),
        *keep,
    )


def curate_holidays(raw: DataFrame) -> DataFrame:
    """CUR-3: holidays, one per (event_date, country_code, name); the most
    recently ingested entry wins."""
    deduped = dedupe_by(project_holidays(raw), HOLIDAYS_KEYS, newest=HOLIDAYS_NEWEST)
    return add_event_partitions(deduped)


# CUR-4 slot layout of an aircraft state vector: (slot, output, type).
# Slot 12 (receiving sensors) is not kept; slots beyond 16 are ignored.
FLIGHT_SLOTS = (
    (0, "icao24", "string"),
    (1, "callsign", "string"),
    (2, "origin_country", "string"),
    (3, "time_position", "long"),
    (4, "last_contact", "long"),
    (5, "longitude", "double"),
    (6, "latitude", "double"),
    (7, "baro_altitude", "double"),
    (8, "on_ground", "boolean"),
    (9, "velocity", "double"),
    (10, "true_track", "double"),
    (11, "vertical_rate", "double"),
    (13, "geo_altitude", "double"),
    (14, "squawk", "string"),
    (15, "spi", "boolean"),
    (16, "position_source", "int"),
)


def project_flights(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """CUR-4 projection: one row per state vector, decoded by position.
    The callsign is trimmed before the cast, so a blank one becomes ''."""
    states = explode_array(raw, "states", alias="state",
                           include_cols=("ingest_date", "snapshot_time", "time", *keep))
    decoded = []
    for index, name, data_type in FLIGHT_SLOTS:
        value = slot("state", index)
        if name == "callsign":
            value = trimmed_text(value)
        decoded.append(lenient_cast(value, data_type).alias(name))
    return states.select(
        *decoded,
        lenient_cast("snapshot_time", "long").alias("snapshot_time"),
        lenient_cast("time", "long").alias("source_time"),
        parse_date("ingest_date").alias("event_date"),
        *keep,
    )


def curate_flights(raw: DataFrame) -> DataFrame:
    """CUR-4: aircraft snapshots, one per (icao24, snapshot_time); the state
    with the latest ``last_contact`` wins."""
    deduped = dedupe_by(project_flights(raw), FLIGHTS_KEYS, newest=FLIGHTS_NEWEST)
    return add_event_partitions(deduped)
