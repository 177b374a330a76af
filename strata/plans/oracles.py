"""DuckDB oracle SQL for the registered queries.

Each statement computes, straight from the driver's tables, what the Spark
query computes through payload documents and the operators. Survivor choice
of the dedupe (D5) is spelled out as ``row_number()`` ordered by every
payload column: ascending NULLS FIRST for smallest-wins, descending NULLS LAST
for newest-wins. Float literals are DOUBLE so arithmetic is IEEE on both
sides; integer truncation uses ``trunc``.
"""

from __future__ import annotations


# -- traffic ------------------------------------------------------------------

_TRAFFIC_REC = """
traffic_rec AS (
  SELECT {center} AS center_id,
         date_trunc('hour', ts) AS event_timestamp,
         CAST(ts AS DATE) AS event_date,
         CAST(json_extract(props, '$.k') AS INTEGER) AS visitors_count,
         lower(dayname(ts)) AS day_of_week,
         event_type = 'signup' AS is_holiday,
         CASE WHEN event_type = 'error' THEN 'heavy rain' ELSE event_type END AS weather_condition,
         value AS temperature_c
  FROM events)"""

_TRAFFIC_ORDER = ("event_date NULLS FIRST, visitors_count NULLS FIRST, day_of_week NULLS FIRST, "
                  "is_holiday NULLS FIRST, weather_condition NULLS FIRST, temperature_c NULLS FIRST")

_PARTS = ("CAST(year(event_date) AS INTEGER) AS year, CAST(month(event_date) AS INTEGER) AS month, "
          "CAST(day(event_date) AS INTEGER) AS day")

_TRAFFIC_COLS = ("center_id, event_timestamp, event_date, visitors_count, day_of_week, is_holiday, "
                 "weather_condition, temperature_c")


def _traffic_rec(center: str = "'C' || CAST(user_id AS VARCHAR)") -> str:
    return _TRAFFIC_REC.format(center=center)


TRAFFIC_CURATED = f"""
WITH {_traffic_rec()},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY center_id, event_timestamp ORDER BY {_TRAFFIC_ORDER}) AS rn
  FROM traffic_rec)
SELECT {_TRAFFIC_COLS}, {_PARTS}
FROM ranked WHERE rn = 1
"""

EXPLODE_RECORDS = f"""
WITH {_traffic_rec()}
SELECT {_TRAFFIC_COLS} FROM traffic_rec
"""

DEDUPE_NULL_KEYS = f"""
WITH {_traffic_rec("CASE WHEN event_type = 'view' THEN NULL ELSE 'C' || CAST(user_id AS VARCHAR) END")},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY center_id, event_timestamp ORDER BY {_TRAFFIC_ORDER}) AS rn
  FROM traffic_rec)
SELECT {_TRAFFIC_COLS} FROM ranked WHERE rn = 1
"""

# -- weather ------------------------------------------------------------------

_WEATHER_REC = f"""
ev AS (
  SELECT *, CAST(ts AS DATE) AS d,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events),
doc AS (
  SELECT user_id, d, max(event_id) AS last_id FROM ev GROUP BY user_id, d),
weather_rec AS (
  SELECT date_trunc('hour', ev.ts) AS event_timestamp,
         CAST(ev.ts AS DATE) AS event_date,
         ev.value AS temperature_c,
         CAST(ev.k AS DOUBLE) / 10.0::DOUBLE AS precipitation_mm,
         -ev.value AS wind_speed_kmh,
         CASE WHEN ev.user_id % 3 = 0 AND ev.event_id = doc.last_id THEN NULL ELSE ev.k END AS weather_code,
         40.0::DOUBLE + CAST(ev.user_id AS DOUBLE) / 1000.0::DOUBLE AS latitude,
         -3.0::DOUBLE - CAST(ev.user_id AS DOUBLE) / 1000.0::DOUBLE AS longitude,
         'Europe/Madrid' AS timezone
  FROM ev JOIN doc ON ev.user_id = doc.user_id AND ev.d = doc.d)"""

_WEATHER_COLS = ("event_timestamp, event_date, temperature_c, precipitation_mm, wind_speed_kmh, "
                 "weather_code, latitude, longitude, timezone")

WEATHER_CURATED = f"""
WITH {_WEATHER_REC},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY event_timestamp, latitude, longitude
    ORDER BY event_date NULLS FIRST, temperature_c NULLS FIRST, precipitation_mm NULLS FIRST,
             wind_speed_kmh NULLS FIRST, weather_code NULLS FIRST, timezone NULLS FIRST) AS rn
  FROM weather_rec)
SELECT {_WEATHER_COLS}, {_PARTS} FROM ranked WHERE rn = 1
"""

EXPLODE_ZIPPED = f"""
WITH {_WEATHER_REC}
SELECT {_WEATHER_COLS} FROM weather_rec
"""

# -- holidays -----------------------------------------------------------------

# Entities whose number grows with the tables, so that an entity-day does not.
_COUNTRY = "'K' || CAST(o_custkey // 100 AS VARCHAR)"
_AREA = "'A' || CAST(l_suppkey // 100 AS VARCHAR)"

HOLIDAYS_CURATED = f"""
WITH holiday_rec AS (
  SELECT COALESCE(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END,
                  CAST(date_trunc('month', o_orderdate) AS DATE)) AS event_date,
         {_COUNTRY} AS country_code,
         lower(o_orderpriority) AS local_name,
         o_orderpriority AS name,
         o_totalprice > 200000 AS is_fixed,
         o_custkey % 2 = 0 AS is_global,
         CASE WHEN month(o_orderdate) = 2 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS launch_year,
         CASE WHEN o_totalprice > 200000 THEN ['Public', 'Bank'] ELSE ['Public'] END AS holiday_types,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS ingest_date
  FROM orders),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY event_date, country_code, name
    ORDER BY ingest_date DESC NULLS LAST, local_name DESC NULLS LAST, is_fixed DESC NULLS LAST,
             is_global DESC NULLS LAST, launch_year DESC NULLS LAST, holiday_types DESC NULLS LAST) AS rn
  FROM holiday_rec)
SELECT event_date, country_code, local_name, name, is_fixed, is_global, launch_year, holiday_types,
       ingest_date, {_PARTS}
FROM ranked WHERE rn = 1
"""

# -- flights ------------------------------------------------------------------

_FLIGHT_REC = """
flight_rec AS (
  SELECT printf('%06x', l_suppkey) AS icao24,
         CASE WHEN l_linenumber = 7 THEN ''
              ELSE l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR) END AS callsign,
         CASE WHEN l_returnflag = 'A' THEN 'Spain' WHEN l_returnflag = 'N' THEN 'France'
              ELSE 'Portugal' END AS origin_country,
         l_orderkey AS time_position,
         CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT) + 43200 - 60 + l_linenumber AS last_contact,
         l_discount AS longitude,
         l_tax AS latitude,
         l_extendedprice AS baro_altitude,
         l_linestatus = 'F' AS on_ground,
         l_quantity AS velocity,
         l_quantity AS true_track,
         CAST(NULL AS DOUBLE) AS vertical_rate,
         l_extendedprice AS geo_altitude,
         CAST(l_partkey AS VARCHAR) AS squawk,
         false AS spi,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_linenumber % 4 AS INTEGER) END AS position_source,
         CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT) + 43200 AS snapshot_time,
         CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT) + 43195 AS source_time,
         CAST(l_shipdate AS DATE) AS event_date
  FROM lineitem)"""

_FLIGHT_COLS = ("icao24, callsign, origin_country, time_position, last_contact, longitude, latitude, "
                "baro_altitude, on_ground, velocity, true_track, vertical_rate, geo_altitude, squawk, "
                "spi, position_source, snapshot_time, source_time, event_date")

_FLIGHT_DESC = ", ".join(
    f"{c} DESC NULLS LAST" for c in (
        "last_contact", "callsign", "origin_country", "time_position", "longitude", "latitude",
        "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate", "geo_altitude",
        "squawk", "spi", "position_source", "source_time", "event_date"))

FLIGHTS_CURATED = f"""
WITH {_FLIGHT_REC},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY icao24, snapshot_time ORDER BY {_FLIGHT_DESC}) AS rn
  FROM flight_rec)
SELECT {_FLIGHT_COLS}, {_PARTS} FROM ranked WHERE rn = 1
"""

FLIGHTS_SNAPSHOT_CHECK = f"""
WITH cur AS ({FLIGHTS_CURATED})
SELECT event_date, count(*) AS states,
       CAST(sum(CASE WHEN snapshot_time // 86400 <> date_diff('day', DATE '1970-01-01', event_date) THEN 1 ELSE 0 END)
            AS BIGINT) AS off_day_states,
       CASE WHEN sum(CASE WHEN snapshot_time // 86400 <> date_diff('day', DATE '1970-01-01', event_date) THEN 1 ELSE 0 END) = 0
            THEN 'PASS' ELSE 'FAIL' END AS status
FROM cur GROUP BY event_date
"""

EXPLODE_POSITIONAL = f"""
WITH {_FLIGHT_REC}
SELECT {_FLIGHT_COLS} FROM flight_rec
"""

# -- partitions ---------------------------------------------------------------

EVENT_PARTITIONS = f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date, {_PARTS.replace('event_date', 'CAST(o_orderdate AS DATE)')}
FROM orders
"""

RAW_DAY_SCAN = f"""
WITH {_traffic_rec()}
SELECT {_TRAFFIC_COLS} FROM traffic_rec
WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
"""

# -- payload validation -------------------------------------------------------

_DQ = f"""
WITH tdoc AS (
  SELECT 'traffic' AS source,
         printf('traffic/year=%04d/month=%02d/day=%02d/C%d.json', year(d), month(d), day(d), user_id) AS document,
         user_id % 10 AS shape, n
  FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n
        FROM events GROUP BY ALL)),
wdoc AS (
  SELECT 'weather' AS source,
         printf('weather/year=%04d/month=%02d/day=%02d/L%d.json', year(d), month(d), day(d), user_id) AS document,
         user_id % 10 AS shape, n
  FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n
        FROM events GROUP BY ALL)),
fdoc AS (
  SELECT 'flights' AS source,
         printf('flights/year=%04d/month=%02d/day=%02d/%s.json', year(d), month(d), day(d), area) AS document,
         -1 AS shape, n
  FROM (SELECT {_AREA} AS area, CAST(l_shipdate AS DATE) AS d, count(*) AS n
        FROM lineitem GROUP BY ALL)),
docs AS (SELECT * FROM tdoc UNION ALL SELECT * FROM wdoc UNION ALL SELECT * FROM fdoc),
rules(rule_id, source, field_path, mode, expected) AS (VALUES
  (1, 'traffic', 'records', 'count', 2), (2, 'traffic', 'total_records', 'value', 2),
  (3, 'traffic', 'records', 'gte', 1), (4, 'traffic', '', 'value', 1),
  (5, 'traffic', 'records.x', 'count', 1), (6, 'traffic', 'total_records', 'sum', 1),
  (7, 'traffic', 'meta.source', 'value', 1),
  (8, 'weather', 'hourly.time', 'count', 2), (9, 'weather', 'hourly.time', 'gte', 1),
  (10, 'weather', 'total_records', 'value', 2),
  (11, 'flights', 'states', 'gte', 1), (12, 'flights', 'total_records', 'value', 10)),
pre AS (
  SELECT d.source, d.document, d.n, r.field_path, r.mode, CAST(r.expected AS BIGINT) AS expected, r.rule_id,
    CASE
      WHEN d.source = 'traffic' AND d.shape = 8 THEN 'MALFORMED_JSON'
      WHEN r.rule_id = 4 THEN 'EMPTY_PATH'
      WHEN r.rule_id IN (1, 3, 5) AND d.shape = 6 THEN 'MISSING_FIELD'
      WHEN r.rule_id = 5 THEN 'NOT_OBJECT'
      WHEN r.rule_id = 7 THEN 'MISSING_FIELD'
      WHEN r.rule_id = 6 THEN 'BAD_MODE'
      WHEN r.rule_id = 1 AND d.shape = 7 THEN 'TYPE_MISMATCH'
      WHEN r.rule_id = 2 AND d.shape = 9 THEN 'TYPE_MISMATCH'
      WHEN r.rule_id IN (8, 9) AND d.shape = 5 THEN 'MISSING_FIELD'
      WHEN r.rule_id IN (8, 9) AND d.shape = 6 THEN 'NOT_OBJECT'
      WHEN r.rule_id IN (8, 9) AND d.shape = 7 THEN 'TYPE_MISMATCH'
    END AS pre_error
  FROM docs d JOIN rules r ON d.source = r.source),
judged AS (
  SELECT *, CASE WHEN pre_error IS NULL THEN CAST(n AS BIGINT) END AS actual FROM pre)
SELECT source, document, field_path, mode, expected, actual,
       CASE WHEN error_class IS NULL THEN 'PASS' ELSE 'FAIL' END AS status, error_class
FROM (SELECT *, COALESCE(pre_error,
        CASE WHEN mode = 'gte' AND actual < expected THEN 'BELOW_MINIMUM'
             WHEN mode <> 'gte' AND actual <> expected THEN 'COUNT_MISMATCH' END) AS error_class
      FROM judged)
"""

DQ_VERDICTS = _DQ


def _dq_mode(mode: str) -> str:
    return f"SELECT * FROM ({_DQ}) v WHERE mode = '{mode}'"

DQ_LANDED = f"""
SELECT 'traffic' AS source, 'records' AS field_path, 'count' AS mode, CAST(24 AS BIGINT) AS expected,
       CAST(n AS BIGINT) AS actual,
       CASE WHEN n = 24 THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN n = 24 THEN NULL ELSE 'COUNT_MISMATCH' END AS error_class
FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n
      FROM events GROUP BY ALL)
"""

DQ_SUMMARY = f"""
SELECT source, field_path, mode, status, error_class, count(*) AS documents
FROM ({_DQ}) v
GROUP BY source, field_path, mode, status, error_class
"""

# -- envelopes ----------------------------------------------------------------

_KEY = "printf('%s/year=%04d/month=%02d/day=%02d/%s.json', {src}, year(d), month(d), day(d), {ent})"

ENVELOPE_TRAFFIC = f"""
SELECT 'traffic' AS source, strftime(d, '%Y-%m-%d') AS ingest_date, 'C' || user_id AS entity,
       CAST(n AS INTEGER) AS total_records,
       {_KEY.format(src="'traffic'", ent="'C' || user_id")} AS object_key
FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n
      FROM events GROUP BY ALL)
"""

ENVELOPE_HOT_DAY = f"""
SELECT 'traffic' AS source, strftime(d, '%Y-%m-%d') AS ingest_date, entity, CAST(n AS INTEGER) AS total_records,
       {_KEY.format(src="'traffic'", ent="entity")} AS object_key, CAST(n AS BIGINT) AS records, visitors
FROM (SELECT CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE 'C' || user_id END AS entity, CAST(ts AS DATE) AS d, count(*) AS n,
             CAST(coalesce(sum(CAST(json_extract(props, '$.k') AS INTEGER)), 0) AS BIGINT) AS visitors
      FROM events GROUP BY ALL)
"""

RAW_OBJECT_KEYS = """
SELECT DISTINCT 'C' || CAST(user_id AS VARCHAR) AS entity, CAST(ts AS DATE) AS ingest_date,
       printf('traffic/year=%04d/month=%02d/day=%02d/C%d.json', year(ts), month(ts), day(ts), user_id)
         AS object_key
FROM events
"""

ENVELOPE_WEATHER = f"""
SELECT 'weather' AS source, strftime(d, '%Y-%m-%d') AS ingest_date, 'open-meteo' AS entity,
       CAST(n AS INTEGER) AS total_records,
       {_KEY.format(src="'weather'", ent="'open-meteo'")} AS object_key,
       'Europe/Madrid' AS timezone,
       40.0::DOUBLE + CAST(user_id AS DOUBLE) / 1000.0::DOUBLE AS latitude
FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n
      FROM events GROUP BY ALL)
"""

ENVELOPE_HOLIDAYS = f"""
WITH req AS (
  SELECT DISTINCT country_code, d AS ingest_day
  FROM (SELECT {_COUNTRY} AS country_code, CAST(o_orderdate AS DATE) AS d FROM orders
        UNION ALL
        SELECT {_COUNTRY}, CAST(o_orderdate AS DATE) + 1 FROM orders)),
rec AS (
  SELECT {_COUNTRY} AS country_code, CAST(o_orderdate AS DATE) AS day
  FROM orders WHERE o_orderpriority <> '5-LOW'),
matched AS (
  SELECT req.country_code, req.ingest_day AS d,
         count(rec.day) AS n
  FROM req LEFT JOIN rec ON req.country_code = rec.country_code AND req.ingest_day = rec.day
  GROUP BY ALL)
SELECT 'holidays' AS source, strftime(d, '%Y-%m-%d') AS ingest_date, country_code AS entity,
       CAST(n AS INTEGER) AS total_records,
       {_KEY.format(src="'holidays'", ent="country_code")} AS object_key,
       country_code, CAST(n AS BIGINT) AS matching_records
FROM matched
"""

ENVELOPE_FLIGHTS = f"""
SELECT 'flights' AS source, strftime(d, '%Y-%m-%d') AS ingest_date, area AS entity,
       CAST(n AS INTEGER) AS total_records,
       {_KEY.format(src="'flights'", ent="area")} AS object_key,
       CAST(epoch(TIMESTAMP '2026-04-22 10:00:00') AS BIGINT) AS snapshot_time,
       CAST(n AS INTEGER) AS states
FROM (SELECT {_AREA} AS area, CAST(l_shipdate AS DATE) AS d, count(*) AS n
      FROM lineitem GROUP BY ALL)
"""

# -- expectation model ----------------------------------------------------------

# Fixed values of the model, stated again here so that a wrong constant in the
# library can't agree with itself.
_BASE = ("[50, 30, 20, 15, 15, 20, 50, 150, 400, 700, 900, 1100, "
         "1200, 1100, 950, 850, 900, 1100, 1200, 1000, 700, 400, 150, 80]")
_WEEKDAY = "[0.7, 0.75, 0.8, 0.85, 1.1, 1.5, 1.3]::DOUBLE[]"
_MONTH = "[0.6, 0.65, 0.8, 0.85, 0.9, 0.85, 0.7, 0.65, 0.85, 0.9, 1.1, 1.4]::DOUBLE[]"


_SPINE = """
ranges AS (
  SELECT 'C' || user_id AS center_id, min(CAST(ts AS DATE)) AS f, max(CAST(ts AS DATE)) AS t
  FROM events GROUP BY user_id),
spine AS (
  SELECT center_id, h AS event_timestamp, CAST(h AS DATE) AS event_date, CAST(hour(h) AS INTEGER) AS hour,
         lower(dayname(h)) AS day_of_week
  FROM (SELECT center_id,
               unnest(generate_series(CAST(f AS TIMESTAMP), CAST(t AS TIMESTAMP) + INTERVAL 23 HOUR,
                                      INTERVAL 1 HOUR)) AS h
        FROM ranges))"""


def _model(ts: str, cond: str, temp: str, hol: str) -> str:
    """The untruncated expectation as a DuckDB expression."""
    b0 = f"CAST(list_extract({_BASE}, hour({ts}) + 1) AS DOUBLE)"
    b1 = f"({b0} * list_extract({_WEEKDAY}, isodow({ts})))"
    b2 = f"({b1} * list_extract({_MONTH}, month({ts})))"
    b3 = (f"(CASE WHEN {cond} = 'heavy rain' THEN {b2} - {b2} * 0.3::DOUBLE "
          f"WHEN {temp} > 35 THEN {b2} - {b2} * 0.2::DOUBLE ELSE {b2} END)")
    closed = f"(month({ts}) = 12 AND day({ts}) = 25) OR (month({ts}) = 1 AND day({ts}) = 1)"
    return (f"(CASE WHEN {closed} THEN {b3} * 0.2::DOUBLE "
            f"WHEN {hol} THEN {b3} * 1.4::DOUBLE ELSE {b3} END)")


HOURLY_SPINE = f"""
WITH {_SPINE}
SELECT * FROM spine
"""

MISSING_HOURS = f"""
WITH {_SPINE},
seen AS (SELECT DISTINCT 'C' || user_id AS center_id, date_trunc('hour', ts) AS event_timestamp FROM events)
SELECT s.* FROM spine s
WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.center_id = s.center_id
                                       AND seen.event_timestamp = s.event_timestamp)
"""

EXPECTED_VISITORS = f"""
WITH cur AS ({TRAFFIC_CURATED}),
m AS (SELECT *, {_model('event_timestamp', 'weather_condition', 'temperature_c', 'is_holiday')} AS b
      FROM cur)
SELECT center_id, event_timestamp, visitors_count,
       CAST(trunc(b) AS INTEGER) AS expected_visitors,
       CAST(trunc(b - b * 0.15::DOUBLE) AS INTEGER) AS lower_bound,
       CAST(trunc(b + b * 0.15::DOUBLE) AS INTEGER) AS upper_bound,
       visitors_count BETWEEN CAST(trunc(b - b * 0.15::DOUBLE) AS INTEGER)
                          AND CAST(trunc(b + b * 0.15::DOUBLE) AS INTEGER) AS in_band
FROM m
"""

NOISE_BAND = f"""
SELECT center_id, event_timestamp, visitors_count, lower_bound, upper_bound, in_band
FROM ({EXPECTED_VISITORS}) e
"""

SPINE_EXPECTED = f"""
WITH {_SPINE},
cur AS ({TRAFFIC_CURATED}),
j AS (
  SELECT s.center_id, s.event_timestamp, s.day_of_week,
         COALESCE(c.weather_condition, 'sunny') AS weather_condition,
         COALESCE(c.temperature_c, 22.0::DOUBLE) AS temperature_c,
         COALESCE(c.is_holiday, false) AS is_holiday
  FROM spine s LEFT JOIN cur c ON s.center_id = c.center_id AND s.event_timestamp = c.event_timestamp)
SELECT *, CAST(trunc({_model('event_timestamp', 'weather_condition', 'temperature_c', 'is_holiday')})
               AS INTEGER) AS expected_visitors
FROM j
"""


DAY_LABELS = """
SELECT o_orderkey, date_trunc('hour', o_orderdate) AS hour_bucket, lower(dayname(o_orderdate)) AS day_of_week
FROM orders
"""

TRAFFIC_STREAM_KEYS = f"""
SELECT DISTINCT 'C' || CAST(user_id AS VARCHAR) AS center_id, date_trunc('hour', ts) AS event_timestamp,
       CAST(ts AS DATE) AS event_date,
       {_PARTS.replace('event_date', 'CAST(ts AS DATE)')}
FROM events
"""

CALENDAR_EXPECTED = f"""
WITH o AS (
  SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts,
         CASE WHEN o_orderstatus = 'F' THEN 'heavy rain' ELSE 'sunny' END AS cond,
         CAST(o_custkey % 50 AS DOUBLE) AS temp, o_custkey % 3 = 0 AS hol
  FROM orders)
SELECT o_orderkey, ts AS event_timestamp, CAST(trunc(b) AS INTEGER) AS expected_visitors,
       CAST(trunc(b - b * 0.15::DOUBLE) AS INTEGER) AS lower_bound,
       CAST(trunc(b + b * 0.15::DOUBLE) AS INTEGER) AS upper_bound
FROM (SELECT *, {_model('ts', 'cond', 'temp', 'hol')} AS b FROM o)
"""

SINGLE_DAY_SPINE = """
SELECT center_id, h AS event_timestamp, CAST(h AS DATE) AS event_date, CAST(hour(h) AS INTEGER) AS hour,
       lower(dayname(h)) AS day_of_week
FROM (SELECT o_orderstatus AS center_id,
             unnest(generate_series(d::TIMESTAMP, d::TIMESTAMP + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS h
      FROM (SELECT DISTINCT o_orderstatus, CAST(o_orderdate AS DATE) AS d FROM orders))
"""

STORED_OBJECTS = """
SELECT printf('traffic/year=%04d/month=%02d/day=%02d/C%d.json', year(d), month(d), day(d), user_id) AS object_key,
       CAST(CASE WHEN user_id % 7 = 0 THEN -n ELSE n END AS BIGINT) AS total_records,
       CAST(CASE WHEN user_id % 7 = 0 THEN 0 ELSE n END AS BIGINT) AS records
FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL)
"""

_ALL_TRAFFIC = f"SELECT * FROM ({TRAFFIC_CURATED}) t"

COMPACTED_TABLE = f"""
SELECT year, month, day, count(*) AS rows, CAST(1 AS BIGINT) AS files FROM ({TRAFFIC_CURATED}) t GROUP BY ALL
"""

REVERSED_RANGES = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_date, CAST(date_trunc('month', o_orderdate) AS DATE) + 14 AS to_date,
       'the range ends before it starts' AS error
FROM orders WHERE day(o_orderdate) > 15
"""

DQ_STANDARD = f"""
WITH n AS (
  SELECT 'traffic' AS source, 'records' AS field_path, 'count' AS mode, 24 AS expected, count(*) AS actual
  FROM events GROUP BY user_id, CAST(ts AS DATE)
  UNION ALL
  SELECT 'weather', 'hourly.time', 'count', 24, count(*) FROM events GROUP BY user_id, CAST(ts AS DATE)
  UNION ALL
  SELECT 'holidays', 'total_records', 'value', 3, count(*) FROM orders GROUP BY {_COUNTRY}, date_trunc('month', o_orderdate)
  UNION ALL
  SELECT 'flights', 'states', 'gte', 1, count(*) FROM lineitem GROUP BY {_AREA}, CAST(l_shipdate AS DATE))
SELECT source, field_path, mode, CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual,
       CASE WHEN actual = expected OR mode = 'gte' AND actual > expected THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN actual = expected OR mode = 'gte' AND actual > expected THEN NULL ELSE 'COUNT_MISMATCH' END AS error_class,
       count(*) AS documents
FROM n GROUP BY ALL
"""

DQ_OBJECTS = """
SELECT 'traffic' AS source,
       printf('traffic/year=%04d/month=%02d/day=%02d/C%d.json', year(d), month(d), day(d), user_id) AS document,
       'records' AS field_path, 'count' AS mode, CAST(24 AS BIGINT) AS expected, CAST(n AS BIGINT) AS actual,
       CASE WHEN n = 24 THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN n = 24 THEN NULL ELSE 'COUNT_MISMATCH' END AS error_class
FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL)
"""

DQ_GATE = """
SELECT CAST(least AS INTEGER) AS at_least, CASE WHEN fewest >= least THEN 'PASS' ELSE 'FAIL' END AS gate
FROM (SELECT min(n) AS fewest FROM (SELECT count(*) AS n FROM events GROUP BY user_id, CAST(ts AS DATE))),
     (SELECT unnest([1, 2, 3, 24]) AS least)
"""

SCHEMA_DRIFT = f"""
WITH t AS (
  SELECT d, day(d) % 5 AS turn, count(*) AS n
  FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) GROUP BY d),
h AS (
  SELECT m AS d, count(*) AS n, sum(dated) AS dated
  FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, {_COUNTRY} AS country,
               count(*) FILTER (o_orderpriority <> '5-LOW') AS dated
        FROM orders GROUP BY ALL) GROUP BY m)
SELECT source, strftime(d, '%Y-%m-%d') AS day, drift, path, declared, observed, CAST(n AS BIGINT) AS documents
FROM (
  SELECT 'traffic' AS source, d, 'NEW' AS drift, 'records[].gate' AS path, NULL AS declared, 'STRING' AS observed, n
  FROM t WHERE turn = 0
  UNION ALL SELECT 'traffic', d, 'NEW', 'total', NULL, 'BIGINT', n FROM t WHERE turn = 1
  UNION ALL SELECT 'traffic', d, 'VANISHED', 'total_records', 'scalar', NULL, n FROM t WHERE turn = 1
  UNION ALL SELECT 'traffic', d, 'RETYPED', 'total_records', 'scalar', 'object', n FROM t WHERE turn = 2
  UNION ALL SELECT 'weather', d, 'VANISHED', 'timezone', 'scalar', NULL, n FROM t WHERE turn = 3
  UNION ALL SELECT 'holidays', d, 'VANISHED', 'holidays[].counties', 'list', NULL, n FROM h
  UNION ALL SELECT 'holidays', d, 'VANISHED', 'holidays[].date', 'scalar', NULL, n FROM h WHERE dated = 0
  UNION ALL SELECT 'holidays', d, 'RETYPED', 'holidays[].launchYear', 'integer', 'STRING', n FROM h WHERE month(d) = 2)
"""

ORACLES: dict[str, str] = {
    "traffic_curated": TRAFFIC_CURATED,
    "weather_curated": WEATHER_CURATED,
    "holidays_curated": HOLIDAYS_CURATED,
    "flights_curated": FLIGHTS_CURATED,
    "explode_records": EXPLODE_RECORDS,
    "explode_zipped": EXPLODE_ZIPPED,
    "explode_positional": EXPLODE_POSITIONAL,
    "dedupe_null_keys": DEDUPE_NULL_KEYS,
    "event_partitions": EVENT_PARTITIONS,
    "raw_roundtrip": TRAFFIC_CURATED,
    "raw_day_scan": RAW_DAY_SCAN,
    "traffic_from_landed": TRAFFIC_CURATED,
    "weather_from_landed": WEATHER_CURATED,
    "holidays_from_landed": HOLIDAYS_CURATED,
    "flights_from_landed": FLIGHTS_CURATED,
    "curated_rerun": TRAFFIC_CURATED,
    "curation_job": TRAFFIC_CURATED,
    "dq_verdicts": DQ_VERDICTS,
    "dq_summary": DQ_SUMMARY,
    "dq_value": _dq_mode("value"),
    "dq_count": _dq_mode("count"),
    "dq_gte": _dq_mode("gte"),
    "dq_landed": DQ_LANDED,
    "flights_snapshot_check": FLIGHTS_SNAPSHOT_CHECK,
    "envelope_traffic": ENVELOPE_TRAFFIC,
    "envelope_hot_day": ENVELOPE_HOT_DAY,
    "raw_object_keys": RAW_OBJECT_KEYS,
    "envelope_weather": ENVELOPE_WEATHER,
    "envelope_holidays": ENVELOPE_HOLIDAYS,
    "envelope_flights": ENVELOPE_FLIGHTS,
    "hourly_spine": HOURLY_SPINE,
    "missing_hours": MISSING_HOURS,
    "expected_visitors": EXPECTED_VISITORS,
    "noise_band": NOISE_BAND,
    "spine_expected": SPINE_EXPECTED,
    "day_labels": DAY_LABELS,
    "traffic_stream_keys": TRAFFIC_STREAM_KEYS,
    "null_arrays_traffic": f"SELECT * FROM ({TRAFFIC_CURATED}) t WHERE CAST(substr(center_id, 2) AS BIGINT) % 6 > 2",
    "null_states_flights": f"SELECT * FROM ({FLIGHTS_CURATED}) t WHERE day(event_date) % 2 = 1",
    "dq_defaults": f"SELECT * FROM ({_DQ}) v WHERE source = 'traffic' AND field_path = 'total_records' AND mode = 'value'",
    "calendar_expected": CALENDAR_EXPECTED,
    "single_day_spine": SINGLE_DAY_SPINE,
    "late_record_kept": _ALL_TRAFFIC,
    "rerun_after_late_record": _ALL_TRAFFIC,
    "incremental_runs": _ALL_TRAFFIC,
    "stream_merged": _ALL_TRAFFIC,
    "compacted_table": COMPACTED_TABLE,
    "explicit_input": _ALL_TRAFFIC,
    "reversed_ranges": REVERSED_RANGES,
    "dq_standard": DQ_STANDARD,
    "dq_objects": DQ_OBJECTS,
    "dq_gate": DQ_GATE,
    "schema_drift": SCHEMA_DRIFT,
    "raw_two_entities": _ALL_TRAFFIC,
    "stored_objects": STORED_OBJECTS,
    "catalog_append": _ALL_TRAFFIC,
}
