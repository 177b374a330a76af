"""Payload documents derived from the driver's tables.

The driver's tables are not platform payloads, so Spark shapes them into the
raw documents each source would land, then the real operators run on them.
Every builder reads whole tables; a document is one (entity, day), as a source
lands it.

Mappings (fixed, mirrored by the DuckDB oracles in ``plans.oracles``):

traffic  <- events   centre 'C'||user_id, hour of ts, visitors = props.k,
                     weekday label, holiday = signup, condition = event type
                     with error -> 'heavy rain', temperature = value; users
                     divisible by 4 spell the numbers differently
weather  <- events   location per user (lat 40 + user/1000, lon -3 - user/1000),
                     hourly arrays ordered by event_id; for users divisible
                     by 3 the weathercode array lacks its last element
holidays <- orders   country 'K'||(custkey div 100), one document per (country,
                     month), name = priority, date omitted for '5-LOW',
                     launchYear spelled as text in February documents
flights  <- lineitem area 'A'||(suppkey div 100), one state vector per line, one
                     document per (area, ship day)

The number of centres, countries and areas grows with the tables; what one of
them has on a day or in a month does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.calendar import day_label, iso_date_text, iso_hour_text
from strata.operators.envelopes import (
    flights_envelope,
    holidays_envelope,
    raw_object_key,
    traffic_envelope,
    weather_envelope,
)

AS_OF = "2026-04-22T10:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _props_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


# ---------------------------------------------------------------- traffic --

def _exchange_on(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by the document keys before records are built.

    The grouping that forms documents needs exactly this exchange, so it adds
    no shuffle: it only moves the per-record work (struct building, JSON text
    and its parsing downstream) from the scan side to the post-shuffle side,
    and the shuffle carries compact typed columns instead of JSON text. The
    number of partitions is Spark's to choose."""
    return df.repartition(*keys)


def traffic_records(spark: SparkSession, sf_dir: str, null_center_type: str | None = None
                    ) -> DataFrame:
    """One traffic record per event: (entity, ingest_date, record),
    hash-partitioned by (entity, ingest_date)."""
    ev = table(spark, sf_dir, "events").select(
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("entity"),
        F.to_date("ts").alias("ingest_date"),
        "ts", "event_type", "value", "props")
    ev = _exchange_on(ev, "entity", "ingest_date")
    center = F.col("entity")
    if null_center_type is not None:
        center = F.when(F.col("event_type") == null_center_type, F.lit(None)).otherwise(center)
    record = F.struct(
        center.alias("center_id"),
        iso_hour_text("ts").alias("timestamp"),
        _props_k().alias("visitors_count"),
        day_label("ts").alias("day_of_week"),
        (F.col("event_type") == "signup").alias("is_holiday"),
        F.when(F.col("event_type") == "error", F.lit("heavy rain"))
         .otherwise(F.col("event_type")).alias("weather_condition"),
        F.col("value").alias("temperature_c"),
    )
    return ev.select("entity", "ingest_date", record.alias("record"))


def traffic_documents(spark: SparkSession, sf_dir: str, null_center_type: str | None = None
                      ) -> DataFrame:
    """ENV-1 documents ``{records, total_records}`` per (centre, day).

    Documents of users divisible by 4 spell numbers the way other producers
    do - ``visitors_count`` as ``69.0`` and ``temperature_c`` as a JSON string
    - which the lenient casts must read as the same values (D1, D3)."""
    recs = traffic_records(spark, sf_dir, null_center_type)
    docs = traffic_envelope(recs, record_col="record", entity_col="entity", date_col="ingest_date")
    user = F.substring("entity", 2, 20).cast("long")
    respelled = F.regexp_replace(
        F.regexp_replace("document", r'"visitors_count":(-?[0-9]+)', '"visitors_count":$1.0'),
        r'"temperature_c":(-?[0-9.Ee+-]+)', '"temperature_c":"$1"')
    return docs.withColumn("document", F.when(F.pmod(user, F.lit(4)) == 0, respelled)
                           .otherwise(F.col("document")))


# ---------------------------------------------------------------- weather --

def weather_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upstream hourly payloads (no tags yet): one per (user, day)."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "value", "props",
        F.to_date("ts").alias("ingest_date"))
    ev = _exchange_on(ev, "user_id", "ingest_date")
    obs = F.struct(
        F.col("event_id"),
        iso_hour_text("ts", with_seconds=False).alias("time"),
        F.col("value").alias("temperature_2m"),
        (_props_k().cast("double") / F.lit(10.0)).alias("precipitation"),
        (-F.col("value")).alias("windspeed_10m"),
        _props_k().alias("weathercode"),
    )
    grouped = ev.groupBy("user_id", "ingest_date").agg(
        F.sort_array(F.collect_list(obs)).alias("obs"))
    codes = F.transform("obs", lambda o: o["weathercode"])
    short = F.slice(codes, F.lit(1), F.size(codes) - 1)
    hourly = F.struct(
        F.transform("obs", lambda o: o["time"]).alias("time"),
        F.transform("obs", lambda o: o["temperature_2m"]).alias("temperature_2m"),
        F.transform("obs", lambda o: o["precipitation"]).alias("precipitation"),
        F.transform("obs", lambda o: o["windspeed_10m"]).alias("windspeed_10m"),
        F.when(F.pmod("user_id", F.lit(3)) == 0, short).otherwise(codes).alias("weathercode"),
    )
    user = F.col("user_id").cast("double")
    return grouped.select(
        "ingest_date",
        (F.lit(40.0) + user / F.lit(1000.0)).alias("latitude"),
        (F.lit(-3.0) - user / F.lit(1000.0)).alias("longitude"),
        F.lit("Europe/Madrid ").alias("timezone"),
        hourly.alias("hourly"),
    )


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENV-2 documents for every (user, day)."""
    return weather_envelope(weather_upstream(spark, sf_dir))


# --------------------------------------------------------------- holidays --

def _country() -> Column:
    """A hundred customers are a country: as many of them as the table needs."""
    return F.concat(F.lit("K"), F.expr("o_custkey div 100").cast("string"))


def holiday_record() -> Column:
    """A holiday record (strict JSON types) built from an order row."""
    return F.struct(
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
         .otherwise(iso_date_text("o_orderdate")).alias("date"),
        F.lower("o_orderpriority").alias("localName"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("countryCode"),
        (F.col("o_totalprice") > 200000).alias("fixed"),
        (F.pmod("o_custkey", F.lit(2)) == 0).alias("global"),
        F.lit(None).cast("array<string>").alias("counties"),
        F.year("o_orderdate").alias("launchYear"),
        F.when(F.col("o_totalprice") > 200000, F.array(F.lit("Public"), F.lit("Bank")))
         .otherwise(F.array(F.lit("Public"))).alias("types"),
    )


def holidays_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly holiday documents per (country, month); record
    dates spread over the month, so ``coalesce`` and newest-wins matter."""
    o = table(spark, sf_dir, "orders").select(
        "*", _country().alias("country_code"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("ingest_day"))
    o = _exchange_on(o, "country_code", "ingest_day")
    grouped = o.groupBy("country_code", "ingest_day").agg(
        F.collect_list(holiday_record()).alias("holidays"))
    grouped = grouped.withColumn("total_records", F.size("holidays"))
    payload = F.to_json(F.struct(
        F.lit("holidays").alias("source"), "country_code",
        iso_date_text("ingest_day").alias("ingest_date"), "total_records", "holidays"))
    # February documents spell launchYear as text: the strict holidays schema
    # must turn it into NULL (D3).
    payload = F.when(F.month("ingest_day") == 2, F.regexp_replace(
        payload, r'"launchYear":([0-9]+)', '"launchYear":"$1"')).otherwise(payload)
    return grouped.select(F.lit("holidays").alias("source"),
                          iso_date_text("ingest_day").alias("ingest_date"),
                          F.col("country_code").alias("entity"), "total_records",
                          payload.alias("document"))


def holidays_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bare holiday lists per (country, day) as an upstream API would return
    them (ENV-3 input). A list of a year would grow with the table while the
    number of lists would not."""
    o = table(spark, sf_dir, "orders").select(
        "*", _country().alias("country_code"), F.to_date("o_orderdate").alias("day"))
    o = _exchange_on(o, "country_code", "day")
    return o.groupBy("country_code", "day").agg(
        F.collect_list(holiday_record()).alias("holidays"))


def holidays_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest requests (country, day): every order day and the day after it,
    so some requests find no holiday."""
    o = table(spark, sf_dir, "orders").select(_country().alias("country_code"),
                                              F.to_date("o_orderdate").alias("d"))
    return o.select("country_code", F.explode(F.array("d", F.date_add("d", 1))).alias("ingest_date")
                    ).distinct()


def holidays_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return holidays_envelope(holidays_upstream(spark, sf_dir), holidays_requests(spark, sf_dir))


# ---------------------------------------------------------------- flights --

def _js(c: Column) -> Column:
    """JSON text of a plain string value (no quotes or escapes in these data)."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def _jn(c: Column) -> Column:
    """JSON text of a number or boolean; NULL -> null."""
    return F.coalesce(c.cast("string"), F.lit("null"))


def flight_state_text() -> Column:
    """One aircraft state vector (17 positional slots), as JSON text, from a lineitem row.

    Slots mix JSON types; slot 12 is a nested array; line 1 has only 16
    slots (no position source), line 2 carries two extra slots, line 7 a
    blank callsign."""
    ln = F.col("l_linenumber")
    callsign = F.when(ln == 7, F.lit("    ")).otherwise(
        F.concat(F.lit("  "), F.col("l_returnflag"), F.col("l_linestatus"),
                 ln.cast("string"), F.lit("   ")))
    country = (F.when(F.col("l_returnflag") == "A", F.lit("Spain"))
               .when(F.col("l_returnflag") == "N", F.lit("France")).otherwise(F.lit("Portugal")))
    snapshot = _ship_epoch() + F.lit(43200)
    slots = [
        _js(_hex6(F.col("l_suppkey"))),                              # 0 icao24
        _js(callsign),                                               # 1 callsign
        _js(country),                                                # 2 origin_country
        _jn(F.col("l_orderkey")),                                    # 3 time_position
        _jn(snapshot - F.lit(60) + ln),                              # 4 last_contact
        _jn(F.col("l_discount")),                                    # 5 longitude
        _jn(F.col("l_tax")),                                         # 6 latitude
        _jn(F.col("l_extendedprice")),                               # 7 baro_altitude
        _jn(F.col("l_linestatus") == "F"),                           # 8 on_ground
        _jn(F.col("l_quantity")),                                    # 9 velocity
        _js(F.col("l_quantity").cast("string")),                     # 10 true_track (text)
        F.lit("null"),                                               # 11 vertical_rate
        F.concat(F.lit("["), F.col("l_suppkey").cast("string"), F.lit("]")),  # 12 sensors
        _js(F.col("l_extendedprice").cast("string")),                # 13 geo_altitude (text)
        _js(F.col("l_partkey").cast("string")),                      # 14 squawk
        F.lit("false"),                                              # 15 spi
        _jn(F.pmod(ln, F.lit(4))),                                   # 16 position_source
    ]
    full = F.concat_ws(",", *slots)
    short = F.concat_ws(",", *slots[:16])
    body = (F.when(ln == 1, short)
            .when(ln == 2, F.concat(full, F.lit(',"x",17')))
            .otherwise(full))
    return F.concat(F.lit("["), body, F.lit("]"))


def _hex6(c: Column) -> Column:
    """Lower-case hex, zero-padded to at least six digits (printf '%06x')."""
    h = F.lower(F.hex(c))
    return F.when(F.length(h) >= 6, h).otherwise(F.lpad(h, 6, "0"))


def _ship_epoch() -> Column:
    """Epoch seconds of the ship day's midnight, independent of session zone."""
    return F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("long") \
        * F.lit(86400)


def flights_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upstream state payloads per (area, ship day): ``time`` + states text."""
    area = F.concat(F.lit("A"), F.expr("l_suppkey div 100").cast("string"))
    li = table(spark, sf_dir, "lineitem").select(
        "*", area.alias("area"), F.to_date("l_shipdate").alias("ingest_date"))
    li = _exchange_on(li, "area", "ingest_date")
    grouped = li.groupBy("area", "ingest_date").agg(
        F.concat(F.lit("["), F.concat_ws(",", F.collect_list(flight_state_text())), F.lit("]"))
         .alias("states_json"),
        F.first(_ship_epoch() + F.lit(43200 - 5)).alias("time"),
    )
    return grouped


def flights_raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights raw documents as the curator expects them: the upstream payload
    tagged with the ship day's snapshot time (noon UTC of that day)."""
    up = flights_upstream(spark, sf_dir)
    doc = F.concat(
        F.lit('{"time":'), F.col("time").cast("string"),
        F.lit(',"states":'), F.col("states_json"),
        F.lit(',"source":"flights","ingest_date":"'), iso_date_text("ingest_date"),
        F.lit('","snapshot_time":'), (F.col("time") + F.lit(5)).cast("string"),
        F.lit(',"total_records":'), F.json_array_length("states_json").cast("string"),
        F.lit("}"))
    return up.select(F.lit("flights").alias("source"), iso_date_text("ingest_date").alias("ingest_date"),
                     F.col("area").alias("entity"), doc.alias("document"))


def flights_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENV-4 over the upstream payloads with snapshot time ``AS_OF`` (ENV-5)."""
    return flights_envelope(flights_upstream(spark, sf_dir), AS_OF, entity_col="area")


# ------------------------------------------------------ validation inputs --

def _shape(user_col: str = "user_id") -> Column:
    return F.pmod(F.col(user_col), F.lit(10))


def dq_traffic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic documents for validation, with broken shapes by user_id mod 10:
    6 ``records`` renamed, 7 ``records`` a number, 8 truncated JSON,
    9 ``total_records`` a boolean. Columns: source, object_key, document."""
    recs = traffic_records(spark, sf_dir).withColumn(
        "user_id", F.substring("entity", 2, 20).cast("long"))
    g = recs.groupBy("user_id", "entity", "ingest_date").agg(
        F.collect_list("record").alias("records"), F.count(F.lit(1)).alias("total_records"))
    good = F.to_json(F.struct("records", "total_records"))
    text = (F.when(_shape() == 6, F.to_json(F.struct(F.col("records").alias("rows"), "total_records")))
            .when(_shape() == 7, F.to_json(F.struct(F.col("total_records").alias("records"),
                                                    "total_records")))
            .when(_shape() == 8, F.expr("substring(to_json(struct(records, total_records)), 1, "
                                        "length(to_json(struct(records, total_records))) - 1)"))
            .when(_shape() == 9, F.to_json(F.struct("records", F.lit(True).alias("total_records"))))
            .otherwise(good))
    return g.select(F.lit("traffic").alias("source"),
                    raw_object_key("traffic", "ingest_date", "entity").alias("object_key"),
                    text.alias("document"))


def dq_weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather documents for validation, shapes by user_id mod 10: 5 empty
    ``hourly`` object, 6 ``hourly`` a list, 7 ``hourly.time`` null."""
    ev = table(spark, sf_dir, "events").select(
        "user_id", "ts", F.to_date("ts").alias("ingest_date"))
    ev = _exchange_on(ev, "user_id", "ingest_date")
    g = ev.groupBy("user_id", "ingest_date").agg(
        F.collect_list(iso_hour_text("ts", with_seconds=False)).alias("time"),
        F.count(F.lit(1)).alias("total_records"))
    loc = [F.lit(40.0).alias("latitude"), F.lit(-3.0).alias("longitude")]
    hourly = (F.when(_shape() == 5, F.to_json(F.struct(F.struct().alias("hourly"))))
              .when(_shape() == 6, F.to_json(F.struct(F.array().cast("array<string>").alias("hourly"))))
              .when(_shape() == 7, F.lit('{"hourly":{"time":null}}'))
              .otherwise(F.to_json(F.struct(F.struct("time").alias("hourly")))))
    rest = F.to_json(F.struct(*loc, "total_records"))
    # splice {"hourly":...} and the other fields into one object
    text = F.concat(F.expr("substring(x_hourly, 1, length(x_hourly) - 1)"), F.lit(","),
                    F.expr("substring(x_rest, 2)"))
    entity = F.concat(F.lit("L"), F.col("user_id").cast("string"))
    return g.select(
        F.lit("weather").alias("source"),
        raw_object_key("weather", "ingest_date", entity).alias("object_key"),
        hourly.alias("x_hourly"), rest.alias("x_rest"),
    ).select("source", "object_key", text.alias("document"))


def dq_flights_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights documents for validation, as curated (no broken shapes)."""
    docs = flights_raw_documents(spark, sf_dir)
    return docs.select("source", raw_object_key("flights", "ingest_date", "entity")
                       .alias("object_key"), "document")


def dq_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All validation documents: source, object_key, document."""
    parts = [dq_traffic_documents(spark, sf_dir), dq_weather_documents(spark, sf_dir),
             dq_flights_documents(spark, sf_dir)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
