"""Raw payload shaping (ENV-1..5, FLT-1, AGG-1, SNK-7).

Upstream payloads become tagged raw documents, for any number of entities and
days at once. Output of every envelope: one row per document with

    source, ingest_date (text), entity, total_records, object_key, document

where ``document`` is the JSON text that lands in the raw zone.

A document is one entity's day: a group holds what one raw object holds, and
grows with the number of records of an entity-day alone.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from strata.functions.calendar import iso_date_text
from strata.functions.casts import array_length

DOC_COLUMNS = ("source", "ingest_date", "entity", "total_records", "object_key", "document")

# --- fixed values: default raw file names (the <file> part of SNK-7 keys) ---
WEATHER_DOCUMENT_NAME = "open-meteo"
FLIGHTS_AREA_NAME = "Madrid"


def record_count(array_col: Column | str) -> Column:
    """AGG-1: length of a record array; a NULL or missing array counts 0."""
    return F.coalesce(array_length(array_col), F.lit(0))


def raw_object_key(source: Column | str, day: Column | str, entity: Column | str) -> Column:
    """SNK-7 (``source`` text is a literal name, ``day``/``entity`` text are column names): ``<source>/year=YYYY/month=MM/day=DD/<entity>.json`` (zero-padded)."""
    src = F.lit(source) if isinstance(source, str) else source
    d = F.col(day) if isinstance(day, str) else day
    d = d.cast("date")
    ent = F.col(entity) if isinstance(entity, str) else entity
    parts = [src, F.lit("/year="), F.lpad(F.year(d).cast("string"), 4, "0"),
             F.lit("/month="), F.lpad(F.month(d).cast("string"), 2, "0"),
             F.lit("/day="), F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), F.lit("/"), ent]
    return F.concat(*parts, F.lit(".json"))


def _finish(docs: DataFrame, source: str, payload_json: Column) -> DataFrame:
    return docs.select(
        F.lit(source).alias("source"),
        iso_date_text("ingest_date").alias("ingest_date"),
        F.col("entity").cast("string").alias("entity"),
        F.col("total_records").cast("int").alias("total_records"),
        raw_object_key(F.lit(source), "ingest_date", "entity").alias("object_key"),
        payload_json.alias("document"),
    )


def assembled(records: DataFrame, keys: list[Column], record: Column | str, salts: int) -> DataFrame:
    """(keys..., records_json, total_records): record arrays as JSON text, put
    together in two levels for keys that hold a large share of all records.

    Level one turns up to ``salts`` shares of a key into JSON fragments, each in
    its own group; level two joins a key's fragments and adds up their counts, so
    that the task of a hot key concatenates finished text, at most ``salts``
    pieces, and serialises nothing. The total is the key's, whatever the shares."""
    if salts < 1:
        raise ValueError("a document is put together from one share at least")
    value = F.to_json(F.col(record) if isinstance(record, str) else record)
    names = [f"_k{i}" for i in range(len(keys))]
    rows = records.select(*[k.alias(n) for k, n in zip(keys, names)], value.alias("_json"))
    share = F.pmod(F.xxhash64("_json"), F.lit(salts))
    parts = rows.groupBy(*names, share.alias("_share")).agg(
        F.concat_ws(",", F.collect_list("_json")).alias("_part"), F.count("_json").alias("_n"))
    whole = parts.groupBy(*names).agg(F.collect_list("_part").alias("_parts"), F.sum("_n").alias("total_records"))
    text = F.concat(F.lit("["), F.concat_ws(",", "_parts"), F.lit("]"))
    return whole.select(*names, text.alias("records_json"), "total_records")


def traffic_envelope(records: DataFrame, record_col: str = "record", entity_col: str = "entity",
                     date_col: str = "ingest_date", salts: int = 1) -> DataFrame:
    """ENV-1: group traffic records into ``{records, total_records}`` documents,
    one per (entity, day); no source tags are added. ``salts`` above 1 spreads the
    work of a hot entity-day over as many tasks (``assembled``)."""
    keys = [F.col(entity_col).alias("entity"), F.col(date_col).cast("date").alias("ingest_date")]
    if salts > 1:
        found = assembled(records, keys, record_col, salts).withColumnsRenamed({"_k0": "entity", "_k1": "ingest_date"})
        payload = F.concat(F.lit('{"records":'), "records_json", F.lit(',"total_records":'),
                           F.col("total_records").cast("string"), F.lit("}"))
        return _finish(found, "traffic", payload)
    docs = records.groupBy(*keys).agg(F.collect_list(record_col).alias("records"))
    docs = docs.withColumn("total_records", record_count("records"))
    payload = F.to_json(F.struct("records", "total_records"))
    return _finish(docs, "traffic", payload)


def weather_envelope(upstream: DataFrame, date_col: str = "ingest_date",
                     entity: str = WEATHER_DOCUMENT_NAME) -> DataFrame:
    """ENV-2: tag an hourly weather payload with ``source``, ``ingest_date`` and
    ``total_records`` = number of hourly times (0 when missing). A carried
    ``timezone`` is trimmed (D9)."""
    docs = upstream.withColumns({
        "ingest_date": F.col(date_col).cast("date"),
        "timezone": F.trim(F.col("timezone")),
        "total_records": record_count("hourly.time"),
        "entity": F.lit(entity),
    })
    payload = F.to_json(F.struct(
        "latitude", "longitude", "timezone", "hourly",
        F.lit("weather").alias("source"), iso_date_text("ingest_date").alias("ingest_date"),
        "total_records"))
    return _finish(docs, "weather", payload)


def holidays_on_day(holidays: Column | str, day_text: Column | str) -> Column:
    """FLT-1: keep the holidays whose ``date`` text equals the day exactly
    (no parsing; a record without a date never matches)."""
    h = F.col(holidays) if isinstance(holidays, str) else holidays
    d = F.col(day_text) if isinstance(day_text, str) else day_text
    return F.filter(h, lambda rec: F.coalesce(rec["date"] == d, F.lit(False)))


def holidays_envelope(upstream: DataFrame, requests: DataFrame) -> DataFrame:
    """ENV-3: for every ingest request (country_code, ingest_date) build
    ``{source, country_code, ingest_date, total_records, holidays}`` with the
    upstream holidays of that exact day (FLT-1).

    ``upstream`` holds bare lists (country_code, holidays); they are exploded
    and matched to the requests by an equi-join on (country, date text), so no
    list is replicated per requested day. An INNER join, which adaptive
    execution may split on a hot key, gives the days with holidays; requests
    without any come from a LEFT ANTI join against those days' keys, one row
    each, and get an empty document with ``total_records`` 0.
    """
    recs = upstream.select(F.col("country_code").alias("rec_country"),
                           F.explode("holidays").alias("holiday"))
    recs = recs.withColumn("rec_day", F.col("holiday.date"))
    # a repeated request is one document (same key), not duplicated records
    req = requests.select("country_code", F.col("ingest_date").cast("date").alias("ingest_date")
                          ).dropDuplicates(["country_code", "ingest_date"])
    req = req.withColumn("req_day", iso_date_text("ingest_date"))
    on = (F.col("country_code") == F.col("rec_country")) & (F.col("req_day") == F.col("rec_day"))
    keys = ["country_code", "req_day", "ingest_date"]
    full = req.join(recs, on, "inner").groupBy(*keys).agg(F.collect_list("holiday").alias("holidays"))
    seen = full.select(F.col("country_code").alias("rec_country"), F.col("req_day").alias("rec_day"))
    empty = req.join(seen, on, "left_anti").select(
        *keys, F.array().cast(ArrayType(recs.schema["holiday"].dataType)).alias("holidays"))
    docs = full.unionByName(empty)
    docs = docs.withColumns({"total_records": record_count("holidays"),
                             "entity": F.col("country_code")})
    payload = F.to_json(F.struct(
        F.lit("holidays").alias("source"), "country_code",
        iso_date_text("ingest_date").alias("ingest_date"), "total_records", "holidays"))
    return _finish(docs, "holidays", payload)


def snapshot_seconds(as_of: datetime | str) -> int:
    """ENV-5: the snapshot time of a flights payload is the current UTC second
    whatever day is requested; ``as_of`` stands for "now" so runs replay."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return int(as_of.timestamp())


def flights_envelope(upstream: DataFrame, as_of: datetime | str, date_col: str = "ingest_date",
                     entity: str = FLIGHTS_AREA_NAME, states_col: str = "states_json",
                     time_col: str = "time", entity_col: str | None = None) -> DataFrame:
    """ENV-4: tag a state-vector payload with ``source``, ``ingest_date``,
    ``snapshot_time`` (ENV-5) and ``total_records`` = number of states
    (NULL ``states`` counts 0).

    ``states_col`` holds the upstream JSON text of ``states`` - positional
    arrays whose slots mix JSON types - so it is spliced in as text. The area is
    ``entity``, or the payload's ``entity_col`` where that has a value."""
    states = F.coalesce(F.col(states_col), F.lit("null"))
    docs = upstream.withColumns({
        "ingest_date": F.col(date_col).cast("date"),
        "total_records": F.coalesce(F.json_array_length(F.col(states_col)), F.lit(0)),
        "entity": F.coalesce(F.col(entity_col), F.lit(entity)) if entity_col else F.lit(entity),
    })
    snap = snapshot_seconds(as_of)
    payload = F.concat(
        F.lit('{"time":'), F.coalesce(F.col(time_col).cast("string"), F.lit("null")),
        F.lit(',"states":'), states,
        F.lit(',"source":"flights","ingest_date":"'), iso_date_text("ingest_date"),
        F.lit(f'","snapshot_time":{snap},"total_records":'), F.col("total_records").cast("string"),
        F.lit("}"))
    return _finish(docs, "flights", payload)
