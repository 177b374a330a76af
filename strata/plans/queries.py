"""Registered queries over the driver's tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the DuckDB oracle of the same name in ``plans.oracles``. The tables are
not payload-shaped, so most queries first build the raw documents a source
would land (``plans.payloads``) and then run the operators on them; every
query reads whole tables. Queries that exercise storage (raw round trips,
curated reruns, the job, validation of landed files, streaming) write below
the session's ``spark.checkpoint.dir`` first. Zoned timestamps are shown as
TIMESTAMP_NTZ (wall clock) so both engines present the same type; results do
not depend on the session zone or ANSI setting.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from strata import schemas
from strata.functions.calendar import day_label, hour_bucket
from strata.functions.casts import array_length
from strata.operators import curators, expectation, quality
from strata.operators.dedupe import dedupe_by
from strata.operators.envelopes import traffic_envelope
from strata.operators.partitions import add_event_partitions
from strata.plans import payloads
from strata.session import scratch_path
from strata.sinks.curated import write_curated
from strata.sinks.raw import write_raw
from strata.sources.raw import parse_documents, read_curated, read_raw, read_raw_days, read_raw_objects

Query = Callable[[SparkSession, str], DataFrame]


def as_ntz(df: DataFrame) -> DataFrame:
    """Present zoned timestamps as NTZ wall-clock values."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


# -- raw documents parsed with the declared schemas (in-memory SRC-1) -------

def traffic_raw(spark: SparkSession, sf_dir: str, null_center_type: str | None = None) -> DataFrame:
    docs = payloads.traffic_documents(spark, sf_dir, null_center_type)
    return parse_documents(docs, schemas.TRAFFIC_RAW)


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(payloads.weather_documents(spark, sf_dir), schemas.WEATHER_RAW)


def holidays_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(payloads.holidays_documents(spark, sf_dir), schemas.HOLIDAYS_RAW)


def flights_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(payloads.flights_raw_documents(spark, sf_dir), schemas.FLIGHTS_RAW)


# -- curated tables (CUR-1..4 with DED-1 and PRT-1) --------------------------

def traffic_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: EXP-2 -> CUR-1 -> DED-1 -> PRT-1 over every traffic document."""
    return as_ntz(curators.curate_traffic(traffic_raw(spark, sf_dir)))


def weather_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-3 -> CUR-2 -> DED-1 -> PRT-1."""
    return as_ntz(curators.curate_weather(weather_raw(spark, sf_dir)))


def holidays_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-2 with carried columns -> CUR-3 (coalesced date) -> newest-wins DED-1."""
    return curators.curate_holidays(holidays_raw(spark, sf_dir))


def flights_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-1 -> positional decode CUR-4 -> newest-wins DED-1."""
    return curators.curate_flights(flights_raw(spark, sf_dir))


# -- row generators before dedupe (EXP-1..3) ---------------------------------

def explode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-2: every traffic record as a typed row, no dedupe."""
    return as_ntz(curators.project_traffic(traffic_raw(spark, sf_dir)))


def explode_zipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-3: every hourly position of every weather document, no dedupe."""
    return as_ntz(curators.project_weather(weather_raw(spark, sf_dir)))


def explode_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-1 + SCL-5: every state vector decoded by slot, no dedupe."""
    return curators.project_flights(flights_raw(spark, sf_dir))


def dedupe_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-1 where one key part is NULL for a fifth of the records: NULL
    centres of the same hour collapse into one group."""
    raw = traffic_raw(spark, sf_dir, null_center_type="view")
    return as_ntz(dedupe_by(curators.project_traffic(raw), curators.TRAFFIC_KEYS))


def event_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRT-1 over every order's date."""
    o = payloads.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("event_date"))
    return add_event_partitions(o)


# -- raw and curated zones on storage (SRC-1/2, SNK-1/3/6) --------------------

SCAN_WEEK = ("2024-01-08", "2024-01-14")


def raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6 then SRC-1: land every traffic document one-per-file under the
    checkpoint folder, read every file of the raw zone back with the declared
    schema and curate it."""
    root = scratch_path(spark, "raw-document")
    target = write_raw(payloads.traffic_documents(spark, sf_dir), root, "traffic", "document",
                       by_entity=False)
    raw = read_raw_objects(spark, target, schemas.TRAFFIC_RAW)
    return as_ntz(curators.curate_traffic(raw))


_DOCUMENTS = {
    "traffic": payloads.traffic_documents,
    "weather": payloads.weather_documents,
    "holidays": payloads.holidays_documents,
    "flights": payloads.flights_raw_documents,
}


def _from_landed(source: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from strata.specs import get_spec

        spec = get_spec(source)
        root = scratch_path(spark, f"landed-{source}")
        target = write_raw(_DOCUMENTS[source](spark, sf_dir), root, source, "lines", by_entity=False)
        return as_ntz(spec.curate(read_raw(spark, target, spec.raw_schema, "lines")))
    run.__doc__ = (f"SNK-6 then SRC-1 for {source}: land the documents as JSON Lines, read "
                   "them back with the declared schema (the file reader, not from_json) "
                   "and curate.")
    run.__name__ = f"{source}_from_landed"
    return run


traffic_from_landed = _from_landed("traffic")
weather_from_landed = _from_landed("weather")
holidays_from_landed = _from_landed("holidays")
flights_from_landed = _from_landed("flights")


def raw_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2 over a date range: land the traffic documents as JSON Lines, then
    read one ingest week from the source folder; the day predicate is a
    partition filter, so other days' folders are never opened."""
    root = scratch_path(spark, "raw-lines")
    write_raw(payloads.traffic_documents(spark, sf_dir), root, "traffic", "lines", by_entity=False)
    raw = read_raw_days(spark, root, "traffic", schemas.TRAFFIC_RAW, *SCAN_WEEK, raw_format="lines")
    return as_ntz(curators.project_traffic(raw))


def curated_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1/SNK-3 idempotence (D4): write the curated table, rerun three days
    of it with the default partition-overwrite mode, read the table back.
    Other days survive and the rerun days are not duplicated."""
    path = scratch_path(spark, "curated-traffic")
    first = curators.curate_traffic(traffic_raw(spark, sf_dir))
    write_curated(first, path=path)
    rerun = curators.curate_traffic(traffic_raw(spark, sf_dir)).where(
        F.col("event_date").between("2024-01-10", "2024-01-12"))
    write_curated(rerun, path=path)
    back = read_curated(spark, path)
    return as_ntz(back.select(*first.columns))


def curation_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-3/API-4 end to end: land the traffic documents (JSON Lines), run
    the curation job over the whole ingest range given as CLI parameters
    (partition-pruned day range), read the curated table back."""
    from strata.jobs import JobParams, run_curation

    root = scratch_path(spark, "job")
    docs = payloads.traffic_documents(spark, sf_dir)
    write_raw(docs, f"{root}/raw", "traffic", "lines", by_entity=False)
    first, last = payloads.table(spark, sf_dir, "events").select(
        F.min(F.to_date("ts")).cast("string"), F.max(F.to_date("ts")).cast("string")).first()
    params = JobParams.from_args(
        ["curate", "--SOURCE_NAME", "traffic", "--RAW_BUCKET", f"{root}/raw",
         "--CURATED_BUCKET", f"{root}/curated", "--INGEST_DATE", first, "--END_DATE", last,
         "--RAW_FORMAT", "lines"], env={})
    report = run_curation(spark, params, register_table=False, quarantine=False)
    back = read_curated(spark, report["output"])
    return as_ntz(back.select(*curators.curate_traffic(traffic_raw(spark, sf_dir)).columns))


# -- payload validation (DQ-1..9) --------------------------------------------

# Rules of the validation queries: the standard rule of each source plus one
# rule per error class.
DQ_RULES = (
    quality.Rule(2, "records", "count", "traffic"),
    quality.Rule(2, "total_records", "value", "traffic"),
    quality.Rule(1, "records", "gte", "traffic"),
    quality.Rule(1, "", "value", "traffic"),
    quality.Rule(1, "records.x", "count", "traffic"),
    quality.Rule(1, "total_records", "sum", "traffic"),
    quality.Rule(1, "meta.source", "value", "traffic"),
    quality.Rule(2, "hourly.time", "count", "weather"),
    quality.Rule(1, "hourly.time", "gte", "weather"),
    quality.Rule(2, "total_records", "value", "weather"),
    quality.Rule(1, "states", "gte", "flights"),
    quality.Rule(10, "total_records", "value", "flights"),
)


def dq_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-1..7: a verdict per (document, rule) over every traffic, weather and
    flights document, including malformed and wrongly shaped ones."""
    return quality.verdicts(payloads.dq_documents(spark, sf_dir), DQ_RULES)


def dq_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6 + DQ-8: land the traffic documents, scan them back as whole
    documents (text, no schema) and apply the standard traffic rule (24
    hourly records per document); one verdict per landed document."""
    from strata.sources.raw import read_documents_text

    root = scratch_path(spark, "dq-landed")
    target = write_raw(payloads.traffic_documents(spark, sf_dir), root, "traffic", "lines", by_entity=False)
    texts = read_documents_text(spark, target, "lines").withColumn("source", F.lit("traffic"))
    rules = [r for r in quality.standard_rules() if r.source == "traffic"]
    v = quality.verdicts(texts, rules, id_col="path")
    return v.drop("document")


def flights_snapshot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D11 report over curated flights: per event date, states whose
    snapshot lies on another day."""
    return quality.snapshot_day_check(curators.curate_flights(flights_raw(spark, sf_dir)))


def _dq_mode(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = [r for r in DQ_RULES if r.mode == mode]
        return quality.verdicts(payloads.dq_documents(spark, sf_dir), rules)
    run.__doc__ = f"Verdicts of the ``{mode}`` rules over every validation document."
    run.__name__ = f"dq_{mode}"
    return run


dq_value = _dq_mode("value")   # DQ-2
dq_count = _dq_mode("count")   # DQ-3
dq_gte = _dq_mode("gte")       # DQ-4


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-9 report: documents per (source, rule, status, error class)."""
    return quality.summarize(dq_verdicts(spark, sf_dir))


# -- raw payload shaping (ENV-1..5, FLT-1, AGG-1, SNK-7) ----------------------

_ENVELOPE_COLS = ("source", "ingest_date", "entity", "total_records", "object_key")


def envelope_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENV-1 + AGG-1 + SNK-7: traffic documents per (centre, day)."""
    return payloads.traffic_documents(spark, sf_dir).select(*_ENVELOPE_COLS)


def envelope_hot_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENV-1 where one centre has a third of all records: its days are put
    together from salted shares; the documents parse back to all their records."""
    recs = payloads.traffic_records(spark, sf_dir)
    user = F.substring("entity", 2, 20).cast("long")
    recs = recs.withColumn("entity", F.when(F.pmod(user, F.lit(3)) == 0, F.lit("hot")).otherwise(F.col("entity")))
    docs = traffic_envelope(recs, salts=16)
    back = F.from_json("document", schemas.TRAFFIC_RAW)
    visitors = F.aggregate(back["records"], F.lit(0).cast("long"),
                           lambda acc, r: acc + F.coalesce(r["visitors_count"].cast("long"), F.lit(0)))
    return docs.select(*_ENVELOPE_COLS, F.size(back["records"]).cast("long").alias("records"), visitors.alias("visitors"))


def raw_object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-7: the raw object key of every (centre, day) with traffic."""
    from strata.operators.envelopes import raw_object_key

    ev = payloads.table(spark, sf_dir, "events")
    pairs = ev.select(F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("entity"),
                      F.to_date("ts").alias("ingest_date")).distinct()
    return pairs.select("entity", "ingest_date",
                        raw_object_key("traffic", "ingest_date", "entity").alias("object_key"))


def _with_payload(docs: DataFrame, schema) -> DataFrame:
    """Envelope columns plus the parsed document as a ``payload`` struct."""
    return docs.select(*_ENVELOPE_COLS, F.from_json("document", schema).alias("payload"))


def envelope_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENV-2: weather payloads tagged with source, day, record count; the
    carried time zone is trimmed (D9)."""
    docs = _with_payload(payloads.weather_documents(spark, sf_dir), schemas.WEATHER_RAW)
    return docs.select(*_ENVELOPE_COLS, F.col("payload.timezone").alias("timezone"),
                       F.col("payload.latitude").cast("double").alias("latitude"))


def envelope_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENV-3 + FLT-1: one document per ingest request with only that day's
    holidays; requests without a holiday get an empty document."""
    docs = _with_payload(payloads.holidays_envelopes(spark, sf_dir), schemas.HOLIDAYS_RAW)
    matching = F.aggregate(
        "payload.holidays", F.lit(0).cast("long"),
        lambda acc, h: acc + F.when(h["date"] == F.col("ingest_date"), 1).otherwise(0))
    return docs.select(*_ENVELOPE_COLS, F.col("payload.country_code").alias("country_code"),
                       matching.alias("matching_records"))


def envelope_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENV-4 + ENV-5: flights payloads tagged with source, day, the snapshot
    second of the run and the number of states."""
    docs = _with_payload(payloads.flights_envelopes(spark, sf_dir), schemas.FLIGHTS_RAW)
    return docs.select(*_ENVELOPE_COLS,
                       F.col("payload.snapshot_time").cast("long").alias("snapshot_time"),
                       array_length("payload.states").alias("states"))


# -- traffic expectation model (GEN-1..13) -----------------------------------

def centre_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per centre, the first and last day it has events: the range a
    traffic request for that centre would cover."""
    ev = payloads.table(spark, sf_dir, "events")
    return ev.groupBy(F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("center_id")).agg(
        F.min(F.to_date("ts")).alias("from_date"), F.max(F.to_date("ts")).alias("to_date"))


def hourly_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-1/2/4: 24 NTZ hours per day of every centre's range."""
    return expectation.hourly_spine(centre_ranges(spark, sf_dir))


def missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-13: spine hours for which no traffic record exists. A repeated record
    sets its hour's bit again, so the records need no dedupe first."""
    observed = curators.project_traffic(traffic_raw(spark, sf_dir))
    return expectation.missing_hours(centre_ranges(spark, sf_dir), observed)


def expected_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-6..12 on curated traffic: expected count, noise band and whether
    the observed count lies inside it."""
    traffic = as_ntz(curators.curate_traffic(traffic_raw(spark, sf_dir)))
    out = expectation.with_expectation(traffic)
    return out.select("center_id", "event_timestamp", "visitors_count", "expected_visitors",
                      "lower_bound", "upper_bound", "in_band")


def noise_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-12: for every curated traffic record, the integer band a noisy
    count around the expectation falls in, and whether the observed count
    does."""
    out = expectation.with_expectation(as_ntz(curators.curate_traffic(traffic_raw(spark, sf_dir))))
    return out.select("center_id", "event_timestamp", "visitors_count", "lower_bound",
                      "upper_bound", "in_band")


def spine_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-1 + GEN-5 + GEN-11: the model's expectation for every spine hour,
    using the observed weather/holiday of that hour when a record exists and
    the defaults otherwise (day-grain join, hourly expansion after it)."""
    traffic = curators.curate_traffic(traffic_raw(spark, sf_dir))
    observed = ("weather_condition", "temperature_c", "is_holiday")
    joined = expectation.with_defaults(
        expectation.attach_observed(centre_ranges(spark, sf_dir), traffic, observed))
    return expectation.add_expected(joined).select(
        "center_id", "event_timestamp", "day_of_week", *observed, "expected_visitors")


def null_arrays_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-2: documents whose ``records`` are null, missing or empty (users 0, 1
    and 2 of every six) contribute nothing."""
    shape = F.pmod(F.substring("entity", 2, 20).cast("long"), F.lit(6))
    docs = payloads.traffic_documents(spark, sf_dir).withColumn("document", F.when(
        shape == 0, '{"records":null,"total_records":0}').when(shape == 1, '{"total_records":0}')
        .when(shape == 2, '{"records":[],"total_records":0}').otherwise(F.col("document")))
    return as_ntz(curators.curate_traffic(parse_documents(docs, schemas.TRAFFIC_RAW)))


def null_states_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-2 for positional arrays: ``states`` is null on even days."""
    docs = payloads.flights_raw_documents(spark, sf_dir).withColumn("document", F.when(
        F.pmod(F.dayofmonth(F.col("ingest_date").cast("date")), F.lit(2)) == 0,
        F.regexp_replace("document", r'"states":\[.*\],"source"', '"states":null,"source"'))
        .otherwise(F.col("document")))
    return as_ntz(curators.curate_flights(parse_documents(docs, schemas.FLIGHTS_RAW)))


def dq_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-7: a rule of an expectation alone checks the value of total_records,
    and belongs to every source."""
    return quality.verdicts(payloads.dq_traffic_documents(spark, sf_dir), [quality.Rule(" 2 ")])


def calendar_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-6..12 over the orders' calendar: every month, weekday and hour, the
    closed days, heavy rain and heat."""
    o = payloads.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.timestamp_add("HOUR", F.pmod("o_orderkey", F.lit(24)).cast("int"),
                                      F.to_date("o_orderdate").cast("timestamp_ntz")).alias("event_timestamp"),
        F.when(F.col("o_orderstatus") == "F", "heavy rain").otherwise("sunny").alias("weather_condition"),
        F.pmod("o_custkey", F.lit(50)).cast("double").alias("temperature_c"),
        (F.pmod("o_custkey", F.lit(3)) == 0).alias("is_holiday"))
    return expectation.add_expected(o, band=True).select(
        "o_orderkey", "event_timestamp", "expected_visitors", "lower_bound", "upper_bound")


def single_day_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-2: ranges of one day, from = to, for every (status, order day)."""
    o = payloads.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("center_id"), F.to_date("o_orderdate").alias("from_date")).distinct()
    return expectation.hourly_spine(o.withColumn("to_date", F.col("from_date")))


def _job(source_root: str, curated: str, first: str, last: str, *more: str):
    from strata.jobs import JobParams

    return JobParams.from_args(["curate", "--SOURCE_NAME", "traffic", "--RAW_BUCKET", source_root, "--CURATED_BUCKET",
                                curated, "--INGEST_DATE", first, "--END_DATE", last, "--RAW_FORMAT", "lines", *more],
                               env={})


def _event_days(spark: SparkSession, sf_dir: str):
    return payloads.table(spark, sf_dir, "events").select(
        F.min(F.to_date("ts")), F.max(F.to_date("ts")), F.date_add(F.min(F.to_date("ts")), 14)).first()


def late_record_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-4 with late records: every record of an odd user lands a day late,
    in the next day's documents. Two runs, the first half of the days and then
    the rest, must give what one run over all would: rows of days that a run
    doesn't own join what is there."""
    from strata.jobs import run_curation

    root = scratch_path(spark, "late")
    docs = payloads.traffic_documents(spark, sf_dir)
    odd = F.pmod(F.substring("entity", 2, 20).cast("long"), F.lit(2)) == 1
    landed = docs.withColumn("ingest_date", F.when(odd, F.date_add(F.col("ingest_date").cast("date"), 1))
                             .otherwise(F.col("ingest_date").cast("date")))
    write_raw(landed, f"{root}/raw", "traffic", "lines", by_entity=False)
    first, last, middle = _event_days(spark, sf_dir)
    day = timedelta(days=1)
    for lo, hi in ((first, middle), (middle + day, last + day)):
        report = run_curation(spark, _job(f"{root}/raw", f"{root}/curated", str(lo), str(hi), "--MISSING_DAYS", "skip"),
                              register_table=False)
    back = read_curated(spark, report["output"])
    return as_ntz(back.select(*curators.curate_traffic(traffic_raw(spark, sf_dir)).columns))


def rerun_after_late_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-4/SNK-3, reruns: every third user's records land three days late. The
    first half of the days is run, then the rest, then the first half again: the
    rerun must keep the late records of its days that lie in folders of the
    other half, and the table must equal one run over everything."""
    from strata.jobs import run_curation

    root = scratch_path(spark, "rerun")
    docs = payloads.traffic_documents(spark, sf_dir)
    late = F.pmod(F.substring("entity", 2, 20).cast("long"), F.lit(3)) == 0
    day = F.col("ingest_date").cast("date")
    write_raw(docs.withColumn("ingest_date", F.when(late, F.date_add(day, 3)).otherwise(day)), f"{root}/raw", "traffic",
              "lines", by_entity=False)
    first, last, middle = _event_days(spark, sf_dir)
    halves = ((first, middle), (middle + timedelta(days=1), last + timedelta(days=3)))
    for lo, hi in (*halves, halves[0]):
        report = run_curation(spark, _job(f"{root}/raw", f"{root}/curated", str(lo), str(hi), "--MISSING_DAYS", "skip"),
                              register_table=False)
    back = read_curated(spark, report["output"])
    return as_ntz(back.select(*curators.curate_traffic(traffic_raw(spark, sf_dir)).columns))


def _landed_late(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Traffic documents in two halves by a hash of their records, so that copies
    of a key lie in both; the second half lands three days late. Returns the
    second half; the first is landed."""
    recs = payloads.traffic_records(spark, sf_dir)
    half = F.pmod(F.xxhash64(F.to_json("record")), F.lit(2))
    first, second = (traffic_envelope(recs.where(half == n)) for n in (0, 1))
    write_raw(first, f"{root}/raw", "traffic", "lines", by_entity=False)
    return second.withColumn("ingest_date", F.date_add(F.col("ingest_date").cast("date"), 3))


def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2 by landing time: half of the records land and are taken in, then
    the rest lands late, in other folders, and a second run opens the new files
    only. Copies of a key meet across both; the table equals one full run."""
    from strata.jobs import run_incremental

    root = scratch_path(spark, "incremental")
    late = _landed_late(spark, sf_dir, root)
    params = _job(f"{root}/raw", f"{root}/curated", "2024-01-01", "2024-01-01")
    run_incremental(spark, params, register_table=False, overlap=timedelta(0))
    write_raw(late, f"{root}/raw", "traffic", "lines", by_entity=False, mode="append")
    report = run_incremental(spark, params, register_table=False, overlap=timedelta(0))
    back = read_curated(spark, report["output"])
    return as_ntz(back.select(*curators.curate_traffic(traffic_raw(spark, sf_dir)).columns))


def stream_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-1 in the stream: the same two landings go through micro-batches that
    merge into the table. Late rows are kept and every key's survivor is the
    batch curator's."""
    from strata.specs import get_spec
    from strata.streaming.incremental import start_merge_stream

    root = scratch_path(spark, "stream-merge")
    late = _landed_late(spark, sf_dir, root)
    run = lambda: start_merge_stream(spark, get_spec("traffic"), f"{root}/raw/traffic", f"{root}/out",
                                     f"{root}/checkpoint").awaitTermination()
    run()
    write_raw(late, f"{root}/raw", "traffic", "lines", by_entity=False, mode="append")
    run()
    back = read_curated(spark, f"{root}/out")
    return as_ntz(back.select(*curators.curate_traffic(traffic_raw(spark, sf_dir)).columns))


def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1 compaction: the curated rows are appended in three writes, so every
    day has several files, then packed: rows and files of each day."""
    from strata.sinks.compaction import compact, partition_files

    path = scratch_path(spark, "compaction")
    rows = curators.curate_traffic(traffic_raw(spark, sf_dir))
    third = F.pmod(F.xxhash64("center_id", "event_timestamp"), F.lit(3))
    for n in range(3):
        write_curated(rows.where(third == n), path=path, mode="append")
    compact(spark, path)
    counts = read_curated(spark, path).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(partition_files(spark, path).select("year", "month", "day", "files"), ["year", "month", "day"])


def explicit_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3 and SCL-10: the job over an explicit input path, its source spelled
    with blanks and capitals."""
    from strata.jobs import JobParams, run_curation

    root = scratch_path(spark, "explicit")
    write_raw(payloads.traffic_documents(spark, sf_dir), f"{root}/drop", "anything", "lines", by_entity=False)
    params = JobParams.from_args(["curate", "--SOURCE_NAME", " TraFFic\t", "--INPUT_PATH", f"{root}/drop/anything",
                                  "--OUTPUT_PATH", f"{root}/out", "--RAW_FORMAT", "lines"], env={})
    report = run_curation(spark, params, register_table=False)
    back = read_curated(spark, report["output"])
    return as_ntz(back.select(*curators.curate_traffic(traffic_raw(spark, sf_dir)).columns))


def reversed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-3: requests from each order's day to the middle of its month; those
    of later days are reversed."""
    o = payloads.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("from_date"),
        F.date_add(F.trunc(F.to_date("o_orderdate"), "month"), 14).alias("to_date"))
    return expectation.reversed_ranges(o)


def dq_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-8 for every source: the standard rules, with an expected value for
    holidays, over the documents of all four."""
    docs = None
    for source, build in _DOCUMENTS.items():
        found = build(spark, sf_dir).select(F.lit(source).alias("source"), "document", F.sha2("document", 256).alias("id"))
        docs = found if docs is None else docs.unionByName(found)
    found = quality.verdicts(docs, quality.standard_rules({"holidays": 3}), id_col="id")
    return found.groupBy("source", "field_path", "mode", "expected", "actual", "status", "error_class").agg(
        F.count(F.lit(1)).alias("documents"))


def dq_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6 with one document a file: documents stored as objects, scanned back
    whole and judged by the standard traffic rule."""
    from strata.sinks.objects import write_objects
    from strata.sources.raw import read_documents_text

    root = scratch_path(spark, "dq-objects")
    write_objects(payloads.traffic_documents(spark, sf_dir), root)
    texts = read_documents_text(spark, f"{root}/traffic", "document").withColumn("source", F.lit("traffic"))
    rules = [r for r in quality.standard_rules() if r.source == "traffic"]
    found = quality.verdicts(texts, rules, id_col="path")
    return found.withColumn("document", F.regexp_extract("document", "traffic/year=.*$", 0))


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-9: the batch gate over all traffic documents, for each number of
    records that a document may be expected to have at least."""
    docs = payloads.traffic_documents(spark, sf_dir).withColumn("id", F.col("object_key"))
    rows = []
    for least in (1, 2, 3, 24):
        try:
            quality.assert_passed(quality.verdicts(docs, [quality.Rule(least, "records", "gte", "traffic")], id_col="id"))
            rows.append((least, "PASS"))
        except quality.ValidationFailed:
            rows.append((least, "FAIL"))
    return spark.createDataFrame(rows, "at_least int, gate string")


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5: documents whose shape changes by day of the month - a field is
    added, renamed or becomes an object - against the declared schemas."""
    from strata.operators.drift import schema_drift as drift

    turn = F.pmod(F.dayofmonth(F.col("ingest_date").cast("date")), F.lit(5))
    doc = F.col("document")
    traffic = payloads.traffic_documents(spark, sf_dir).select("source", "ingest_date", F.when(
        turn == 0, F.regexp_replace(doc, r'"records":\[\{', '"records":[{"gate":"G1",')).when(
        turn == 1, F.regexp_replace(doc, '"total_records":', '"total":')).when(
        turn == 2, F.regexp_replace(doc, '"total_records":([0-9]+)', '"total_records":{"n":$1}'))
        .otherwise(doc).alias("document"))
    weather = payloads.weather_documents(spark, sf_dir).select("source", "ingest_date", F.when(
        turn == 3, F.regexp_replace(doc, '"timezone":"[^"]*",', "")).otherwise(doc).alias("document"))
    holidays = payloads.holidays_documents(spark, sf_dir).select("source", "ingest_date", "document")
    return drift(traffic.unionByName(weather).unionByName(holidays),
                 {"traffic": schemas.TRAFFIC_RAW, "weather": schemas.WEATHER_RAW, "holidays": schemas.HOLIDAYS_RAW})


def raw_two_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6 by object: the centres' documents land in two writes over the same
    days; the second leaves the first's alone."""
    root = scratch_path(spark, "entities")
    docs = payloads.traffic_documents(spark, sf_dir)
    half = F.pmod(F.substring("entity", 2, 20).cast("long"), F.lit(2))
    # a few entity folders a day, as many small ones would be in a bulk load
    docs = docs.withColumn("entity", F.concat(F.lit("half-"), half.cast("string")))
    for n in (0, 1):
        target = write_raw(docs.where(F.col("entity") == f"half-{n}"), root, "traffic", "lines")
    return as_ntz(curators.curate_traffic(read_raw(spark, target, schemas.TRAFFIC_RAW, "lines")))


def stored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6/SNK-7 as an object store: every (centre, day) document is stored
    under its own key, then every seventh centre's documents are written again,
    changed. The stored paths are the keys, and the last write of a key wins."""
    from strata.sinks.objects import list_objects, write_objects

    root = scratch_path(spark, "objects")
    docs = payloads.traffic_documents(spark, sf_dir)
    write_objects(docs, root)
    seventh = F.pmod(F.substring("entity", 2, 20).cast("long"), F.lit(7)) == 0
    emptied = F.concat(F.lit('{"records":[],"total_records":'), (-F.col("total_records")).cast("string"), F.lit("}"))
    write_objects(docs.where(seventh).withColumn("document", emptied), root)
    return list_objects(spark, root, "traffic").select(
        "object_key", F.get_json_object("document", "$.total_records").cast("long").alias("total_records"),
        F.json_array_length(F.get_json_object("document", "$.records")).cast("long").alias("records"))


def catalog_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1/SNK-3/SNK-4: half of the days are written to a folder, a table is
    then registered over it by a job in mode append, which adds the rest; the
    catalog gives all days back."""
    from strata.jobs import run_curation

    root = scratch_path(spark, "append")
    write_raw(payloads.traffic_documents(spark, sf_dir), f"{root}/raw", "traffic", "lines", by_entity=False)
    first, last, middle = _event_days(spark, sf_dir)
    run_curation(spark, _job(f"{root}/raw", f"{root}/curated", str(first), str(middle), "--MISSING_DAYS", "skip"),
                 register_table=False)
    database = "strata_" + root.rsplit("-", 1)[-1]
    report = run_curation(spark, _job(f"{root}/raw", f"{root}/curated", str(middle + timedelta(days=1)), str(last),
                                      "--MISSING_DAYS", "skip", "--WRITE_MODE", "append", "--CURATED_DATABASE", database))
    back = read_curated(spark, table=report["table"])
    return as_ntz(back.select(*curators.curate_traffic(traffic_raw(spark, sf_dir)).columns))


def day_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-3 + GEN-4 over every order timestamp."""
    o = payloads.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", hour_bucket("o_orderdate").alias("hour_bucket"),
                    day_label("o_orderdate").alias("day_of_week"))


# -- incremental curation (Structured Streaming) ---------------------------------

def traffic_stream_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the traffic documents as JSON Lines, curate them with the
    streaming path (watermark + first-arrival dedupe, checkpointed Parquet
    sink, available-now trigger, one micro-batch, so no row is late) and return
    the curated key set."""
    from strata.specs import get_spec
    from strata.streaming.incremental import start_curation_stream

    root = scratch_path(spark, "stream")
    write_raw(payloads.traffic_documents(spark, sf_dir), f"{root}/raw", "traffic", "lines", by_entity=False)
    q = start_curation_stream(spark, get_spec("traffic"), f"{root}/raw/traffic", f"{root}/out",
                              f"{root}/checkpoint", raw_format="lines")
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return as_ntz(out.select("center_id", "event_timestamp", "event_date", "year", "month", "day"))


QUERIES: dict[str, Query] = {
    "traffic_curated": traffic_curated,
    "weather_curated": weather_curated,
    "holidays_curated": holidays_curated,
    "flights_curated": flights_curated,
    "explode_records": explode_records,
    "explode_zipped": explode_zipped,
    "explode_positional": explode_positional,
    "dedupe_null_keys": dedupe_null_keys,
    "event_partitions": event_partitions,
    "raw_roundtrip": raw_roundtrip,
    "raw_day_scan": raw_day_scan,
    "traffic_from_landed": traffic_from_landed,
    "weather_from_landed": weather_from_landed,
    "holidays_from_landed": holidays_from_landed,
    "flights_from_landed": flights_from_landed,
    "curated_rerun": curated_rerun,
    "curation_job": curation_job,
    "dq_verdicts": dq_verdicts,
    "dq_summary": dq_summary,
    "dq_value": dq_value,
    "dq_count": dq_count,
    "dq_gte": dq_gte,
    "dq_landed": dq_landed,
    "flights_snapshot_check": flights_snapshot_check,
    "envelope_traffic": envelope_traffic,
    "envelope_hot_day": envelope_hot_day,
    "raw_object_keys": raw_object_keys,
    "envelope_weather": envelope_weather,
    "envelope_holidays": envelope_holidays,
    "envelope_flights": envelope_flights,
    "hourly_spine": hourly_spine,
    "missing_hours": missing_hours,
    "expected_visitors": expected_visitors,
    "noise_band": noise_band,
    "spine_expected": spine_expected,
    "day_labels": day_labels,
    "traffic_stream_keys": traffic_stream_keys,
    "null_arrays_traffic": null_arrays_traffic,
    "null_states_flights": null_states_flights,
    "dq_defaults": dq_defaults,
    "calendar_expected": calendar_expected,
    "single_day_spine": single_day_spine,
    "late_record_kept": late_record_kept,
    "rerun_after_late_record": rerun_after_late_record,
    "incremental_runs": incremental_runs,
    "stream_merged": stream_merged,
    "compacted_table": compacted_table,
    "explicit_input": explicit_input,
    "reversed_ranges": reversed_ranges,
    "dq_standard": dq_standard,
    "dq_objects": dq_objects,
    "dq_gate": dq_gate,
    "schema_drift": schema_drift,
    "raw_two_entities": raw_two_entities,
    "stored_objects": stored_objects,
    "catalog_append": catalog_append,
}
