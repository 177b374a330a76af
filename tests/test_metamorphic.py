"""Metamorphic and skew tests for every curator on the driver's smallest
tables: duplicated and reshuffled documents give the same curated table; a key
holding a third of all records still yields one row, reduced map-side."""

import pytest
from pyspark.sql import functions as F

from strata.plans import payloads
from strata.sources.raw import parse_documents
from strata.specs import SOURCES
from tests.conftest import SF_SMALL

BUILDERS = {
    "traffic": payloads.traffic_documents,
    "weather": payloads.weather_documents,
    "holidays": payloads.holidays_documents,
    "flights": payloads.flights_raw_documents,
}


@pytest.mark.parametrize("source", sorted(BUILDERS))
def test_duplicated_and_shuffled_documents_same_output(spark, source):
    spec = SOURCES[source]
    docs = BUILDERS[source](spark, SF_SMALL).select("document")
    once = spec.curate(parse_documents(docs, spec.raw_schema))
    twice = docs.unionByName(docs).repartition(7).orderBy(F.rand(11))
    again = spec.curate(parse_documents(twice, spec.raw_schema))
    a, b = once.collect(), again.collect()
    assert len(a) == len(b) > 0
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_hot_key_collapses_map_side(spark):
    """A third of all records share one (centre, hour); the dedupe keeps one
    row and its plan aggregates partially before the exchange."""
    spec = SOURCES["traffic"]
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    n = ev.count()
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("event_id") + 1)
    rec = ev.select(
        (F.col("event_id") % 50).cast("string").alias("entity"), F.lit("2026-04-22").alias("ingest_date"),
        F.struct(F.lit("HOT").alias("center_id"),
                 F.format_string("2026-04-22T%02d:00:00", hot % 24).alias("timestamp"),
                 F.col("event_id").alias("visitors_count")).alias("record"))
    from strata.operators.envelopes import traffic_envelope
    docs = traffic_envelope(rec)
    out = spec.curate(parse_documents(docs, spec.raw_schema))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    rows = {r.event_timestamp.hour: r.visitors_count for r in out.collect()}
    assert len(rows) == ev.select(hot % 24).distinct().count()
    assert rows[0] == 0  # smallest payload of the hot key
    assert ev.where(F.col("event_id") % 3 == 0).count() * 3 >= n - 2
