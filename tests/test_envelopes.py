"""ENV-1..5, FLT-1, AGG-1, SNK-7: payload shaping and raw object keys."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from strata.operators import envelopes as env


def by_day(df):
    return {r.ingest_date: (r, json.loads(r.document)) for r in df.collect()}


def test_traffic_documents_are_one_entitys_day(spark):
    rows = [("north", "2025-11-30", 5), ("north", "2025-12-01", 3), ("south", "2025-12-01", 1)]
    recs = spark.createDataFrame(rows, "who string, d string, n int").select(
        F.col("who").alias("entity"), F.col("d").alias("ingest_date"),
        F.explode(F.transform(F.sequence(F.lit(1), "n"), lambda i: F.struct(i.alias("v")))).alias("record"))
    got = {(r.entity, r.ingest_date): r for r in env.traffic_envelope(recs.repartition(3)).collect()}
    assert set(got) == {(w, d) for w, d, _ in rows}
    for w, d, n in rows:
        payload = json.loads(got[w, d].document)
        assert payload["total_records"] == got[w, d].total_records == len(payload["records"]) == n
        assert set(payload) == {"records", "total_records"}
        assert got[w, d].object_key == f"traffic/year={d[:4]}/month={d[5:7]}/day={d[8:]}/{w}.json"


def test_weather_tags(spark):
    up = spark.createDataFrame(
        [(1.5, 2.5, "  Asia/Tokyo", (["a", "b", "c"],), "2025-01-09"), (1.5, 2.5, None, ([],), "2025-01-10"),
         (1.5, 2.5, "UTC", (None,), "2025-01-11"), (1.5, 2.5, "UTC", None, "2025-01-12")],
        "latitude double, longitude double, timezone string, hourly struct<time:array<string>>, ingest_date string")
    docs = by_day(env.weather_envelope(up, entity="tokyo"))
    assert [docs[f"2025-01-{d}"][0].total_records for d in ("09", "10", "11", "12")] == [3, 0, 0, 0]
    row, payload = docs["2025-01-09"]
    assert payload["timezone"] == "Asia/Tokyo" and payload["source"] == "weather"
    assert payload["ingest_date"] == "2025-01-09" and payload["total_records"] == 3
    assert row.object_key.endswith("/day=09/tokyo.json")


def test_holidays_match_the_exact_day_text(spark):
    listed = [("PT", [("2025-06-10", "a"), ("2025-06-10", "b"), ("2025-6-10", "unpadded"), (None, "undated")]),
              ("PT", [("2025-06-13", "c")]), ("IT", [("2025-06-02", "d")])]
    up = spark.createDataFrame(listed, "country_code string, holidays array<struct<date:string,name:string>>")
    asked = [("PT", d) for d in ("2025-06-10", "2025-06-13", "2025-06-14")] + [("IT", "2025-06-10")]
    req = spark.createDataFrame(asked * 2, "country_code string, ingest_date string")
    got = {(r.entity, r.ingest_date): json.loads(r.document) for r in env.holidays_envelope(up, req).collect()}
    names = {k: sorted(h["name"] for h in d["holidays"]) for k, d in got.items()}
    assert names == {asked[0]: ["a", "b"], asked[1]: ["c"], asked[2]: [], asked[3]: []}
    assert all(d["total_records"] == len(d["holidays"]) and d["country_code"] == k[0] for k, d in got.items())
    kept = up.select(F.transform(env.holidays_on_day("holidays", F.lit("2025-06-10")), lambda h: h["name"]).alias("n"))
    assert sorted(map(str, (r.n for r in kept.collect()))) == ["['a', 'b']", "[]", "[]"]


def test_a_hot_day_of_holidays_is_one_document(spark):
    up = spark.range(4000).select(F.lit("ES").alias("country_code"), F.array(F.struct(
        F.lit("2025-01-06").alias("date"), F.col("id").cast("string").alias("name"))).alias("holidays"))
    req = spark.createDataFrame([("ES", "2025-01-06"), ("ES", "2025-01-07")], "country_code string, ingest_date string")
    assert sorted(r.total_records for r in env.holidays_envelope(up, req).collect()) == [0, 4000]


def test_flights_tags_and_snapshot(spark):
    states = ["[]", "null", None, '[["x",null,[1]],["y"]]']
    up = spark.createDataFrame([(f"2025-08-0{i + 1}", i, s) for i, s in enumerate(states)],
                               "ingest_date string, time long, states_json string")
    docs = by_day(env.flights_envelope(up, "1970-01-02T00:00:05", entity="box"))
    assert [docs[f"2025-08-0{i}"][0].total_records for i in (1, 2, 3, 4)] == [0, 0, 0, 2]
    assert all(p["snapshot_time"] == 86405 and p["source"] == "flights" for _, p in docs.values())
    assert docs["2025-08-04"][1]["states"] == [["x", None, [1]], ["y"]] and docs["2025-08-03"][1]["states"] is None


@pytest.mark.parametrize("as_of,seconds", [("1970-01-01T00:01:00", 60), ("1970-01-01T02:00:00+02:00", 0)])
def test_snapshot_is_the_utc_second(as_of, seconds):
    assert env.snapshot_seconds(as_of) == seconds


def test_object_keys_are_padded(spark):
    df = spark.createDataFrame([("0999-01-05", "e 1")], "d string, e string")
    assert df.select(env.raw_object_key("src", "d", "e").alias("k")).first().k == "src/year=0999/month=01/day=05/e 1.json"


def test_upstream_holiday_lists_hold_one_day(spark):
    from strata.plans import payloads

    sf = "/root/testdata/sf0.01"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    country = F.concat(F.lit("K"), F.expr("o_custkey div 100").cast("string")).alias("country")
    want = {(r.country, r.day): r["count"] for r in orders.groupBy(
        country, F.to_date("o_orderdate").alias("day")).count().collect()}
    lists = [(r.country_code, r.holidays) for r in payloads.holidays_upstream(spark, sf).collect()]
    assert sorted(len(x) for _, x in lists) == sorted(want.values())
    for country, holidays in lists:
        days = {h.date for h in holidays if h.date}
        assert len(days) <= 1
        assert all(want[country, datetime.date.fromisoformat(d)] == len(holidays) for d in days)


@pytest.mark.parametrize("salts", [2, 16])
def test_salted_assembly_holds_the_same_records(spark, salts):
    """A hot entity-day in two levels: the same records and total, whatever the
    shares, with repeated and null-bearing records."""
    rows = [("hot", "2026-04-22", i % 50, None if i % 7 else 1.5) for i in range(3000)]
    rows += [(f"C{i}", "2026-04-22", i, 2.0) for i in range(20)] + [("hot", "2026-04-23", 1, None)]
    recs = spark.createDataFrame(rows, "entity string, ingest_date string, v int, t double").select(
        "entity", "ingest_date", F.struct(F.col("v").alias("visitors_count"), F.col("t").alias("temperature_c")).alias("record"))

    def content(docs):
        return sorted((r.object_key, r.total_records, json.loads(r.document)["total_records"],
                       sorted(map(json.dumps, json.loads(r.document)["records"]))) for r in docs.collect())

    plain, salted = (content(env.traffic_envelope(recs, salts=n)) for n in (1, salts))
    assert plain == salted and len(plain) == 22
    with pytest.raises(ValueError):
        env.assembled(recs, [F.col("entity")], "record", 0)
