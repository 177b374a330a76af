"""Incremental curation: runs over newly landed files, dedupe across runs,
restart from the checkpoint without duplicates."""

import json

from strata.sinks.raw import write_raw
from strata.specs import get_spec
from strata.streaming.incremental import start_curation_stream


def _land(spark, root, day, records):
    doc = json.dumps({"records": records, "total_records": len(records)})
    df = spark.createDataFrame([(day, doc)], "ingest_date string, document string")
    write_raw(df, root, "traffic", "lines", mode="append")


def _run(spark, tmp_dir):
    q = start_curation_stream(spark, get_spec("traffic"), f"{tmp_dir}/raw/traffic", f"{tmp_dir}/out",
                              f"{tmp_dir}/ckpt", raw_format="lines", delay="3 days")
    q.awaitTermination()
    return spark.read.parquet(f"{tmp_dir}/out")


def test_incremental_runs_dedupe_and_restart(spark, tmp_dir):
    r = lambda c, h, v: {"center_id": c, "timestamp": f"2026-04-22T{h:02d}:00:00", "visitors_count": v}
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", [r("A", 1, 10), r("A", 1, 11), r("B", 2, 5)])
    first = _run(spark, tmp_dir)
    assert first.count() == 2
    _land(spark, f"{tmp_dir}/raw", "2026-04-23", [r("A", 1, 99), r("A", 3, 7)])
    second = _run(spark, tmp_dir)
    keys = sorted((x.center_id, x.event_timestamp.hour) for x in second.collect())
    assert keys == [("A", 1), ("A", 3), ("B", 2)]
    # nothing new landed: the checkpoint makes the rerun a no-op
    assert _run(spark, tmp_dir).count() == 3
    assert second.where("center_id = 'A' AND hour(event_timestamp) = 1").first().visitors_count in (10, 11)


def test_flights_stream_uses_the_event_date(spark, tmp_dir):
    """Date-typed event time (flights) works as the watermark column."""
    state = '["a1","X","ES",1,{c},1.0,2.0,3.0,false,4.0,5.0,6.0,null,7.0,"1",false,0]'
    doc = ('{{"time":1,"snapshot_time":100,"ingest_date":"2026-04-22","states":[{a},{b}]}}'
           .format(a=state.format(c=10), b=state.format(c=20)))
    df = spark.createDataFrame([("2026-04-22", doc)], "ingest_date string, document string")
    write_raw(df, f"{tmp_dir}/raw", "flights", "lines")
    q = start_curation_stream(spark, get_spec("flights"), f"{tmp_dir}/raw/flights", f"{tmp_dir}/out",
                              f"{tmp_dir}/ckpt", raw_format="lines")
    q.awaitTermination()
    rows = spark.read.parquet(f"{tmp_dir}/out").collect()
    assert [(r.icao24, r.snapshot_time, r.year, r.month, r.day) for r in rows] == [
        ("a1", 100, 2026, 4, 22)]


def test_a_row_older_than_the_delay_is_late_in_a_later_batch(spark, tmp_dir):
    """Within one micro-batch nothing is late; across batches the watermark is
    the newest event less the delay, and what is older when it arrives is dropped."""
    r = lambda c, day: {"center_id": c, "timestamp": f"2026-04-{day:02d}T01:00:00", "visitors_count": 1}
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", [r("A", 1), r("A", 22)])
    assert _run(spark, tmp_dir).count() == 2  # 21 days apart, one batch
    _land(spark, f"{tmp_dir}/raw", "2026-04-23", [r("B", 10), r("B", 20), r("B", 23)])
    got = _run(spark, tmp_dir)
    assert sorted(x.day for x in got.where("center_id = 'B'").collect()) == [20, 23]


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_dir):
    import os

    recs = [{"center_id": f"C{i}", "timestamp": "2026-04-22T01:00:00", "visitors_count": 1} for i in range(2000)]
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", recs)
    assert _run(spark, tmp_dir).count() == 2000
    files = [f for _, _, names in os.walk(f"{tmp_dir}/out") for f in names if f.endswith(".parquet")]
    assert 2 <= len(files) <= 8


def test_merged_batches_keep_late_rows_and_the_batch_survivor(spark, tmp_dir):
    """Copies of a key in different micro-batches end as the batch curator has
    it, and a batch that is replayed changes nothing."""
    from strata.sinks import ledger
    from strata.sources.paths import Location
    from strata.streaming.incremental import start_merge_stream

    r = lambda c, day, v: {"center_id": c, "timestamp": f"2026-04-{day:02d}T01:00:00", "visitors_count": v}

    def run(checkpoint="ckpt"):
        start_merge_stream(spark, get_spec("traffic"), f"{tmp_dir}/raw/traffic", f"{tmp_dir}/out",
                           f"{tmp_dir}/{checkpoint}", max_files_per_trigger=1).awaitTermination()
        return sorted((x.center_id, x.day, x.visitors_count) for x in spark.read.parquet(f"{tmp_dir}/out").collect())

    _land(spark, f"{tmp_dir}/raw", "2026-04-22", [r("A", 22, 10), r("B", 22, 5)])
    assert run() == [("A", 22, 10), ("B", 22, 5)]
    _land(spark, f"{tmp_dir}/raw", "2026-04-23", [r("A", 22, 3), r("A", 1, 7), r("B", 22, 9)])
    whole = [("A", 1, 7), ("A", 22, 3), ("B", 22, 5)]
    assert run() == whole
    assert run() == whole
    assert ledger.merged_batch(spark, Location(f"{tmp_dir}/out"), f"{tmp_dir}/ckpt") == 1
    assert run("another") == whole  # all files once more
