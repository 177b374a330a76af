"""SNK-6, SNK-7: documents stored under their own keys."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.envelopes import raw_object_key
from strata.schemas import TRAFFIC_RAW
from strata.sinks import objects
from strata.sources.raw import read_raw, read_raw_days


def _docs(spark, rows):
    df = spark.createDataFrame(rows, "entity string, ingest_date string, document string, n int")
    return df.withColumn("object_key", raw_object_key("traffic", "ingest_date", "entity"))


def _doc(v):
    return '{"records": [{"center_id": "A", "timestamp": "2026-04-22T01:00:00", "visitors_count": %d}]}' % v


def test_every_document_is_an_object_and_the_last_write_wins(spark, tmp_dir):
    rows = [(f"C{i}", f"2026-04-{1 + i % 3:02d}", _doc(i), i) for i in range(30)]
    docs = _docs(spark, rows).repartition(4)
    assert objects.write_objects(docs, tmp_dir) == 30
    stored = {r.object_key: r.document for r in objects.list_objects(spark, tmp_dir, "traffic").collect()}
    assert stored == {r.object_key: r.document for r in docs.collect()}
    assert os.path.isfile(f"{tmp_dir}/traffic/year=2026/month=04/day=01/C0.json")
    again = docs.where("n % 5 = 0").withColumn("document", F.lit(_doc(77)))
    assert objects.write_objects(again, tmp_dir) == 6
    after = {r.object_key: r.document for r in objects.list_objects(spark, tmp_dir, "traffic").collect()}
    assert after == stored | {r.object_key: _doc(77) for r in again.collect()}
    assert os.listdir(f"{tmp_dir}/_attempts") == []
    raw = read_raw(spark, f"{tmp_dir}/traffic", TRAFFIC_RAW)  # the document layout reads objects
    assert raw.count() == 30
    assert read_raw_days(spark, tmp_dir, "traffic", TRAFFIC_RAW, "2026-04-01", "2026-04-02").count() == 20


def test_one_run_keeps_one_document_of_a_key(spark, tmp_dir):
    docs = _docs(spark, [("A", "2026-04-01", "old", 1), ("A", "2026-04-01", "new", 2), ("B b+%", "2026-04-01", "x", 1),
                         (None, "2026-04-01", "no entity, no key", 1), ("E", "2026-04-01", None, 1)])
    assert objects.write_objects(docs, tmp_dir, order="n") == 3
    got = {r.object_key.rsplit("/", 1)[-1]: r.document for r in objects.list_objects(spark, tmp_dir, "traffic").collect()}
    assert got == {"A.json": "new", "B b+%.json": "x", "E.json": ""} or got == {"A.json": "new", "B b+%.json": "x"}


def test_a_failed_write_publishes_nothing(spark, tmp_dir):
    docs = _docs(spark, [(f"C{i}", "2026-04-01", _doc(i), i) for i in range(20)])
    bad = docs.withColumn("document", F.when(F.col("n") == 13, F.raise_error(F.lit("lost"))).otherwise(F.col("document")))
    with pytest.raises(Exception, match="lost"):
        objects.write_objects(bad, tmp_dir)
    assert not os.path.exists(f"{tmp_dir}/traffic")


def test_attempts_that_were_not_committed_are_not_published(spark, tmp_dir):
    """What an executor left behind lies in a folder that no manifest names, and
    a task that moves its files twice changes nothing."""
    run = f"file:{tmp_dir}/_attempts/run"
    spark.dataSource.register(objects.AttemptSource)
    docs = _docs(spark, [("A", "2026-04-01", "a", 1)]).select("object_key", "document")
    docs.write.format("strata_objects").mode("append").save(run)
    stray = f"{tmp_dir}/_attempts/run/000000-999999"
    os.makedirs(stray)
    with open(f"{stray}/keys.json", "w") as f:
        f.write('{"n": 0, "object_key": "traffic/stray.json"}\n')
    with open(f"{stray}/0", "w") as f:
        f.write("stray")
    for _ in range(2):
        assert objects._publish(spark, run, f"file:{tmp_dir}") == 1
    assert [r.document for r in objects.list_objects(spark, tmp_dir, "traffic").collect()] == ["a"]


def test_attempts_are_few_files_until_they_are_published(spark, tmp_dir):
    """A small file fills a whole block: the documents of a task wait in one file."""
    rows = [(f"C{i}", "2026-04-01", _doc(i) + "\n\u00e9", i) for i in range(400)]
    docs = _docs(spark, rows).select("object_key", "document").repartition(2)
    run = f"file:{tmp_dir}/_attempts/run"
    spark.dataSource.register(objects.AttemptSource)
    docs.write.format("strata_objects").mode("append").save(run)
    waiting = [os.path.join(d, n) for d, _, names in os.walk(f"{tmp_dir}/_attempts") for n in names]
    assert len(waiting) <= 3 and sum(map(os.path.getsize, waiting)) < sum(len(r[2]) for r in rows) / 2
    for _ in range(2):  # as a repeated task
        assert objects._publish(spark, run, f"file:{tmp_dir}") == 400
    got = objects.list_objects(spark, tmp_dir, "traffic").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, docs.collect()))


def test_an_empty_frame_writes_nothing(spark, tmp_dir):
    assert objects.write_objects(_docs(spark, []), tmp_dir) == 0
