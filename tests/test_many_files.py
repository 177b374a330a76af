"""SRC-6, SNK-6, SNK-7 on zones of very many files: tasks list, open and place them."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.envelopes import raw_object_key
from strata.plans import queries
from strata.schemas import TRAFFIC_RAW
from strata.sinks.objects import list_objects, write_objects
from strata.sinks.raw import write_raw
from strata.sources.raw import read_documents_text, read_raw, read_raw_objects


def _docs(spark, rows):
    return spark.createDataFrame(rows, "ingest_date string, entity string, document string")


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_files_are_listed_as_by_spark_but_not_on_the_driver(spark, tmp_dir):
    for name, data in {"a/b/c/d/e/f/deep.json": b"1", "top.json": b"{}\n", "y=1/B b+%\xc3\xa9[x]#?.json".encode().decode(): b"x",
                       "bad.json": b"x\xff", "empty.json": b"", "_hidden/x.json": b"h", "_x=1/kept.json": b"k", "a/.dot": b"d"}.items():
        _write(f"{tmp_dir}/{name}", data)
    want = spark.read.option("recursiveFileLookup", "true").text(tmp_dir, wholetext=True)
    want = want.select(F.col("_metadata.file_path"), F.hex("value")).collect()
    got = read_documents_text(spark, tmp_dir, "document")
    assert got.inputFiles() == []
    got = got.select("path", F.hex("document")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 5
    some = read_documents_text(spark, [f"{tmp_dir}/t*.json", f"{tmp_dir}/a"], "document").collect()
    assert sorted(r.document for r in some) == ["1", "{}\n"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_documents_text(spark, f"{tmp_dir}/none", "document").collect()


def test_stored_objects_are_not_listed_on_the_driver(spark, tmp_dir):
    docs = _docs(spark, [(f"2026-04-{1 + i % 3:02d}", f"C{i}", f"{i}") for i in range(40)])
    docs = docs.withColumn("object_key", raw_object_key("traffic", "ingest_date", "entity"))
    write_objects(docs, tmp_dir)
    found = list_objects(spark, tmp_dir, "traffic")
    assert found.inputFiles() == []
    assert sorted(map(tuple, found.collect())) == sorted((r.object_key, r.document) for r in docs.collect())


def test_documents_land_in_the_folders_that_spark_names(spark, tmp_dir):
    rows = [("2026-04-01", "a/b: c%", "1"), ("2026-04-01", "", "2"), (None, None, "3"), ("2026-04-02", "é [x]", "4"), ("2026-04-02", "é [x]", "5")]
    target = write_raw(_docs(spark, rows), f"{tmp_dir}/own", "traffic", "document")
    parts = _docs(spark, rows).select(*[F.date_format(F.col("ingest_date").cast("date"), p).alias(n)
                                        for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))], "entity", "document")
    parts.write.partitionBy("year", "month", "day", "entity").text(f"{tmp_dir}/spark")

    def folders(root):
        return sorted(os.path.relpath(d, root) for d, _, names in os.walk(root) if any(n.startswith("part-") for n in names))

    assert folders(target) == folders(f"{tmp_dir}/spark")
    names = [n for _, _, files in os.walk(target) for n in files]
    assert len(names) == 5  # no checksum or success files of a committer on the driver
    assert sorted(r.document for r in read_documents_text(spark, target, "document").collect()) == list("12345")


def test_landing_again_replaces_whole_folders_or_appends(spark, tmp_dir):
    def texts():
        return sorted(r.document for r in read_documents_text(spark, f"{tmp_dir}/traffic", "document").collect())

    first = _docs(spark, [("2026-04-01", "A", "1"), ("2026-04-01", "B", "2"), ("2026-04-02", "A", "3")])
    write_raw(first, tmp_dir, "traffic", "document")
    write_raw(first.where("document = 2").withColumn("document", F.lit("9")), tmp_dir, "traffic", "document")
    assert texts() == ["1", "3", "9"]
    write_raw(first.where("document = 3"), tmp_dir, "traffic", "document", mode="append")
    assert texts() == ["1", "3", "3", "9"]
    write_raw(first.where("document = 1"), tmp_dir, "traffic", "document", by_entity=False)  # a day, all entities
    assert texts() == ["1", "3", "3"]
    write_raw(first.limit(0), tmp_dir, "traffic", "document")
    assert texts() == ["1", "3", "3"] and os.listdir(f"{tmp_dir}/_attempts") == []


def test_objects_parse_as_declared(spark, tmp_dir):
    doc = '{\n "records": [{"center_id": "A", "visitors_count": 3}]\n}'
    target = write_raw(_docs(spark, [("2026-04-01", "A", doc), ("2026-04-01", "B", "{")]), tmp_dir, "traffic", "document")
    got = {r._corrupt_record: r.records for r in read_raw_objects(spark, target, TRAFFIC_RAW).collect()}
    assert got["{"] is None and got[None][0].center_id == "A"


def test_the_round_trip_lists_nothing_on_the_driver(spark):
    assert queries.raw_roundtrip(spark, "/root/testdata/sf0.001").inputFiles() == []


def test_lines_land_compressed_and_whole(spark, tmp_dir):
    rows = [(f"2026-04-{1 + i % 3:02d}", f"C{i}", '{"records": [{"center_id": "C%d", "visitors_count": 3}]}' % i) for i in range(3000)]
    target = write_raw(_docs(spark, rows), tmp_dir, "traffic", "lines", by_entity=False)
    files = [os.path.join(d, n) for d, _, names in os.walk(target) for n in names if n.startswith("part-")]
    assert sum(map(os.path.getsize, files)) < sum(len(r[2]) for r in rows) / 4
    assert sorted(r.document for r in read_documents_text(spark, target, "lines").collect()) == sorted(r[2] for r in rows)
    assert read_raw(spark, target, TRAFFIC_RAW, "lines").where("records[0].visitors_count = 3").count() == 3000
