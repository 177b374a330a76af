"""SRC-1/2/6, SNK-1..6, D4, D7, D15: storage round trips and pruning."""

import json
import os

import pytest
from pyspark.sql import functions as F

from strata.jobs import JobParams, read_job_input, run_curation
from strata.operators import curators
from strata.plans.inspect import plan_text
from strata.schemas import CORRUPT_COL, TRAFFIC_RAW
from strata.sinks.curated import write_curated
from strata.sinks.raw import write_raw
from strata.sources.raw import mixed_layout, read_curated, read_documents_text, read_raw, read_raw_days


def _docs(spark, n_days=3, per_day=2):
    rows = []
    for d in range(1, n_days + 1):
        for c in range(per_day):
            rec = {"center_id": f"C{c}", "timestamp": f"2026-04-{d:02d}T10:00:00",
                   "visitors_count": d * 10 + c}
            rows.append((f"2026-04-{d:02d}", f"C{c}",
                         json.dumps({"records": [rec], "total_records": 1}, indent=2)))
    return spark.createDataFrame(rows, "ingest_date string, entity string, document string")


def test_document_roundtrip_keeps_every_document(spark, tmp_dir):
    target = write_raw(_docs(spark), tmp_dir, "traffic", "document")
    assert os.path.isdir(f"{target}/year=2026/month=04/day=01")  # zero padded
    back = read_raw(spark, target, TRAFFIC_RAW, "document", source_file=True)
    assert back.count() == 6
    assert back.where(F.col(CORRUPT_COL).isNull() & (F.size("records") == 1)).count() == 6
    assert back.select("source_file").distinct().count() == 6


def test_lines_roundtrip_and_wrong_layout_is_found(spark, tmp_dir):
    docs = _docs(spark).withColumn("document", F.to_json(F.from_json("document", TRAFFIC_RAW)))
    docs = docs.coalesce(1)  # one file per day holding both documents
    target = write_raw(docs, tmp_dir, "traffic", "lines", by_entity=False)
    assert read_raw(spark, target, TRAFFIC_RAW, "lines").count() == 6
    # Read as whole documents, one of each file would be kept: the job refuses.
    found = mixed_layout(spark, target).collect()
    assert [r.documents for r in found] == [2, 2, 2]
    params = JobParams.from_args(
        ["job", "--SOURCE_NAME", "traffic", "--RAW_BUCKET", tmp_dir, "--OUTPUT_PATH", f"{tmp_dir}/o",
         "--INGEST_DATE", "2026-04-01", "--END_DATE", "2026-04-03"], env={})
    with pytest.raises(ValueError, match="RAW_FORMAT"):
        run_curation(spark, params, register_table=False)
    whole = write_raw(_docs(spark), f"{tmp_dir}/w", "traffic", "document")
    assert mixed_layout(spark, whole).count() == 0


def test_rewriting_a_day_replaces_only_that_entity_and_day(spark, tmp_dir):
    write_raw(_docs(spark), tmp_dir, "traffic", "document")
    one = _docs(spark).where("ingest_date = '2026-04-02' AND entity = 'C0'")
    one = one.withColumn("document", F.regexp_replace("document", "20", "77"))
    write_raw(one, tmp_dir, "traffic", "document")
    back = read_raw_days(spark, tmp_dir, "traffic", TRAFFIC_RAW, "2026-04-01", "2026-04-03")
    assert back.groupBy("day").count().orderBy("day").collect()[1]["count"] == 2 and back.count() == 6


def test_separate_landings_of_one_day_equal_one_landing(spark, tmp_dir):
    docs = _docs(spark)
    for layout in ("document", "lines"):
        flat = docs.withColumn("document", F.to_json(F.from_json("document", TRAFFIC_RAW)))
        for c in ("C0", "C1", "C0"):
            write_raw(flat.where(F.col("entity") == c), f"{tmp_dir}/{layout}", "traffic", layout)
        back = read_raw(spark, f"{tmp_dir}/{layout}/traffic", TRAFFIC_RAW, layout)
        assert back.count() == 6


def test_day_range_scan_prunes_partitions(spark, tmp_dir):
    write_raw(_docs(spark), tmp_dir, "traffic", "document")
    df = read_raw_days(spark, tmp_dir, "traffic", TRAFFIC_RAW, "2026-04-02", "2026-04-03")
    assert df.count() == 4
    assert len(df.inputFiles()) == 4 and not any("day=01" in f for f in df.inputFiles())
    assert {(r.year, r.month, r.day) for r in df.collect()} == {(2026, 4, 2), (2026, 4, 3)}


def test_day_dirs_lists_only_requested_days(spark, tmp_dir):
    from strata.sources.raw import day_dirs
    write_raw(_docs(spark), tmp_dir, "traffic", "document")
    dirs = day_dirs(spark, f"{tmp_dir}/traffic", "2026-03-30", "2026-04-02")
    assert [d.rsplit("/", 1)[-1] for d in dirs] == ["day=01", "day=02"]
    assert day_dirs(spark, f"{tmp_dir}/traffic", "2026-05-01", "2026-05-03") == []
    with pytest.raises(FileNotFoundError, match="3 day"):
        read_raw_days(spark, tmp_dir, "traffic", TRAFFIC_RAW, "2026-05-01", "2026-05-03")
    with pytest.raises(FileNotFoundError, match="month=04/day=04"):
        read_raw_days(spark, tmp_dir, "traffic", TRAFFIC_RAW, "2026-04-03", "2026-04-04")
    empty = read_raw_days(spark, tmp_dir, "traffic", TRAFFIC_RAW, "2026-05-01", "2026-05-03", allow_missing=True)
    assert empty.count() == 0 and "records" in empty.columns


def test_whole_document_text_scan(spark, tmp_dir):
    target = write_raw(_docs(spark), tmp_dir, "traffic", "document")
    texts = read_documents_text(spark, target)
    assert texts.count() == 6
    assert texts.first().document.lstrip().startswith("{")


def _curated(spark, days):
    docs = _docs(spark).where(F.col("ingest_date").isin(days))
    from strata.sources.raw import parse_documents
    return curators.curate_traffic(parse_documents(docs, TRAFFIC_RAW))


def test_overwrite_partitions_is_idempotent_and_keeps_other_days(spark, tmp_dir):
    path = f"{tmp_dir}/curated"
    all_days = ["2026-04-01", "2026-04-02", "2026-04-03"]
    write_curated(_curated(spark, all_days), path=path)
    write_curated(_curated(spark, ["2026-04-02"]), path=path)
    write_curated(_curated(spark, ["2026-04-02"]), path=path)
    assert spark.read.parquet(path).count() == 6


def test_append_duplicates_and_static_overwrite_drops_days(spark, tmp_dir):
    path = f"{tmp_dir}/curated"
    write_curated(_curated(spark, ["2026-04-01", "2026-04-02"]), path=path, mode="append")
    write_curated(_curated(spark, ["2026-04-02"]), path=path, mode="append")
    assert spark.read.parquet(path).count() == 6
    write_curated(_curated(spark, ["2026-04-02"]), path=path, mode="overwrite")
    assert spark.read.parquet(path).count() == 2


def test_read_curated_prunes_by_event_date(spark, tmp_dir):
    path = f"{tmp_dir}/curated"
    write_curated(_curated(spark, ["2026-04-01", "2026-04-02", "2026-04-03"]), path=path)
    df = read_curated(spark, path, "2026-04-02", "2026-04-03")
    assert df.count() == 4
    assert "PartitionFilters: [isnotnull(year" in plan_text(df) or \
        "PartitionFilters" in plan_text(df)


def test_table_sink_dynamic_overwrite_through_catalog(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS strata_test")
    table = "`strata_test`.`traffic`"
    path = f"{tmp_dir}/t"
    write_curated(_curated(spark, ["2026-04-01", "2026-04-02"]), path=path, table=table)
    write_curated(_curated(spark, ["2026-04-02"]), path=path, table=table)
    assert spark.table(table).count() == 4
    spark.sql(f"DROP TABLE {table}")


def test_run_curation_end_to_end_with_quarantine(spark, tmp_dir):
    raw_root, cur_root = f"{tmp_dir}/raw", f"{tmp_dir}/cur"
    write_raw(_docs(spark), raw_root, "traffic", "document")
    bad_dir = f"{raw_root}/traffic/year=2026/month=04/day=02"
    with open(f"{bad_dir}/broken.json", "w") as f:
        f.write('{"records": [')
    params = JobParams.from_args(
        ["job", "--SOURCE_NAME", " Traffic ", "--RAW_BUCKET", raw_root, "--CURATED_BUCKET", cur_root,
         "--INGEST_DATE", "2026-04-02"], env={})
    report = run_curation(spark, params, register_table=False)
    assert (report["documents"], report["malformed_documents"]) == (3, 1)
    out = spark.read.parquet(report["output"])
    assert out.count() == 2 and report["output"] == f"{cur_root}/curated/traffic"
    run_curation(spark, params, register_table=False)
    quarantined = spark.read.json(f"{report['output']}/_quarantine")
    assert quarantined.count() == 1  # a rerun replaces the day's
    assert str(quarantined.first().ingest_date) == "2026-04-02"
    # the range form reads several days through partition pruning
    ranged = JobParams.from_args(
        ["job", "--SOURCE_NAME", "traffic", "--RAW_BUCKET", raw_root, "--CURATED_BUCKET", cur_root,
         "--INGEST_DATE", "2026-04-01", "--END_DATE", "2026-04-03"], env={})
    run_curation(spark, ranged, register_table=False, quarantine=False)
    assert spark.read.parquet(report["output"]).count() == 6


def _land(spark, root, day, stamps, entity="C0"):
    doc = json.dumps({"records": [{"center_id": entity, "timestamp": t, "visitors_count": 1} for t in stamps]})
    write_raw(spark.createDataFrame([(day, entity, doc)], "ingest_date string, entity string, document string"),
              root, "traffic", "lines")


def _run(spark, root, day, *more, table=False):
    params = JobParams.from_args(
        ["job", "--SOURCE_NAME", "traffic", "--RAW_BUCKET", f"{root}/raw", "--CURATED_BUCKET", f"{root}/cur",
         "--INGEST_DATE", day, "--RAW_FORMAT", "lines", *more], env={})
    return run_curation(spark, params, register_table=table)


def test_late_and_undated_rows_join_what_is_there(spark, tmp_dir):
    _land(spark, f"{tmp_dir}/raw", "2026-04-21", [f"2026-04-21T{h:02d}:00:00" for h in range(24)] + ["junk"])
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", ["2026-04-22T01:00:00", "2026-04-21T23:00:00", "2026-04-21T22:30:00",
                                                  "2026-04-23T00:00:00", "trash"])
    assert _run(spark, tmp_dir, "2026-04-21")["rows_of_other_days"] == 1
    report = _run(spark, tmp_dir, "2026-04-22")
    report = _run(spark, tmp_dir, "2026-04-22")  # again: nothing doubles
    rows = spark.read.parquet(report["output"])
    assert {(r.day, r["count"]) for r in rows.groupBy("day").count().collect()} == {(21, 25), (22, 1), (23, 1), (None, 1)}


def test_append_registers_over_a_folder_without_deleting(spark, tmp_dir):
    _land(spark, f"{tmp_dir}/raw", "2026-04-20", ["2026-04-20T01:00:00"])
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", ["2026-04-22T01:00:00"])
    _run(spark, tmp_dir, "2026-04-20")
    report = _run(spark, tmp_dir, "2026-04-22", "--WRITE_MODE", "append", "--CURATED_DATABASE", "strata_w13", table=True)
    assert sorted(r.day for r in spark.table(report["table"]).collect()) == [20, 22]
    with pytest.raises(ValueError, match="lies at"):
        _run(spark, tmp_dir, "2026-04-22", "--OUTPUT_PATH", f"{tmp_dir}/elsewhere", "--CURATED_DATABASE", "strata_w13",
             table=True)
    skipped = _run(spark, tmp_dir, "2026-04-22", "--WRITE_MODE", "ignore", "--CURATED_DATABASE", "strata_w13", table=True)
    assert not skipped["written"] and spark.table(report["table"]).count() == 2
    with pytest.raises(ValueError, match="already exists"):
        _run(spark, tmp_dir, "2026-04-22", "--WRITE_MODE", "error", "--CURATED_DATABASE", "strata_w13", table=True)
    spark.sql(f"DROP TABLE {report['table']}")


def test_a_bare_bucket_means_the_same_place_everywhere(spark):
    params = JobParams.from_args(
        ["job", "--SOURCE_NAME", "traffic", "--RAW_BUCKET", "landing", "--CURATED_BUCKET", "lake",
         "--INGEST_DATE", "2026-04-20", "--END_DATE", "2026-04-21"], env={})
    with pytest.raises(Exception, match='(?i)scheme "s3"|s3'):
        read_job_input(spark, params)


def test_absent_input_is_an_error(spark, tmp_dir):
    with pytest.raises(Exception, match="(?i)path"):
        _run(spark, tmp_dir, "2026-04-20")


def test_explicit_input_path(spark, tmp_dir):
    _land(spark, f"{tmp_dir}/raw", "2026-04-20", ["2026-04-20T01:00:00", "2026-03-01T01:00:00"])
    report = _run(spark, tmp_dir, "2026-04-20", "--INPUT_PATH", f"{tmp_dir}/raw/traffic/year=2026/month=04/day=20")
    assert spark.read.parquet(report["output"]).count() == 2


def test_session_pins_utc_d8():
    from strata.session import BASE_CONF
    assert BASE_CONF["spark.sql.session.timeZone"] == "UTC"
    assert BASE_CONF["spark.sql.autoBroadcastJoinThreshold"] == "-1"


def test_two_locations_one_day_both_land_d12(spark, tmp_dir):
    """D12: the weather key has no location; the raw sink keeps both
    documents of a day (part files), the location stays inside them."""
    from strata.operators.envelopes import weather_envelope
    from strata.schemas import WEATHER_RAW
    up = spark.createDataFrame(
        [(40.4, -3.7, "Europe/Madrid", (["2026-04-22T00:00"],), "2026-04-22"),
         (41.4, 2.2, "Europe/Madrid", (["2026-04-22T00:00"],), "2026-04-22")],
        "latitude double, longitude double, timezone string, hourly struct<time:array<string>>, "
        "ingest_date string")
    docs = weather_envelope(up)
    assert docs.select("object_key").distinct().count() == 1
    target = write_raw(docs, tmp_dir, "weather", "document")
    back = read_raw(spark, target, WEATHER_RAW, "document")
    assert sorted(r.latitude for r in back.collect()) == ["40.4", "41.4"]


def test_null_event_date_lands_in_default_partition(spark, tmp_dir):
    from strata.sources.raw import parse_documents
    docs = spark.createDataFrame(
        [('{"records":[{"center_id":"A","timestamp":"garbage"},'
          '{"center_id":"B","timestamp":"2026-04-22T01:00:00"}]}',)], "document string")
    path = f"{tmp_dir}/curated"
    write_curated(curators.curate_traffic(parse_documents(docs, TRAFFIC_RAW)), path=path)
    assert any("__HIVE_DEFAULT_PARTITION__" in d for d in os.listdir(path))
    back = {r.center_id: r for r in spark.read.parquet(path).collect()}
    assert back["A"].year is None and back["A"].event_timestamp is None
    assert (back["B"].year, back["B"].month, back["B"].day) == (2026, 4, 22)


def test_day_dirs_across_a_year_boundary(spark, tmp_dir):
    from strata.sources.raw import day_dirs
    df = spark.createDataFrame([(d, "{}") for d in ("2025-12-30", "2025-12-31", "2026-01-01",
                                                    "2026-01-03")],
                               "ingest_date string, document string")
    write_raw(df, tmp_dir, "traffic", "lines")
    dirs = day_dirs(spark, f"{tmp_dir}/traffic", "2025-12-31", "2026-01-02")
    assert [d.split("/traffic/")[1] for d in dirs] == ["year=2025/month=12/day=31",
                                                       "year=2026/month=01/day=01"]


def test_day_listing_falls_back_without_jvm_gateway():
    import types
    from strata.sources.raw import _day_dirs_or_none
    assert _day_dirs_or_none(types.SimpleNamespace(_jvm=None), "/x", "2026-04-01", "2026-04-02",
                             True) is None


def test_read_curated_by_table_and_open_ranges(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS strata_read_test")
    table = "strata_read_test.traffic"
    write_curated(_curated(spark, ["2026-04-01", "2026-04-02", "2026-04-03"]),
                  path=f"{tmp_dir}/t", table=table)
    assert read_curated(spark, table=table, start="2026-04-02", end="2026-04-02").count() == 2
    assert "PartitionFilters" in plan_text(read_curated(spark, table=table, start="2026-04-02"))
    assert read_curated(spark, f"{tmp_dir}/t", start="2026-04-02").count() == 4
    assert read_curated(spark, f"{tmp_dir}/t", end="2026-04-01").count() == 2
    assert read_curated(spark, f"{tmp_dir}/t", "2026-05-01", "2026-05-02").count() == 0
    spark.sql(f"DROP TABLE {table}")


def _rows(spark, report):
    return sorted((r.day, r.event_timestamp.strftime("%d %H")) for r in spark.read.parquet(report["output"]).collect())


def test_a_rerun_keeps_the_late_rows_that_other_folders_brought(spark, tmp_dir):
    _land(spark, f"{tmp_dir}/raw", "2026-04-21", [f"2026-04-21T{h:02d}:00:00" for h in range(3)])
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", ["2026-04-22T01:00:00", "2026-04-21T09:00:00"])
    _land(spark, f"{tmp_dir}/raw", "2026-04-23", ["2026-04-23T01:00:00", "2026-04-21T10:00:00"])
    for day in ("2026-04-21", "2026-04-22", "2026-04-23"):
        report = _run(spark, tmp_dir, day)
    whole = _rows(spark, report)
    assert len(whole) == 7
    again = _run(spark, tmp_dir, "2026-04-21")
    assert again["late_folders"] == ["2026-04-22", "2026-04-23"] and again["rows_of_other_days"] == 0
    assert _rows(spark, again) == whole
    ranged = _run(spark, tmp_dir, "2026-04-21", "--END_DATE", "2026-04-22")
    assert ranged["late_folders"] == ["2026-04-23"] and _rows(spark, ranged) == whole
    from strata.sinks.ledger import pairs
    from strata.sources.paths import Location
    known = pairs(spark, Location(report["output"]))
    assert known.count() == known.distinct().count() == 2


def test_a_late_row_inside_one_range_run_is_remembered_too(spark, tmp_dir):
    _land(spark, f"{tmp_dir}/raw", "2026-04-21", ["2026-04-21T01:00:00"])
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", ["2026-04-22T01:00:00", "2026-04-21T09:00:00"])
    whole = _rows(spark, _run(spark, tmp_dir, "2026-04-21", "--END_DATE", "2026-04-22"))
    assert _rows(spark, _run(spark, tmp_dir, "2026-04-21")) == whole and len(whole) == 3


def test_a_run_that_fails_between_merge_and_publication_changes_nothing(spark, tmp_dir, monkeypatch):
    import strata.jobs as jobs
    _land(spark, f"{tmp_dir}/raw", "2026-04-21", ["2026-04-21T01:00:00"])
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", ["2026-04-22T01:00:00"])
    _run(spark, tmp_dir, "2026-04-21")
    report = _run(spark, tmp_dir, "2026-04-22")
    before = _rows(spark, report)
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", ["2026-04-22T05:00:00", "2026-04-21T09:00:00"])

    def fail(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(jobs, "write_curated", fail)
        with pytest.raises(RuntimeError, match="lost"):
            _run(spark, tmp_dir, "2026-04-22")
    assert _rows(spark, report) == before
    assert [x for x in _rows(spark, _run(spark, tmp_dir, "2026-04-22")) if x not in before] == [(21, "21 09"), (22, "22 05")]


def test_incremental_runs_open_only_what_landed_since(spark, tmp_dir):
    import time
    from datetime import timedelta

    from strata.jobs import run_incremental

    def run(overlap=timedelta(0)):
        params = JobParams.from_args(
            ["job", "--SOURCE_NAME", "traffic", "--RAW_BUCKET", f"{tmp_dir}/raw", "--CURATED_BUCKET", f"{tmp_dir}/cur",
             "--RAW_FORMAT", "lines"], env={})
        return run_incremental(spark, params, register_table=False, overlap=overlap)

    _land(spark, f"{tmp_dir}/raw", "2026-04-21", ["2026-04-21T01:00:00", "2026-04-21T02:00:00"])
    first = run()
    assert (first["documents"], first["since"]) == (1, "")
    time.sleep(1.1)
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", ["2026-04-22T01:00:00", "2026-04-21T09:00:00"])
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", ["2026-04-22T01:00:00"], entity="C1")
    second = run()
    assert second["documents"] == 2 and second["since"]
    whole = _rows(spark, second)
    assert [d for d, _ in whole] == [21, 21, 21, 22, 22]
    assert run(timedelta(days=1))["documents"] == 3 and _rows(spark, second) == whole  # again: nothing changes
    day = _run(spark, tmp_dir, "2026-04-21")  # a day run keeps what another folder brought
    assert day["late_folders"] == ["2026-04-22"] and _rows(spark, day) == whole


def test_incremental_run_without_news_writes_nothing(spark, tmp_dir):
    import time
    from datetime import timedelta

    from strata.jobs import run_incremental

    _land(spark, f"{tmp_dir}/raw", "2026-04-21", ["2026-04-21T01:00:00"])
    params = JobParams.from_args(
        ["job", "--SOURCE_NAME", "traffic", "--RAW_BUCKET", f"{tmp_dir}/raw", "--CURATED_BUCKET", f"{tmp_dir}/cur",
         "--RAW_FORMAT", "lines", "--LANDED_SINCE", "last"], env={})
    assert params.landed_since == "last"
    report = run_incremental(spark, params, register_table=False, overlap=timedelta(0))
    from strata.sinks import ledger
    from strata.sources.paths import Location
    mark = ledger.landed_until(spark, Location(report["output"]))
    ledger.advance(spark, Location(report["output"]), int((mark + timedelta(seconds=5)).timestamp() * 1_000_000))
    time.sleep(0.1)
    again = run_incremental(spark, params, register_table=False, overlap=timedelta(0))
    assert again["documents"] == 0 and not again["written"] and len(_rows(spark, report)) == 1


def test_compaction_packs_only_what_has_too_many_files(spark, tmp_dir):
    from strata.sinks.compaction import compact, partition_files

    path = f"{tmp_dir}/curated"
    days = ["2026-04-01", "2026-04-02", "2026-04-03"]
    write_curated(_curated(spark, days[:1]), path=path)
    for _ in range(4):
        write_curated(_curated(spark, days[1:]), path=path, mode="append")
    before = sorted(map(tuple, spark.read.parquet(path).collect()), key=str)
    untouched = os.listdir(f"{path}/year=2026/month=4/day=1")
    done = compact(spark, path)
    assert sorted((r.day, r.files, r.bins) for r in done.collect()) == [(2, 4, 1), (3, 4, 1)]
    assert {r.day: r.files for r in partition_files(spark, path).collect()} == {1: 1, 2: 1, 3: 1}
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=str) == before
    assert os.listdir(f"{path}/year=2026/month=4/day=1") == untouched
    assert compact(spark, path).isEmpty()
    size = {r.day: r.bytes for r in partition_files(spark, path).collect()}[2]
    for _ in range(2):
        write_curated(_curated(spark, days[1:2]), path=path, mode="append")
    compact(spark, path, target_bytes=size)
    files = {r.day: r.files for r in partition_files(spark, path).collect()}
    assert files[2] <= 3 and files[3] == 1


def test_a_day_that_lost_its_rows_is_emptied_by_a_rerun(spark, tmp_dir):
    _land(spark, f"{tmp_dir}/raw", "2026-04-21", ["2026-04-21T01:00:00"])
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", ["2026-04-22T01:00:00"])
    report = _run(spark, tmp_dir, "2026-04-21", "--END_DATE", "2026-04-22", "--CURATED_DATABASE", "strata_emptied", table=True)
    assert len(_rows(spark, report)) == 2 and report["emptied_days"] == []
    _land(spark, f"{tmp_dir}/raw", "2026-04-22", [])
    again = _run(spark, tmp_dir, "2026-04-21", "--END_DATE", "2026-04-23", "--CURATED_DATABASE", "strata_emptied",
                 "--MISSING_DAYS", "skip", table=True)
    assert again["emptied_days"] == ["2026-04-22"] and _rows(spark, again) == [(21, "21 01")]
    assert [r.day for r in spark.table(report["table"]).collect()] == [21]
    _land(spark, f"{tmp_dir}/raw", "2026-04-23", ["2026-04-22T05:00:00"])  # a late row keeps its day
    _run(spark, tmp_dir, "2026-04-23")
    kept = _run(spark, tmp_dir, "2026-04-22")
    assert kept["emptied_days"] == [] and _rows(spark, kept) == [(21, "21 01"), (22, "22 05")]
    spark.sql(f"DROP TABLE {report['table']}")
