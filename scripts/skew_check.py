"""Skew check: a third of all traffic records share one (centre, hour) key.

    python scripts/skew_check.py <event-log folder> [sf_dir]

Curates the documents and prints, from Spark's event log, per stage: task
count, run time max/median and shuffle records read max/median/total. With
map-side partial aggregation the dedupe stage reads about one row per map
task for the hot key instead of a third of the input.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    event_dir = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    import zstandard
    from pyspark.sql import functions as F

    from strata.operators import curators
    from strata.operators.envelopes import traffic_envelope
    from strata.plans import payloads
    from strata.schemas import TRAFFIC_RAW
    from strata.session import get_session
    from strata.sources.raw import parse_documents

    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "16",
                                          "spark.eventLog.enabled": "true",
                                          "spark.eventLog.dir": event_dir})
    spark.sparkContext.setLogLevel("ERROR")
    recs = payloads.traffic_records(spark, sf_dir)
    hot = F.pmod(F.xxhash64("record"), F.lit(3)) == 0
    recs = recs.withColumn("record", F.when(
        hot, F.col("record").withField("center_id", F.lit("HOT"))
        .withField("timestamp", F.lit("2024-01-01T10:00:00"))).otherwise(F.col("record")))
    docs = traffic_envelope(recs)
    out = curators.curate_traffic(parse_documents(docs, TRAFFIC_RAW))
    out.write.format("noop").mode("overwrite").save()
    n, n_hot = recs.count(), recs.where(F.col("record.center_id") == "HOT").count()
    print(f"records {n}, hot-key records {n_hot}, curated rows {out.count()}")
    spark.stop()
    log = glob.glob(f"{event_dir}/*/events_*")[0]
    tasks: dict[int, list[tuple[int, int]]] = {}
    stream = zstandard.ZstdDecompressor().stream_reader(open(log, "rb"))
    for line in io.TextIOWrapper(stream, encoding="utf-8"):
        e = json.loads(line)
        if e.get("Event") != "SparkListenerTaskEnd":
            continue
        m = e.get("Task Metrics") or {}
        sr = m.get("Shuffle Read Metrics", {})
        read = sr.get("Total Records Read", 0)
        tasks.setdefault(e["Stage ID"], []).append((m.get("Executor Run Time", 0), read))
    for sid in sorted(tasks)[:4]:
        runs, reads = [t[0] for t in tasks[sid]], [t[1] for t in tasks[sid]]
        print(f"stage {sid}: tasks={len(runs)} run_ms max={max(runs)} median={statistics.median(runs)}"
              f" shuffle_records max={max(reads)} median={statistics.median(reads)} total={sum(reads)}")


if __name__ == "__main__":
    main()
