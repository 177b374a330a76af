"""Incremental curation of a landing raw zone with Structured Streaming.

Not parity with the batch curators, and documented as such: a stream cannot
wait for every copy of a key, so the streaming dedupe keeps the *first*
arrival of a key within the watermark (``dropDuplicatesWithinWatermark``)
instead of the batch's deterministic survivor, and a record older than the
watermark when it arrives is dropped as late. The key *set* written is the
same as the batch curator's whenever nothing arrives later than the delay.

``start_merge_stream`` is the exact alternative: each micro-batch is curated as a
batch would be and merged into its partitions, so late rows are never dropped and
the survivor of a key is the batch curator's, at the cost of rewriting the
partitions that a batch touches.

The sink of the first form is the Parquet file sink with a checkpoint: each micro-batch commits
atomically through the sink's metadata log, so a restarted query (or a lost
executor) neither loses nor duplicates output. Sessions made by
``strata.session.get_session`` keep the dedupe state in the RocksDB state
store (off-heap), which large key spaces need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.partitions import add_event_partitions
from strata.sinks import ledger
from strata.sinks.curated import merge_partitions
from strata.sources.paths import Location
from strata.sources.raw import _check_format, _json_options
from strata.specs import SourceSpec

# Event-time column of each source's projection, for the watermark.
EVENT_TIME = {"traffic": "event_timestamp", "weather": "event_timestamp",
              "holidays": "event_date", "flights": "event_date"}


def read_raw_stream(spark: SparkSession, path: str, spec: SourceSpec, raw_format: str = "lines",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming twin of SRC-1: new raw files under ``path`` as they land."""
    fmt = _check_format(raw_format)
    reader = spark.readStream.schema(spec.raw_schema).options(**_json_options(spec.raw_schema))
    if fmt == "document":
        reader = reader.option("multiLine", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def curate_stream(raw: DataFrame, spec: SourceSpec, delay: str = "2 days") -> DataFrame:
    """Projection, watermark, first-arrival dedupe, partitions."""
    projected = spec.project(raw)
    event_time = EVENT_TIME[spec.name]
    wm_col = "__event_time"
    projected = projected.withColumn(wm_col, F.col(event_time).cast("timestamp"))
    deduped = projected.withWatermark(wm_col, delay).dropDuplicatesWithinWatermark(list(spec.keys))
    return add_event_partitions(deduped.drop(wm_col), spec.event_date_col)


def start_curation_stream(spark: SparkSession, spec: SourceSpec, raw_path: str, output_path: str,
                          checkpoint: str, raw_format: str = "lines", delay: str = "2 days",
                          available_now: bool = True, max_files_per_trigger: int | None = None,
                          files_per_day: int = 8) -> StreamingQuery:
    """Run the incremental curation into a partitioned Parquet folder.

    ``available_now`` processes everything that has landed and stops (a
    scheduled incremental run); otherwise the query keeps running.
    ``max_files_per_trigger`` bounds a micro-batch: set it for the first run over
    a large zone. A row that arrives in a later micro-batch than one ``delay``
    newer is late and dropped; rows of one micro-batch are never late."""
    raw = read_raw_stream(spark, raw_path, spec, raw_format, max_files_per_trigger)
    curated = curate_stream(raw, spec, delay)
    # After the stateful dedupe every state-store task would write a file into
    # every day it touches. Dealing by day and a few buckets of the key writes at
    # most ``files_per_day`` files a day, and a hot day is several tasks' work.
    bucket = F.pmod(F.xxhash64(*spec.keys), F.lit(files_per_day))
    curated = curated.repartition(*spec.partition_cols, bucket)
    writer = (curated.writeStream.format("parquet").outputMode("append")
              .partitionBy(*spec.partition_cols)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start(output_path)


def start_merge_stream(spark: SparkSession, spec: SourceSpec, raw_path: str, output_path: str,
                       checkpoint: str, raw_format: str = "lines", available_now: bool = True,
                       max_files_per_trigger: int | None = None, table: str | None = None) -> StreamingQuery:
    """Run the curation batch by batch into a curated table (DED-1 in the stream).

    A micro-batch is curated (projection, deterministic dedupe, partitions) and
    merged into the partitions that its rows belong to; those become their old
    rows and the new ones, one for each key. The survivor is a minimum (or the
    newest) over all rows of a key, so the order and the cut of the batches don't
    matter, and no state is kept. Merged batches are noted beside the table: one
    that is replayed after a failure is skipped, or, when the failure came before
    the note, merged again without effect. One stream writes a table at a time."""
    out = Location(output_path)

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch_id <= ledger.merged_batch(session, out, checkpoint):
            return
        merge_partitions(spec.curate(batch), out, spec.keys, spec.newest, table, spec.partition_cols)
        ledger.record_batch(session, out, checkpoint, batch_id)

    raw = read_raw_stream(spark, raw_path, spec, raw_format, max_files_per_trigger)
    writer = raw.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
