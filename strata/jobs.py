"""Job parameters and the end-to-end curation job (API-3, API-4).

Parameter precedence (API-3): a ``--KEY value`` pair on the command line wins;
an empty or absent value falls through to the environment. ``SOURCE`` and
``INGEST_SOURCE`` are accepted aliases of ``SOURCE_NAME``; the source is
matched case- and blank-insensitively. ``INPUT_PATH``/``OUTPUT_PATH`` from
either place satisfy the bucket requirement.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_by
from strata.operators.partitions import PARTITION_COLS, add_event_partitions
from strata.schemas import CORRUPT_COL
from strata.session import scratch_path
from strata.sinks import ledger
from strata.sinks.curated import drop_days, with_what_is_there, write_curated
from strata.sources.paths import Location, identifier
from strata.sources.raw import day_folders, mixed_layout, read_raw, read_raw_days, with_day_columns
from strata.specs import SourceSpec, get_spec

# Job keys of each field, in order of preference (the names are the contract),
# and what an absent value becomes.
KEYS: dict[str, tuple[tuple[str, ...], str]] = {
    "source_name": (("SOURCE_NAME", "SOURCE", "INGEST_SOURCE"), ""),
    "raw_root": (("RAW_BUCKET",), ""),
    "curated_root": (("CURATED_BUCKET",), ""),
    "ingest_date": (("INGEST_DATE",), ""),
    "end_date": (("END_DATE",), ""),
    "input_path": (("INPUT_PATH",), ""),
    "output_path": (("OUTPUT_PATH",), ""),
    "write_mode": (("WRITE_MODE",), "overwrite_partitions"),
    "database": (("CURATED_DATABASE",), "curated"),
    "job_name": (("JOB_NAME",), ""),
    "raw_format": (("RAW_FORMAT",), "document"),
    "missing_days": (("MISSING_DAYS",), "error"),
    "landed_since": (("LANDED_SINCE",), ""),
}
# Each job needs a value for one field of every group.
NEEDED = (("source_name",), ("input_path", "raw_root"), ("output_path", "curated_root"))


def parse_cli_pairs(argv: Sequence[str]) -> dict[str, str]:
    """``--KEY value`` pairs after the program name. A ``--KEY`` takes the
    next token as its value whatever it looks like; tokens outside a pair
    and a trailing ``--KEY`` without a value are ignored."""
    pairs: dict[str, str] = {}
    tokens = iter(argv[1:])
    for token in tokens:
        if token.startswith("--"):
            value = next(tokens, None)
            if value is not None:
                pairs[token[2:]] = value
    return pairs


@dataclass(frozen=True)
class JobParams:
    source_name: str
    raw_root: str
    curated_root: str
    ingest_date: str
    end_date: str
    input_path: str
    output_path: str
    write_mode: str
    database: str
    job_name: str
    raw_format: str = "document"
    missing_days: str = "error"  # or "skip": read the days of a range that are there
    landed_since: str = ""  # "last": an incremental run over what landed since the last one

    @classmethod
    def from_args(cls, argv: Sequence[str], env: Mapping[str, str] | None = None,
                  today: date | None = None) -> "JobParams":
        layers = (parse_cli_pairs(argv), os.environ if env is None else env)
        found = {field: next((layer[k] for layer in layers for k in keys if layer.get(k)), default)
                 for field, (keys, default) in KEYS.items()}
        lacking = [" or ".join(KEYS[f][0][0] for f in group) for group in NEEDED
                   if not any(found[f] for f in group)]
        if lacking:
            raise ValueError("the job has no value for " + "; ".join(lacking))
        found["source_name"] = found["source_name"].strip().lower()
        found["ingest_date"] = found["ingest_date"] or str((today or date.today()) - timedelta(days=1))
        found["end_date"] = found["end_date"] or found["ingest_date"]
        found["job_name"] = found["job_name"] or f"curate-{found['source_name']}"
        return cls(**found)

    @property
    def table(self) -> str:
        return identifier(self.database, self.source_name)

    def input_location(self) -> Location:
        if self.input_path:
            return Location(self.input_path)
        zone = Location(self.raw_root) / self.source_name
        return zone.on(self.ingest_date) if self.end_date == self.ingest_date else zone

    def output_location(self) -> Location:
        if self.output_path:
            return Location(self.output_path)
        return Location(self.curated_root) / "curated" / self.source_name


def _dated(params: JobParams) -> bool:
    """Whether a run owns days: an explicit path says nothing about its days."""
    return not params.input_path and params.write_mode.strip().lower() == "overwrite_partitions"


def read_job_input(spark: SparkSession, params: JobParams, source_file: bool = False,
                   more: Sequence[date] = ()) -> DataFrame:
    """Raw documents of the job: an explicit path, or the day folders of its
    range and of the days ``more`` (only those folders are listed and read)."""
    spec = get_spec(params.source_name)
    if params.input_path:
        return read_raw(spark, params.input_location(), spec.raw_schema, params.raw_format,
                        source_file=source_file)
    return read_raw_days(spark, params.raw_root, spec.name, spec.raw_schema, params.ingest_date,
                         params.end_date, params.raw_format, source_file=source_file,
                         allow_missing=params.missing_days == "skip", more=more)


def corrupt_documents(raw: DataFrame, schema_fields: list[str] | None = None) -> DataFrame:
    """Documents that did not parse, fully or partly (D7): file, raw text and
    whatever fields did parse. The parsed fields are part of the output because
    Spark rejects raw-JSON queries that reference only the corrupt column."""
    fields = schema_fields or [c for c in raw.columns
                               if c not in (CORRUPT_COL, "source_file", "year", "month", "day", "entity")]
    return raw.where(F.col(CORRUPT_COL).isNotNull()).select(
        "source_file", CORRUPT_COL, F.to_json(F.struct(*fields)).alias("parsed_fields"))


def _check_layout(spark: SparkSession, params: JobParams, more: Sequence[date] = ()) -> None:
    """Refuse JSON Lines that would be read as whole documents (one pass over
    the text, in the ``document`` layout only)."""
    if params.raw_format.strip().lower() == "document":
        paths = [params.input_location()] if params.input_path else day_folders(
            spark, params.raw_root, params.source_name, params.ingest_date, params.end_date,
            params.missing_days == "skip", more) or []
        bad = mixed_layout(spark, paths).limit(5).collect() if paths else []
        if bad:
            raise ValueError("files hold several documents; set RAW_FORMAT to lines: "
                             + ", ".join(f"{r.path} ({r.documents})" for r in bad))


def _quarantine(spark: SparkSession, params: JobParams, more: Sequence[date] = ()) -> None:
    """Malformed documents below ``_quarantine``, by ingest day, so that a rerun
    replaces them (D7)."""
    spec = get_spec(params.source_name)
    with_files = read_job_input(spark, params, source_file=True, more=more)
    bad = corrupt_documents(with_files, spec.raw_schema.fieldNames()[:-1])
    folder = F.regexp_extract("source_file", "/year=([0-9]+)/month=([0-9]+)/day=([0-9]+)/", 0)
    day = F.regexp_replace(folder, "/year=([0-9]+)/month=([0-9]+)/day=([0-9]+)/", "$1-$2-$3")
    bad = bad.withColumn("ingest_date", F.coalesce(F.nullif(day, F.lit("")), F.lit(params.ingest_date)))
    (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ingest_date").json(params.output_location() / "_quarantine"))


LANDING = "landing_day"
# Files of the last minutes before the mark are read again by the next incremental run.
OVERLAP = timedelta(minutes=5)


def staged_days(spark: SparkSession, params: JobParams, late: Sequence[date], seen: Observation,
                kept: Observation) -> DataFrame:
    """Curated rows of the run's folders, and of the folders ``late`` the rows
    of its own days, stored; ``landing_day`` lists the days of other folders that
    a row came from."""
    spec = get_spec(params.source_name)
    raw = read_job_input(spark, params, more=late).observe(
        seen, F.count(F.lit(1)).alias("documents"), F.count(F.col(CORRUPT_COL)).alias("malformed_documents"))
    raw = raw.withColumn(LANDING, F.make_date("year", "month", "day"))
    rows = spec.project(raw, keep=(LANDING,))
    if late:
        rows = rows.where(_own(params, spec) | _inside(params, LANDING))
    rows = _with_landing(rows, spec)
    curated = add_event_partitions(dedupe_by(rows, spec.keys, spec.newest, gather=(LANDING,)), spec.event_date_col)
    curated = curated.observe(kept, F.count_if(~_own(params, spec)).alias("other_days"),
                              F.count_if(F.size(LANDING) > 0).alias("elsewhere"))
    scratch = scratch_path(spark, "staged")
    curated.write.parquet(scratch)
    return spark.read.schema(curated.schema).parquet(scratch)


def _with_landing(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    """``landing_day`` only where it is another than the row's own day."""
    elsewhere = F.col(spec.event_date_col).isNotNull() & (F.col(spec.event_date_col) != F.col(LANDING))
    return rows.withColumn(LANDING, F.when(elsewhere, F.col(LANDING)))


def _inside(params: JobParams, day: str) -> Column:
    return F.col(day).between(F.lit(params.ingest_date).cast("date"), F.lit(params.end_date).cast("date"))


def _own(params: JobParams, spec: SourceSpec) -> Column:
    return F.coalesce(_inside(params, spec.event_date_col), F.lit(False))


def _emptied(spark: SparkSession, params: JobParams, staged: DataFrame, out: Location, table: str | None) -> list[date]:
    """Drop the partitions of own days whose folders are there but hold no row
    any more: an overwrite replaces only the partitions that it has rows of."""
    spec = get_spec(params.source_name)
    if tuple(spec.partition_cols) != PARTITION_COLS:
        return []
    folders = day_folders(spark, params.raw_root, spec.name, params.ingest_date, params.end_date, allow_missing=True) or []
    landed = {date(*(int(x.split("=")[1]) for x in f.rstrip("/").split("/")[-3:])) for f in folders}
    full = {r[0] for r in staged.where(_own(params, spec)).select(spec.event_date_col).distinct().collect()}
    return drop_days(spark, sorted(landed - full), out, table)


def _run_days(spark: SparkSession, params: JobParams, table: str | None, quarantine: bool) -> dict[str, object]:
    """A run that owns the days [ingest_date, end_date]; see ``run_curation``."""
    spec, out = get_spec(params.source_name), params.output_location()
    first, last = date.fromisoformat(params.ingest_date), date.fromisoformat(params.end_date)
    late = ledger.feeding_days(spark, out, first, last)
    _check_layout(spark, params, late)
    seen, kept = Observation("raw_documents"), Observation("curated_rows")
    staged = staged_days(spark, params, late, seen, kept)
    others, elsewhere = (int(kept.get.get(k) or 0) for k in ("other_days", "elsewhere"))
    if elsewhere:
        ledger.record(staged.select(F.col(spec.event_date_col).alias("event_date"), F.explode(LANDING).alias(LANDING)), out)
    rows = staged.drop(LANDING)
    if others:
        merged = with_what_is_there(rows.where(~_own(params, spec)), out, spec.keys, spec.newest, spec.partition_cols)
        rows = rows.where(_own(params, spec)).unionByName(merged)
    written = write_curated(rows, path=out, table=table, mode=params.write_mode, partition_cols=spec.partition_cols)
    emptied = _emptied(spark, params, staged, out, table)
    malformed = int(seen.get.get("malformed_documents") or 0)
    if quarantine and malformed:
        _quarantine(spark, params, late)
    return {"written": written, "emptied_days": [str(d) for d in emptied], "documents": int(seen.get.get("documents") or 0), "malformed_documents": malformed,
            "rows_of_other_days": others, "late_folders": [str(d) for d in late]}


def run_curation(spark: SparkSession, params: JobParams, register_table: bool = True,
                 quarantine: bool = True) -> dict[str, object]:
    """API-4: read raw, curate, write the curated table.

    Rows of the run's own days [ingest_date, end_date] replace those days. Late
    and early rows, and rows without a date, are added to the partitions they
    belong to instead, which keep what is there, and the ledger notes from which
    folder they came: a later run of those days reads that folder as well, so no
    order of runs and reruns loses a row.

    The input is parsed once, into stored curated rows. Own and merged partitions
    are then published by one write, whose commit replaces all of them: a run that
    fails before it leaves the table as it was. Only when there are malformed
    documents is the input read again, to write them below ``_quarantine``."""
    spec = get_spec(params.source_name)
    out, table = params.output_location(), params.table if register_table else None
    report = {"job_name": params.job_name, "source": spec.name, "input": str(params.input_location()),
              "output": str(out), "table": table or "", "mode": params.write_mode}
    if register_table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {identifier(params.database)}")
    if _dated(params):
        return report | _run_days(spark, params, table, quarantine)
    raw = read_job_input(spark, params)
    _check_layout(spark, params)
    seen = Observation("raw_documents")
    observed = raw.observe(seen, F.count(F.lit(1)).alias("documents"),
                           F.count(F.col(CORRUPT_COL)).alias("malformed_documents"))
    written = write_curated(spec.curate(observed), path=out, table=table, mode=params.write_mode,
                            partition_cols=spec.partition_cols)
    report |= {"written": written, "documents": 0, "malformed_documents": 0, "rows_of_other_days": 0}
    if not written:
        return report
    malformed = int(seen.get.get("malformed_documents") or 0)
    if quarantine and malformed:
        _quarantine(spark, params)
    return report | {"documents": int(seen.get.get("documents") or 0), "malformed_documents": malformed}


def run_incremental(spark: SparkSession, params: JobParams, register_table: bool = True,
                    overlap: timedelta = OVERLAP) -> dict[str, object]:
    """SRC-2 incrementally: take in the files that landed since the last such run.

    Only files modified after the high-water mark, less ``overlap`` for those that
    appeared out of order or with the mark itself, are opened. Their rows join the partitions that they
    belong to, one for each key as in a run over everything; reading a file twice
    changes nothing. The ledger notes rows that came from another day's folder, so
    that day runs keep them. The mark moves after the rows are published. A file
    that is rewritten with fewer records needs a run of its day: rows that
    it no longer has stay until then."""
    spec, out = get_spec(params.source_name), params.output_location()
    table = params.table if register_table else None
    if register_table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {identifier(params.database)}")
    zone = Location(params.input_path) if params.input_path else Location(params.raw_root) / spec.name
    mark = ledger.landed_until(spark, out)
    since = None if mark is None else mark - overlap
    seen = Observation("landed_files")
    report = {"job_name": params.job_name, "source": spec.name, "input": str(zone), "output": str(out),
              "table": table or "", "since": since.isoformat() if since else "", "documents": 0,
              "malformed_documents": 0, "written": False}
    raw = with_day_columns(read_raw(spark, zone, spec.raw_schema, params.raw_format, modified_after=since))
    if raw.isEmpty():
        return report
    raw = raw.withColumn("__landed", F.unix_micros(F.col("_metadata.file_modification_time"))).observe(
        seen, F.count(F.lit(1)).alias("documents"), F.count(F.col(CORRUPT_COL)).alias("malformed_documents"),
        F.max("__landed").alias("until"))
    rows = _with_landing(spec.project(raw.withColumn(LANDING, F.make_date("year", "month", "day")), keep=(LANDING,)), spec)
    curated = add_event_partitions(dedupe_by(rows, spec.keys, spec.newest, gather=(LANDING,)), spec.event_date_col)
    scratch = scratch_path(spark, "landed")
    curated.write.parquet(scratch)
    staged = spark.read.schema(curated.schema).parquet(scratch)
    ledger.record(staged.select(F.col(spec.event_date_col).alias("event_date"), F.explode(LANDING).alias(LANDING)), out)
    merged = with_what_is_there(staged.drop(LANDING), out, spec.keys, spec.newest, spec.partition_cols)
    write_curated(merged, path=out, table=table, mode="overwrite_partitions", partition_cols=spec.partition_cols)
    found = seen.get
    ledger.advance(spark, out, int(found["until"]))
    return report | {"documents": int(found["documents"]), "malformed_documents": int(found["malformed_documents"]),
                     "written": True}


def main(argv: Sequence[str] | None = None) -> int:
    """``python -m strata.jobs --SOURCE_NAME traffic --RAW_BUCKET ... --CURATED_BUCKET ...``"""
    import json
    import sys

    from strata.session import get_session

    params = JobParams.from_args(list(argv) if argv is not None else sys.argv)
    spark = get_session(app_name=params.job_name)
    report = (run_incremental if params.landed_since == "last" else run_curation)(spark, params)
    print(json.dumps(report))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
