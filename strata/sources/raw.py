"""Raw-zone and curated-zone readers (SRC-1, SRC-2, SRC-6, read_curated).

Raw documents come in one of two layouts (D15):

* ``document`` - one indented JSON document per file, as landed by the
  ingest step. Read with ``multiLine``; each file is one task.
* ``lines``    - JSON Lines, one document per line. Splittable, so large
  files spread over many tasks.

The layout is always explicit, because Spark keeps only the first document of a
file of several when it reads whole files. ``mixed_layout`` finds such files; the
curation job refuses them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.schemas import CORRUPT_COL
from strata.session import ship
from strata.sources.paths import Location, filesystem, qualified, reachable

RAW_FORMATS = ("document", "lines")


def _check_format(raw_format: str) -> str:
    fmt = raw_format.strip().lower()
    if fmt not in RAW_FORMATS:
        raise ValueError(f"raw_format must be one of {RAW_FORMATS}, got '{raw_format}'")
    return fmt


def _json_options(schema: StructType) -> dict[str, str]:
    opts = {"mode": "PERMISSIVE"}
    if CORRUPT_COL in schema.fieldNames():
        opts["columnNameOfCorruptRecord"] = CORRUPT_COL
    return opts


def parse_documents(docs: DataFrame, schema: StructType, text_col: str = "document",
                    keep: Sequence[str] = ()) -> DataFrame:
    """Parse JSON document text with a declared raw schema (SCL-11) - the
    in-memory twin of SRC-1 for documents that are already in a DataFrame."""
    parsed = docs.select(F.from_json(F.col(text_col), schema, _json_options(schema)).alias("__doc"),
                         *[F.col(k) for k in keep])
    return parsed.select("__doc.*", *keep)


def read_raw(spark: SparkSession, path: str | Sequence[str], schema: StructType,
             raw_format: str = "document", source_file: bool = False,
             modified_after: datetime | None = None) -> DataFrame:
    """SRC-1: read raw JSON documents with a declared schema (never inferred).

    ``modified_after`` (with a time zone) leaves out the files that landed at
    that time or before; only the others are opened.

    With ``source_file`` a column of that name carries each row's file path
    (provenance, e.g. for quarantine). It is opt-in: once the file metadata is
    referenced, the scan carries the metadata columns for every file."""
    fmt = _check_format(raw_format)
    # Every file below the path, whether producers land it in the day's folder or
    # in an entity's below it; partition discovery would skip one of the two.
    reader = spark.read.schema(schema).options(**_json_options(schema)).option("recursiveFileLookup", "true")
    if fmt == "document":
        reader = reader.option("multiLine", "true")
    if modified_after is not None:
        utc = modified_after.astimezone(timezone.utc)
        reader = reader.option("modifiedAfter", utc.strftime("%Y-%m-%dT%H:%M:%S.%f")).option("timeZone", "UTC")
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.json(paths)
    return df.withColumn("source_file", F.col("_metadata.file_path")) if source_file else df


def with_day_columns(raw: DataFrame) -> DataFrame:
    """int ``year``, ``month`` and ``day`` of each document's folder."""
    return raw.withColumns({c: F.regexp_extract(F.col("_metadata.file_path"), f"/{c}=([0-9]+)/", 1).try_cast("int")
                            for c in ("year", "month", "day")})


def _day_number(y: Column, m: Column, d: Column) -> Column:
    return y * 10000 + m * 100 + d


def _as_date(day: date | str) -> date:
    return date.fromisoformat(day) if isinstance(day, str) else day


def _day_key(d: date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def day_range_predicate(start: date | str | None, end: date | str | None = None,
                        year: str = "year", month: str = "month", day: str = "day",
                        open_end: bool = False) -> Column:
    """A predicate over int partition columns selecting [start, end] (a single
    day when ``end`` is None, unless ``open_end``; either end may be None with
    ``open_end``). It only references partition columns, so Spark turns it into
    a PartitionFilter and skips the other day folders."""
    lo = _as_date(start) if start is not None else None
    hi = _as_date(end) if end is not None else (None if open_end else lo)
    if lo is not None and hi is not None and lo > hi:
        raise ValueError(f"start {lo} is after end {hi}")
    key = _day_number(F.col(year), F.col(month), F.col(day))
    pred = F.lit(True)
    if lo is not None:
        pred = pred & (key >= _day_key(lo))
    if hi is not None:
        pred = pred & (key <= _day_key(hi))
    return pred


def _months(lo: date, hi: date):
    y, m = lo.year, lo.month
    while (y, m) <= (hi.year, hi.month):
        yield y, m
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)


def day_dirs(spark: SparkSession, base: str, start: date | str, end: date | str | None = None,
             padded: bool = True) -> list[str]:
    """Existing ``year=/month=/day=`` folders below ``base`` for [start, end].

    One Hadoop glob per month (metadata calls on the driver, no data): the
    reader is then given only these folders, so the file index never lists
    the rest of a large zone. ``padded`` selects ``month=04`` (raw zone) or
    ``month=4`` (curated tables written from int partition columns)."""
    lo = _as_date(start)
    hi = _as_date(end) if end is not None else lo
    if lo > hi:
        raise ValueError(f"start {lo} is after end {hi}")
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    found: list[str] = []
    for y, m in _months(lo, hi):
        first = lo.day if (y, m) == (lo.year, lo.month) else 1
        last = hi.day if (y, m) == (hi.year, hi.month) else 31
        fmt = "{:02d}" if padded else "{}"
        days = ",".join(fmt.format(d) for d in range(first, last + 1))
        pattern = f"{base.rstrip('/')}/year={y}/month={fmt.format(m)}/day={{{days}}}"
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        statuses = path.getFileSystem(conf).globStatus(path)
        for st in statuses or []:
            if st.isDirectory():
                found.append(st.getPath().toString())
    return sorted(found)


def _day_dirs_or_none(spark: SparkSession, base: str, start, end, padded: bool
                      ) -> list[str] | None:
    """``day_dirs`` where the JVM gateway is available, else None."""
    if getattr(spark, "_jvm", None) is None:
        return None
    return day_dirs(spark, base, start, end, padded)


def missing_days(base: str, dirs: Sequence[str], start: date | str, end: date | str | None) -> list[date]:
    """Days of [start, end] that have no folder among ``dirs``."""
    lo = _as_date(start)
    hi = _as_date(end) if end is not None else lo
    found = {"/".join(d.rstrip("/").split("/")[-3:]) for d in dirs}
    days = [lo + timedelta(days=i) for i in range((hi - lo).days + 1)]
    return [d for d in days if str(Location(base).on(d))[len(base) + 1:] not in found]


def mixed_layout(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, documents): files that hold several one-line documents, of which
    the ``document`` layout would keep only the first."""
    paths = [path] if isinstance(path, str) else list(path)
    line = spark.read.option("recursiveFileLookup", "true").text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    whole = line.where(F.col("value").rlike(r"^\{.*\}\s*$"))
    return whole.groupBy("path").agg(F.count("*").alias("documents")).where("documents > 1")


def day_folders(spark: SparkSession, raw_root: str, source: str, start: date | str, end: date | str | None = None,
                allow_missing: bool = False, more: Sequence[date] = ()) -> list[str] | None:
    """The folders of [start, end], and of the days ``more``, under
    ``<root>/<source>``: at most one for each day. Days without a folder raise
    FileNotFoundError, unless ``allow_missing``. None where folders can't be
    listed (no JVM gateway)."""
    base = Location(raw_root) / source
    dirs = _day_dirs_or_none(spark, base, start, end, padded=True)
    if dirs is None:
        return None
    lacking = missing_days(base, dirs, start, end)
    for d in more:
        found = day_dirs(spark, base, d)
        dirs += found
        lacking += [] if found else [d]
    if lacking and not allow_missing:
        raise FileNotFoundError(f"no raw folder for {len(lacking)} day(s) below the path {base}: "
                                + ", ".join(str(Location(base).on(d))[len(base) + 1:] for d in lacking[:5]))
    return dirs


def read_raw_days(spark: SparkSession, raw_root: str, source: str, schema: StructType,
                  start: date | str, end: date | str | None = None,
                  raw_format: str = "document", source_file: bool = False,
                  allow_missing: bool = False, more: Sequence[date] = ()) -> DataFrame:
    """SRC-2 widened to a date range: only the day folders of [start, end], and
    of the days ``more``, under ``<root>/<source>`` are listed and read
    (``day_folders``); the zero-padded folder names become int ``year/month/day``
    columns. With ``allow_missing`` the days that are there are read (none: empty)."""
    dirs = day_folders(spark, raw_root, source, start, end, allow_missing, more)
    if dirs is None:  # no JVM gateway (e.g. a Spark Connect session): filter only
        raw = with_day_columns(read_raw(spark, Location(raw_root) / source, schema, raw_format, source_file=source_file))
        wanted = day_range_predicate(start, end)
        for d in more:
            wanted = wanted | day_range_predicate(d)
        return raw.where(wanted)
    if not dirs:
        empty = spark.createDataFrame([], schema).withColumns({
            "year": F.lit(None).cast("int"), "month": F.lit(None).cast("int"),
            "day": F.lit(None).cast("int")})
        return empty.withColumn("source_file", F.lit(None).cast("string")) if source_file else empty
    return with_day_columns(read_raw(spark, dirs, schema, raw_format, source_file=source_file))


FOLDER_LEVELS = 3  # year, month, day: listed level by level, each by tasks
BATCH_BYTES = 4 << 20


def _hidden(name: str) -> bool:
    """Names that Spark's own file listing leaves out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _list(deep: bool):
    """A task that turns folders into what lies in them: one level, or all of it."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import fs

        for batch in batches:
            files = batch.filter(pc.invert(batch.column("folder")))
            if files.num_rows:
                yield files
            open_ = batch.filter(batch.column("folder")).to_pylist()
            while open_:
                r = open_.pop()
                store, _ = filesystem(r["root"])
                found = [i for i in store.get_file_info(fs.FileSelector(r["place"]))
                         if not _hidden(i.base_name) and (i.type == fs.FileType.Directory or i.size)]
                if deep:
                    open_ += [{**r, "place": i.path} for i in found if i.type == fs.FileType.Directory]
                    found = [i for i in found if i.type != fs.FileType.Directory]
                for a in range(0, len(found), 10000):
                    part = found[a:a + 10000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["root"]] * len(part)), pa.array([i.path for i in part]),
                         pa.array([i.type == fs.FileType.Directory for i in part])], ["root", "place", "folder"])

    return run


def _fetch(batches):
    """A task that reads files whole: (path as a URI, bytes)."""
    import re

    import pyarrow as pa

    def uri(root: str, place: str) -> str:
        quoted = re.sub(r"[\x00-\x20\x7f-\xa0%\"<>\\\\^`{|}\[\]#?]", lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), place)
        if root.startswith("file:"):
            return "file:" + quoted
        bucket, _, key = quoted.lstrip("/").partition("/")  # s3, gs: the place starts with the bucket
        head, _, rest = root.partition("://")
        return f"{head}://{rest.split('/', 1)[0]}/{key if rest.split('/', 1)[0] == bucket else quoted.lstrip('/')}"

    def batch_of(paths, texts):
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], ["path", "raw"])

    for batch in batches:
        paths, texts, size = [], [], 0
        for root, place in zip(batch.column("root").to_pylist(), batch.column("place").to_pylist()):
            store, _ = filesystem(root)
            with store.open_input_stream(place) as f:
                text = f.read()
            paths.append(uri(root, place))
            texts.append(text)
            size += len(text)
            if size >= BATCH_BYTES:
                yield batch_of(paths, texts)
                paths, texts, size = [], [], 0
        if paths:
            yield batch_of(paths, texts)


def _read_whole(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """(path, document) of every file below the paths, listed and opened by tasks:
    the driver holds no file names, however many there are. None where a path
    does not exist or its file system is known to Hadoop alone."""
    ship(spark)
    roots = []
    for p in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(p)
        found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
        found = [(qualified(spark, f.getPath().toString()), f.isDirectory()) for f in found or []]
        if not found or not all(reachable(uri) for uri, _ in found):
            return None
        roots += [(uri, filesystem(uri)[1], folder) for uri, folder in found]
    schema = "root string, place string, folder boolean"
    files, tasks = spark.createDataFrame(roots, schema), spark.sparkContext.defaultParallelism
    for level in range(FOLDER_LEVELS + 1):
        files = files.repartition(tasks).mapInArrow(_list(level == FOLDER_LEVELS), schema)
    # Dealt in turn: the work is in the files, not in the bytes of their names.
    files = files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.mapInArrow(_fetch, "path string, raw binary").select("path", F.col("raw").cast("string").alias("document"))


def read_documents_text(spark: SparkSession, path: str | Sequence[str],
                        raw_format: str = "document") -> DataFrame:
    """SRC-6: raw documents as text for validation - one row per document with
    its ``path``; no schema is imposed (the validator parses to VARIANT).

    Files of one document each are listed and read by tasks; their number is
    bounded by the shared storage alone. Empty files hold no document."""
    fmt = _check_format(raw_format)
    paths = [path] if isinstance(path, str) else list(path)
    whole = _read_whole(spark, paths) if fmt == "document" and getattr(spark, "_jvm", None) is not None else None
    if whole is not None:
        return whole
    df = spark.read.option("recursiveFileLookup", "true").text(paths, wholetext=(fmt == "document"))
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))


def read_raw_objects(spark: SparkSession, path: str | Sequence[str], schema: StructType) -> DataFrame:
    """SRC-1 for a zone of one document a file whose files are too many for the
    driver to list: ``read_documents_text`` parsed with the declared schema."""
    return parse_documents(read_documents_text(spark, path, "document"), schema)


def read_curated(spark: SparkSession, path: str | None = None, start: date | str | None = None,
                 end: date | str | None = None, table: str | None = None) -> DataFrame:
    """Read a curated table by ``path`` or catalog ``table``, optionally
    limited to event dates [start, end].

    With a range, the range is also expressed on ``year/month/day`` so Spark
    prunes partitions (a catalog table prunes through its metastore); a filter
    on ``event_date`` alone would scan every partition. For a path with both
    ends given, only the matching day folders are listed (``day_dirs``)."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    if start is None and end is None:
        return spark.table(table) if table else spark.read.parquet(path)
    if table:
        df = spark.table(table)
    else:
        dirs = _day_dirs_or_none(spark, path, start, end, padded=False) \
            if start is not None and end is not None else None
        if dirs:
            df = spark.read.option("basePath", path).parquet(*dirs)
        elif dirs == []:
            df = spark.read.parquet(path).where(F.lit(False))
        else:
            df = spark.read.parquet(path)
    in_range = F.lit(True)
    if start is not None:
        in_range = in_range & (F.col("event_date") >= F.lit(_as_date(start)))
    if end is not None:
        in_range = in_range & (F.col("event_date") <= F.lit(_as_date(end)))
    return df.where(day_range_predicate(start, end, open_end=True)).where(in_range)
