"""Raw documents as objects under their own keys (SNK-6, SNK-7).

Spark's file writers name their part files themselves. This sink stores every
document as ``<root>/<object_key>``, one file each, in two steps that both survive
lost executors:

1. A Python data source writes each task's documents as one compressed attempt file,
   in a folder named after the task attempt, and commits one message for each task. Only
   the attempts that Spark commits are named in the run's manifest; an abort, or an
   attempt whose executor was lost, leaves files that no manifest names.
2. A job over the manifest writes the committed documents below their keys, each beside
   its attempt first and then moved whole. A repeated task puts the same in place again.

Small files fill whole blocks of a file system, so documents are files of their own only
in the zone itself: a run that replaces objects needs hardly more room than they have.

As in any object store the last write of a key wins: a later run replaces the
objects that it names and leaves all others alone. Within one run a key has one
document, that with the greatest ``order`` value, then the greatest text. Readers
see objects appear one by one, each whole.
"""

from __future__ import annotations

import gzip
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from strata.session import CLEANUP, scratch_path, ship
from strata.sources.paths import Location, filesystem, qualified, remove
from strata.sources.raw import read_documents_text

ATTEMPTS = "_attempts"
DOCUMENTS = "documents.json.gz"  # of an attempt: a line for each, its key and its text
WHOLE = ("s3", "gcs", "abfs")  # stores whose objects appear whole when they are closed


@dataclass
class Written(WriterCommitMessage):
    folder: str  # of the attempt
    objects: int


class AttemptWriter(DataSourceWriter):
    """Rows (object_key, document) become one file of the attempt's folder. A key
    that ends in a slash is a folder: the document's file gets a name of its own in it."""

    def __init__(self, options: dict[str, str]):
        self.run = options["path"]

    def write(self, iterator) -> Written:
        from pyspark import TaskContext

        part = f"{TaskContext.get().partitionId():06d}"
        folder = f"{self.run}/{part}-{TaskContext.get().taskAttemptId()}"
        own = f"part-{self.run.rsplit('/', 1)[-1]}-{part}"
        store, place = filesystem(folder)
        rows, n = iter(iterator), 0
        row = next(rows, None)
        if row is None:
            return Written("", 0)
        store.create_dir(place, recursive=True)
        with store.open_output_stream(f"{place}/{DOCUMENTS}") as f, gzip.GzipFile(fileobj=f, mode="wb", compresslevel=1) as z:
            while row is not None:
                key = f"{row[0]}{own}-{n}.json" if row[0].endswith("/") else row[0]
                z.write(json.dumps([key, row[1] or ""]).encode() + b"\n")
                row, n = next(rows, None), n + 1
        return Written(folder, n)

    def commit(self, messages) -> None:
        """The manifest: one line for each task that wrote anything."""
        store, place = filesystem(self.run)
        store.create_dir(place, recursive=True)
        with store.open_output_stream(f"{place}/manifest.json") as f:
            f.write("".join(json.dumps({"folder": m.folder, "objects": m.objects}) + "\n"
                            for m in messages if m is not None and m.folder).encode())

    def abort(self, messages) -> None:
        """Without a manifest nothing is published; what was written goes."""
        from pyarrow import fs

        store, place = filesystem(self.run)
        if store.get_file_info(place).type != fs.FileType.NotFound:
            store.delete_dir(place)


class AttemptSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "strata_objects"

    def schema(self) -> str:
        return "object_key string, document string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return AttemptWriter(dict(self.options))


def _entries(folder: str) -> Iterator[list[str]]:
    """[object_key, document] of everything that an attempt holds."""
    store, place = filesystem(folder)
    with store.open_input_stream(f"{place}/{DOCUMENTS}") as f, gzip.GzipFile(fileobj=f) as z:
        yield from map(json.loads, z)


def _clear(folders: DataFrame, root: str) -> None:
    """Empty every folder that the committed attempts have files for."""

    def above(batches):
        for batch in batches:
            for folder in batch["folder"]:
                yield pd.DataFrame({"above": sorted({key.rpartition("/")[0] for key, _ in _entries(folder)})})

    def clear(batches):
        from pyarrow import fs

        store, target = filesystem(root)
        for batch in batches:
            for a in batch["above"]:
                if store.get_file_info(f"{target}/{a}").type == fs.FileType.Directory:
                    store.delete_dir_contents(f"{target}/{a}")
            yield batch

    found = folders.select("folder").mapInPandas(above, "above string").distinct()
    found.mapInPandas(clear, "above string").agg(F.count(F.lit(1))).collect()


def _publish(spark: SparkSession, run: str, root: str, clear: bool = False) -> int:
    """Write the committed documents below their keys; returns how many. With
    ``clear`` their folders are emptied first."""
    folders = spark.read.schema("folder string, objects long").json(f"{run}/manifest.json")
    total = int(folders.agg(F.sum("objects")).first()[0] or 0)
    if not total:
        return 0
    # one task for each attempt folder, as they were written
    tasks = max(1, folders.count())
    if clear:
        _clear(folders.repartition(tasks), root)

    def place_all(batches):
        from pyspark import TaskContext

        for batch in batches:
            placed = 0
            for folder in batch["folder"]:
                store, place = filesystem(folder)
                _, target = filesystem(root)
                beside = f"{place}/{TaskContext.get().taskAttemptId()}.whole"
                made = set()
                for key, document in _entries(folder):
                    to = f"{target}/{key}"
                    above = to.rsplit("/", 1)[0]
                    if above not in made:
                        store.create_dir(above, recursive=True)
                        made.add(above)
                    direct = store.type_name in WHOLE
                    with store.open_output_stream(to if direct else beside) as f:
                        f.write(document.encode())
                    if not direct:
                        store.move(beside, to)  # replaces what is there
                    placed += 1
            yield pd.DataFrame({"placed": [placed]})

    done = folders.select("folder").repartition(tasks).mapInPandas(place_all, "placed long")
    return int(done.agg(F.sum("placed")).first()[0] or 0)


def store(spark: SparkSession, rows: DataFrame, root: str, clear: bool = False) -> int:
    """Write (object_key, document) rows below a qualified root and publish them."""
    ship(spark)
    run = f"{root}/{ATTEMPTS}/{scratch_path(spark, 'objects').rsplit('/', 1)[-1]}"
    spark.dataSource.register(AttemptSource)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        rows.select("object_key", "document").write.format(AttemptSource.name()).mode("append").save(run)
    finally:
        spark.conf.set(CLEANUP, before)
    placed = _publish(spark, run, root, clear)
    remove(spark, run)
    return placed


def write_objects(docs: DataFrame, raw_root: str, key_col: str = "object_key", text_col: str = "document",
                  order: str | None = None) -> int:
    """Store every document under ``<raw_root>/<key>``; returns how many."""
    spark = docs.sparkSession
    rank = F.struct(*([F.col(order).alias("o")] if order else []), F.col(text_col).alias("d"))
    keyed = docs.where(F.col(key_col).isNotNull()).withColumn("_key", F.col(key_col))
    # The grouping's own exchange, in parts that adaptive execution leaves alone: the
    # work is in the files, not in the bytes that it would merge tasks by.
    keyed = keyed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_key")
    last = keyed.groupBy(F.col("_key").alias("object_key")).agg(F.max(rank).alias("last"))
    return store(spark, last.select("object_key", F.col("last.d").alias("document")), qualified(spark, Location(raw_root)))


def list_objects(spark: SparkSession, raw_root: str, source: str) -> DataFrame:
    """(object_key, document) of every object of a source, from the paths that
    they are stored under."""
    root = qualified(spark, Location(raw_root))
    texts = read_documents_text(spark, str(Location(root) / source))
    path = F.regexp_replace(F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    start = len(root.replace("file:///", "file:/")) + 2
    return texts.select(F.substring(path, start, 1 << 20).alias("object_key"), "document")
