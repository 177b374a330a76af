"""Raw-zone sink (SNK-6, decision D15).

Documents land below ``<root>/<source>/year=YYYY/month=MM/day=DD/entity=<E>/`` with
zero-padded folder names. The entity folder makes the last write win for each
object, a day of one entity, as an object key does: landing one centre or
country leaves the others of that day alone. The ``document`` layout writes one
JSON document per file (read back with ``multiLine``); ``lines`` writes JSON
Lines, compressed, in files of bounded size (readers take plain ones too).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sinks import objects
from strata.sources.paths import Location, qualified, reachable
from strata.sources.raw import _check_format

ENTITY_COL = "entity"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# as Spark escapes the values of partition folders
ESCAPED = "%" + "".join(map(chr, range(1, 32))) + "\"#'*/:=?\\\x7f{[]^"


def _day_folder(folders: list[str], source: str) -> Column:
    """``<source>/year=YYYY/.../`` as Spark names the folders of partitions."""
    steps = [F.lit(source)]
    for name in folders:
        value = F.col(name)
        if name == ENTITY_COL:
            value = reduce(lambda c, x: F.replace(c, F.lit(x), F.lit(f"%{ord(x):02X}")), ESCAPED, value)
        steps.append(F.concat(F.lit(f"{name}="), F.when(value != "", value).otherwise(F.lit(NO_VALUE))))
    return F.concat(F.concat_ws("/", *steps), F.lit("/"))


def write_raw(docs: DataFrame, raw_root: str, source: str, raw_format: str = "document",
              text_col: str = "document", date_col: str = "ingest_date",
              mode: str = "overwrite_partitions", by_entity: bool = True) -> str:
    """Write the documents of one source; returns the source folder.

    Frames without an ``entity`` column, and backfills with ``by_entity=False``,
    have day folders only: such a write replaces whole days, so it must hold all
    documents of the days that it writes (fewer, larger files for bulk loads).
    """
    fmt = _check_format(raw_format)
    split = by_entity and ENTITY_COL in docs.columns
    d = F.col(date_col).cast("date")
    out = docs.select(
        F.date_format(d, "yyyy").alias("year"),
        F.date_format(d, "MM").alias("month"),
        F.date_format(d, "dd").alias("day"),
        *([F.col(ENTITY_COL).cast("string").alias(ENTITY_COL)] if split else []),
        F.col(text_col).alias("value"),
    )
    target = Location(raw_root) / source
    folders = ["year", "month", "day", *([ENTITY_COL] if split else [])]
    spark = docs.sparkSession
    # A file for each document: written and put in place by tasks, because Spark's
    # own committer moves files one by one on the driver.
    root = qualified(spark, Location(raw_root)) if fmt == "document" else None
    if root and mode in ("overwrite_partitions", "append") and reachable(root):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{source}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
        rows = out.select(_day_folder(folders, source).alias("object_key"), F.col("value").alias("document"))
        rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        objects.store(spark, rows, root, clear=mode == "overwrite_partitions")
        return target
    if fmt == "lines":
        # Without this every task writes a file into every day it holds
        # (tasks x days small files); rebalancing on the day gives about one
        # file per day, and AQE still splits a day holding many documents.
        out = out.hint("rebalance", *folders)
    else:
        # A file for each document: the work is in the files, not the bytes that
        # adaptive execution would merge tasks by. Dealt in turn, so no key is hot.
        out = out.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    writer = out.write.partitionBy(*folders)
    if mode == "overwrite_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    if fmt == "document":
        writer = writer.option("maxRecordsPerFile", 1)
    # Lines repeat their field names, so they land compressed. Such a file is read by
    # one task: the rebalancing bounds what a file holds, however large a day is.
    writer.option("compression", "gzip" if fmt == "lines" else "none").text(target)
    return target
