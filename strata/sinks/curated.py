"""Curated table sink (SNK-1, SNK-3, decisions D4 and D6).

Default mode ``overwrite_partitions`` replaces exactly the (year, month, day)
partitions present in the frame and leaves every other day alone, so a
rerun is idempotent. ``append``, ``overwrite`` (whole table), ``ignore`` and
``error`` are the plain Spark modes.

``overwrite_partitions`` replaces whole partitions, so its frame must hold all
rows of each (D6). Rows that arrive for other days than a run's own go through
``merge_partitions``, which keeps what is there.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_by
from strata.operators.partitions import PARTITION_COLS
from strata.session import scratch_path
from strata.sources.paths import exists, identifier, remove

WRITE_MODES = ("overwrite_partitions", "append", "overwrite", "ignore", "error", "errorifexists")


def _check_mode(mode: str) -> str:
    m = mode.strip().lower()
    if m not in WRITE_MODES:
        raise ValueError(f"write mode must be one of {WRITE_MODES}, got '{mode}'")
    return m


def _qualified(spark: SparkSession, path: str) -> str:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")


def table_location(spark: SparkSession, table: str) -> str:
    """The folder in which a registered table lies."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[-1].data_type if rows else ""


def _register(df: DataFrame, table: str, path: str, cols: list[str]) -> None:
    """An external table over ``path`` with whatever partitions lie there, so
    that a write through the catalog sees them and leaves them alone."""
    spark = df.sparkSession
    fields = ", ".join(f"{identifier(f.name)} {f.dataType.simpleString()}" for f in df.schema)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet"
              + (f" PARTITIONED BY ({', '.join(map(identifier, cols))})" if cols else "") + f" LOCATION '{place}'")
    if cols and exists(spark, path):
        spark.catalog.recoverPartitions(table)


def _insert_over(rows: DataFrame, table: str, overwrite: str) -> None:
    """Overwrite through the catalog; ``insertInto`` takes the overwrite mode
    from the session, not from a writer's option."""
    conf, key = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, overwrite)
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        conf.set(key, before)


def write_curated(df: DataFrame, path: str | None = None, table: str | None = None,
                  mode: str = "overwrite_partitions",
                  partition_cols: Sequence[str] = PARTITION_COLS,
                  rebalance: bool = True) -> bool:
    """SNK-1: write Parquet partitioned by ``partition_cols`` to ``path`` and/or
    register it as ``table`` (an external table when ``path`` is given).

    Returns whether anything was written (``ignore`` skips an existing target).
    A table that is registered at another place than ``path`` is an error. A
    table that is new over an existing folder takes the folder's partitions in
    before it is written, so only ``overwrite`` deletes any.

    ``rebalance`` adds a REBALANCE on the partition columns before the write:
    each task then holds few days, so the write creates about one file per
    day and split, not one per (task, day); AQE splits a day that holds a
    large share of the rows into several tasks.
    """
    if path is None and table is None:
        raise ValueError("write_curated needs a path or a table")
    m = _check_mode(mode)
    cols = list(partition_cols)
    spark = df.sparkSession
    out = df.hint("rebalance", *cols) if rebalance and cols else df
    registered = table is not None and spark.catalog.tableExists(table)
    if registered and path is not None:
        place = table_location(spark, table)
        if _qualified(spark, place) != _qualified(spark, path):
            raise ValueError(f"table {table} lies at {place}, not at {path}")
    if registered or path is not None and exists(spark, path):
        if m == "ignore":
            return False
        if m in ("error", "errorifexists"):
            raise ValueError(f"{table if registered else path} already exists")
    if table is not None and path is not None and not registered:
        _register(df, table, path, cols)
        registered = True
    if registered:
        rows = out.select(*spark.table(table).columns)
        if m in ("overwrite_partitions", "overwrite"):
            _insert_over(rows, table, "dynamic" if m == "overwrite_partitions" else "static")
        else:
            rows.write.insertInto(table, overwrite=False)
        return True
    writer = out.write.partitionBy(*cols)
    if m == "overwrite_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(m).option("partitionOverwriteMode", "static")
    if table is not None:  # a managed table that is new: there is nothing to overwrite
        out.write.partitionBy(*cols).format("parquet").saveAsTable(table)
    else:
        writer.parquet(path)
    return True


def drop_days(spark: SparkSession, days: Sequence[date], path: str, table: str | None = None) -> list[date]:
    """Remove the (year, month, day) partitions of these days; returns those that
    were there."""
    dropped = []
    for d in days:
        folder = f"{path.rstrip('/')}/year={d.year}/month={d.month}/day={d.day}"
        if exists(spark, folder):
            if table is not None:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (year={d.year}, month={d.month}, day={d.day})")
            remove(spark, folder)
            dropped.append(d)
    return dropped


def with_what_is_there(df: DataFrame, path: str, keys: Sequence[str], newest: Sequence[str] = (),
                       partition_cols: Sequence[str] = PARTITION_COLS) -> DataFrame:
    """Rows and those of the table's partitions that they belong to, one for
    each key (DED-1). Other partitions are not read. The result is stored beside
    the table, because a folder can't be read while it is overwritten.
    """
    spark, cols = df.sparkSession, list(partition_cols)
    scratch = scratch_path(spark, "merge")
    df.write.parquet(f"{scratch}/new")
    new = spark.read.schema(df.schema).parquet(f"{scratch}/new")
    if exists(spark, path):
        touched = new.select(*[F.col(c).alias(f"_{c}") for c in cols]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols]
        kept = spark.read.schema(df.schema).option("basePath", path).parquet(path).select(*df.columns)
        new = new.unionByName(kept.join(touched, functools.reduce(lambda a, b: a & b, same), "left_semi"))
    dedupe_by(new, list(keys), newest).write.parquet(f"{scratch}/merged")
    return spark.read.schema(df.schema).parquet(f"{scratch}/merged")


def merge_partitions(df: DataFrame, path: str, keys: Sequence[str], newest: Sequence[str] = (),
                     table: str | None = None, partition_cols: Sequence[str] = PARTITION_COLS) -> None:
    """Add rows to the partitions that they belong to: each of those becomes
    its old rows and the new ones, one for each key. Other partitions are neither
    read nor written."""
    merged = with_what_is_there(df, path, keys, newest, partition_cols)
    write_curated(merged, path, table, "overwrite_partitions", partition_cols)
