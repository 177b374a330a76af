"""Compaction of a curated table's small files (SNK-1).

Appends, merges and micro-batches leave partitions with many small files. The
sizes come from the files' metadata columns, summed by Spark; a partition that has
more files than its bytes need is packed into bins of about ``target_bytes``, and
only such partitions are read and written, by one dynamic partition overwrite.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.partitions import PARTITION_COLS
from strata.session import scratch_path
from strata.sinks.curated import write_curated

TARGET_BYTES = 128 << 20


def partition_files(spark: SparkSession, path: str, partition_cols: Sequence[str] = PARTITION_COLS) -> DataFrame:
    """(partition columns, files, bytes) of a table's folder. No data column is read."""
    cols = list(partition_cols)
    rows = spark.read.parquet(path).select(*cols, F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.file_size").alias("size"))
    return rows.groupBy(*cols, "file", "size").agg(F.lit(1)).groupBy(*cols).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def _same(cols: Sequence[str], prefix: str) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in cols])


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, table: str | None = None,
            partition_cols: Sequence[str] = PARTITION_COLS) -> DataFrame:
    """Pack the small files; returns (partition columns, files, bytes, bins) of
    the partitions that were rewritten, ``files`` being those before.

    A row's bin is the remainder of a hash of its values, and a task writes each
    bin that it holds as one file, so a partition has at most ``bins`` files."""
    cols = list(partition_cols)
    bins = F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(target_bytes))).cast("int")
    scratch = scratch_path(spark, "compaction")
    partition_files(spark, path, cols).withColumn("bins", bins).where("files > bins").write.parquet(f"{scratch}/plan")
    plan = spark.read.parquet(f"{scratch}/plan")
    if plan.isEmpty():
        return plan
    rows = spark.read.option("basePath", path).parquet(path)
    wanted = plan.select("bins", *[F.col(c).alias(f"_{c}") for c in cols])
    packed = rows.join(wanted, _same(cols, "_"))
    values = [c for c in rows.columns if c not in cols]
    packed = packed.withColumn("_bin", F.pmod(F.xxhash64(*values), F.col("bins"))).select(*rows.columns, "_bin")
    packed.write.parquet(f"{scratch}/rows")  # a folder can't be read while it is overwritten
    stored = spark.read.schema(packed.schema).parquet(f"{scratch}/rows")
    write_curated(stored.repartition(*cols, "_bin").drop("_bin"), path, table, "overwrite_partitions", cols, rebalance=False)
    return plan
