"""Helpers shared by the text operators: words, blocks of rows, scratch tables.

A *word* is a maximal run of characters other than space and ``\\t \\n \\v \\f
\\r``. ``bytes.split()`` splits UTF-8 text at exactly those six bytes, so the
Python operators read texts as binary columns; the native ones use ``WORD``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import CLEANUP, scratch_path, ship

SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

# Characters of text held as Python objects at once; a longer text is a block
# of its own.
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)  # the operators' Python workers import this package
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back, so that
    what follows neither recomputes it nor depends on a live executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(col: str = "text") -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into row ranges of at most ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.frombuffer(pa.compute.binary_length(column).cast(pa.int64()).buffers()[1],
                              np.int64, batch.num_rows)
        at = 0
        while at < batch.num_rows:
            end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), limit, "right")))
            yield batch.slice(at, end - at), column.slice(at, end - at).to_pylist()
            at = end


def factorised(lists: list[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all items of ``lists`` in order, the distinct items, and each
    list's bounds in the codes (one longer than ``lists``)."""
    bounds = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=bounds[1:])
    flat = np.empty(int(bounds[-1]), object)
    at = 0
    for x in lists:
        flat[at:at + len(x)] = x
        at += len(x)
    codes, distinct = pd.factorize(flat)
    return codes, distinct, bounds


def per_text(docs: DataFrame, f, extra: str, text: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the columns ``extra`` (a schema string) that ``f`` makes of
    a block of whole texts: ``f(list of bytes) -> list of columns``."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    made = [x.strip().split(" ")[0] for x in extra.split(",")]

    def run(batches):
        for part, texts in blocks(batches, "_t", limit):
            columns = [part.column(i) for i in range(len(names))] + [pa.array(x) for x in f(texts)]
            yield pa.RecordBatch.from_arrays(columns, [*names, *[f"x_{m}" for m in made]])

    kinds = ", ".join(f"{n} {kind}" for n, (_, kind) in zip(names, docs.dtypes))
    rows = docs.toDF(*names).withColumn("_t", text_bytes(names[docs.columns.index(text)]))
    found = rows.mapInArrow(run, kinds + ", " + ", ".join(f"x_{x.strip()}" for x in extra.split(",")))
    return found.toDF(*docs.columns, *made)
