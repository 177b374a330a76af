"""Exact dedup by deterministic block naming.

Texts are equal when they are identical without white space (space and
``\\t \\n \\v \\f \\r``). A text without its white space is cut into blocks of a
fixed size. The distinct blocks are sorted and numbered, so that a block's name
is an integer that no other block has; then the distinct pairs of adjacent names
are numbered, and so on, until every document is left with one name. The number
of levels together with that name is the document's identity: two documents
share it exactly if all their blocks do. No hash decides.

Only the distinct blocks are shuffled whole, once. Documents keep a 128-bit
locator for each of their blocks and take the names by it. Whether two different
blocks share a locator is counted when they are numbered; if any do, the names
are taken by the blocks themselves instead.

At scale: a block or a pair that a third of all documents hold is one row of each
map task in the shuffles that find what is distinct, and the joins that hand out
names are by plain keys, which adaptive execution splits. A document is never
gathered: its names travel as rows (row, place, name), half as many on each level.
Every level is a written table, so a lost executor costs one level at most.

Defined results: a null text is empty; texts without any other character than
white space are equal to each other. Of equal texts the one with the most code
points stays, then the smallest key, null keys last; rows that repeat key and
length are told apart by their place in the input, so exactly one row of a group
stays. ``keep_id`` is null where the key of the row that stays is. Long texts are
more blocks. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import blocks, stored, text_bytes

BLANKS = b" \t\n\x0b\x0c\r"
BLOCK = 4096  # bytes of a block
NONE = -1  # takes the place of the missing second name of a pair


def locators(parts: list[bytes]) -> np.ndarray:
    """Two longs for each block."""
    from xxhash import xxh3_128_digest

    return np.frombuffer(b"".join(map(xxh3_128_digest, parts)), np.int64).reshape(-1, 2)


def cut(text: bytes, size: int) -> list[bytes]:
    """The blocks of a text without its white space; an empty one has one."""
    plain = text.translate(None, BLANKS)
    return [plain[i:i + size] for i in range(0, len(plain), size)] or [b""]


def _prints(docs: DataFrame, size: int, locate) -> DataFrame:
    """(row, key, chars, sha, at): what is known of each row by itself."""

    def run(batches):
        for rows, texts in blocks(batches, "t"):
            parts = [cut(t, size) for t in texts]
            at = locate([p for mine in parts for p in mine])
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1])], ["a", "b"])
            sha = [hashlib.sha256(b"".join(mine)).hexdigest() for mine in parts]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(sha), pa.ListArray.from_arrays(pa.array(ends), pairs)],
                ["key", "chars", "sha", "at"])

    kind = docs.schema["key"].dataType.simpleString()
    made = docs.mapInArrow(run, f"key {kind}, chars long, sha string, at array<struct<a:bigint,b:bigint>>")
    return made.withColumn("row", F.monotonically_increasing_id())


def _contents(docs: DataFrame, size: int, locate) -> DataFrame:
    """(a, b, block): the blocks with their locators, each once for a few rows."""

    def run(batches):
        for _, texts in blocks(batches, "t"):
            parts = list({p for t in texts for p in cut(t, size)})
            at = locate(parts)
            yield pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1]), pa.array(parts, pa.binary())],
                                             ["a", "b", "block"])

    return docs.select("t").mapInArrow(run, "a long, b long, block binary")


def _with_contents(docs: DataFrame, prints: DataFrame, size: int) -> DataFrame:
    """(row, pos, block): every block of every row, for the case that locators
    do not tell blocks apart. Rows are found again by key, length and digest;
    those that agree in all three hold the same blocks."""

    def run(batches):
        for rows, texts in blocks(batches, "t"):
            parts = [cut(t, size) for t in texts]
            sha = [hashlib.sha256(b"".join(mine)).hexdigest() for mine in parts]
            yield pa.RecordBatch.from_arrays([pa.array(sha), pa.array(parts, pa.list_(pa.binary()))], ["sha", "parts"])

    texts = docs.select("t").mapInArrow(run, "sha string, parts array<binary>").dropDuplicates(["sha", "parts"])
    found = prints.select("row", "sha").join(texts, "sha")
    return found.select("row", F.posexplode("parts").alias("pos", "block"))


def _numbered(distinct: DataFrame, by: list[str], kept: list[str], name: str) -> DataFrame:
    """``distinct`` rows in order, with an integer that no other row has."""
    rows = distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())
    return stored(rows.select(*kept, "name"), name)


def identities(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = BLOCK,
               locate=locators) -> tuple[DataFrame, DataFrame]:
    """(row, level, name) for each row, and (row, key, chars, sha) of the rows."""
    if size < 1:
        raise ValueError("a block holds at least one byte")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("chars"),
                       text_bytes(text).alias("t"))
    prints = stored(_prints(rows, size, locate), "naming-prints")
    distinct = _contents(rows, size, locate).distinct()
    names = _numbered(distinct, ["block"], ["a", "b"], "naming-blocks")
    sizes = prints.select("row", F.size("at").alias("n"))
    if names.groupBy("a", "b").count().filter("count > 1").isEmpty():
        places = prints.select("row", F.size("at").alias("n"), F.posexplode("at").alias("pos", "at"))
        named = places.select("row", "n", "pos", "at.a", "at.b").join(names, ["a", "b"])
    else:
        whole = _numbered(distinct, ["block"], ["block"], "naming-blocks")
        named = _with_contents(rows, prints, size).join(whole, "block").join(sizes, "row")
    largest = sizes.agg(F.max("n")).first()[0] or 1
    done, level = [], 0
    named = named.select("row", "n", "pos", "name")
    while True:
        more = largest > 1
        now = stored(named, "naming-level") if more else named
        done.append(now.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
        if not more:
            break
        second = F.col("pos") % 2 == 1
        pairs = stored(now.filter("n > 1").groupBy("row", "n", F.expr("cast(pos div 2 as int)").alias("pos")).agg(
            F.max(F.when(~second, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(second, F.col("name"))), F.lit(NONE)).alias("b")), "naming-pairs")
        names = _numbered(pairs.select("a", "b").distinct(), ["a", "b"], ["a", "b"], "naming-names")
        named = pairs.join(names, ["a", "b"]).select("row", F.expr("cast((n + 1) div 2 as int)").alias("n"), "pos", "name")
        largest, level = (largest + 1) // 2, level + 1
    found = done[0]
    for x in done[1:]:
        found = found.union(x)
    return found, prints.drop("at")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = BLOCK, locate=locators) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256) for every row of ``docs``."""
    named, prints = identities(docs, key, text, size, locate)
    rows = stored(prints.join(named, "row"), "naming-identities")
    best = F.min(F.struct((-F.col("chars")).alias("short"), F.col("key").isNull().alias("last"), "key", "row"))
    chosen = rows.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    return rows.join(chosen, ["level", "name"]).select(
        F.col("key").alias(key), F.col("best.key").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
  FROM documents),
r AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY plain) AS n
  FROM d WINDOW w AS (PARTITION BY plain ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, CAST(n AS BIGINT) AS group_size, place = 1 AS kept, sha256(plain) AS text_sha256 FROM r
"""
