"""Mixing sources to target weights with hash-threshold histograms.

Every source gets a share of ``share`` times all words by its weight; no target
exceeds ``most`` times its source, and what a source can't take goes to the
others by weight. A document is taken as often as its source's target holds the
source whole, and once more where its hash lies at or below the source's
threshold. Thresholds are nested: a larger budget takes all that a smaller one
takes.

The threshold is found without sorting documents: words are summed by source
and the hash's first 12 bits; the bucket in which the budget ends is refined
alone, by the next 16 bits, and then by the whole hash. The sum that is nearest
to the budget wins. Only DataFrame operations are used.

Defined results: a null text has no words. Null is a source of its own, after
all others. Rows with equal ids have equal hashes and are taken alike; a null id
hashes like an empty text. A source without words has target 0, and one whose
copies use up its target gives nothing more, documents without words included.
Words are counted over whole texts, whatever their length. An empty table gives
an empty result; other columns are not read by ``mix`` and are kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.words import WORD, stored

WEIGHTS = (3, 1, 2)  # for the sources in order, repeating
BITS = (12, 16, 32)  # of the hash at each refinement
SMALL = 10_000  # rows of a table that is sent to every task


def place(key: Column) -> Column:
    """A 60-bit hash of a row's id."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h): words and hash of every document."""
    return docs.select("doc_id", "source",
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       place(F.col("doc_id")).alias("h"))


def targets(sized: DataFrame, share: float = 1.5, most: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, target) of every source.

    In the order of ``most * size / weight`` sources reach their limit one by
    one: a source is at its limit when the level that the rest would share
    without it (``level``) is above its own.
    """
    by_source = W.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(by_source) - 1) % len(weights)
    full = F.col("source_size") * most
    rows = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
            .withColumn("limit", full / F.col("weight")))
    order = W.orderBy("limit", F.col("source").isNull(), "source")
    left = F.lit(share) * F.sum("source_size").over(W.partitionBy()) - F.coalesce(
        F.sum(full).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    level = left / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("level", level).withColumn("open", F.col("level") < F.col("limit"))
    shared = F.max(F.when(F.col("open"), F.col("level"))).over(W.partitionBy())
    return rows.select("source", "source_size",
                       F.when(F.col("open"), shared * F.col("weight")).otherwise(full).alias("target"))


def small(df: DataFrame) -> DataFrame:
    """A stored table; sent to every task only where its rows are few."""
    df = stored(df, "mix")
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def thresholds(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """(src, source_size, target, whole, last): copies that every document of
    the source gets, and the hash up to which one more is taken (-1: none)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    state = small(wanted.select(F.col("source").alias("src"), "source_size", "target", whole.alias("whole"))
                  .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
                  .withColumn("prefix", F.lit(0).cast("long")).withColumn("below", F.lit(0).cast("long")))
    shift = sum(BITS)
    for bits in BITS:
        rows = sized.join(state.select("src", "prefix"), F.col("source").eqNullSafe(F.col("src")))
        inside = rows.filter(F.shiftright("h", shift) == F.col("prefix"))
        shift -= bits
        sums = inside.groupBy("src", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(W.partitionBy("src").orderBy("bucket"))
        ends = (sums.withColumn("upto", upto).withColumnRenamed("src", "s")
                .join(state.select("src", "budget", "below"), F.col("s").eqNullSafe(F.col("src")))
                .filter(F.col("below") + F.col("upto") > F.col("budget"))
                .groupBy("s").agg(F.min(F.struct("bucket", "upto", "words")).alias("e")))
        # A source without such a bucket has no words left to give: prefix -1 matches nothing.
        state = small(state.join(ends, F.col("src").eqNullSafe(F.col("s")), "left").select(
            "src", "source_size", "target", "whole", "budget", F.coalesce("e.bucket", F.lit(-1)).alias("prefix"),
            (F.col("below") + F.coalesce(F.col("e.upto") - F.col("e.words"), F.lit(0))).alias("below"),
            F.col("e.words").alias("words")))
    over, under = F.col("below") + F.col("words") - F.col("budget"), F.col("budget") - F.col("below")
    last = F.when((F.col("prefix") < 0) | (F.col("budget") <= 0), -1).when(over < under, F.col("prefix")).otherwise(F.col("prefix") - 1)
    return small(state.select("src", "source_size", "target", "whole", last.cast("long").alias("last")))


def copies(rows: DataFrame, found: DataFrame, h: Column) -> DataFrame:
    """``rows`` with the columns of ``found`` and ``copies``, a document's number."""
    joined = rows.join(found, rows["source"].eqNullSafe(found["src"]))
    return joined.withColumn("copies", F.col("whole") + (h <= F.col("last")).cast("int"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row."""
    sized = stored(sizes(docs), "mix-sizes")
    found = thresholds(sized, targets(sized, share, most, weights))
    return (copies(sized, found, F.col("h"))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mixed(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """``docs`` with every row as often as the mix takes it."""
    sized = stored(sizes(docs), "mix-sizes")
    found = thresholds(sized, targets(sized, share, most, weights))
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("source", F.col(names[docs.columns.index("source")]))
    taken = copies(rows, found, place(F.col(names[docs.columns.index("doc_id")])))
    return (taken.select(*names, F.explode(F.sequence(F.lit(1), "copies")).alias("turn"), "copies")
            .filter("copies > 0").select(*names).toDF(*docs.columns))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
            / CAST(sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM s),
t AS (
  SELECT source, source_size,
         CASE WHEN level < 2.0::DOUBLE * source_size / weight
              THEN max(CASE WHEN level < 2.0::DOUBLE * source_size / weight THEN level END) OVER () * weight
              ELSE 2.0::DOUBLE * source_size END AS target
  FROM l),
b AS (
  SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole FROM t),
c AS (
  SELECT source, h, CAST(sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS BIGINT) AS upto
  FROM d GROUP BY source, h),
e AS (
  SELECT b.source, any_value(b.target - b.whole * b.source_size) AS budget,
         min(CASE WHEN c.upto > b.target - b.whole * b.source_size THEN c.upto END) AS above,
         min(CASE WHEN c.upto > b.target - b.whole * b.source_size THEN c.h END) AS h_above,
         coalesce(max(CASE WHEN c.upto <= b.target - b.whole * b.source_size THEN c.upto END), 0) AS below
  FROM b JOIN c ON b.source IS NOT DISTINCT FROM c.source GROUP BY b.source),
f AS (
  SELECT source, CASE WHEN h_above IS NULL THEN -1 WHEN above - budget < budget - below THEN h_above
                      ELSE h_above - 1 END AS last
  FROM e)
SELECT d.doc_id, d.size, b.source_size, b.target,
       CAST(d.size * (b.whole + CASE WHEN d.h <= f.last THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN f ON d.source IS NOT DISTINCT FROM f.source
"""
