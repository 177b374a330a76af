"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has bit *b* set when more than half of its shingle hashes
(XXH64, seed 42) have it set. Two fingerprints are linked when they differ in
at most two bits; a component is a set connected by links.

Candidates: a fingerprint is cut into two 32-bit segments. With at most two
differing bits, one segment differs in at most one. Each segment is indexed
under its 32 one-wildcard variants (one position blanked), and segments that
differ in at most one bit share a variant. Equality joins on the variants give
candidate pairs, which the full distance then verifies.

Hot variants: exact copies share a fingerprint, so only distinct fingerprints
are indexed. Where more than ``hot`` of them still share a variant, pairs
would grow with the square of the group. The fingerprints of such groups are
linked by whole-fingerprint variants instead: within two bits of each other
means that the sets of fingerprints within one bit of each meet. Every member
of a shared neighbour is within two bits of the smallest member, so one verified
link to that member keeps the component whole; links stay linear in the rows.
``hot`` therefore changes the plan, never the components.

Defined results: a null or empty text has fingerprint zero and is linked like
any other. Repeated rows each get a row. A null id takes part in links but is
no candidate for the component id, which is null only where every id of the
component is null. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import blocks, stored, text_bytes

SEED = 42
HOT = 24


def shingle_hashes(text: bytes, width: int) -> list[int]:
    """Unsigned XXH64 of each word shingle; of the whole sequence where it is
    shorter than ``width``; none for a text without words."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    return [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[width - 1:] - 1).tolist())]


def majority(hashes: list[list[int]]) -> np.ndarray:
    """One 64-bit fingerprint for each list of hashes."""
    out = np.zeros(len(hashes), np.uint64)
    full = [i for i, h in enumerate(hashes) if h]
    if full:
        sizes = np.array([len(hashes[i]) for i in full])
        flat = np.fromiter((x for i in full for x in hashes[i]), "<u8", int(sizes.sum()))
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int64)
        packed = np.packbits(2 * sums > sizes[:, None], axis=1, bitorder="little")
        out[full] = packed.view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): the fingerprint of each row's whole text as a signed long."""

    def run(batches):
        for rows, texts in blocks(batches, "_t", 1 << 20):
            fp = majority([shingle_hashes(t, width) for t in texts]).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fp)], ["k", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("k"), text_bytes(text).alias("_t"))
            .mapInArrow(run, f"k {kind}, fp long").select(F.col("k").alias(key), "fp"))


def links(distinct: DataFrame, max_bits: int = 2, hot: int = HOT) -> DataFrame:
    """(a, b), a < b: verified links that connect what is within ``max_bits``
    (0 to 2) bits; all of them outside hot variants, a spanning set inside."""
    if not 0 <= max_bits <= 2:
        raise ValueError("two segments with one wildcard each find at most two differing bits")
    n = F.col("n")
    segment = F.when(n < 32, F.col("fp").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("fp", 32))
    at = F.expr("cast(n % 32 as int)")
    kept = segment.bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, cast(n % 32 as int))")))
    variant = kept.bitwiseOR(F.expr("shiftleft(cast(n as long), 32)"))
    own = F.expr("shiftrightunsigned(case when n < 32 then fp else shiftrightunsigned(fp, 32) end, "
                 "cast(n % 32 as int)) & 1")
    # Few bytes become 64 rows each: dealt in turn first, so that the tasks are as
    # many as the rows that follow need, not as the bytes before would get.
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = (distinct.repartition(tasks).select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("n"))
                .select("fp", variant.alias("variant"), own.cast("byte").alias("bit"),
                        (at == 0).alias("first")))
    sizes = (variants.groupBy("variant").agg(F.count("*").alias("members"))
             .filter("members > 1"))
    # Spark sizes what is exploded by the bytes before, far too low: no side of a join
    # on variants or neighbours is ever a broadcast.
    shared = stored(variants.join(sizes.hint("merge"), "variant"), "simhash-variants")

    cold = shared.filter(F.col("members") <= hot)
    x, y = cold.alias("x"), cold.alias("y")
    # Equal segments share all 32 variants; only the first of them pairs up.
    pairs = (x.join(y.hint("merge"), (F.col("x.variant") == F.col("y.variant")) & (F.col("x.fp") < F.col("y.fp"))
                    & ((F.col("x.bit") != F.col("y.bit")) | F.col("x.first"))
                    & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits))
             .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")))

    around = (shared.filter(F.col("members") > hot).select("fp").distinct()
              .select("fp", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("n"))
              .select("fp", F.when(n < 0, F.col("fp")).otherwise(
                  F.col("fp").bitwiseXOR(F.expr("shiftleft(1L, greatest(n, 0))"))).alias("near")))
    smallest = around.groupBy("near").agg(F.min("fp").alias("a"))
    spokes = (around.join(smallest.hint("merge"), "near")
              .filter((F.col("a") < F.col("fp")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= max_bits))
              .select("a", F.col("fp").alias("b")))
    if max_bits < 2:  # the smallest neighbour may be two bits away: take links of one bit
        near = around.filter("near != fp").alias("n")
        spokes = (near.join(distinct.alias("d").hint("merge"), F.col("n.near") == F.col("d.fp"))
                  .select(F.least("n.fp", "d.fp").alias("a"), F.greatest("n.fp", "d.fp").alias("b"))
                  if max_bits else spokes.limit(0))
    return pairs.union(spokes).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for nodes with edges.

    Alternating large-star and small-star rounds: every round replaces edges
    by as many that point to smaller nodes, until each component is one star.
    Each round is a written table, so a lost executor costs one round.
    """
    edges = stored(edges.select("a", "b"), "components")
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # after large-star every edge points from larger a to smaller b
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        edges = stored(small, "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def components(docs: DataFrame, width: int = 3, max_bits: int = 2, hot: int = HOT,
               key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component_id) for every row of ``docs``; ``component_id`` is
    the smallest key of the row's component."""
    prints = stored(fingerprints(docs, width, key, text), "simhash-prints")
    distinct = stored(prints.groupBy("fp").agg(F.min(key).alias("least")), "simhash-distinct")
    roots = connected(links(distinct.select("fp"), max_bits, hot))
    named = (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return (prints.join(named.join(ids, "root").select("fp", "component_id"), "fp")
            .select(key, "fp", "component_id"))


def keep_one(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """The row of the smallest ``doc_id`` of each component, all columns.

    Rows that repeat that id are all kept; rows without an id, which no
    component names, stay.
    """
    chosen = (components(docs, width, max_bits).filter("doc_id = component_id")
              .select(F.col("doc_id").alias("_kept")).distinct())
    kept = docs.join(chosen, F.col("doc_id") == F.col("_kept"), "left_semi")
    return kept.union(docs.filter("doc_id is null"))
