"""Exact top-k search by inner product over an impact-ordered index.

Vectors are turned into integers, floor(``SCALE`` * x). The index holds, for
each shard of vectors, a posting for every component that isn't zero, in
segments by impact, the impact being a component's size quantised to powers of
two. Segments are processed score-at-a-time, by descending impact, for a block of
queries at once: a segment is a matrix of its postings, and its product with the
queries is added to the scores found so far.

After an impact level the rest of a vector is known by its length, so no score
can lie further from what was found than the product of that length and the
query's. A query stops on proof only: once the vectors whose upper bound reaches
its ``k``-th best lower bound are few, no other can be a member, and the
possible members are rescored exactly from the whole integer vectors. Queries
that are proven leave the block; whether any is, is first asked of a few of them.
A query that is never proven has all segments processed, and its possible members
rescored as well.

At scale: a shard is one stored index row, queries are cut into blocks, and
every block meets every shard once, where both are grouped by the shard's number
and a turn. A turn holds at most ``MEET`` blocks, so a group fits a task however
many queries there are; a shard travels once for each turn, and neither side is
ever a broadcast. Each pair returns at most ``k`` rows for a query.

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part. Vectors of different lengths are compared as if the
shorter ended in zeros. A row without an id takes no part. Rows that repeat an
id are candidates each, and none for queries of that id. Query rows that repeat
both id and vector are one query; other query rows that share an id are queries
each, every one with its own ranks from 1 to ``k`` under that id.
Scaled components and scores beyond a long are not defined.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.words import stored

SCALE = 64
SHARD = 1 << 13  # vectors of an index row
BLOCK = 256  # queries scored at once
MEET = 32  # blocks that meet a shard in one group
FEW = 16  # times k: so many possible members are rescored rather than narrowed
PROBES = 16  # queries of a block that are asked first whether they are proven
EXACT = 1 << 23  # products of lengths below which single precision holds every sum


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): ids and scaled integer components of the rows that take part."""
    odd = f"exists({vector}, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    scaled = f"transform({vector}, x -> floor(double(x) * {SCALE}))"
    return (rows.select(F.col(key).alias("id"), F.col(vector).alias("_v"))
            .filter(F.expr(f"id is not null and size(_v) > 0 and not {odd.replace(vector, '_v')}"))
            .select("id", F.expr(scaled.replace(vector, "_v")).alias("v")))


def _matrix(vectors: list, width: int | None = None) -> np.ndarray:
    sizes = np.array([len(v) for v in vectors])
    out = np.zeros((len(vectors), width or int(sizes.max())), np.int64)
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        out[rows, :min(n, out.shape[1])] = np.array([vectors[i] for i in rows], np.int64)[:, :out.shape[1]]
    return out


def _packed(m: np.ndarray) -> tuple[bytes, str]:
    """The matrix as bytes of the narrowest integers that hold it, and their kind."""
    low, high = int(m.min(initial=0)), int(m.max(initial=0))
    kind = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return m.astype(kind).tobytes(), kind


def index(vectors: DataFrame, shards: int, spread: int) -> DataFrame:
    """(shard, turn, ids, m, dims, kind): one row for each shard, ``spread`` times."""

    def build(keys, table):
        m = _matrix(table["v"].to_pylist())
        order = np.argsort(table["id"].to_numpy(), kind="stable")
        packed, kind = _packed(m[order])
        return pa.table({"shard": [keys[0].as_py()], "ids": [table["id"].to_numpy()[order].tobytes()],
                         "m": [packed], "dims": [m.shape[1]], "kind": [kind]},
                        schema=pa.schema([("shard", pa.int32()), ("ids", pa.binary()), ("m", pa.binary()),
                                          ("dims", pa.int32()), ("kind", pa.string())]))

    # rows that repeat an id are spread as well
    deal = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    rows = vectors.withColumn("shard", deal).groupBy("shard").applyInArrow(
        build, "shard int, ids binary, m binary, dims int, kind string")
    rows = stored(rows, "vector-index")
    return rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("turn"))


def query_blocks(queries: DataFrame, blocks: int, shards: int, spread: int) -> DataFrame:
    """(shard, turn, block, numbers, qids, q, qdims, qkind): every block once for each shard."""

    def pack(keys, table):
        m = _matrix(table["v"].to_pylist())
        packed, kind = _packed(m)
        return pa.table({"block": [keys[0].as_py()], "numbers": [table["number"].to_numpy().tobytes()],
                         "qids": [table["id"].to_numpy().tobytes()], "q": [packed], "qdims": [m.shape[1]],
                         "qkind": [kind]},
                        schema=pa.schema([("block", pa.int32()), ("numbers", pa.binary()), ("qids", pa.binary()),
                                          ("q", pa.binary()), ("qdims", pa.int32()), ("qkind", pa.string())]))

    deal = F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int")
    rows = queries.withColumn("block", deal).groupBy("block").applyInArrow(
        pack, "block int, numbers binary, qids binary, q binary, qdims int, qkind string")
    rows = stored(rows, "vector-queries")
    return rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                       F.expr(f"block % {spread}").alias("turn"))


class Shard:
    """Postings of a shard's vectors, in segments of descending impact."""

    def __init__(self, ids: np.ndarray, m: np.ndarray):
        self.ids, self.m = ids, m.astype(np.int64)
        size = np.abs(self.m)
        self.segments = []  # of a level: dimensions that have postings, their components, lengths of the rest
        rest = size.astype(np.float64) ** 2
        self.length = np.sqrt(rest.sum(axis=1))
        top = int(size.max(initial=0)).bit_length()
        single = self.length.max(initial=0) < EXACT
        for bits in range(top, 0, -1):
            inside = (size >= 1 << bits - 1) & (size < 1 << bits)
            dims = np.flatnonzero(inside.any(axis=0))
            part = np.where(inside[:, dims], self.m[:, dims], 0).T.astype(np.float32 if single else np.float64)
            rest[inside] = 0
            self.segments.append((dims, np.ascontiguousarray(part), np.sqrt(rest.sum(axis=1))))
        self.read = 0  # segments of the last search

    def top(self, qids: np.ndarray, q: np.ndarray, k: int):
        """(query's place, vector, score): the k best of this shard for each query."""
        n, width = self.m.shape
        whole = np.zeros((len(q), width), np.int64)
        whole[:, :min(width, q.shape[1])] = q[:, :width]
        length = np.sqrt((whole.astype(np.float64) ** 2).sum(axis=1))
        # Sums of integers are exact below 2**24 in single and 2**53 in double precision; beyond the latter each
        # of a score's additions and products may round by 2**-53 of at most the lengths' product.
        kind = np.float32 if self.length.max(initial=0) * length.max(initial=0) < EXACT else np.float64
        first, last = np.searchsorted(self.ids, qids, "left"), np.searchsorted(self.ids, qids, "right")
        left = np.arange(len(q))  # queries that are not proven
        scores = np.zeros((len(q), n), kind)
        for i in range(len(q)):
            scores[i, first[i]:last[i]] = -np.inf  # never a candidate of its own
        found, self.read = [], 0
        for level, (dims, part, rest) in enumerate(self.segments):
            scores += whole[left][:, dims].astype(kind) @ part.astype(kind, copy=False)
            self.read = level + 1
            # lengths, their products and a score's distance are rounded up
            reach = (rest * (1 + 1e-6) + (2 * width + 4) * 2.0**-53 * self.length).astype(kind)
            wide = (length[left] * (1 + 1e-6)).astype(kind)
            done = np.zeros(len(left), bool)
            if level + 1 < len(self.segments):
                some = self._possible(scores[:PROBES], wide[:PROBES, None] * reach + 2, k)
                if not (some.sum(axis=1) <= FEW * k).any():
                    continue
            possible = self._possible(scores, wide[:, None] * reach + 2, k)
            done = (possible.sum(axis=1) <= FEW * k) | (level + 1 == len(self.segments))
            found += [self._exact(left[done], possible[done], whole, k)]
            left, scores = left[~done], scores[~done]
            if not len(left):
                break
        if len(left):  # there is no posting at all
            found += [self._exact(left, scores > -np.inf, whole, k)]
        return tuple(np.concatenate(x) for x in zip(*found))

    def _exact(self, queries: np.ndarray, possible: np.ndarray, whole: np.ndarray, k: int):
        """The k best of the possible vectors of each query, by whole vectors."""
        query, vector = np.nonzero(possible)
        exact = np.empty(len(vector), np.int64)
        for a in range(0, len(vector), 1 << 16):
            b = a + (1 << 16)
            exact[a:b] = np.einsum("ij,ij->i", self.m[vector[a:b]], whole[queries[query[a:b]]])
        by = np.lexsort((self.ids[vector], -exact, query))
        vector, query, exact = vector[by], query[by], exact[by]
        kept = np.arange(len(query)) - np.searchsorted(query, query) < k
        return queries[query[kept]], self.ids[vector[kept]], exact[kept]

    @staticmethod
    def _possible(scores: np.ndarray, slack: np.ndarray, k: int) -> np.ndarray:
        """Pairs that may be among a query's k best by what is proven so far."""
        if scores.shape[1] <= k or not len(scores):
            return scores > -np.inf
        at = scores.shape[1] - k
        bound = np.partition(scores - slack, at, axis=1)[:, at]
        return (scores + slack >= bound[:, None]) & (scores > -np.inf)


def search(rows: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding",
           shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, <key>, score): the k candidates of ``rows`` with the
    highest integer inner product for each distinct row of ``queries``, ties to
    the smaller id."""
    wanted = usable(queries.select(key, vector).distinct(), key, vector)
    wanted = wanted.withColumn("number", F.monotonically_increasing_id())
    wanted = stored(wanted, "vector-wanted")
    kept = usable(rows, key, vector)
    shards = max(1, math.ceil(kept.count() / shard))
    blocks = max(1, math.ceil(wanted.count() / block))
    spread = min(blocks, max(1, math.ceil(32 / shards), math.ceil(blocks / MEET)))
    left = query_blocks(wanted, blocks, shards, spread)
    right = index(kept, shards, spread)

    def run(left, right):
        made = [pa.table({"number": [], "query_id": [], "id": [], "score": []}, schema=names)]
        for r in right.to_pylist():
            ids = np.frombuffer(r["ids"], np.int64)
            found = Shard(ids, np.frombuffer(r["m"], r["kind"]).reshape(len(ids), r["dims"]))
            for b in left.to_pylist():
                numbers, qids = np.frombuffer(b["numbers"], np.int64), np.frombuffer(b["qids"], np.int64)
                q = np.frombuffer(b["q"], b["qkind"]).reshape(len(qids), b["qdims"]).astype(np.int64)
                for a in range(0, len(qids), BLOCK):
                    query, *best = found.top(qids[a:a + BLOCK], q[a:a + BLOCK], k)
                    best = [numbers[a + query], qids[a + query], *best]
                    made.append(pa.table([pa.array(x) for x in best], schema=names))
        return pa.concat_tables(made)

    names = pa.schema([(x, pa.int64()) for x in ("number", "query_id", "id", "score")])
    # A task for each group: the work is in the products, not in the bytes that
    # adaptive execution would merge tasks by.
    tasks = max(shards * spread, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    left, right = (x.repartition(tasks, "shard", "turn").groupBy("shard", "turn") for x in (left, right))
    best = left.cogroup(right).applyInArrow(run, "number long, query_id long, id long, score long")
    order = W.partitionBy("number").orderBy(F.desc("score"), "id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(key), "score"))
