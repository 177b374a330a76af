"""Ranked lexical search by the Best Position Algorithm.

A term is a maximal run of ASCII letters and digits and of characters beyond
ASCII; only A-Z are lower-cased. A document's score for a query sums, over the
query's distinct terms, ``w * ((10**9 * tf) div (1000 * tf + 20 * m))``, where
``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and ``m = 50 + (50 n N) div L``:
N documents have terms, L terms in all, n of them in this document.

One pass over the texts keeps, for each document, its number of terms and the
frequencies of those terms that any query of the block asks for. What holds for
the whole corpus (N, L, df) is summed from that. Then the documents are searched
in shards, where they lie: a term's list orders a shard's documents by impact,
and a query opens its terms' lists together.

Access is by position: each list is read at the first place that has not been
seen yet, each document so found is looked up in all other lists, and every place
that a look-up meets counts as seen. A list's best position is the last of the
run of seen places at its head; no unseen document can score more than the sum of
the impacts at the best positions, and a query stops when that sum is strictly
below its k-th score. Places are read in batches that double, since a place read
beyond the stop only costs time.

At scale: nothing is shuffled but the at most ``k`` rows that a shard returns for
a query. Queries travel in blocks of at most ``QUERY_BYTES`` bytes of text, each
of which is one search over all documents.

Defined results: null texts have no terms; documents without a term of the query
are not returned, nor are those whose score is 0. Equal scores are in order of the
document's key, null keys last. Rows that repeat a key are candidates each. Query
rows that repeat key and text are one query, others that share a key are queries
each. No limit holds on the length of a text. An empty table on either side gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.words import blocks, stored, text_bytes

QUERY_BYTES = 16 << 20  # text of the queries that travel together
SHARD = 1 << 13  # documents of a shard
CELLS = 1 << 24  # at most so many (list, document) places at once; a shard is smaller for very long queries
FIRST = 8  # places of each list in the first batch
# Every byte that is no part of a term becomes a blank, A-Z become a-z.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _query_blocks(queries: DataFrame, limit: int) -> tuple[int, DataFrame]:
    """How many blocks there are, and the queries with their block."""
    bound = queries.agg(F.sum(F.length("t")), F.count(F.lit(1))).first()
    n = max(1, math.ceil((bound[0] or 0) / limit), math.ceil((bound[1] or 0) * 64 / limit))
    return n, queries.withColumn("block", F.expr(f"cast(number % {n} as int)"))


def _frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(key, n, ids, tf): the asked-for terms of each document that has terms."""
    size = max(1, len(vocabulary))

    def run(batches):
        for rows, texts in blocks(batches, "t"):
            found = [terms(t) for t in texts]
            n = np.array([len(x) for x in found], np.int64)
            ids = [np.fromiter(map(vocabulary.get, x, repeat(-1)), np.int64, len(x)) for x in found]
            both = np.concatenate(ids) + np.repeat(np.arange(len(texts)) * size, n)
            both, tf = np.unique(both[np.concatenate(ids) >= 0], return_counts=True)
            cuts = np.searchsorted(both, np.arange(len(texts) + 1) * size).astype(np.int32)
            at = pa.array(cuts)
            batch = pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n), pa.ListArray.from_arrays(at, pa.array((both % size).astype(np.int32))),
                 pa.ListArray.from_arrays(at, pa.array(tf.astype(np.int64)))], ["key", "n", "ids", "tf"])
            yield batch.filter(pa.array(n > 0))

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, n long, ids array<int>, tf array<long>")


class Lists:
    """A shard's documents by impact, for each term that occurs in it."""

    def __init__(self, docs: np.ndarray, ids: np.ndarray, impacts: np.ndarray):
        order = np.lexsort((docs, -impacts, ids))
        self.docs, self.impacts = docs[order], impacts[order]
        self.terms, first = np.unique(ids[order], return_index=True)
        self.bounds = np.append(first, len(ids))

    def of(self, wanted: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(documents, impacts) of those of the terms that occur."""
        at = np.intersect1d(self.terms, wanted, assume_unique=True, return_indices=True)[1]
        return [(self.docs[self.bounds[i]:self.bounds[i + 1]], self.impacts[self.bounds[i]:self.bounds[i + 1]])
                for i in at.tolist()]


def best(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, places read) of all that may be among the k best."""
    width = max((len(d) for d, _ in lists), default=0)
    place = np.full((len(lists), documents), -1, np.int32)  # of a document in a list
    value = np.zeros((len(lists), width + 1), np.int64)  # impacts by place; 0 behind a list's end
    seen = np.zeros((len(lists), width + 1), bool)
    for i, (d, x) in enumerate(lists):
        place[i, d] = np.arange(len(d))
        value[i, :len(d)] = x
        seen[i, len(d):width] = True
    scores = np.full(documents, -1, np.int64)
    position = np.zeros(len(lists), np.int64)  # places at the head of a list that are all seen
    step, read, kth = FIRST, 0, 0
    while True:
        bound = int(value[np.arange(len(lists)), np.maximum(position - 1, 0)].sum()) if position.all() else None
        if not len(lists) or (position >= width).all() or (bound is not None and kth and bound < kth):
            break
        fresh = []
        for i, (d, _) in enumerate(lists):  # the next unseen places of each list
            a = int(position[i])
            unseen = a + np.flatnonzero(~seen[i, a:min(a + step, len(d))])
            fresh.append(d[unseen])
        new = np.unique(np.concatenate(fresh))
        read += sum(map(len, fresh))
        found = place[:, new]  # direct access to every list
        scores[new] = np.take_along_axis(value, found.astype(np.int64), 1).sum(axis=0)  # place -1 has impact 0
        rows, which = np.nonzero(found >= 0)
        seen[rows, found[rows, which]] = True
        position = np.argmin(seen, axis=1)  # the place behind the run of seen ones
        full = scores[scores >= 0]
        kth = int(np.partition(full, len(full) - k)[len(full) - k]) if len(full) >= k else 0
        step *= 2
    kept = np.flatnonzero(scores > max(0, kth - 1))
    return kept, scores[kept], read


def _search_block(docs: DataFrame, asked: list, k: int, shard: int) -> DataFrame:
    """(number, key, score): at most k rows of each shard for each query."""
    vocabulary: dict[bytes, int] = {}
    wanted = [(r.number, np.array(sorted({vocabulary.setdefault(x, len(vocabulary)) for x in terms(bytes(r.t))}), np.int32))
              for r in asked]
    found = stored(_frequencies(docs, vocabulary), "ranked-frequencies")
    total = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    documents, length = int(total[0]), int(total[1] or 0)
    df = found.select(F.explode("ids").alias("id")).groupBy("id").count().collect()  # a row for each term asked for
    most = max((len(x) for _, x in wanted), default=1)
    shard = max(64, min(shard, CELLS // max(1, most)))
    weights = np.zeros(max(1, len(vocabulary)), np.int64)
    for r in df:
        weights[r["id"]] = weight(documents, r["count"])

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, shard):
                part = batch.slice(a, shard)
                n = part.column(1).to_numpy()
                ids, tf = (part.column(i).flatten().to_numpy() for i in (2, 3))
                sizes = pa.compute.list_value_length(part.column(2)).to_numpy()
                whole = n.max() < (1 << 62) // (50 * documents)
                m = 50 + (50 * n * documents // length if whole else
                          np.array([50 * int(x) * documents // length for x in n], np.int64))
                row = np.repeat(np.arange(part.num_rows), sizes)
                impacts = weights[ids] * (10**9 * tf // (1000 * tf + 20 * m[row]))
                lists = Lists(row, ids, impacts)
                keys = part.column(0)
                order = pa.compute.array_sort_indices(keys, null_placement="at_end").to_numpy()
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                out = []
                for number, terms_ in wanted:
                    mine, scores, _ = best(lists.of(terms_), part.num_rows, k)
                    by = np.lexsort((rank[mine], -scores))[:k]
                    out.append((np.full(len(by), number, np.int64), mine[by], scores[by]))
                if out:
                    numbers, rows, scores = (np.concatenate(x) for x in zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(numbers), keys.take(pa.array(rows)), pa.array(scores)],
                                                     ["number", "key", "score"])

    kind = docs.schema["key"].dataType.simpleString()
    return found.mapInArrow(run, f"number long, key {kind}, score long")


def search(docs: DataFrame, queries: DataFrame, k: int, key: str = "doc_id", text: str = "text",
           query_key: str = "item_id", query_text: str = "text", shard: int = SHARD,
           query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(<query_key>, rank, <key>, score): the ``k`` rows of ``docs`` with the
    highest score above 0 for each distinct row of ``queries``."""
    if k < 1:
        raise ValueError("at least one result")
    asked = queries.select(F.col(query_key).alias("key"), text_bytes(query_text).alias("t")).distinct()
    asked = stored(asked.withColumn("number", F.monotonically_increasing_id()), "ranked-queries")
    n, dealt = _query_blocks(asked, query_bytes)
    rows = docs.select(F.col(key).alias("key"), text_bytes(text).alias("t"))
    found = None
    for block in range(n):
        mine = dealt.filter(F.col("block") == block).select("number", "t").collect()  # at most about query_bytes
        part = _search_block(rows, mine, k, shard)
        found = part if found is None else found.union(part)
    order = W.partitionBy("number").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = asked.select("number", F.col("key").alias("asked"))
    return ranked.join(named, "number").select(F.col("asked").alias(query_key), "rank", F.col("key").alias(key), "score")


ORACLE = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(terms)) AS n_terms FROM t WHERE len(terms) > 0),
q AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))),
p AS (
  SELECT r, doc_id, 50 + (50 * CAST(n AS BIGINT) * CAST(n_docs AS BIGINT)) // CAST(n_terms AS BIGINT) AS m, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM t), s GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY term, n_docs),
scored AS (
  SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
"""
