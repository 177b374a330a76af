"""Substring dedup with difference-cover anchors.

A window is ``window`` consecutive words of one document. A word is removed
when a window that covers it has the same words as a window that starts
earlier: in a smaller ``doc_id``, or further left in the same document.
Windows are judged on the input.

Anchors: positions whose remainder modulo a period lies in a difference cover
are hashed with the next ``window - period + 1`` words. For any two positions
some shift below the period makes both cover positions, so two equal windows
always share an aligned anchor, and only about a third of the positions need a
hash. A hash that occurs twice anywhere marks its anchors. Extension: only the
windows that contain a marked anchor are hashed as a whole (128 bits), and
equal windows are settled by their smallest document.

Hot passages: every block of rows sends an anchor hash at most once; what it
saw twice itself needs no partner and is sent as already marked, dealt at
random. So a hash held by a third of all rows reaches one task with a row for
each block, not for each document. Window owners are a minimum, which Spark
combines before the shuffle.

Defined results: null and empty texts have no words. Rows that repeat a
``doc_id`` are one document whose texts lie side by side: of equal windows those
that start furthest left stay, in each of these rows. A null ``doc_id`` comes
after all others, and all such rows are one document, so that its marks meet in
one group. Texts shorter than a window lose nothing. An empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import blocks, factorised, stored, text_bytes

# Difference covers, period to positions.
COVERS = {13: (0, 1, 3, 9), 7: (0, 1, 3), 3: (0, 1), 1: (0,)}
LAST = (1 << 63) - 1  # stands for a null doc_id
STEP = np.uint64(0x9E3779B97F4A7C15 & ~0x7 | 0x5)  # odd, 5 modulo 8: long powers stay distinct
MIX = np.uint64(0xFF51AFD7ED558CCD)


def cover(window: int) -> tuple[int, tuple[int, ...], int]:
    """Period, cover positions and anchor width for a window of words."""
    if window < 1:
        raise ValueError("a window holds at least one word")
    period = max(p for p in COVERS if p <= max(1, 2 * window // 3))
    return period, COVERS[period], window - period + 1


class Block:
    """Words of some texts as hashes, with each word's place in its text."""

    def __init__(self, texts: list[bytes]):
        from xxhash import xxh3_128_digest

        self.words = [t.split() for t in texts]
        codes, distinct, self.bounds = factorised(self.words)
        self.sizes = np.diff(self.bounds)
        pairs = np.frombuffer(b"".join(map(xxh3_128_digest, distinct)), np.uint64).reshape(-1, 2)
        self.row = np.repeat(np.arange(len(texts)), self.sizes)
        self.at = np.arange(len(codes)) - self.bounds[self.row]
        powers = np.full(len(codes) + 1, STEP, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        inverse = np.full(len(codes) + 1, pow(int(STEP), -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.inverse = np.multiply.accumulate(inverse)
        self.sums = []
        for side in (0, 1):
            total = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(pairs[codes, side] * powers[:-1], out=total[1:])
            self.sums.append(total)

    def hashes(self, starts: np.ndarray, width: int, side: int = 0) -> np.ndarray:
        """Hash of ``width`` words from each start; equal words, equal hash."""
        h = (self.sums[side][starts + width] - self.sums[side][starts]) * self.inverse[starts]
        h = (h ^ (h >> np.uint64(33))) * MIX
        return (h ^ (h >> np.uint64(29))).view(np.int64)

    def starts(self, width: int) -> np.ndarray:
        return np.flatnonzero(self.at + width <= self.sizes[self.row])

    def candidates(self, marks: list[list[int] | None], window: int, width: int) -> np.ndarray:
        """Starts of windows that contain a marked anchor."""
        edge = np.zeros(len(self.row) + 1, np.int32)
        for r, found in enumerate(marks):
            if found is not None and len(found):
                i = np.asarray(found, np.int64)
                i = i[i < self.sizes[r]]
                np.add.at(edge, self.bounds[r] + np.maximum(i - (window - width), 0), 1)
                np.add.at(edge, self.bounds[r] + i + 1, -1)
        inside = np.cumsum(edge[:-1]) > 0
        starts = self.starts(window)
        return starts[inside[starts]]


def _anchor_rows(texts: list[bytes], ids: np.ndarray, window: int, rng) -> tuple[np.ndarray, ...]:
    """(hash, id, position, marked): each hash once, unless it is marked."""
    period, places, width = cover(window)
    block = Block(texts)
    starts = block.starts(width)
    starts = starts[np.isin(block.at[starts] % period, places)]
    h = block.hashes(starts, width)
    order = np.argsort(h, kind="stable")
    h, starts = h[order], starts[order]
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    again = np.zeros(len(h), bool)  # this hash occurs more than once here
    again[:-1] |= ~first[1:]
    again |= ~first
    h = np.where(first, h, rng.integers(-LAST, LAST, len(h)))
    return h, ids[block.row[starts]], block.at[starts].astype(np.int32), again


def marked_anchors(docs: DataFrame, window: int) -> DataFrame:
    """(doc, marks): positions of the anchors whose hash occurs twice."""

    def run(batches):
        rng = np.random.default_rng(1)  # only spreads rows that are already marked
        for rows, texts in blocks(batches, "_t"):
            ids = rows.column(0).to_numpy()
            h, doc, at, again = _anchor_rows(texts, ids, window, rng)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, doc, at, again)], ["h", "doc", "at", "again"])

    anchors = docs.select("doc", "_t").mapInArrow(run, "h long, doc long, at int, again boolean")
    shared = anchors.select("doc", "at", (F.col("again") | (F.expr("count(*) over (partition by h)") > 1)).alias("m"))
    return shared.filter("m").groupBy("doc").agg(F.collect_set("at").alias("marks"))


def _windows(block: Block, ids: np.ndarray, marks: list, window: int):
    """Candidate windows: start, two hashes, and whether the same document has
    the same window further left."""
    starts = block.candidates(marks, window, cover(window)[2])
    a, b = block.hashes(starts, window), block.hashes(starts, window, 1)
    doc = block.row[starts]
    order = np.lexsort((starts, b, a, doc))
    same = np.zeros(len(starts), bool)
    same[1:] = ((a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
                & (doc[order][1:] == doc[order][:-1]))
    later = np.zeros(len(starts), bool)
    later[order] = same
    return starts, a, b, later


def owned_windows(docs: DataFrame, marks: DataFrame, window: int) -> DataFrame:
    """(doc, owned): hashes of the candidate windows whose first document it is."""

    def run(batches):
        for rows, texts in blocks(batches, "_t"):
            block, ids = Block(texts), rows.column(0).to_numpy()
            starts, a, b, later = _windows(block, ids, rows.column(2).to_pylist(), window)
            doc = ids[block.row[starts]]
            yield pa.RecordBatch.from_arrays([pa.array(x[~later]) for x in (a, b, doc)], ["a", "b", "doc"])

    found = (docs.select("doc", "_t").join(marks, "doc")
             .mapInArrow(run, "a long, b long, doc long"))
    first = found.groupBy("a", "b").agg(F.min("doc").alias("doc"))
    return first.groupBy("doc").agg(F.collect_list("a").alias("owned"))


def first_places(docs: DataFrame, marks: DataFrame, repeated: DataFrame, window: int) -> DataFrame:
    """(doc, first_a, first_at): of documents of several rows, the candidate
    windows and where each first starts in any of the rows."""

    def run(batches):
        for rows, texts in blocks(batches, "_t"):
            block, ids = Block(texts), rows.column(0).to_numpy()
            starts, a, b, later = _windows(block, ids, rows.column(2).to_pylist(), window)
            at = block.at[starts].astype(np.int32)
            doc = ids[block.row[starts]]
            yield pa.RecordBatch.from_arrays([pa.array(x[~later]) for x in (a, b, at, doc)], ["a", "b", "at", "doc"])

    found = (docs.select("doc", "_t").join(repeated, "doc", "left_semi").join(marks, "doc")
             .mapInArrow(run, "a long, b long, at int, doc long"))
    first = found.groupBy("doc", "a", "b").agg(F.min("at").alias("at"))
    return first.groupBy("doc").agg(F.collect_list(F.struct("a", "at")).alias("f")).select(
        "doc", F.col("f.a").alias("first_a"), F.col("f.at").alias("first_at"))


def covered(block: Block, ids: np.ndarray, marks: list, owned: list, firsts: list, window: int) -> np.ndarray:
    """Which words of the block go; ``firsts`` holds (windows, places) of rows
    that share their document with others, else (None, None)."""
    starts, a, _, later = _windows(block, ids, marks, window)
    doc = block.row[starts]
    gone = later
    cuts = np.searchsorted(doc, np.arange(len(marks) + 1))
    for r, mine in enumerate(owned):
        part = slice(cuts[r], cuts[r + 1])
        if part.stop > part.start:
            gone[part] |= ~np.isin(a[part], np.asarray(mine if mine is not None else [], np.int64))
            if firsts[r][0]:
                known, place = (np.asarray(x, np.int64) for x in firsts[r])
                order = np.argsort(known)
                i = order[np.minimum(np.searchsorted(known, a[part], sorter=order), len(known) - 1)]
                gone[part] |= (known[i] == a[part]) & (block.at[starts[part]] > place[i])
    edge = np.zeros(len(block.row) + 1, np.int32)
    np.add.at(edge, starts[gone], 1)
    np.add.at(edge, starts[gone] + window, -1)
    return np.cumsum(edge[:-1]) > 0


def dedup(docs: DataFrame, window: int = 20) -> DataFrame:
    """Each row of ``docs`` with ``n_words``, ``n_removed`` and ``kept_words``:
    the words that stay, joined by one space."""
    name = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in name.items()],
                       F.coalesce(docs.doc_id.cast("long"), F.lit(LAST)).alias("doc"),
                       text_bytes("text").alias("_t"))
    marks = stored(marked_anchors(rows, window), "substring-marks")
    owned = stored(owned_windows(rows, marks, window), "substring-owned")
    found = marks.join(owned, "doc", "left")
    repeated = stored(rows.groupBy("doc").count().filter("count > 1").select("doc"), "substring-repeated")
    if repeated.isEmpty():
        found = found.select("*", F.lit(None).cast("array<bigint>").alias("first_a"),
                             F.lit(None).cast("array<int>").alias("first_at"))
    else:
        found = found.join(stored(first_places(rows, marks, repeated, window), "substring-firsts"), "doc", "left")

    def run(batches):
        for part, texts in blocks(batches, "_t"):
            block = Block(texts)
            columns = {f.name: part.column(i) for i, f in enumerate(part.schema)}
            gone = covered(block, columns["doc"].to_numpy(), columns["marks"].to_pylist(),
                           columns["owned"].to_pylist(),
                           list(zip(columns["first_a"].to_pylist(), columns["first_at"].to_pylist())), window)
            lost = np.add.reduceat(np.append(gone, False), np.minimum(block.bounds[:-1], len(gone)), dtype=np.int64)
            lost[block.sizes == 0] = 0
            kept = [b" ".join(words if not n else [w for w, g in zip(words, gone[a:b].tolist()) if not g])
                    for words, n, a, b in zip(block.words, lost.tolist(), block.bounds, block.bounds[1:])]
            out = [columns[n] for n in name.values()] + [
                pa.array(block.sizes.astype(np.int64)), pa.array(lost), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, [*name.values(), "n_words", "n_removed", "kept_words"])

    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in name.items())
    joined = rows.join(found, "doc", "left").select(
        *name.values(), "doc", "_t", "marks", "owned", "first_a", "first_at")
    found = joined.mapInArrow(run, f"{schema}, n_words long, n_removed long, kept_words binary")
    return found.select(*[F.col(n).alias(c) for c, n in name.items()],
                        *[F.col(c).alias(c) for c in ("n_words", "n_removed")],
                        F.col("kept_words").cast("string").alias("kept_words"))


def without_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """``docs`` with the removed words cut from ``text`` and ``n_chars`` to
    match; untouched texts stay as they are, texts that lose all words go."""
    found = dedup(docs, window).filter("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_words")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept_words")).otherwise(F.col("n_chars"))
    return found.select(*[{"text": text.alias("text"), "n_chars": chars.cast(t).alias("n_chars")}.get(c, F.col(c))
                          for c, t in docs.dtypes])


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS k,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
w AS (
  SELECT r, k, i, words[i:i + 19] AS win
  FROM (SELECT r, k, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20)),
e AS (SELECT r, i, (k, i) > min((k, i)) OVER (PARTITION BY win) AS again FROM w),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 20)) AS p FROM e WHERE again)),
kept AS (
  SELECT a.r, string_agg(a.word, ' ' ORDER BY a.p) AS words, count(*) AS n
  FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d) a
  LEFT JOIN gone g ON a.r = g.r AND a.p = g.p WHERE g.p IS NULL GROUP BY a.r)
SELECT doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(len(d.words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
