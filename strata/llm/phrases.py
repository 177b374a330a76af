"""Collocations by Rabin-Karp fingerprints.

Texts are cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at
spaces and tabs; only A-Z are lower-cased. A phrase is two to ``longest``
consecutive words of a piece. Everything is counted by language.

Texts are first coded: a row of the stored table ``blocks`` holds the words of
some megabytes of text once and the texts as numbers of those words. Prefix sums
of word hashes times powers of a base then give the fingerprint of every n-gram
of a block in a few numpy operations. A block sends each fingerprint once, with
how often it occurs, as an entry of its table; the shuffle adds them up. What
reaches ``least`` in all goes back to every block that has it, as a pointer to its
entry there.

Fingerprints only nominate. A block turns its marked pointers back into words,
counts every nominated phrase by its word numbers, which no collision can
confuse, and sends phrase and count; the phrases whose counts reach ``least`` are
the frequent ones. A collision can only nominate a phrase too many, since the sum
of a fingerprint is never below the count of any phrase that has it.

Words and pairs come first. A longer n-gram can only be frequent where all the
pairs in it are, so only those positions get a fingerprint in the second round.

The score of a phrase is that of its worst cut into two parts, ``2000000 * a``
over the sum of the parts' counts, rounded down; a phrase goes when a longer
frequent phrase holds it and has 80 % of its count or more.

At scale: entries travel in slices, a block's share of a range of fingerprints
being one row of five bytes a fingerprint and a count; slices are as many as keep
about ``SLICE`` entries each, and hashing deals them evenly whatever is frequent.
A fingerprint that is found everywhere is one entry of each block, and so is a
phrase in the last count. Pointers return to blocks, never to single rows. Ranks
need at most ``most`` rows of a language from each task.

Defined results: a null text is empty; a null language is ``und``. Repeated rows
count each. A text longer than a block is a block of its own. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.words import blocks, factorised, stored, text_bytes

UNKNOWN = "und"
BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX = np.uint64(0xFF51AFD7ED558CCD)
# A-Z become a-z, every byte that ends a piece a line end.
TABLE = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
SCALE = 2_000_000
SLICE = 1 << 22  # entries that are added up together, about
LEAST_SLICES = 64
BLOCK = 3 << 20  # bytes of text that are coded together; a longer text is a block of its own
TASKS = 1 << 15  # at most so many tasks for the blocks
WIDTH = 5  # bytes of a fingerprint in a slice, besides the bits that name the slice


def pieces(text: bytes) -> list[list[bytes]]:
    """Words of the pieces that have any."""
    return [w for w in map(bytes.split, text.translate(TABLE).split(b"\n")) if w]


def coded(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(block, langs, words, codes, ends, spoken): texts as numbers of words;
    a piece ends where ``ends`` says and has the language ``langs[spoken]``."""

    def run(batches):
        for rows, texts in blocks(batches, "t", BLOCK):
            langs, names = rows.column(0).dictionary_encode(), None
            names = langs.dictionary.to_pylist()
            cut = [pieces(t) for t in texts]
            flat = list(chain.from_iterable(cut))
            codes, words, bounds = factorised(flat)
            spoken = np.repeat(langs.indices.to_numpy(), [len(x) for x in cut])
            yield pa.RecordBatch.from_arrays([
                pa.array([names], pa.list_(pa.string())), pa.array([b"\n".join(words.tolist())], pa.binary()),
                pa.array([codes.astype("<i4").tobytes()], pa.binary()),
                pa.array([bounds[1:].astype("<i4").tobytes()], pa.binary()),
                pa.array([spoken.astype("<i4").tobytes()], pa.binary())], ["langs", "words", "codes", "ends", "spoken"])

    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), text_bytes(text).alias("t"))
    made = rows.mapInArrow(run, "langs array<string>, words binary, codes binary, ends binary, spoken binary")
    return stored(made.withColumn("block", F.monotonically_increasing_id()), "phrase-blocks")


class Block:
    """One row of ``coded``, with the fingerprints of its n-grams."""

    def __init__(self, langs: list[str], words: bytes, codes: bytes, ends: bytes, spoken: bytes, bits: int = 64):
        from xxhash import xxh3_64_intdigest

        self.langs, self.drop = langs, np.uint64(64 - bits)
        self.codes = np.frombuffer(codes, "<i4")
        self.words = words.split(b"\n") if len(self.codes) else []
        ends = np.frombuffer(ends, "<i4")
        sizes = np.diff(ends, prepend=0)
        self.end = np.repeat(ends, sizes)
        self.lang = np.repeat(np.frombuffer(spoken, "<i4"), sizes)
        n = len(self.codes)
        hashes = np.fromiter(map(xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        self.salt = np.array([xxh3_64_intdigest(x.encode()) for x in langs], np.uint64)
        powers = np.full(n + 1, BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.multiply(hashes[self.codes], powers[:-1], out=self.sums[1:])
        np.cumsum(self.sums, out=self.sums)
        self.back = powers  # its place is taken by the inverse powers
        self.back[0], self.back[1:] = 1, BACK
        np.multiply.accumulate(self.back, out=self.back)

    def starts(self, n: int) -> np.ndarray:
        """Where n words of one piece begin."""
        return np.flatnonzero(np.arange(n, len(self.codes) + n, dtype=np.int32) <= self.end).astype(np.int32)

    def prints(self, starts: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the n-grams of their language at these places."""
        h = self.sums[starts + n]
        h -= self.sums[starts]
        h *= self.back[starts]
        h += self.salt[self.lang[starts]]
        h += np.uint64(n)
        h *= MIX
        h ^= h >> np.uint64(31)
        return h >> self.drop << self.drop if self.drop else h

    def entries(self, places: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct fingerprints in order, and how often each occurs."""
        return np.unique(np.concatenate([self.prints(starts, n) for n, starts in places]), return_counts=True)

    def pointed(self, marked: np.ndarray, n: int, starts: np.ndarray) -> np.ndarray:
        """Those of the places whose fingerprint is marked; ``marked`` in order."""
        if not len(marked):
            return starts[:0]
        h = self.prints(starts, n)
        return starts[marked[np.minimum(np.searchsorted(marked, h), len(marked) - 1)] == h]

    def marked(self, r: dict) -> np.ndarray:
        """The fingerprints that the first round's pointers name, in order."""
        return self.entries(self.short())[0][np.sort(_entries(r["short"]))]

    def short(self) -> list[tuple[int, np.ndarray]]:
        return [(n, self.starts(n)) for n in (1, 2)]

    def longer(self, marked: np.ndarray, sizes) -> list[tuple[int, np.ndarray]]:
        """Where so many words begin whose pairs are all marked."""
        pair = np.zeros(len(self.codes) + 8, bool)
        pair[self.pointed(marked, 2, self.starts(2))] = True
        out = []
        for n in sizes:
            starts = self.starts(n)
            for i in range(n - 1):
                starts = starts[pair[starts + i]]
            out.append((n, starts))
        return out

    def counted(self, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """One place of each distinct n-gram by words and language, and how
        often it occurs at the places given."""
        name = self.lang[starts].astype(np.int64)
        for i in range(n):  # pairs of numbers become numbers
            name = np.unique(name << 32 | self.codes[starts + i], return_inverse=True)[1]
        _, first, count = np.unique(name, return_index=True, return_counts=True)
        return starts[first], count

    def spelled(self, starts: np.ndarray, n: int) -> list[bytes]:
        parts = [[self.words[c] for c in self.codes[starts + i].tolist()] for i in range(n)]
        return list(map(b" ".join, zip(*parts)))


FIELDS = ("langs", "words", "codes", "ends", "spoken")


def _each(batches, bits: int):
    """(row, block) of every row of ``coded`` in the batches."""
    for batch in batches:
        for i in range(batch.num_rows):
            r = {f: batch.column(f)[i].as_py() for f in batch.schema.names}
            yield r, Block(*[r[f] for f in FIELDS], bits)


def _entries(pointers) -> np.ndarray:
    return np.frombuffer(b"".join(pointers or []), "<i4")


def _places(block: Block, r: dict, sizes) -> list[tuple[int, np.ndarray]]:
    """The places whose n-grams a round looks at: all words and pairs in the
    first, what the first round's pointers allow in the second."""
    if "short" not in r:
        return block.short()
    return block.longer(block.marked(r), sizes)


def nominated(texts: DataFrame, sizes: tuple[int, ...], least: int, slices: int, bits: int, name: str) -> DataFrame:
    """(block, <name>): pointers to the entries of a block whose fingerprint
    reaches ``least`` over all blocks."""
    shift = np.uint64(slices.bit_length() - 1)
    small = np.dtype("<u1" if least < 1 << 8 else "<u2" if least < 1 << 16 else "<i8")
    kinds = pa.schema([("slice", pa.int32()), ("block", pa.int64()), ("base", pa.int32()), ("prints", pa.binary()),
                       ("counts", pa.binary())])

    def send(batches):
        for r, block in _each(batches, bits):
            h, count = block.entries(_places(block, r, sizes))
            cuts = np.searchsorted(h >> (np.uint64(64) - shift) if shift else h * 0, np.arange(slices + 1))
            kept = np.ascontiguousarray((h << shift >> np.uint64(64 - 8 * WIDTH)).view(np.uint8).reshape(-1, 8)[:, :WIDTH])
            count = np.minimum(count, least).astype(small)  # no less is enough
            rows = [(i, a, b) for i, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if b > a]
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _, _ in rows], pa.int32()), pa.array([r["block"]] * len(rows), pa.int64()),
                pa.array([a for _, a, _ in rows], pa.int32()), pa.array([kept[a:b].tobytes() for _, a, b in rows], pa.binary()),
                pa.array([count[a:b].tobytes() for _, a, b in rows], pa.binary())], schema=kinds)

    def add(table):
        blocks_, base = table["block"].to_numpy(), table["base"].to_numpy()
        prints = [np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, WIDTH) for x in table["prints"]]
        sizes_ = np.array([len(x) for x in prints])
        h = np.zeros((int(sizes_.sum()), 8), np.uint8)
        np.concatenate(prints, out=h[:, :WIDTH])
        h = h.view("<u8").ravel()
        count = np.concatenate([np.frombuffer(x.as_buffer(), small) for x in table["counts"]])
        order = np.argsort(h)
        first = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
        total = np.add.reduceat(count[order], first, dtype=np.int64)
        hit = np.zeros(len(h), bool)
        hit[order] = np.repeat(total >= least, np.diff(np.append(first, len(h))))
        ends = np.cumsum(sizes_)
        found = [(b, (np.flatnonzero(hit[e - n:e]) + a).astype("<i4").tobytes())
                 for b, a, n, e in zip(blocks_.tolist(), base.tolist(), sizes_.tolist(), ends.tolist())]
        found = [x for x in found if x[1]]
        return pa.table({"block": pa.array([b for b, _ in found], pa.int64()),
                         "entries": pa.array([x for _, x in found], pa.binary())})

    sent = texts.mapInArrow(send, "slice int, block long, base int, prints binary, counts binary")
    hits = sent.groupBy("slice").applyInArrow(add, "block long, entries binary")
    return stored(hits.groupBy("block").agg(F.collect_list("entries").alias(name)), f"phrase-{name}")


def slices_for(texts: DataFrame) -> int:
    """A power of two: slices of about ``SLICE`` entries, ``LEAST_SLICES`` at least."""
    words = (texts.agg(F.sum(F.octet_length("codes"))).first()[0] or 0) // 4
    return max(LEAST_SLICES, 1 << max(0, (2 * words // SLICE)).bit_length())


def frequencies(docs: DataFrame, longest: int = 4, least: int = 30, lang: str = "lang", text: str = "text",
                bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f): all phrases and words that occur ``least`` times,
    and (lang, n): how many words each language has."""
    if not 2 <= longest <= 7 or least < 1:
        raise ValueError("phrases have two to seven words and occur at least once")
    texts = coded(docs, lang, text)
    slices, sizes = slices_for(texts), tuple(range(3, longest + 1))
    # A block is some megabytes in one row: about one for each task, not as many as would be a usual task's rows.
    tasks = max(1, min(TASKS, texts.count()))
    short = nominated(texts, (1, 2), least, slices, bits, "short")
    marked = texts.repartition(tasks, "block").join(short.repartition(tasks, "block"), "block")
    if sizes:
        more = nominated(marked, sizes, least, slices, bits, "long")
        marked = marked.join(more.repartition(tasks, "block"), "block", "left")

    def run(batches):
        for r, block in _each(batches, bits):
            places = block.short()
            marked = block.marked(r)
            if sizes:
                longer = block.longer(marked, sizes)
                marked = np.sort(np.concatenate([marked, block.entries(longer)[0][_entries(r["long"])]]))
                places += longer
            for n, starts in places:
                starts, count = block.counted(block.pointed(marked, n, starts), n)
                langs = pa.array(block.langs, pa.string()).take(pa.array(block.lang[starts]))
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array(np.full(len(starts), n, np.int32)), pa.array(block.spelled(starts, n), pa.binary()),
                     pa.array(count.astype(np.int64))], ["lang", "size", "phrase", "c"])

    def words(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = {f: batch.column(f)[i].as_py() for f in batch.schema.names}
                size = np.diff(np.frombuffer(r["ends"], "<i4").astype(np.int64), prepend=0)
                n = np.bincount(np.frombuffer(r["spoken"], "<i4"), size, len(r["langs"])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(r["langs"], pa.string()), pa.array(n)], ["lang", "n"])

    said = marked.mapInArrow(run, "lang string, size int, phrase binary, c long")
    counts = said.groupBy("lang", "size", "phrase").agg(F.sum("c").alias("f")).filter(F.col("f") >= least)
    totals = texts.select("langs", "ends", "spoken").mapInArrow(words, "lang string, n long").groupBy("lang").agg(
        F.sum("n").alias("n"))
    return stored(counts.withColumn("phrase", F.col("phrase").cast("string")), "phrase-counts"), totals


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, most: int = 2000, share: int = 80,
                 lang: str = "lang", text: str = "text", bits: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``most`` best."""
    f, totals = frequencies(docs, longest, least, lang, text, bits)
    part = f.select("lang", F.col("phrase").alias("part"), F.col("f").alias("has"))
    words = F.split("phrase", " ")
    whole = f.filter("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), words.alias("w"))
    cuts = whole.select("lang", "phrase", "a", "w", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("head"),
        F.array_join(F.expr("slice(w, k + 1, size - k)"), " ").alias("tail"))
    for side, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(part.select("lang", F.col("part").alias(side), F.col("has").alias(name)), ["lang", side])
    score = F.expr(f"cast((cast({SCALE} as decimal(20,0)) * a) div (l + r) as long)")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = whole.filter("size > 2").select(
        "lang", F.col("a").alias("held"), "w", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    inside = inside.select("lang", "held", "w", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("i"))
    inside = inside.groupBy("lang", F.array_join(F.expr("slice(w, i, m)"), " ").alias("phrase")).agg(
        F.max("held").alias("held"))
    kept = worst.join(inside, ["lang", "phrase"], "left").filter(
        F.expr(f"held is null or cast(100 as decimal(20,0)) * held < cast({share} as decimal(20,0)) * a"))
    order = W.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM w, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(words) >= size)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, h.f AS l, t.f AS r,
         CAST((2000000::HUGEINT * c.a) // (h.f + t.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c
  JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.w[k + 1:], ' ')),
worst AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM cuts) WHERE nth = 1),
inside AS (
  SELECT lang, phrase, max(a) AS held
  FROM (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM c)))
  GROUP BY ALL),
kept AS (
  SELECT x.* FROM worst x LEFT JOIN inside i USING (lang, phrase)
  WHERE i.held IS NULL OR 100::HUGEINT * i.held < 80::HUGEINT * x.a)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN totals USING (lang) WHERE rank <= 2000
"""
