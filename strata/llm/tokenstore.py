"""Token-ID shards with a minimal perfect hash index for keyed access.

Documents are dealt by range of their key, sorted, encoded and written as raw
little-endian ids (two bytes each where the vocabulary allows, else four), so
the shards in order hold the corpus in ascending key order, null keys first.
A shard is closed at ``SHARD_ROWS`` documents or ``SHARD_IDS`` ids.

Files of a shard, in the shared folder:

``<shard>.bin``  the ids of its documents, one after the other.
``<shard>.idx``  magic, a JSON header with the length of each section, then
  the sections: level bit sets and their running ranks, a 32-bit fingerprint,
  first row and number of rows for each distinct key, and the offset in ids of
  each row (one more than rows).

The index is a cascade of bit sets: a key sets one bit of a level; keys that
collide go on to the next. A key's rank among all set bits is its place, so
there are exactly as many places as keys, and a look-up costs a few probes
whatever the shard's size. The stored fingerprint rejects keys that the shard
never held (all but one in 2**32).

Files carry the task attempt in their name and the manifest, which Spark
commits, names those of the attempt that succeeded: a lost executor or a
speculative copy leaves an unused file, never a mixed one.

Defined results: a null text is empty and holds the end id alone. Rows that
repeat a key are all written, in order of their texts, and one look-up returns
them all. An empty table gives no shards.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.words import blocks, stored, text_bytes
from strata.session import scratch_path

MAGIC = b"STRATAIX"
SHARD_ROWS = 1 << 15
SHARD_IDS = 1 << 24
CACHE_BYTES = 64 << 20  # of a generation of known words
LONGEST = 64  # bytes of a word that is kept
ENTRY = 200  # bytes that a known word takes besides its own and its ids'
# Words of these characters alone are in the normaliser's form once they are
# lower-cased; they are cut as the tokenizer's patterns do and encoded by piece.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
TEXT_BYTES = 1 << 20  # of a block of texts
READERS = 10_000
ROUTES = 1 << 20  # shards that are routed to at once
GAMMA = 2.0  # bits of a level for each key that reaches it
_encoders: dict = {}


class Known(dict):
    """Ids of the words met so far, in two generations of a bounded size."""

    def __init__(self, learn, limit: int):
        super().__init__()
        self.learn, self.limit, self.held, self.older = learn, limit, 0, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.learn(word)
        if len(word) <= LONGEST:
            self[word] = ids
            self.held += len(word) + len(ids) + ENTRY
            if self.held > self.limit:
                self.older = dict(self)
                self.clear()
                self.held = 0
        return ids


class Encoder:
    """The tokenizer over whole texts, word by word.

    Its normaliser and its patterns never look across white space, so a text's
    ids are those of its words in turn, and ids of words already met are kept.
    Fewer words differ once A-Z are lower-cased, as the normaliser does. A word of
    printable ASCII and Latin-1 letters needs no more of the normaliser: it is cut
    where the patterns cut it and its pieces go to the model directly, as the
    characters that stand for their bytes. A text that could hold a special token
    is left as it is, and its words with it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark places the work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        # Byte-level vocabularies spell a byte as itself where that is a visible
        # Latin-1 character, else as one of those from U+0100 on, in order.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.spelling = {**{b: b for b in shown}, **{b: 256 + i for i, b in enumerate(hidden)}}
        self.forget()

    def forget(self) -> None:
        """Let go of all words."""
        self.known = Known(self._learn, CACHE_BYTES)

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        ids_of = self.known.__getitem__
        return [b"".join(map(ids_of, (t if b"<|" in t else t.lower()).split())) for t in texts]

    def _learn(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if PLAIN.fullmatch(text) and "<|" not in text:
            pieces = PIECE.findall(text.lower())
            if len(pieces) > 1:  # most are a known word and a sign
                return b"".join([self.known[p.encode()] for p in pieces])
            text = pieces[0]
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(self.spelling)
            ids = [x.id for x in self.model.tokenize(text)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        made = array(self.code, ids)
        if sys.byteorder == "big":
            made.byteswap()
        return made.tobytes()


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _probe(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    x = hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(size)


def key_hashes(keys: list) -> tuple[np.ndarray, np.ndarray]:
    """(placing hash, fingerprint) of each key."""
    from xxhash import xxh3_128_digest

    both = np.frombuffer(b"".join(xxh3_128_digest(b"\xff" if k is None else str(k).encode()) for k in keys), "<u8")
    return both[0::2], (both[1::2] >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Places of a set of distinct keys: 0 to n - 1, one for each."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # a byte for each bit position while in memory
        counts = [np.cumsum(x, dtype=np.int64) for x in levels]
        before = np.cumsum([0, *[int(c[-1]) for c in counts]])
        self.ranks = [c - x + b for c, x, b in zip(counts, levels, before)]

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        levels, left = [], hashes
        while len(left):
            size = max(64, int(GAMMA * len(left)))
            at = _probe(left, len(levels), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            levels.append(alone.astype(np.uint8))
            left = left[~alone[at]]
        return cls(levels)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each key; of a key never built in, any place or -1."""
        out = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        for i, (level, rank) in enumerate(zip(self.levels, self.ranks)):
            at = _probe(hashes[left], i, len(level))
            hit = level[at] == 1
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


def index_bytes(keys: list, sizes: list[int], dtype: np.dtype) -> bytes:
    """The .idx file of rows with these keys (equal ones adjacent) and sizes."""
    first = [i for i, k in enumerate(keys) if not i or k != keys[i - 1]]
    rows = np.diff([*first, len(keys)])
    hashes, prints = key_hashes([keys[i] for i in first])
    table = PerfectHash.build(hashes)
    at = table.places(hashes)
    parts = [np.zeros(len(first), "<u4") for _ in range(3)]
    for part, values in zip(parts, (prints, np.array(first), rows)):
        part[at] = values
    starts = np.zeros(len(sizes) + 1, "<u8")
    np.cumsum(sizes, out=starts[1:])
    sections = [np.packbits(x).tobytes() for x in table.levels] + [p.tobytes() for p in parts] + [starts.tobytes()]
    header = json.dumps({"dtype": dtype.str, "keys": len(first), "rows": len(keys),
                         "levels": [len(x) for x in table.levels]}).encode()
    return MAGIC + len(header).to_bytes(8, "little") + header + b"".join(sections)


class Shard:
    """Keyed access to one written shard."""

    def __init__(self, path: str):
        store, path = filesystem(path)
        with store.open_input_stream(path + ".idx") as f:
            data = f.read()
        if data[:8] != MAGIC:
            raise ValueError(f"not an index: {path}.idx")
        end = 16 + int.from_bytes(data[8:16], "little")
        head = json.loads(data[16:end])
        levels = []
        for size in head["levels"]:
            n = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, n, end))[:size])
            end += n
        self.table, n = PerfectHash(levels), head["keys"]
        self.prints, self.first, self.rows = (np.frombuffer(data, "<u4", n, end + 4 * n * i) for i in range(3))
        self.starts = np.frombuffer(data, "<u8", head["rows"] + 1, end + 12 * n).astype(np.int64)
        self.dtype = np.dtype(head["dtype"])
        self.payload = store.open_input_file(path + ".bin")

    def ranges(self, keys: list) -> list[list[tuple[int, int]]]:
        """(start, end) in ids of each key's rows; empty for an unknown key."""
        hashes, prints = key_hashes(keys)
        out = []
        for at, print_ in zip(self.table.places(hashes), prints):
            if at < 0 or self.prints[at] != print_:
                out.append([])
            else:
                i, n = int(self.first[at]), int(self.rows[at])
                out.append([(int(self.starts[j]), int(self.starts[j + 1])) for j in range(i, i + n)])
        return out

    def ids(self, start: int, end: int) -> np.ndarray:
        width = self.dtype.itemsize
        return np.frombuffer(self.payload.read_at((end - start) * width, start * width), self.dtype)


def filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared scratch root, with its scheme."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
          shard_rows: int = SHARD_ROWS, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode and write ``docs``; returns the manifest, in corpus order:
    (path, part, shard, rows, ids, first, last, base), first and last being its
    outermost keys and base the number of ids before it."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        encode = encoder(tokenizer)
        end = np.array([end_id], encode.dtype).tobytes()
        part, shard = task.partitionId(), 0
        keys, sizes, out = [], [], None

        def close():
            nonlocal keys, sizes, out, shard
            out.close()
            with store.open_output_stream(f"{root}/{name()}.idx") as f:
                f.write(index_bytes(keys, sizes, encode.dtype))
            row = pa.RecordBatch.from_arrays([
                pa.array([f"{folder}/{name()}"]), pa.array([part], pa.int32()), pa.array([shard], pa.int32()),
                pa.array([len(keys)], pa.int64()), pa.array([sum(sizes)], pa.int64()),
                pa.array(keys[:1], key_type), pa.array(keys[-1:], key_type)],
                ["path", "part", "shard", "rows", "ids", "first", "last"])
            keys, sizes, out, shard = [], [], None, shard + 1
            return row

        def name():
            return f"{part:06d}-{shard:06d}-{task.taskAttemptId()}"

        held = 0
        try:
            for rows, texts in blocks(batches, "_t", TEXT_BYTES):
                key_type = rows.schema.field("k").type
                for k, ids in zip(rows.column(0).to_pylist(), encode(texts)):
                    if out is None:
                        out, held = store.open_output_stream(f"{root}/{name()}.bin"), 0
                    out.write(ids + end)
                    keys.append(k)
                    sizes.append(len(ids) // encode.dtype.itemsize + 1)
                    held += sizes[-1]
                    if len(keys) >= shard_rows or held >= shard_ids:
                        yield close()
            if out is not None:
                yield close()
        finally:
            encode.forget()  # the worker outlives its task

    rows = docs.select(F.col(key).alias("k"), text_bytes(text).alias("_t"))
    ordered = rows.repartitionByRange("k", F.xxhash64("_t")).sortWithinPartitions("k", "_t")
    written = stored(ordered.mapInArrow(
        run, f"path string, part int, shard int, rows long, ids long, first {kind}, last {kind}"), "token-manifest")
    before = W.orderBy("part", "shard").rowsBetween(W.unboundedPreceding, -1)
    bases = written.select("path", "part", "shard", "ids").withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    return written.join(bases.select("path", "base"), "path")


def _ordered(key):
    """Keys in corpus order: null first."""
    return (key is not None, "" if key is None else key)


def _routed(keys: DataFrame, kind: str, shards: list) -> DataFrame:
    """(path, base, k): each key with the shards whose range it lies in."""
    firsts, lasts = [_ordered(s["first"]) for s in shards], [_ordered(s["last"]) for s in shards]
    paths, bases = [s["path"] for s in shards], [s["base"] for s in shards]

    def run(batches):
        for batch in batches:
            found = []
            for k in batch.column(0).to_pylist():
                key = _ordered(k)
                i = bisect_left(lasts, key)
                while i < len(firsts) and firsts[i] <= key:
                    found.append((i, k))
                    i += 1
            yield pa.RecordBatch.from_arrays([
                pa.array([paths[i] for i, _ in found], pa.string()), pa.array([bases[i] for i, _ in found], pa.int64()),
                pa.array([k for _, k in found], batch.schema.field(0).type)], ["path", "base", "k"])

    return keys.mapInArrow(run, f"path string, base long, k {kind}")


def read(manifest: DataFrame, keys: DataFrame, routes: int = ROUTES) -> DataFrame:
    """(key, path, base, start, ids): the rows that the files hold for the
    distinct values of the one column of ``keys``, by look-ups in the index.

    ``start`` counts from the corpus' first id. A key goes to the shards between
    whose outermost keys it lies; there the index finds it or turns it away. The
    ranges of at most ``routes`` shards travel to the tasks at once.
    """
    (name, kind), = keys.dtypes

    def run(batches):
        opened, shard = None, None
        for batch in batches:
            paths, bases = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            wanted = batch.column(2).to_pylist()
            at = 0
            while at < len(paths):
                end = at + 1
                while end < len(paths) and paths[end] == paths[at] and end - at < 256:
                    end += 1
                if paths[at] != opened:
                    opened, shard = paths[at], Shard(paths[at])
                found = [(k, a, b) for k, spans in zip(wanted[at:end], shard.ranges(wanted[at:end])) for a, b in spans]
                yield pa.RecordBatch.from_arrays([
                    pa.array([k for k, _, _ in found], batch.schema.field("k").type),
                    pa.array([bases[at] + a for _, a, _ in found], pa.int64()),
                    pa.array([shard.ids(a, b).astype(np.int32) for _, a, b in found], pa.list_(pa.int32()))],
                    [name, "start", "ids"])
                at = end

    distinct = keys.toDF("w").distinct()
    order = W.orderBy("part", "shard")
    placed = manifest.select("path", "base", "first", "last", "part", "shard")
    shards, wanted = manifest.count(), None
    for a in range(0, max(1, shards), routes):
        mine = placed if shards <= routes else placed.withColumn("n", F.row_number().over(order)).filter(
            F.col("n").between(a + 1, a + routes))
        found = _routed(distinct, kind, mine.orderBy("part", "shard").collect())
        wanted = found if wanted is None else wanted.union(found)
    # A shard is some thousand look-ups but few bytes: a task for each, up to
    # READERS, not as many as the bytes would get.
    tasks = max(1, min(READERS, shards))
    dealt = wanted.repartition(tasks, "path").sortWithinPartitions("path", "k")
    return dealt.mapInArrow(run, f"{name} {kind}, start long, ids array<int>")


def checksums(found: DataFrame) -> DataFrame:
    """``ids`` of each row as their number and the CRC-32 of their 32-bit form."""
    names = [c for c in found.columns if c != "ids"]

    def run(batches):
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids"))
            made = [np.asarray(x.values).astype("<u4").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in names]
                + [pa.array([len(x) // 4 for x in made], pa.int64()), pa.array([zlib.crc32(x) for x in made], pa.int64())],
                [*names, "n_tokens", "ids_crc32"])

    kinds = ", ".join(f"{c} {t}" for c, t in found.dtypes if c != "ids")
    return found.mapInArrow(run, f"{kinds}, n_tokens long, ids_crc32 long")
