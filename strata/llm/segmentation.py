"""SentencePiece encoding by sampling without replacement.

``k`` distinct segmentations of a text are drawn by Gumbel top-k: every
segmentation's log-probability is perturbed by Gumbel noise and those with the
largest sums are emitted, in that order, with their inclusion score, the chance
to lie above the threshold that the next one sets.

Nothing is enumerated. An A-star search goes over sets of segmentations of the
text's lattice, always opening the set with the largest perturbed maximum: its
best member is emitted, and the rest of the set splits into one set for each
later word, those that agree with that member up to the word and differ in it.
The exact log-mass of every set is known from a backward pass over the lattice,
so its maximum is a Gumbel variable at that mass, cut off at its parent's, and
no bound is ever loose.

The lattice: pieces of a vocabulary never go across the start of a run of
spaces or a line end (checked when a model is read), so a text's lattice is the
chain of its words' lattices, and all distinct words of a block are walked
through the vocabulary's trie together. The model's order of pieces gives their
weights: the n-th has log-weight -``alpha`` * log(n + 2).

Random numbers are a hash of the row's key, the sample, the word and the step:
results don't depend on partitions or batches, and rows with one key and one
text get the same samples.

Defined results: null and empty texts have one segmentation, without pieces. A
text with fewer than ``k`` segmentations has as many rows, with score 1.
Characters outside the vocabulary, and a literal U+2581, become bytes, so that
decoding restores every text of valid UTF-8.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import blocks, factorised, text_bytes

SPACE = "▁"
LITERAL = "\U0010ffff"  # stands for a U+2581 in the text itself
CHUNK = re.compile(r"\n| *[^ \n]+| +")
SLOT_BITS = 18  # of the hash table that holds the trie
SLOTS = 1 << SLOT_BITS
_models: dict = {}


def _slot(key: np.ndarray, probe: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (key.astype(np.uint64) + np.uint64(probe * 0x632BE59BD9B4E019 % (1 << 64))) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


class Model:
    """A vocabulary as a trie over its characters."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.byte_ids = np.zeros(256, np.int32)
        self.spelled = [b""] * size
        for i in range(size):
            if sp.is_byte(i):
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i
                self.spelled[i] = bytes([int(self.pieces[i][3:5], 16)])
        ranks = {i: -sp.get_score(i) for i in plain}
        self.weights = np.full(size, -alpha * np.log(size + 2.0))
        children: dict[tuple[int, str], int] = {}
        ends = [-1]
        for i in plain:
            p = self.pieces[i]
            if SPACE in p.lstrip(SPACE) or "\n" in p:
                raise ValueError(f"a piece goes across words: {p!r}")
            self.spelled[i] = p.replace(SPACE, " ").encode()
            self.weights[i] = -alpha * np.log(min(ranks[i], size) + 2.0)
            node = 0
            for c in p:
                at = children.get((node, c))
                if at is None:
                    at = children[node, c] = len(ends)
                    ends.append(-1)
                node = at
            ends[node] = i
        self.lengths = np.fromiter(map(len, self.spelled), np.int32, size)
        self.offsets = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)
        self.letters = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.ends = np.array(ends, np.int32)
        self.keys, self.nodes = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, np.int64)
        left = np.array([n << 21 | ord(c) for n, c in children], np.int64)
        to = np.array(list(children.values()), np.int64)
        self.probes = 0
        while len(left):  # place the keys whose slot is free, one of each slot
            slot = _slot(left, self.probes)
            _, one = np.unique(slot, return_index=True)
            one = one[self.keys[slot[one]] < 0]
            self.keys[slot[one]], self.nodes[slot[one]] = left[one], to[one]
            left, to, self.probes = np.delete(left, one), np.delete(to, one), self.probes + 1

    def child(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The node below each node by a character; -1 where there is none."""
        key = node << 21 | char
        out = np.full(len(key), -1, np.int64)
        left, sought = np.arange(len(key)), key
        for probe in range(self.probes):
            slot = _slot(sought, probe)
            held = self.keys[slot]
            hit = held == sought
            out[left[hit]] = self.nodes[slot[hit]]
            left = left[~hit & (held >= 0)]
            sought = key[left]
            if not len(left):
                break
        return out

    def spell(self, ids: list[int]) -> bytes:
        """What the pieces spell, with the space before the first word."""
        return b"".join(map(self.spelled.__getitem__, ids))

    def spell_all(self, ids: np.ndarray) -> bytes:
        """The same of many pieces."""
        out = []
        for a in range(0, len(ids), 1 << 19):
            part = ids[a:a + (1 << 19)]
            sizes = self.lengths[part]
            ends = np.cumsum(sizes, dtype=np.int32)
            at = np.repeat(self.offsets[part] - (ends - sizes), sizes)
            at += np.arange(len(at), dtype=np.int32)
            out.append(self.letters[at].tobytes())
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        return self.spell(ids)[1:].decode("utf-8", "replace")


def model(path: str, alpha: float) -> Model:
    """One model for each Python worker."""
    if (path, alpha) not in _models:
        _models[path, alpha] = Model(path, alpha)
    return _models[path, alpha]


def chunks(text: str) -> list[str]:
    """Words with the spaces before them, of a text behind one more space."""
    return CHUNK.findall(" " + text) if text else []


class Lattice:
    """All segmentations of distinct words, by character position."""

    def __init__(self, m: Model, words):
        self.model = m
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.begin = np.cumsum(sizes) - sizes
        spelled = "".join(words).replace(SPACE, LITERAL).replace(" ", SPACE)
        self.chars = np.frombuffer(spelled.encode("utf-32-le"), "<u4").astype(np.int64)
        n = len(self.chars)
        self.stop = np.repeat(self.begin + sizes, sizes)
        found = []  # (start, piece) of the edges of each length
        count = np.zeros(n + 1, np.int64)
        at, node, length = np.arange(n), np.zeros(n, np.int64), 0
        while len(at):
            inside = at + length < self.stop[at]
            at, node = at[inside], node[inside]
            node = m.child(node, self.chars[at + length])
            hit = node >= 0
            at, node, length = at[hit], node[hit], length + 1
            piece = m.ends[node]
            whole = piece >= 0
            found.append((at[whole], piece[whole]))
            if length == 1:  # characters that only bytes can spell
                lacking = np.ones(n, bool)
                lacking[at[whole]] = False
                rest = np.flatnonzero(lacking)
                c = self.chars[rest]
                one = np.where(c < 0x80, m.byte_ids[np.minimum(c, 0x7F)], -1)  # or looked up by ids()
                width = np.where(c == ord(LITERAL), 3, 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF))
                found[0] = (np.concatenate([at[whole], rest]), np.concatenate([piece[whole], one]))
            count[found[-1][0] + 1] += 1
        # Each start's edges side by side, shortest first.
        self.edges = np.cumsum(count)
        total = int(self.edges[-1])
        self.start = np.repeat(np.arange(n, dtype=np.int32), count[1:])
        self.end, self.piece = np.empty(total, np.int32), np.empty(total, np.int32)
        weight, used = np.empty(total), self.edges[:-1].copy()
        for i, (at, piece) in enumerate(found):
            slot = used[at]
            used[at] += 1
            self.end[slot], self.piece[slot] = at + i + 1, piece
            weight[slot] = m.weights[piece]
        if n:
            weight[self.edges[rest]] = width * m.weights[m.byte_ids[0]]
        # Backward: the log-mass from each position to its word's end.
        mass = np.zeros(n + 1)
        far = self.stop - np.arange(n)
        longest = int(far.max()) if n else 0
        key = far.astype(np.uint16 if longest < 1 << 16 else np.int64)[self.start]  # 16 bits sort by radix
        turn = np.argsort(key, kind="stable")
        cuts = np.concatenate([[0], np.cumsum(np.bincount(key, minlength=longest + 1)[1:])])
        last = self.end == self.stop[self.start]  # a word's last edge
        starts, ends, lasts, weights = self.start[turn], self.end[turn], last[turn], weight[turn]
        fresh = np.ones(total, bool)
        fresh[1:] = starts[1:] != starts[:-1]
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            if a < b:
                first = np.flatnonzero(fresh[a:b])
                ahead = mass[ends[a:b]]
                ahead[lasts[a:b]] = 0.0
                ahead += weights[a:b]
                mass[starts[a:b][first]] = np.logaddexp.reduceat(ahead, first)
        ahead = np.where(last, 0.0, mass[self.end])
        self.logp = np.minimum(weight + ahead - mass[self.start], 0.0)  # of an edge, at its start
        self.upto = np.cumsum(np.exp(self.logp))

    def _first_above(self, at: np.ndarray, sought: np.ndarray) -> np.ndarray:
        """Of each position's few edges the first whose running sum is above a
        number, else the last. They lie side by side: a search through the sums of
        all words would leave the caches at every step."""
        e, final = self.edges[at], self.edges[at + 1] - 1
        left = np.flatnonzero((self.upto[e] <= sought) & (e < final))
        while len(left):
            e[left] += 1
            now = e[left]
            left = left[(self.upto[now] <= sought[left]) & (now < final[left])]
        return e

    def sample(self, word: np.ndarray, uniform) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A segmentation of each word by its probability: edges in order, where
        each word's begin, and the words' log-probabilities."""
        total = np.zeros(len(word))
        # neighbours in the tables one after the other, near enough (16 bits sort by radix)
        who = np.argsort((word >> max(0, len(self.begin).bit_length() - 16)).astype(np.uint16), kind="stable")
        at = self.begin[word[who]]
        count = np.zeros(len(word) + 1, np.int64)
        steps = []
        while len(who):
            base = np.where(at > 0, self.upto[np.maximum(self.edges[at] - 1, 0)], 0.0)
            top = self.upto[self.edges[at + 1] - 1]
            e = self._first_above(at, base + uniform(who, len(steps)) * (top - base))
            total[who] += self.logp[e]
            count[who + 1] += 1
            steps.append((who, e))
            more = self.end[e] < self.stop[at]
            who, at = who[more], self.end[e][more]
        cuts = np.cumsum(count)
        taken = np.empty(int(cuts[-1]), np.int64)
        for i, (who, e) in enumerate(steps):
            taken[cuts[who] + i] = e
        return taken, cuts, total

    def other(self, word: int, excluded: list[tuple[int, ...]], uniform) -> tuple[int, ...]:
        """A segmentation of one word by its probability among the rest."""
        at, stop = int(self.begin[word]), int(self.stop[self.begin[word]])
        live = [(x, math.exp(math.fsum(self.logp[list(x)].tolist()))) for x in excluded]
        path: list[int] = []
        while at < stop:
            a, b = int(self.edges[at]), int(self.edges[at + 1])
            whole = [math.exp(x) for x in self.logp[a:b].tolist()]
            p = list(whole)
            for x, q in live:
                p[x[len(path)] - a] -= q
            p = [x if x > 1e-13 else 0.0 for x in p]
            if not any(p):
                p = whole
            left = uniform(len(path)) * math.fsum(p)
            i = 0
            while i < b - a - 1 and left >= p[i]:
                left -= p[i]
                i += 1
            live = [(x, q / whole[i]) for x, q in live if x[len(path)] == a + i]
            path.append(a + i)
            at = int(self.end[a + i])
        return tuple(path)

    def ids_of(self, paths: list[np.ndarray]) -> list[np.ndarray]:
        """Piece ids of each path; bytes where the vocabulary has no piece."""
        if not paths:
            return []
        cuts = np.cumsum([0, *map(len, paths)])
        piece = self.piece[np.concatenate(paths)]
        out = [piece[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
        for i in np.unique(np.searchsorted(cuts, np.flatnonzero(piece < 0), "right") - 1).tolist():
            out[i] = self._with_bytes(paths[i], out[i])
        return out

    def _with_bytes(self, edges: np.ndarray, piece: np.ndarray) -> np.ndarray:
        odd = np.flatnonzero(piece < 0)
        out, last = [], 0
        for i in odd.tolist():
            c = int(self.chars[self.start[edges[i]]])
            spelled = (SPACE if c == ord(LITERAL) else chr(c)).encode("utf-8", "replace")
            out += [piece[last:i], self.model.byte_ids[np.frombuffer(spelled, np.uint8)]]
            last = i + 1
        return np.concatenate([*out, piece[last:]]).astype(np.int32)


def _uniform(seed, sample, word, step):
    """Hash of its arguments, as a number in (0, 1)."""
    return _drawn(_base(seed, word), sample, step)


def _base(seed, word):
    """What the draws of one word have in common."""
    with np.errstate(over="ignore"):
        return np.asarray(seed, np.uint64) + np.asarray(word).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _drawn(base, sample, step):
    with np.errstate(over="ignore"):
        x = base + np.uint64((sample * 0xD1B54A32D192ED03 + step * 0x8CB92BA72F3D8DD7) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def _uniform1(seed: int, sample: int, word: int, step: int) -> float:
    """The same for one number."""
    full = (1 << 64) - 1
    x = (seed + word * 0x9E3779B97F4A7C15 + sample * 0xD1B54A32D192ED03 + step * 0x8CB92BA72F3D8DD7) & full
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & full
    x = (x ^ x >> 27) * 0x94D049BB133111EB & full
    return ((x ^ x >> 31) >> 11) * 2.0**-53 + 2.0**-54


def _gumbel(u):
    return -np.log(-np.log(u))


class _Text:
    """The search over one text's sets of segmentations."""

    def __init__(self, seed: int, words: np.ndarray):
        self.seed, self.words = seed, words
        self.paths: list[tuple] = []  # edges, where each word's begin, log-probability of each word
        self.sets: list[list] = []  # closed sets of a path: words, path, maxima, what a word must not be
        self.out: list[tuple[float, float]] = []
        self.next = -np.inf

    def pop(self):
        """The set with the largest maximum: (maximum, path, word, excluded)."""
        best = None
        for at, (words, path, top, excluded) in enumerate(self.sets):
            if len(top):
                i = int(np.argmax(top))
                if top[i] > -np.inf and (best is None or top[i] > best[0]):
                    best = (float(top[i]), path, int(words[i]), excluded, at, i)
        return best


def samples(m: Model, texts: list[str], seeds: list[int], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text its (ids, log-probability, perturbed, inclusion score)."""
    if k < 1:
        raise ValueError("at least one sample")
    split = [chunks(t) for t in texts]
    codes, distinct, bounds = factorised(split)
    lattice = Lattice(m, distinct)
    seeds = np.array(seeds, np.uint64)
    docs = [_Text(int(s), codes[a:b]) for s, a, b in zip(seeds, bounds, bounds[1:])]
    opened = [(d, float(_gumbel(_uniform1(t.seed, 0, 0, 1 << 20))), -1, -1, {}) for d, t in enumerate(docs)]
    for r in range(k):
        if not opened:
            break
        # Fresh words of every text at once: all of them, or those after the word that differs.
        which = np.array([d for d, *_ in opened])
        differs = np.array([w for _, _, _, w, _ in opened])
        many = np.diff(bounds)[which]
        fresh = np.concatenate([[0], np.cumsum(many - differs - 1)])
        at = np.arange(fresh[-1]) + np.repeat(differs + 1 - fresh[:-1], np.diff(fresh))
        doc = np.repeat(which, np.diff(fresh))
        base = _base(seeds[doc], at)
        word = codes[bounds[doc] + at]
        edges, cuts, logp = lattice.sample(word, lambda i, s, base=base, r=r: _drawn(base[i], r + 1, s))
        # The rest of each set: agree before a word, differ in it; the words of all texts side by side.
        rest = np.maximum(differs, 0)
        place = np.concatenate([[0], np.cumsum(many - rest)])
        later = np.arange(place[-1]) + np.repeat(rest - place[:-1], np.diff(place))
        before, gone, excludes = np.zeros(len(later)), np.empty(len(later)), []
        for (d, top, path, w, excluded), a, b, first, end in zip(
                opened, place.tolist(), place[1:].tolist(), fresh.tolist(), fresh[1:].tolist()):
            text = docs[d]
            begun = int(cuts[first])
            taken, where, lp = edges[begun:cuts[end]], cuts[first:end + 1] - begun, logp[first:end]
            exclude = {}
            if w >= 0:
                old_edges, old_cuts, old_lp = text.paths[path]
                i = int(text.words[w])
                mine = lattice.other(i, excluded[w], lambda s, t=text, w=w, r=r: _uniform1(t.seed, r + 1, w, s))
                own = float(lattice.logp[list(mine)].sum())
                taken = np.concatenate([old_edges[:old_cuts[w]], np.array(mine, np.int64), taken])
                where = np.concatenate([old_cuts[:w + 1], where + (old_cuts[w] + len(mine))])
                lp = np.concatenate([old_lp[:w], [own], lp])
                exclude[w] = [*excluded[w], mine]
            text.paths.append((taken, where, lp))
            text.out.append((float(lp.sum()), top))
            if b > a:
                sums = np.cumsum(lp)
                before[a + 1:b] = sums[max(w, 0):-1]
                if w > 0:
                    before[a] = sums[w - 1]
                gone[a:b] = lp[max(w, 0):]
            excludes.append(exclude)
        gone = np.exp(gone)
        for (_, _, _, w, _), a, exclude in zip(opened, place.tolist(), excludes):
            if w >= 0:
                gone[a] = sum(float(np.exp(lattice.logp[list(x)].sum())) for x in exclude[w])
        with np.errstate(divide="ignore"):
            mass = before + np.where(gone > 1 - 1e-12, -np.inf, np.log1p(-np.minimum(gone, 1 - 1e-12)))
        noise = _gumbel(_uniform(np.repeat(seeds[which], np.diff(place)), r + 1, later, 1 << 21))
        tops = np.repeat(np.array([top for _, top, _, _, _ in opened]), np.diff(place))
        maxima = np.where(np.isinf(mass), -np.inf, -np.logaddexp(-tops, -(mass + noise)))
        for (d, *_), a, b, exclude in zip(opened, place.tolist(), place[1:].tolist(), excludes):
            docs[d].sets.append([later[a:b], len(docs[d].paths) - 1, maxima[a:b], exclude])
        opened = []
        for d, text in enumerate(docs):
            best = text.pop() if len(text.out) == r + 1 else None
            text.next = best[0] if best else -np.inf
            if best and r + 1 < k:
                top, path, w, exclude, s, i = best
                text.sets[s][2][i] = -np.inf
                if w not in exclude:
                    e, c, _ = text.paths[path]
                    exclude = {w: [tuple(e[c[w]:c[w + 1]].tolist())]}
                opened.append((d, top, path, w, exclude))
    result, ids = [], iter(lattice.ids_of([path[0] for text in docs for path in text.paths]))
    for text in docs:
        score = lambda lp, t=text: 1.0 if t.next == -np.inf else float(-np.expm1(-np.exp(lp - t.next)))
        result.append([(next(ids), lp, g, score(lp)) for lp, g in text.out])
    return result


def encode(docs: DataFrame, path: str, k: int = 3, alpha: float = 1.0, seed: int = 0, key: str = "doc_id",
           text: str = "text", with_ids: bool = True, limit: int = 1 << 20) -> DataFrame:
    """(key, sample, n_pieces, ids_crc32, log_prob, perturbed, inclusion,
    restored[, ids]): up to ``k`` rows for each row, sample from 1; ``restored``
    says that decoding the ids gives the text."""

    def run(batches):
        from xxhash import xxh3_64_intdigest

        m = model(path, alpha)
        for rows, raw in blocks(batches, "_t", limit):
            texts = [t.decode("utf-8", "replace") for t in raw]
            keys = rows.column(0).to_pylist()
            found = samples(m, texts, [xxh3_64_intdigest(str(x), seed) for x in keys], k)
            ids = [x[0] for mine in found for x in mine]
            flat = np.concatenate(ids).astype(np.int32, copy=False)
            bounds = np.cumsum([0, *map(len, ids)])
            spelled = m.spell_all(flat)
            letters = np.concatenate([[0], np.cumsum(m.lengths[flat], dtype=np.int64)])[bounds].tolist()
            out, at = [[], [], [], [], [], [], [], []], 0
            for i, (t, mine) in enumerate(zip(raw, found)):
                for n, (own, lp, g, inclusion) in enumerate(mine):
                    whole = spelled[letters[at]:letters[at + 1]] == b" " * bool(t) + t
                    for column, x in zip(out, (i, n + 1, len(own), zlib.crc32(own.astype("<u4").tobytes()), lp, g,
                                               inclusion, whole)):
                        column.append(x)
                    at += 1
            kinds = (None, pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_())
            arrays = [rows.column(0).take(pa.array(out[0], pa.int64()))]
            arrays += [pa.array(x, kind) for x, kind in list(zip(out, kinds))[1:]]
            if with_ids:
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["k", "sample", "n_pieces", "ids_crc32", "log_prob", "perturbed", "inclusion", "restored", "ids"][:8 + with_ids]
    kind = docs.schema[key].dataType.simpleString()
    schema = (f"k {kind}, sample int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, "
              "inclusion double, restored boolean" + ", ids array<int>" * with_ids)
    return (docs.select(F.col(key).alias("k"), text_bytes(text).alias("_t")).mapInArrow(run, schema)
            .withColumnRenamed("k", key))


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text that the ids spell."""
    names = [f"c{i}" for i in range(len(rows.columns))]
    at = rows.columns.index(ids)

    def run(batches):
        m = model(path, 1.0)
        for b in batches:
            made = [None if x is None else m.decode(x) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], [*names, "d"])

    kinds = ", ".join(f"{n} {kind}" for n, (_, kind) in zip(names, rows.dtypes))
    return rows.toDF(*names).mapInArrow(run, f"{kinds}, d string").toDF(*rows.columns, "decoded")
