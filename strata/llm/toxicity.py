"""Toxicity scores from subword-bag embeddings under a linear softmax.

A word is the mean of the vectors of its character n-grams and of the word
itself, each held in a hashed bucket; a text is the mean of its words. A linear
softmax on top gives the score. Buckets and softmax are trained jointly in
numpy, so a misspelling or an unseen ending of a known word shares most of its
vectors.

Training rows are labelled rows outside the held-out quarter of ``doc_id`` s:
at most ``per_class`` of each label, the lowest by hash, weighted back to the
shares of the labels. That bound is the only one; every whole text is scored.
Training runs in one task over that bounded sample. What is sent to the scoring
tasks is one number for each bucket, whatever the size of the corpus.

Defined results: null and empty texts have no words and score the bias alone.
Rows with a null label or a null id train nothing; of repeated labels of one id
the largest holds, of repeated texts the first in order. With no training rows
of one of the labels every text scores the share of label 1 (0 without labels).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.words import factorised, per_text, text_bytes

PER_CLASS = 2500  # the bound of the training sample
THRESHOLD = 0.3
BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
DIM = 3
MIN_TEXTS = 5  # a bucket seen in fewer training texts is left out
PAD = 30  # neutral words added to every text, so that a few words never decide
SCALE = 30.0  # a text holds few telling words, so the mean of many is small
STEPS = 120
WARM = 30  # steps before the check texts have a say
RATE = 0.2
DECAY = 1e-7
EPS = 3e-5
TOKEN = re.compile(r"[^\W_]+")


def held_out(key: Column) -> Column:
    """Rows that never train: a quarter, by the checksum of the id as text."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def tokens(text: bytes) -> list[str]:
    """The distinct words of a text: a word repeated over and over tells no
    more than once."""
    return list(dict.fromkeys(TOKEN.findall(text.decode("utf-8", "replace").lower())))


def subwords(distinct) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of ``<word>`` for each word, and each word's bounds."""
    joined = "".join([f"<{w}>" for w in distinct])
    chars = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in distinct), np.int64, len(distinct))
    ends = np.repeat(np.cumsum(sizes), sizes)
    word = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(chars))
    owner, found = [], []
    for n in GRAMS:
        h = np.full(len(chars), n, np.uint64)
        for j in range(n):
            m = max(0, len(chars) - j)
            h[:m] = (h[:m] ^ chars[j:]) * np.uint64(0x100000001B3)
        inside = place + n <= ends
        owner.append(word[inside])
        found.append(h[inside])
    sums = np.add.reduceat(chars * np.uint64(0x9E3779B97F4A7C15) * ((place - ends).astype(np.uint64) * np.uint64(2) + np.uint64(1)),
                           np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0, np.uint64)
    owner.append(np.arange(len(sizes)))
    found.append(sums)
    h = np.concatenate(found)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    buckets = (h >> np.uint64(40)).astype(np.int64) % BUCKETS
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    bounds = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=len(sizes)), out=bounds[1:])
    return buckets[order], bounds


class _Mean:
    """Weighted row sums of a sparse matrix over vectors held one dimension
    after the other, and the transpose of that operation."""

    def __init__(self, columns, bounds, weights, width):
        rows = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
        self.columns, self.weights, self.starts = columns.astype(np.int32), weights.astype(np.float32), bounds[:-1]
        order = np.argsort(columns, kind="stable")
        self.back_rows, self.back_weights = rows[order], self.weights[order]
        self.used, self.back_starts = np.unique(columns[order], return_index=True)
        self.width = width

    def forward(self, x):
        return np.stack([np.add.reduceat(d[self.columns] * self.weights, self.starts) for d in x])

    def backward(self, g):
        out = np.zeros((len(g), self.width), np.float32)
        for d, row in zip(out, g):
            d[self.used] = np.add.reduceat(row[self.back_rows] * self.back_weights, self.back_starts)
        return out


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """(one number for each bucket, bias): the margin of label 1 is the text's
    mean of its words' means of these numbers, plus the bias."""
    lists = [tokens(t) for t in texts]
    kept = [i for i, x in enumerate(lists) if x]
    share = float(np.average(labels, weights=weights)) if len(labels) else 0.0
    if not 0 < share < 1 or not kept:
        return np.zeros(BUCKETS, np.float32), _logit(share)
    codes, distinct, bounds = factorised([lists[i] for i in kept])
    del lists
    sizes, different = np.diff(bounds), len(distinct)
    bags = _Mean(codes, bounds, np.repeat(1 / (sizes + PAD), sizes), different)
    parts = [subwords(distinct[i:i + 20_000]) for i in range(0, len(distinct), 20_000)]
    buckets = np.concatenate([b.astype(np.int32) for b, _ in parts])
    grams = np.concatenate([np.diff(c) for _, c in parts])
    cuts = np.concatenate([[0], np.cumsum(grams)])
    del parts, distinct, codes
    # A bucket seen in few texts would only learn those texts by heart.
    spread = np.bincount(bags.columns, minlength=different)  # texts that hold the word
    texts_of = np.bincount(buckets, np.repeat(spread.astype(np.float32), grams), minlength=BUCKETS)
    used = np.flatnonzero(texts_of)
    common = texts_of[used] >= MIN_TEXTS
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    at = place[buckets]
    words = _Mean(at, cuts, np.repeat((1 / grams).astype(np.float32), grams) * common[at], len(used))
    del buckets, at
    y, w = labels[kept].astype(np.float32), weights[kept].astype(np.float32)
    check = np.zeros(len(y), bool)  # every fifth text of either label says when to stop
    for c in (0, 1):
        check[np.flatnonzero(y == c)[::5]] = True
    w, least, best = np.where(check, 0, w) / max(w[~check].sum(), 1e-9), np.inf, None

    rng = np.random.default_rng(0)
    params = [rng.normal(0, 0.05, (DIM, len(used))).astype(np.float32),
              rng.normal(0, 1, (2, DIM)).astype(np.float32), np.array([[0], [_logit(share)]], np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        vectors, top, bias = params
        hidden = bags.forward(words.forward(vectors))
        logits = SCALE * top @ hidden + bias
        p = np.exp(logits - logits.max(axis=0))
        p /= p.sum(axis=0)
        loss = -np.average(np.log(np.where(y > 0, p[1], p[0])[check] + 1e-9), weights=weights[kept][check])
        if step > WARM and loss < least:
            least, best = loss, [q.copy() for q in params]
        error = ((p - np.stack([1 - y, y])) * w).astype(np.float32)
        below = words.backward(bags.backward(SCALE * top.T @ error)) + DECAY * vectors
        for i, g in enumerate((below, SCALE * error @ hidden.T, error.sum(axis=1, keepdims=True))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            params[i] = params[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + EPS)
    vectors, top, bias = best
    out = np.zeros(BUCKETS, np.float32)
    out[used] = SCALE * ((top[1] - top[0]) @ vectors) * common
    return out, float(bias[1, 0] - bias[0, 0])


def _logit(share: float) -> float:
    share = min(max(share, 1e-9), 1 - 1e-9)
    return float(np.log(share / (1 - share)))


def scores(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    codes, distinct, bounds = factorised([tokens(t) for t in texts])
    margin = np.full(len(texts), bias)
    if len(distinct):
        buckets, cuts = subwords(distinct)
        word = np.add.reduceat(weights[buckets].astype(np.float64), cuts[:-1]) / np.diff(cuts)
        full = np.diff(bounds) > 0
        margin[full] += np.add.reduceat(word[codes], bounds[:-1][full]) / (np.diff(bounds)[full] + PAD)
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, y, weight, t): at most ``per_class`` texts of each label."""
    known = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
             .join(docs.select("doc_id"), "doc_id", "left_semi"))
    parts = []
    for y in (0, 1):
        one = known.filter(F.col("y") == y)
        low = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        parts.append(low.join(one.agg(F.count("*").alias("n"))))
    chosen = parts[0].union(parts[1])  # at most 2 * per_class ids
    texts = docs.select("doc_id", text_bytes("text").alias("t")).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id", "y", "n").agg(F.min("t").alias("t"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """The trained model: one number for each bucket, and the bias."""

    def run(batches):
        rows = pa.Table.from_batches(list(batches))
        if rows.num_rows:
            rows = rows.sort_by("doc_id")
            y = rows["y"].to_numpy()
            n = rows["n"].to_numpy() / np.bincount(y, minlength=2)[y]
            weights, bias = train(rows["t"].to_pylist(), y, n)
            yield pa.RecordBatch.from_pydict({"w": [weights.tobytes()], "b": [bias]})

    found = sample(docs, labels, per_class).repartition(1).mapInArrow(run, "w binary, b double").first()
    if found is None:
        return np.zeros(BUCKETS, np.float32), _logit(0)
    return np.frombuffer(found.w, np.float32), found.b


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1 for the whole text."""
    weights, bias = model
    return per_text(docs, lambda texts: [scores(texts, weights, bias)], "score double", limit=1 << 20)


def without_toxic(docs: DataFrame, training: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    found = score(docs, fit(training, labels)).toDF(*names, "p")
    return found.filter(F.col("p") < threshold).select(*names).toDF(*docs.columns)
