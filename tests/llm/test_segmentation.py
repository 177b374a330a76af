import collections
import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest

from strata.llm import queries, segmentation

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def m():
    return segmentation.Model(PATH, 1.0)


def enumerate_all(m, text):
    """{ids: probability} of every segmentation, by trying every cut."""
    vocab = {p: i for i, p in enumerate(m.pieces) if m.spelled[i] and not (p.startswith("<0x") and len(p) == 6)}
    spelled = (" " + text).replace(" ", segmentation.SPACE)
    out = {}
    for cuts in itertools.product([0, 1], repeat=len(spelled) - 1):
        parts, at = [], 0
        for i, c in enumerate([*cuts, 1]):
            if c:
                parts.append(spelled[at:i + 1])
                at = i + 1
        ids, w = [], 0.0
        for p in parts:
            if p in vocab:
                ids.append(vocab[p])
                w += m.weights[vocab[p]]
            elif len(p) == 1:
                ids += [int(m.byte_ids[b]) for b in p.encode()]
                w += len(p.encode()) * m.weights[m.byte_ids[0]]
            else:
                break
        else:
            out[tuple(ids)] = np.exp(w)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


@pytest.mark.parametrize("text", ["the", "an ox", "hé\u4e00\U0001f600", "a\nb", "  x "])
def test_probabilities_equal_enumeration(m, text):
    p = enumerate_all(m, text)
    seen = set()
    for s in range(40):
        got = segmentation.samples(m, [text], [s], 4)[0]
        assert len({tuple(x[0].tolist()) for x in got}) == len(got) == min(4, len(p))
        assert [x[2] for x in got] == sorted((x[2] for x in got), reverse=True)
        for ids, lp, _, score in got:
            assert np.exp(lp) == pytest.approx(p[tuple(ids.tolist())], rel=1e-9)
            assert 0 < score <= 1 and m.decode(ids.tolist()) == text
            seen.add(tuple(ids.tolist()))
    assert len(seen) > 1


def test_pairs_follow_sampling_without_replacement():
    m = segmentation.Model(PATH, 0.3)
    p = enumerate_all(m, "an ox")
    n = 6000
    pairs = collections.Counter(
        tuple(tuple(x[0].tolist()) for x in mine) for mine in segmentation.samples(m, ["an ox"] * n, list(range(n)), 2))
    chi, cells = 0.0, 0
    for a, b in itertools.permutations(p, 2):
        expected = n * p[a] * p[b] / (1 - p[a])
        if expected >= 8:
            chi += (pairs[a, b] - expected) ** 2 / expected
            cells += 1
    assert cells >= 8 and chi < cells + 5 * np.sqrt(2 * cells)


def test_inclusion_scores_are_unbiased():
    """Sum over the sample of 1 / inclusion estimates the number of segmentations."""
    m = segmentation.Model(PATH, 0.3)
    p = enumerate_all(m, "the")
    got = segmentation.samples(m, ["the"] * 4000, list(range(4000)), 3)
    for wanted in sorted(p, key=p.get)[-3:]:
        share = np.mean([sum(1 / x[3] for x in mine if tuple(x[0].tolist()) == wanted) for mine in got])
        assert share == pytest.approx(1, abs=0.15)


def test_fewer_segmentations_than_samples(m):
    p = enumerate_all(m, "q")
    got = segmentation.samples(m, ["q", ""], [1, 2], 50)
    assert len(got[0]) == len(p) and sum(np.exp(x[1]) for x in got[0]) == pytest.approx(1)
    assert all(x[3] == 1.0 for x in got[0]) and [len(x[0]) for x in got[1]] == [0]


def test_query_restores_every_text(spark):
    got = queries.QUERIES["op3_sentencepiece_sampling"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.restored for r in got) and docs < len(got) <= 2 * docs
    assert len({(r.doc_id, r.ids_crc32) for r in got}) == len(got)


def test_odd_rows_and_partitions(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "\n\n  \n"), (5, "\u2581a \u2581"), (6, "x\x00y\u0301\t"), (None, "null"),
            (7, "same"), (7, "same"), (8, "long words " * 30000), (9, "z" * 3000), (10, "\u65e5\u672c \U0001f469\u200d\U0001f467")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, sample int, k string")
    got = segmentation.encode(docs, PATH, k=2)
    first = sorted((str(r.doc_id), r["sample"], r.ids_crc32, round(r.inclusion, 9)) for r in got.collect())
    assert all(r.restored for r in got.collect())
    again = segmentation.encode(docs.repartition(5), PATH, k=2, limit=50)
    assert first == sorted((str(r.doc_id), r["sample"], r.ids_crc32, round(r.inclusion, 9)) for r in again.collect())
    texts = {str(k): t or "" for k, t in rows}
    for r in segmentation.decode(got, PATH).collect():
        assert r.decoded == texts[str(r.doc_id)]
    assert segmentation.encode(docs.limit(0), PATH).collect() == []


def test_first_edge_above_a_number(m):
    """As a search through all running sums that is kept within a position's edges."""
    lattice = segmentation.Lattice(m, [" the", " lattices", "日x", " zzzz"])
    rng = np.random.default_rng(3)
    at = rng.integers(0, len(lattice.chars), 5000)
    low = np.where(at > 0, lattice.upto[np.maximum(lattice.edges[at] - 1, 0)], 0.0)
    sought = low + rng.random(5000) * 1.1 * (lattice.upto[lattice.edges[at + 1] - 1] - low)
    want = np.clip(np.searchsorted(lattice.upto, sought, "right"), lattice.edges[at], lattice.edges[at + 1] - 1)
    assert np.array_equal(lattice._first_above(at, sought), want)


def test_query_returns_the_encoding(spark):
    """The sampled ids themselves, not only their number and checksum."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = segmentation.decode(queries.QUERIES["op3_sentencepiece_sampling"](spark, SF), PATH).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        assert r.decoded == texts[r.doc_id] and r.n_pieces == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def test_pieces_spelled_at_once(m):
    rng = np.random.default_rng(5)
    ids = rng.integers(0, len(m.pieces), 600_000).astype(np.int32)
    assert m.spell_all(ids) == m.spell(ids.tolist()) and m.spell_all(ids[:0]) == b""
