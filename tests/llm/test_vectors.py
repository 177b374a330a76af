import math

import numpy as np
import pytest

from strata.llm import vectors
from strata.plans.inspect import count_nodes


def brute(rows, queries, k):
    ok = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in ok:
        if qi in queries:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in ok if i != qi)
            out += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard,block,few", [(8192, 256, 16), (40, 7, 1), (100, 3, 10**9)])
def test_equals_all_pairs(spark, monkeypatch, shard, block, few):
    monkeypatch.setattr(vectors, "FEW", few)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    rows += [(i, (np.eye(16)[i % 16] * 3).tolist()) for i in range(300, 340)]  # many ties
    rows += [(400, None), (401, []), (402, [1.0, None] * 8), (403, [float("nan")] * 16), (404, [float("inf")] * 16),
             (405, [0.0] * 16), (406, [2.0**40, -2.0**40] * 8), (407, [0.5] * 3), (20, [0.1] * 16), (20, [0.1] * 16), (None, [1.0] * 16)]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "vec_id long, embedding array<double>, score int, shard string")
    wanted = {i for i, _ in rows if i is not None and i % 20 == 0}
    got = vectors.search(df, df.filter("vec_id % 20 = 0"), 20, shard=shard, block=block)
    # id 20 is asked by three rows: their answers share its number
    got = sorted(tuple(r) for r in got.collect() if r.query_id != 20)
    assert got == [r for r in brute(rows, wanted, 20) if r[0] != 20]


@pytest.mark.parametrize("shard,block", [(8192, 256), (40, 2)])
def test_each_distinct_query_row_has_its_own_k(spark, shard, block):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(200)]
    rows += [(20, [0.1] * 16)] * 3 + [(40, rows[40][1])] * 2 + [(60, [-0.2] * 16), (60, [0.3] * 15), (20, [None] * 16)]
    rows += [(80, [x + 1e-9 for x in rows[80][1]])]  # another vector, though the integers are the same
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in vectors.search(df, df.filter("vec_id in (20, 40, 60, 80)"), 20, shard=shard, block=block).collect())
    want = []
    for q in (20, 40, 60, 80):
        for v in {tuple(v) for i, v in rows if i == q and None not in v}:  # one query for each vector of an id
            want += [r for r in brute([(q, list(v))] + [r for r in rows if r[0] != q], {q}, 20)]
    assert got == sorted(want)
    assert [sum(r[0] == q for r in got) for q in (20, 40, 60, 80)] == [40, 20, 60, 40]


def test_stops_on_proof_and_loses_nothing():
    rng = np.random.default_rng(1)
    m = np.floor(64 * rng.normal(size=(4000, 64)) / 8).astype(np.int64)
    q = m[:50] + rng.integers(-2, 3, (50, 64))
    shard = vectors.Shard(np.arange(4000), m)
    got = list(zip(*[x.tolist() for x in shard.top(np.full(50, -1), q, 20)]))
    by_query = {i: [(v, s) for j, v, s in got if j == i] for i in range(50)}
    scores = q @ m.T
    for i in range(50):
        best = np.lexsort((np.arange(4000), -scores[i]))[:20]
        assert by_query[i] == [(int(b), int(scores[i, b])) for b in best]
    assert 0 < shard.read < len(shard.segments)  # the smallest impacts were never needed


def test_components_are_never_cut_off(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0**23, 0.0]), (2, [2.0**23 + 8, 0.0]), (3, [-(2.0**45), 1.0]), (4, [0.5, 2.0**36])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in vectors.search(df, df.filter("vec_id = 0"), 20).collect())
    assert got == brute(rows, {0}, 20) and [r[2] for r in got] == [2, 1, 4, 3]
    assert got[0][3] == 64 * (64 * 2**23 + 512)


def test_rounding_of_large_scores_loses_nothing():
    rng = np.random.default_rng(3)
    one = rng.integers(1 << 27, 1 << 28, 32)
    m = np.array([rng.permutation(one) for _ in range(500)])  # all scores are equal, beyond 2**53
    q = np.full((1, 32), (1 << 28) - 1)
    _, got, scores = vectors.Shard(np.arange(500), m).top(np.array([-1]), q, 5)
    assert got.tolist() == [0, 1, 2, 3, 4] and set(scores.tolist()) == {int(one.sum()) * ((1 << 28) - 1)}


def test_fewer_candidates_than_k_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in vectors.search(df, df.filter("vec_id = 0"), 20).collect()]
    assert got == [(0, 1, 1, 128 * 64)]
    assert vectors.search(df.limit(0), df.limit(0), 20).collect() == []


def test_blocks_meet_shards_in_bounded_groups_without_a_broadcast(spark, monkeypatch):
    """Every block goes to every shard; Spark's estimate of them knows of one shard."""
    monkeypatch.setattr(vectors, "MEET", 2)
    seen, made = [], vectors.query_blocks
    monkeypatch.setattr(vectors, "query_blocks", lambda *x: seen.append(made(*x)) or seen[-1])
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vectors.search(df, df.filter("vec_id % 4 = 0"), 5, shard=20, block=10)
    assert count_nodes(found, "BroadcastExchange") == 0
    groups = seen[0].groupBy("shard", "turn").count().collect()
    assert len({r.shard for r in groups}) == 20 and max(r["count"] for r in groups) <= 2
    assert sorted(map(tuple, found.collect())) == brute(rows, set(range(0, 400, 4)), 5)
