import random

import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import queries, simhash
from strata.plans.inspect import count_nodes

SF = "/root/testdata/sf0.001"


def brute_print(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w.decode() for w in low.encode().split()]
    if not words:
        return 0
    spans = ([" ".join(words)] if len(words) < width
             else [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=2):
    """{row: smallest id} by comparing every pair."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, x) in enumerate(prints):
        for j in range(i):
            if bin(x ^ prints[j][1]).count("1") <= bits:
                parent[root(i)] = root(j)
    out = {}
    for i, (k, _) in enumerate(prints):
        ids = [prints[j][0] for j in range(len(prints)) if root(j) == root(i) and prints[j][0] is not None]
        out[i] = min(ids) if ids else None
    return out


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, brute_print(r.text)) for r in docs]
    expected = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id)
           for r in queries.QUERIES["op10_simhash_near_dedup"](spark, SF).collect()}
    assert got == {k: (f"{fp:016x}", expected[i]) for i, (k, fp) in enumerate(prints)}


@pytest.mark.parametrize("max_bits", [0, 1, 2])
@pytest.mark.parametrize("hot", [1, 1000])
def test_links_connect_what_all_pairs_connect(spark, hot, max_bits):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(4)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for c in centres for _ in range(60)}
    values |= {0, 1, 3, 7, 2**64 - 1}
    prints = [(i, v) for i, v in enumerate(sorted(values))]
    expected = brute_components(prints, max_bits)
    df = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for _, v in prints], "fp long")
    edges = simhash.links(df, max_bits, hot)
    assert edges.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > max_bits).count() == 0
    root = {r.node % 2**64: r.root % 2**64 for r in simhash.connected(edges).collect()}
    groups = {}
    for i, v in prints:
        groups.setdefault(root.get(v, v), set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(
        sorted(i for i, _ in prints if expected[i] == m) for m in set(expected.values()))


def test_defined_results_for_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (4, "ONE"), (None, "one"), (9, "É x"), (10, "é x"),
            (11, "a b c " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'s' as fp", "1 as component_id", "2 as k", "3 as least")
    got = sorted((r.doc_id is None, r.doc_id, r.component_id) for r in simhash.components(docs).collect()
                 if r.doc_id is not None)
    assert got == [(False, i, c) for i, c in [(1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (9, 9), (10, 10), (11, 11)]]
    prints = {(r.doc_id): r.fp % 2**64 for r in simhash.fingerprints(docs).collect()}
    assert prints[1] == 0 and prints[9] != prints[10] and prints[9] == brute_print("É x")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(x for x in (r.doc_id for r in kept.collect()) if x) == [1, 4, 4, 9, 10, 11]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.components(docs).collect() == []


@pytest.mark.parametrize("bits", [1, 2])
def test_exploded_sides_are_never_broadcast(spark, monkeypatch, bits):
    """Spark sizes them by the fingerprints before the explode, 64 times too low."""
    seen, stored = [], simhash.stored
    monkeypatch.setattr(simhash, "stored", lambda df, name: seen.append(df) or stored(df, name))
    distinct = stored(spark.range(500).select(F.xxhash64("id").alias("fp")), "test-distinct")
    found = simhash.links(distinct, bits, hot=1)
    plans = [found, *seen]
    assert len(plans) == 2 and sum(count_nodes(p, "SortMergeJoin") for p in plans) >= 3
    assert [count_nodes(p, "BroadcastHashJoin") + count_nodes(p, "BroadcastExchange") for p in plans] == [0, 0]
