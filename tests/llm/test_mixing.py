import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import mixing


def brute_targets(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    """Share out by weight; reshare what is above a limit until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = share * sum(sizes.values())
    closed = set()
    while True:
        open_ = [s for s in order if s not in closed]
        left = total - sum(most * sizes[s] for s in closed)
        target = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if target[s] > most * sizes[s]}
        if not above:
            return {s: target.get(s, most * sizes[s]) for s in order}
        closed |= above


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target string, copies int")


def corpus(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), f"s{i % 5 if i % 3 else 0}", "x", 9) for i in range(600)]
    rows += [(1000, None, "s1", None, None), (1001, "", None, "x", 1), (1002, "a b", None, "x", 1),
             (None, "null id", "s2", "x", 1), (1003, " \t\n", "empty", "x", 1), (7, "again " * 9, "s1", "x", 1),
             (7, "again " * 9, "s1", "x", 1), (1004, "y " * 50000, "é", "x", 1), (1005, "z", "Z", "x", 1)]
    return rows


def test_targets_and_takes(spark):
    rows = corpus(spark)
    got = mixing.mix(frame(spark, rows)).collect()
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    expected = brute_targets(sizes)
    assert len(got) == len(rows)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert all(r.target == pytest.approx(expected[s], rel=1e-12) for r in mine)
        largest = max(r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - expected[s]) <= max(largest, 1) * 2
    assert all(0 <= r.taken <= 2 * r.size for r in got)


def test_equals_sql(spark):
    docs = frame(spark, corpus(spark))
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    expected = sorted(con.execute(mixing.ORACLE).fetchall(), key=str)
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got), key=str) == expected


def test_reruns_agree_and_larger_budgets_take_more(spark):
    docs = frame(spark, corpus(spark))
    key = ["doc_id", "source", "size"]
    first = sorted(map(tuple, mixing.mix(docs).select(*key, "copies").collect()), key=str)
    assert first == sorted(map(tuple, mixing.mix(docs.repartition(7)).select(*key, "copies").collect()), key=str)
    low = {r[:3]: r[3] for r in map(tuple, mixing.mix(docs, 0.6).select(*key, "copies").collect())}
    high = {r[:3]: r[3] for r in map(tuple, mixing.mix(docs, 0.9).select(*key, "copies").collect())}
    assert all(low[k] <= high[k] for k in low) and low != high


def test_a_source_that_is_taken_whole_is_not_taken_once_more(spark):
    """Its budget is used up: documents without words have no part in it."""
    rows = [(i, "w " * (1 + i % 5) if i % 4 else None, "few", "x", 0) for i in range(40)]
    rows += [(100 + i, "w " * 200, "many", "x", 0) for i in range(40)]
    docs = frame(spark, rows)
    got = mixing.mix(docs).collect()
    assert {r.copies for r in got if r.source == "few"} == {2}
    assert mixing.mixed(docs).filter("source = 'few'").count() == 80


def test_row_form_and_empty_table(spark):
    docs = frame(spark, corpus(spark))
    taken = mixing.mix(docs).agg(F.sum("copies")).first()[0]
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == taken
    assert mixing.mixed(docs.limit(0)).collect() == [] and mixing.mix(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(frame(spark, corpus(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
