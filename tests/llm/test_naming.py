import hashlib
import random

import duckdb
import numpy as np
import pytest

from strata.llm import naming, queries

SF = "/root/testdata/sf0.001"
BLANK = dict.fromkeys(map(ord, " \t\n\v\f\r"))


def brute(rows):
    """Multiset of results by comparing normalised texts."""
    groups = {}
    for i, (k, t) in enumerate(rows):
        groups.setdefault((t or "").translate(BLANK), []).append(i)
    out = []
    for plain, members in groups.items():
        keep = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0, i))
        out += [(rows[i][0], rows[keep][0], len(members), i == keep, hashlib.sha256(plain.encode()).hexdigest())
                for i in members]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus():
    r = random.Random(3)
    long = "".join(r.choice("abc é☃") for _ in range(9000))
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randrange(0, 9)))) for i in range(150)]
    rows += [(200, long), (201, long.replace(" ", "\n")), (202, long[:-1]), (203, "x" + long[1:]), (204, long + "\v"),
             (205, None), (206, ""), (207, " \t\r\n"), (None, "a b"), (None, long + "  "), (208, "a b"),
             (3, "tie"), (2, "t ie"), (2, "ti e"), (2, "ti e"), (None, "ti e")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, "a", 1, None) for x in rows],
                                 "doc_id long, text string, name string, row int, at string")  # clashing extra columns


@pytest.mark.parametrize("size", [1, 7, naming.BLOCK])
def test_groups_equal_those_of_whole_texts(spark, size):
    rows = corpus() if size > 1 else corpus()[:60] + corpus()[-8:]
    assert found(naming.groups(frame(spark, rows), size=size)) == brute(rows)


def test_locators_that_collide_do_not_decide(spark):
    weak = lambda parts: np.array([[len(p) % 2, 0] for p in parts], np.int64).reshape(-1, 2)
    rows = corpus()
    assert found(naming.groups(frame(spark, rows), size=16, locate=weak)) == brute(rows)


def test_an_empty_table_and_another_key(spark):
    assert naming.groups(frame(spark, []).limit(0)).collect() == []
    df = spark.createDataFrame([("x", "a"), ("b", " a"), ("a", "a ")], "k string, t string")
    assert {tuple(r)[:4] for r in naming.groups(df, "k", "t").collect()} == {
        ("a", "a", 3, True), ("b", "a", 3, False), ("x", "a", 3, False)}
    with pytest.raises(ValueError):
        naming.groups(df, "k", "t", size=0)


def test_names_are_few_and_levels_follow_the_length(spark):
    rows = [(1, "ab" * 8), (2, "ab" * 8), (3, "ab" * 9), (4, "a")]
    named, prints = naming.identities(frame(spark, rows), size=2)
    got = {r.key: (r.level, r.name) for r in named.join(prints, "row").collect()}
    assert got[1] == got[2] and len(set(got.values())) == 3
    assert [got[k][0] for k in (1, 3, 4)] == [3, 4, 0]


def test_query_equals_brute_force_and_sql(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = found(queries.QUERIES["op12_exact_dedup"](spark, SF))
    assert got == brute(docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert sorted(con.execute(queries.ORACLES["op12_exact_dedup"]).fetchall(), key=str) == got
