import hashlib
import random

import duckdb
import pytest

from strata.llm import queries, substrings

SF = "/root/testdata/sf0.001"


def brute(rows, window=20):
    """{row: removed flags} by looking at every window in order."""
    first = {}
    for k, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            place = (k is None, k or 0, i)
            first[w] = min(first.get(w, place), place)
    out = []
    for k, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] != (k is None, k or 0, i):
                gone[i:i + window] = [True] * window
        out.append((words, gone))
    return out


def digest(words, gone):
    kept = b" ".join(w for w, g in zip(words, gone) if not g)
    return len(words), sum(gone), hashlib.sha256(kept).hexdigest()


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = sorted((k, *digest(*b)) for (k, _), b in zip(rows, brute(rows)))
    got = sorted(tuple(r) for r in queries.QUERIES["op7_substring_dedup"](spark, SF).collect())
    assert got == expected
    assert any(r[2] for r in got)


@pytest.mark.parametrize("window", [1, 4, 10, 20, 33])
def test_planted_repeats(spark, window):
    rng = random.Random(window)
    passages = [[f"w{rng.randrange(3000)}" for _ in range(rng.randrange(window - 1, window + 30) + 1)] for _ in range(5)]
    rows = []
    for k in range(60):
        words = []
        for _ in range(rng.randrange(4)):
            words += [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(40))]
            p = rng.choice(passages)
            words += p[rng.randrange(3):len(p) - rng.randrange(3)] * rng.choice([1, 1, 2])
        rows.append((k * 7 % 60, rng.choice([" ", "\n", "\t\x0b "]).join(words)))
    rows += [(70, None), (71, ""), (72, "  x"), (None, " ".join(passages[0])), (3, " ".join(passages[1] * 2)),
             (73, " ".join(["a b"] * 20000))]
    if window == 1:
        rows = rows[:-1]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                 "doc_id long, text string, marks string, n_words string").repartition(5)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_removed, r.kept_words)
                  for r in substrings.dedup(docs.select("doc_id", "text", "marks"), window).collect()))
    expected = sorted((k is None, k or 0, sum(g), b" ".join(w for w, x in zip(ws, g) if not x).decode())
                      for (k, _), (ws, g) in zip(rows, brute(rows, window)))
    assert got == expected


def test_rows_that_share_an_id_are_judged_by_place(spark):
    passage = [f"p{i}" for i in range(25)]
    rows = [(1, " ".join(passage)), (1, " ".join(["x", "y", "z", *passage])), (1, " ".join(["q"] + passage)),
            (1, " ".join(passage)), (2, " ".join(["s"] * 30)), (2, " ".join(["a", *["s"] * 30])), (3, "only " * 5),
            (None, " ".join(["n", *passage])), (None, " ".join(f"m{i}" for i in range(30))),
            (None, " ".join(["k", *[f"m{i}" for i in range(30)]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_words)
                 for r in substrings.dedup(docs, 20).collect())
    want = sorted((k is None, k or 0, len(ws), sum(g), b" ".join(w for w, x in zip(ws, g) if not x).decode())
                  for (k, _), (ws, g) in zip(rows, brute(rows, 20)))
    assert got == want
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    sql = sorted((k is None, k or 0, n, m) for k, n, m, _ in con.execute(substrings.ORACLE).fetchall())
    assert sql == [r[:4] for r in got]


def test_stage_form(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"a\n{passage}", "en", "s", 99), (2, passage, "en", "s", 5),
                                  (3, f"x  y {passage} z", None, None, None), (4, None, "en", "s", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in substrings.without_repeats(docs).collect()}
    assert sorted(got) == [1, 3, 4]
    assert got[1].text == f"a\n{passage}" and got[1].n_chars == 99
    assert (got[3].text, got[3].n_chars) == ("x y z", 5) and got[4].text is None
    assert substrings.without_repeats(docs.limit(0)).collect() == []
    assert substrings.without_repeats(docs).schema.names == docs.columns
