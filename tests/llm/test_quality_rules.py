import collections

import duckdb
import pytest

from strata.llm import quality

ROWS = [(1, None, 0), (2, "", 0), (3, " \t\n ", 0), (4, "one two", 0), (5, "a b c d e " * 30, 0),
        (6, "The quick brown fox jumps over the lazy dog and then it went on home again.", 0),
        (7, "x|y | z | w | v | u | t | s | r | q | p", 0), (8, "LOUD WORDS HERE TO STAY AND MORE OF THEM ALL", 0),
        (9, "line one here\nline one here\nline one here\n\nother stuff to read for a while now\n \n", 0),
        (10, "1 2 3 4 5 6 7 8 9 10 11 12", 0), (11, "é ü ß à ñ ó í ê ç ö ä", 0),
        (None, "null id has ten words in it or so they say, fine", 0), (6, "The quick again", 0),
        (12, " ".join(f"w{i * i % 9973}" for i in range(30000)), 0), (13, "word " * 20000, 0),
        (14, "p q r s t u a p q r s t b c d e f g h i q r s t a", 0), (15, "a\x0bb\x0cc\rd e f g h i j\x1ck", 0)]


def brute(text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    seen = collections.Counter(tuple(words[i:i + 5]) for i in range(n - 4))
    covered = {j for i in range(n - 4) if seen[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, kept int")


def test_measures_equal_brute_force(spark):
    got = quality.judged(frame(spark)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert sorted((str(r.doc_id), *(r[c] for c in names)) for r in got) == sorted((str(k), *brute(t)) for k, t, _ in ROWS)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_equals_sql(spark):
    con = duckdb.connect()
    con.register("documents", frame(spark).toArrow())
    expected = sorted(con.execute(quality.ORACLE).fetchall(), key=str)
    got = quality.judged(frame(spark)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                              "n_repeat_words", "base_failed", "kept").collect()
    assert sorted(map(tuple, got), key=str) == expected


def test_order_never_changes_the_verdict(spark):
    rows = quality.measures(frame(spark))
    names = list(quality.RULES)
    verdicts = [[r.k for r in rows.select(quality.cascade(order).alias("k")).collect()]
                for order in (names, names[::-1])]
    assert verdicts[0] == verdicts[1] and set(verdicts[0]) == {True, False}


def test_cheap_and_rejecting_rules_come_first(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 31 + j) % 5000}" for j in range(400))) for i in range(300)],
                                 "doc_id long, text string")
    rules = {"never": "n_words > 0", "dear": "size(array_distinct(transform(words, w -> sha2(repeat(w, 200), 512)))) < 0",
             "cheap": "n_words < 0"}
    assert quality.ordered(docs, rules)[0] == "cheap" and quality.ordered(docs, rules)[-1] == "never"


def test_order_on_the_tables(spark):
    """Some rules reject, they come first, and a scan of all words costs more
    than a comparison of two counts."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = quality.measured(docs)
    order = quality.ordered(docs)
    rejecting = [n for n, (_, share) in found.items() if share > 0]
    assert {"few_symbols", "words_have_letters", "word_length"} <= set(rejecting)
    assert set(order[:len(rejecting)]) == set(rejecting)
    assert found["words_have_letters"][0] > 2 * found["few_symbols"][0]
    assert order.index("few_symbols") < order.index("words_have_letters")


def test_empty_table_and_native_plan(spark):
    docs = frame(spark)
    assert quality.judged(docs.limit(0)).collect() == []
    plan = quality.measures(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("words,kept", [("plain words in a row that are all different from each other", True), ("a " * 12, False)])
def test_verdicts(spark, words, kept):
    docs = spark.createDataFrame([(1, words)], "doc_id long, text string")
    assert quality.judged(docs).first().kept is kept
