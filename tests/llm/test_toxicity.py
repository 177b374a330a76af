import zlib

import numpy as np
from pyspark.sql import functions as F

from strata.llm import queries, toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op4_toxicity"](spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    test = [(labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for y, s in test if y], [s for y, s in test if not y]
    # 37 toxic training texts only: the full-size figures are in the README
    ahead = np.mean([[t > c for c in clean] for t in toxic])
    print("held out:", ahead, np.mean(np.array(toxic) >= 0.3), np.mean(np.array(clean) >= 0.3))
    assert ahead >= 0.7


def _corpus(spark, n=240):
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in ("ban", "tor", "mil", "seg", "pru") for b in ("al", "is", "et", "ong", "ima", "uro")]
    docs, labels = [], []
    for i in range(n):
        text = [str(w) for w in rng.choice(words, 40)]
        if i % 3 == 0:
            text[5:7] = ["zugglomat" + str(rng.choice(["o", "ig", "us", "en"])), "zugglomatic"]
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 3 == 0)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_unseen_misspelling_shares_vectors(spark):
    docs, labels = _corpus(spark)
    model = toxicity.fit(docs, labels, per_class=200)
    plain = " ".join(["banal toris milet"] * 12)
    fresh = spark.createDataFrame([(1, f"{plain} zugglomatz zuglomat zugglomatti"), (2, plain + " banima segong")],
                                  "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(fresh, model).collect()}
    assert got[1] > 0.5 > got[2]


def test_labels_outside_the_sample_and_held_out_rows_do_not_matter(spark):
    docs, labels = _corpus(spark)
    model = toxicity.fit(docs, labels)
    changed = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    other = toxicity.fit(docs.repartition(7), changed.union(spark.createDataFrame([(10**9, 1), (None, 1), (5, None)], changed.schema)))
    assert np.array_equal(model[0], other[0]) and model[1] == other[1]
    assert toxicity.sample(docs, labels, 10).count() == 20


def test_odd_rows(spark):
    docs, labels = _corpus(spark, 60)
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "...", None), (4, "zugglomatic " * 50000, "d"),
                                 (4, "x", "e")], "doc_id long, text string, score string")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(odd.drop("score"), model).collect()
    assert len(got) == 5 and len({r.score for r in got[:3]}) == 1
    kept = toxicity.without_toxic(odd, docs, labels, threshold=2)
    assert kept.columns == odd.columns and kept.count() == 5
    assert toxicity.without_toxic(odd.limit(0), docs, labels).collect() == []
    one_class = toxicity.fit(docs, labels.withColumn("toxic", F.lit(0)))
    assert {round(r.score, 6) for r in toxicity.score(odd, one_class).toDF("a", "b", "c", "score").collect()} == {0.0}
    assert {round(r.score, 6) for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}


def test_scores_equal_a_dense_forward_pass():
    """Word by word and text by text in double precision, from the same numbers."""
    rng = np.random.default_rng(8)
    weights, bias = rng.normal(0, 3, toxicity.BUCKETS).astype(np.float32), 0.7
    texts = [b"", b" ,. ", "Ärger über ärger, x".encode(), b"a bb ccc dddd a bb", b"one", ("w%d " * 300 % tuple(range(300))).encode()]
    want = []
    for t in texts:
        margin, words = bias, toxicity.tokens(t)
        for w in words:
            buckets, bounds = toxicity.subwords([w])
            assert bounds.tolist() == [0, len(buckets)]
            margin += float(weights[buckets].astype(np.float64).mean()) / (len(words) + toxicity.PAD)
        want.append(1 / (1 + np.exp(-margin)))
    assert np.allclose(toxicity.scores(texts, weights, bias), want, rtol=1e-12)


def test_backward_is_the_transpose_of_forward():
    """The gradient's two sparse steps: sums over columns and over rows agree
    with a dense matrix."""
    rng = np.random.default_rng(2)
    bounds = np.array([0, 3, 4, 9, 10])
    columns, weights = rng.integers(0, 6, 10), rng.normal(size=10)
    m = toxicity._Mean(columns, bounds, weights, 6)
    dense = np.zeros((4, 6))
    for r, (a, b) in enumerate(zip(bounds, bounds[1:])):
        for j in range(a, b):
            dense[r, columns[j]] += weights[j]
    x, g = rng.normal(size=(3, 6)).astype(np.float32), rng.normal(size=(3, 4)).astype(np.float32)
    assert np.allclose(m.forward(x), x @ dense.T, atol=1e-5) and np.allclose(m.backward(g), g @ dense, atol=1e-5)
