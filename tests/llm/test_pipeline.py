import corpus_pipeline
from strata.llm import mixing, simhash, words
from strata.plans.inspect import count_nodes

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    """Every stage works on what the one before kept, its decisions take effect,
    and run() gives the last one's rows."""
    docs = words.table(spark, SF, "documents")
    columns, seen = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = words.stored(stage(spark, docs, SF), f"test-{name}")
        if i < 4:
            assert docs.columns == columns
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
        if name == "simhash_near_dedup":
            assert {r.doc_id for r in docs.collect()} == {
                r.component_id for r in simhash.components(before).collect()}
        if name == "source_mixing":
            copies = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
            got = [r.doc_id for r in docs.collect()]
            assert all(got.count(k) == n for k, n in copies.items())
    assert all(r.restored for r in docs.collect())
    assert docs.count() > 0 and len(seen) >= 200
    got = corpus_pipeline.run(spark, SF).select("doc_id", "sample", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, docs.select("doc_id", "sample", "ids_crc32").collect()))


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def _folder(spark, path, rows, labels):
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_odd_rows(spark, tmp_dir):
    """Null ids and texts, empty texts, repeated rows, ties and a long text go
    through every stage; what comes out decodes to what went in."""
    words_ = [f"word{i}" for i in range(300)]
    rows = [(i, " ".join(words_[i % 7:i % 7 + 40] + [f"own{i}x{j}" for j in range(30)]), "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(50, None, None, None, None), (51, "", "en", "s0", 0), (52, " \t ", "en", "s1", 3), (None, "no id at all", "en", "s0", 9),
             (53, "same text twice", "en", "s1", 5), (53, "same text twice", "en", "s1", 5), (54, "same text twice", "de", None, 5),
             (55, " ".join(f"long{i}" for i in range(20000)), "en", "s2", 7)]
    out = corpus_pipeline.run(spark, _folder(spark, tmp_dir, rows, [(i, 1, int(i % 9 == 0)) for i in range(40)])).collect()
    assert all(r.restored for r in out)
    ids = {r.doc_id for r in out}
    assert 55 in ids and 53 in ids and 54 not in ids  # one of equal texts stays, with its repeated rows
    assert ids <= {r[0] for r in rows}


def test_empty_table(spark, tmp_dir):
    assert corpus_pipeline.run(spark, _folder(spark, tmp_dir, [], [])).collect() == []


def test_near_copies_send_no_exploded_side_to_the_driver(spark, monkeypatch):
    """Variants are 64 rows of each fingerprint; Spark's estimate knows of one."""
    seen, stored = {}, simhash.stored
    monkeypatch.setattr(simhash, "stored", lambda df, name: seen.setdefault(name, df) and stored(df, name))
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    kept = stage(spark, words.table(spark, SF, "documents"), SF)
    assert count_nodes(seen["simhash-variants"], "SortMergeJoin") == 1
    assert count_nodes(seen["simhash-variants"], "BroadcastExchange") == 0
    assert 0 < kept.count() < 200
