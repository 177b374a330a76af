import os
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strata.llm import queries, tokenstore

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows, end_id=2):
    """(key, start, n, crc) by encoding every whole text in key order."""
    t = Tokenizer.from_file(PATH)
    out, start = [], 0
    for k, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = t.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_whole_text_encoding(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op5_token_store"](spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


ODD = ["", " ", "á b́", "́x ́", "it's WE'LL  'S 'll", "<|endoftext|> a<|startoftext|>b <|endof text|>",
       "İstanbul ΑΣ ΣΑΣ ß ﬁ", "x\x0by\x0cz\r\n\t w\x1cq\x85r s t", "日本語 テスト 123 ４５ ²", "👩‍👩‍👧 a.b,c!?  ..", "ȩ́ q̧́",
       "가 각", "\x00 \x7f", "longword" * 300, "End. Two, a.. b,. C.́ é. 9. X.<|endoftext|> y.", "A.\x1c b,\u2003c.\u0085d."]


def test_word_by_word_equals_whole_text():
    rng = random.Random(5)
    chars = ".,aé́ \n\t'sSLl.!1٣²<|>ßİΣ日‍ \x0b"
    texts = ODD + ["".join(rng.choice(chars) for _ in range(60)) for _ in range(400)]
    t = Tokenizer.from_file(PATH)
    got = tokenstore.Encoder(PATH)([x.encode() for x in texts])
    for x, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u2").tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


def test_cache_is_bounded_in_bytes_and_let_go(monkeypatch):
    monkeypatch.setattr(tokenstore, "CACHE_BYTES", 10 * 210)
    e = tokenstore.Encoder(PATH)
    texts = [" ".join(f"w{i}" for i in range(j, j + 6)).encode() for j in range(30)] + [b"x" * 5000, b"y" * 65]
    assert [e([t])[0] for t in texts] == tokenstore.Encoder(PATH)(texts)
    assert len(e.known) <= 12 and 0 < len(e.known.older) <= 12
    assert all(len(w) <= tokenstore.LONGEST for w in [*e.known, *e.known.older])
    e.forget()
    assert not e.known and not e.known.older


def test_plain_words_are_cut_as_the_patterns_do():
    rng = random.Random(9)
    t, e = Tokenizer.from_file(PATH), tokenstore.Encoder(PATH)
    for _ in range(4000):
        w = "".join(rng.choice("''stlldrevm19.,!?-_<|>{}~`^aZéßÿÀÞ÷×¿ñÜ") for _ in range(rng.randrange(1, 9)))
        assert np.frombuffer(e([w.encode()])[0], "<u2").tolist() == t.encode(w, add_special_tokens=False).ids, w


def test_odd_rows_round_trip(spark):
    rows = [(i * 3, x) for i, x in enumerate(ODD)] + [(None, None), (None, "null key"), (7, None), (6, "again"), (6, "again"),
                                                     (6, "Again two"), (10**12, "far"), (-5, "below")]
    docs = spark.createDataFrame([(*r, "p", "k") for r in rows], "doc_id long, text string, path string, k string")
    folder = tokenstore.shared_folder(spark, "t")
    manifest = tokenstore.write(docs, folder, PATH, 2, shard_rows=4)
    assert manifest.agg({"rows": "sum"}).first()[0] == len(rows)
    found = tokenstore.checksums(tokenstore.read(manifest, docs.select("doc_id")))
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == brute(rows)
    some = spark.createDataFrame([(6,), (6,), (999,), (None,)], "id long")
    assert sorted(str(r[0]) for r in tokenstore.read(manifest, some).collect()) == ["6", "6", "6", "6", "None", "None"]
    local = folder.replace("file:", "")
    shards = manifest.collect()
    for s in shards:
        assert os.path.getsize(f"{local}/{os.path.basename(s.path)}.bin") == 2 * s.ids
        shard = tokenstore.Shard(s.path)
        assert sum(map(len, shard.ranges(list(range(5000, 9000))))) == 0  # fingerprints turn strangers away
        assert all(shard.ranges([s["first"], s["last"]]))
    pieces = tokenstore.checksums(tokenstore.read(manifest, docs.select("doc_id"), routes=2))
    assert sorted(map(tuple, pieces.collect()), key=lambda r: r[1]) == brute(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    manifest = tokenstore.write(docs, tokenstore.shared_folder(spark, "t"), PATH, 2)
    assert manifest.collect() == [] and tokenstore.read(manifest, docs.select("doc_id")).collect() == []


def test_perfect_hash_is_minimal():
    for n in (1, 2, 63, 5000):
        hashes, _ = tokenstore.key_hashes(list(range(n)))
        assert sorted(tokenstore.PerfectHash.build(hashes).places(hashes)) == list(range(n))
