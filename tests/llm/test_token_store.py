import os
import zlib

import numpy as np
import pytest
from public_tokenizers import path

from curata.functions.storage import new_folder
from curata.llm import token_store as store

VOCABULARY = path("byte_bpe_50k.json")


def expected(rows):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    out, start = {}, 0
    for doc_id, text in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    return out


CASES = [(5, "the quick brown fox " * 400), (1, None), (9, ""), (3, "a <|endoftext|> b"), (4, "the quick brown fox " * 400 + "!"), (7, "x" * 9000), (2, "one\n\ntwo  three"), (8, "the quick brown fox " * 400)]


def test_store_reads_back_what_the_library_gives(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in CASES], "doc_id long, text string, start string").repartition(3)
    folder = new_folder(spark, "store")
    store.write_store(docs, VOCABULARY, folder)
    want = expected(CASES)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in store.read_digests(spark, folder).collect()}
    assert got == {k: v[:3] for k, v in want.items()}
    assert {r.doc_id: list(r.ids) for r in store.read_ids(spark, folder).collect()} == {k: v[3] for k, v in want.items()}
    chunks = spark.read.parquet(f"{folder}/objects/kind=chunk")
    assert chunks.count() == chunks.select("digest").distinct().count() < spark.read.parquet(f"{folder}/objects/kind=ref").count()


def test_a_missing_chunk_is_noticed(spark):
    folder = new_folder(spark, "store")
    store.write_store(spark.createDataFrame(CASES, "doc_id long, text string"), VOCABULARY, folder)
    kept = spark.read.parquet(f"{folder}/objects/kind=chunk").orderBy("digest").collect()[1:]
    spark.createDataFrame(kept, "digest binary, payload binary, doc_id long, row long, seq int, n int").write.mode("overwrite").parquet(f"{folder}/objects/kind=chunk")
    with pytest.raises(Exception, match="chunks missing"):
        store.read_digests(spark, folder)


def test_no_documents_and_equal_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert store.stored(empty, VOCABULARY).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = store.stored(twice, VOCABULARY).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows] == [(1, 0, 3), (1, 3, 3), (None, 6, 2)]


def test_cuts_follow_content():
    ids = np.random.default_rng(1).integers(0, 50_000, 20_000)
    a, b = store.cuts(ids), store.cuts(np.concatenate([[7, 8, 9], ids]))
    assert a[-1] == 20_000 and np.diff(a).max() <= store.MOST and np.diff(a)[:-1].min() >= store.LEAST
    assert len(set(a) & set(b - 3)) > 0.8 * len(a)
    assert store.cuts(np.zeros(5000, int))[-1] == 5000


def test_crc_of_parts():
    rng = np.random.default_rng(2)
    parts = [rng.bytes(int(n)) for n in rng.integers(1, 3000, 40)]
    per = np.array([1, 9, 30])
    got = store.joined_crc32(np.array([zlib.crc32(p) for p in parts]), np.array([len(p) for p in parts]), per)
    want = [zlib.crc32(b"".join(x)) for x in (parts[:1], parts[1:10], parts[10:])]
    assert got.tolist() == want
