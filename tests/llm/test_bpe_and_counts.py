import base64
import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import PATTERN, path

from curata.llm import bpe, queries, token_count
from curata.llm.buffers import texts
from curata.llm.pieces import Encoder, PieceTable, cut

RANKS, VOCABULARY = path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json")
ALPHABET = ["a", "b", "'s", "'re", "'", "'ll", "'t", " ", "  ", "\n", "\t", "1", "²", "é", "ß", "中", "!", "***", "😀", "́", "<|endoftext|>", "<|", "|>", "endoftext", "the", " The", "'S", "\x1c", "\r\n", "०", "\x00"]
LONG = ["a" * 5000, "ab" * 3000, " " * 3000, "=" * 999, "aaaaabaaab" * 200, "x" * 300 + "y" * 300]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def mixed_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 25))) for _ in range(n)] + LONG + ["", None]


def encode_all(rows):
    data, offsets = texts(pa.array(rows, pa.string()))
    ids, per = bpe.encoded(RANKS, data, offsets)
    return np.split(ids, np.cumsum(per)[:-1])


def test_ids_and_bytes_as_the_library(reference):
    rows = mixed_texts(1500, 1)
    ranks, _ = bpe.codec(RANKS)
    for text, ids in zip(rows, encode_all(rows), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text or "")
        assert ranks.decode(ids) == (text or "").encode()
        assert bpe.decimal_line(ids) == " ".join(map(str, ids)).encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), max_size=6))
def test_any_text(reference, rows):
    assert [x.tolist() for x in encode_all(rows)] == [reference.encode_ordinary(x) for x in rows] if rows else True


def counts_of(rows):
    encoder = token_count.counter(VOCABULARY)
    data, offsets = texts(pa.array(rows, pa.string()))
    index, per = encoder(data, offsets)
    sums = np.concatenate([[0], np.cumsum(encoder.table.flat[index])])
    return np.diff(sums[np.concatenate([[0], np.cumsum(per)])]).tolist()


def test_counts_as_the_library(library):
    rows = mixed_texts(1500, 2)
    assert counts_of(rows) == [len(library.encode(x or "", add_special_tokens=False).ids) for x in rows]


def test_special_strings_cut_texts(library):
    rows = ["<|endoftext|>", "a <|endoftext|> b", "  <|endoftext|>", "<|endoftext|><|endoftext|>", "x'<|endoftext|>s", "<|<|endoftext|>|>"]
    assert counts_of(rows) == [len(library.encode(x, add_special_tokens=False).ids) for x in rows]


def test_pieces_do_not_cross_texts():
    data, offsets = texts(pa.array(["ab", "cd", "", " e", "'", "s"]))
    starts, per = cut(data, offsets)
    assert per.tolist() == [1, 1, 0, 1, 1, 1] and starts.tolist() == [0, 2, 4, 6, 7]


def thue_morse(bits=10):
    """A word of 2**bits letters and its complement: texts that polynomial hashes modulo 2**64 take for one."""
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_texts_that_weak_hashes_confuse(reference, library):
    rows = [*thue_morse(), *thue_morse(12)]
    assert [x.tolist() for x in encode_all(rows)] == [reference.encode_ordinary(x) for x in rows]
    assert counts_of(rows) == [len(library.encode(x, add_special_tokens=False).ids) for x in rows]


def test_long_pieces_whose_merges_meet(reference):
    rng, rows = random.Random(9), []
    for _ in range(400):
        unit = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 7)))
        other = "".join(rng.choices("etaoinshr", k=rng.randint(1, 5)))
        rows.append("".join(rng.choice([unit, unit, other]) for _ in range(120)) + "x" * 260)
    assert [x.tolist() for x in encode_all(rows)] == [reference.encode_ordinary(x) for x in rows]


def test_merges_wait_for_a_pair_of_lower_rank_that_comes_up_between_them():
    """In b a b a the pair b a (rank 300) makes, once merged on the left, 300 b of rank 299, which goes first."""
    ranks = object.__new__(bpe.Ranks)
    table = {(98, 97): 300, (300, 98): 299, (299, 97): 310}
    ranks.pair = lambda a, b: np.array([table.get((int(x), int(y)), bpe.NONE) for x, y in zip(a, b, strict=True)], np.int32)
    assert ranks.merge_long(np.array([98, 97, 98, 97], np.int32)).tolist() == [310]


def test_table_of_pieces():
    table, rng = PieceTable(bits=4), np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 2000).astype(np.uint64))
    same = np.full(len(keys), 7, np.uint64)
    table.add(keys[:1000], same[:1000], np.ones(1000, int), np.arange(1000, dtype=np.int32))
    table.add(keys[1000:], same[1000:], np.ones(len(keys) - 1000, int), np.arange(1000, len(keys), dtype=np.int32))
    assert table.flat[table.first[table.find(keys, same)]].tolist() == list(range(len(keys)))
    assert (table.find(keys + np.uint64(1), same) == -1).mean() > 0.99
    assert (table.find(keys, same + np.uint64(1)) == -1).all()  # one hash, another piece
    table.add(keys, same + np.uint64(1), np.ones(len(keys), int), np.arange(5000, 5000 + len(keys), dtype=np.int32))
    assert table.flat[table.first[table.find(keys, same + np.uint64(1))]].tolist() == list(range(5000, 5000 + len(keys)))
    assert table.flat[table.first[table.find(keys, same)]].tolist() == list(range(len(keys)))


def test_a_text_of_three_million_distinct_pieces():
    n = 3_000_000
    data, offsets = texts(pa.array([" ".join(map(str, range(10**6, 10**6 + n)))]))
    encoder = Encoder(lambda pieces: (np.ones(len(pieces), int), np.array([int(x) for x in pieces], np.int32)))
    index, per = encoder(data, offsets)
    assert per.tolist() == [n] and (encoder.table.flat[encoder.table.first[index]] == np.arange(10**6, 10**6 + n)).all()


def test_queries_over_the_smallest_tables(spark, reference, library):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op1_byte_bpe(spark, sf).collect():
        ids = reference.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())
    for r in queries.op8_token_counts(spark, sf).collect():
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)


def test_general_interface(spark):
    frame = spark.createDataFrame([(1, "a b", "x"), (2, None, "y"), (2, "", "z")], "doc_id long, text string, ids string")
    ids = bpe.encode(frame, RANKS)
    assert sorted((r.doc_id, len(r.ids)) for r in ids.collect()) == [(1, 2), (2, 0), (2, 0)]
    assert sorted((r.doc_id, bytes(r.decoded)) for r in bpe.decode(ids, RANKS).collect()) == [(1, b"a b"), (2, b""), (2, b"")]
    assert bpe.round_trip_digests(frame.where("false"), RANKS).count() == 0
    assert token_count.token_counts(frame, VOCABULARY, 1).orderBy("doc_id", "n_bytes").collect()[0].over_limit
