import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path

from curata.llm import packing

VOCABULARY = path("word_bpe_49k.json")
CASES = [
    (5, "The quick brown fox " * 900), (1, None), (9, ""), (3, "a <|endoftext|> b <|ENDOFTEXT|>x<|startoftext|>"), (4, "don't they'll IT'S x's'y 1234 --a--b≠   éÅ ÅΣΣ İ"),
    (7, "x" * 9000), (2, "one\n\ntwo\t\x0b three\x1cfour\x85five​six"), (8, "The quick brown fox " * 900), (8, "again"), (None, "no id"), (None, None), (6, " \n "), (10, "日本語 テキスト 漢字仮名 " * 50), (11, "ﬁ ﬀ ǅ ẞ \U0001f600‍\U0001f600"),
]


def ids_of(text):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids, 1]


def checked(rows, texts, capacity=2048):
    """Holds the pieces against the library's ids of every text: each id in one piece, sequences without gaps."""
    want, of, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for key, text in texts:
        want[key].append(ids_of(text))
    for r in rows:
        of[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert of.keys() == want.keys()
    for key, pieces in of.items():
        got = sorted((p.doc_tokens, p.start, p.length, p.ids_crc32) for p in pieces)
        options = defaultdict(list)
        for ids in want[key]:
            options[len(ids)].append(ids)
        for total, lists in options.items():
            own = [x for x in got if x[0] == total]
            assert sum(x[2] for x in own) == total * len(lists)
            for _, start, length, crc in own:
                assert any(zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()) == crc for ids in lists)
            covered = np.zeros(total + 1, int)
            for _, start, length, _ in own:
                covered[start : start + length] += 1
            assert (covered[:total] == len(lists)).all()
    padding = 0
    for pieces in sequences.values():
        end = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == end and p.length > 0
            end += p.length
        assert end <= capacity
        padding += 0 if end & (end - 1) == 0 else capacity - end
    return padding


def test_every_id_lies_in_one_piece(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in CASES], "doc_id long, text string, start string, ids int").repartition(3)
    packed = packing.pack(docs, VOCABULARY)
    rows = packed.collect()
    assert checked(rows, CASES) == 0
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id].ids[r.offset : r.offset + r.length] == r.ids and r.offset + r.length in whole[r.sequence_id].ends


def test_digests_need_no_ids(spark):
    docs = spark.createDataFrame(CASES, "doc_id long, text string").repartition(2)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    key = lambda r: tuple((x is not None, x) for x in r)
    a, b = (sorted(packing.pack(docs, VOCABULARY, with_ids=w).select(*names).collect(), key=key) for w in (True, False))
    assert a == b


def test_an_empty_table_gives_no_piece(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).collect() == []


def test_all_documents_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert checked(packing.pack(docs, VOCABULARY, with_ids=False).collect(), [(r.doc_id, r.text) for r in docs.collect()]) == 0


def test_one_row_over_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_BYTES", 4000)
    rows = packing.pack(spark.createDataFrame(CASES, "doc_id long, text string"), VOCABULARY, with_ids=False).collect()
    assert checked(rows, CASES) == 0
    assert len({r.sequence_id >> 32 for r in rows if r.doc_id == 5}) > 1


@pytest.mark.parametrize("seed", range(20))
def test_pieces_go_to_the_cheapest_sequence_with_room(seed):
    random.seed(seed)
    lengths = np.array(sorted((random.choice([random.randint(1, 64), random.randint(1, 5), 64]) for _ in range(random.randint(0, 60))), reverse=True), np.int64)
    piece, begin, length, sequence, offset, cost = packing.placed(lengths, 64, 1.0, 0.01)
    room, spent, at = packing.capacities(int(lengths.sum()), 64).tolist(), [0.0] * len(cost), 0
    full = list(room)
    for p, n in enumerate(lengths.tolist()):  # the rule, told plainly
        start = 0
        while start < n:
            fits = [s for s in range(len(room)) if room[s] >= n - start]
            s = min(fits, key=lambda s: (spent[s], s)) if fits else max(range(len(room)), key=lambda s: (room[s], -s))
            part = min(room[s], n - start)
            assert (piece[at], begin[at], length[at], sequence[at], offset[at]) == (p, start, part, s, full[s] - room[s])
            room[s], spent[s], start, at = room[s] - part, spent[s] + part + 0.01 * part * part, start + part, at + 1
    assert at == len(piece) and not any(room)
    assert np.allclose(cost, spent)
