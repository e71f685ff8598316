"""Slices that hold one short text only, and rows that repeat."""

import numpy as np
import pytest

from curata.llm import minhash


@pytest.mark.parametrize("text", ["", "one", "one two", "one two three", "a b c d", "a b c d e"])
def test_a_slice_of_one_short_text(text):
    data = text.encode()
    alone = minhash.shingle_sets(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    both = data + b"some other text of seven words here"
    beside = minhash.shingle_sets(np.frombuffer(both, np.uint8), np.array([0, len(data), len(both)]))
    assert len(alone) == 1 and len(alone[0]) == bool(text) and (alone[0] == beside[0]).all()


@pytest.mark.parametrize("text", ["one", "one two", "one two three", "a b c d", "a b c d e", "a b c d e f"])
def test_a_table_of_one_short_document(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.text for r in minhash.deduplicated(docs).collect()] == [text]


LONG, OTHER = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))


def test_rows_with_one_doc_id_are_documents_of_their_own(spark):
    rows = [(3, LONG), (5, LONG), (5, OTHER), (7, OTHER + " more"), (7, None), (7, ""), (None, LONG), (None, LONG)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert found == sorted([(3, 56, 3, True), (5, 56, 3, False), (5, 56, 5, True), (7, 57, 5, False), (7, 0, 7, True), (7, 0, 7, True), (0, 56, 0, True), (0, 56, 0, True)])
    left = sorted((r.doc_id or 0, r.text or "") for r in minhash.deduplicated(docs).collect())
    assert left == sorted([(3, LONG), (5, OTHER), (7, ""), (7, ""), (0, LONG), (0, LONG)])


@pytest.mark.parametrize("texts", [[LONG] * 5, [LONG, LONG + " x", LONG + "  x", LONG]])
def test_of_repeated_rows_one_stays(spark, texts):
    docs = spark.createDataFrame([(5, t, i) for i, t in enumerate(texts)], "doc_id long, text string, text_key int").repartition(3)
    found = minhash.near_duplicates(docs).collect()
    assert [(r.component_id, r.kept) for r in found] == [(5, True)] * len(texts)
    left = minhash.deduplicated(docs)
    assert left.columns == docs.columns and left.count() == 1


def test_links_between_rows_of_one_doc_id_and_others(spark):
    """Both texts of doc 9 have a near copy; neither copy may be lost or joined with the other."""
    rows = [(9, LONG), (9, OTHER), (4, LONG + " a"), (6, OTHER + " b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()) == [(4, 4), (6, 6), (9, 4), (9, 6)]
    assert sorted((r.doc_id, r.text) for r in minhash.deduplicated(docs).collect()) == [(4, LONG + " a"), (6, OTHER + " b")]


def test_texts_that_weak_hashes_confuse():
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    data = (word + word.translate(str.maketrans("ab", "ba"))).encode()
    one, two = minhash.shingle_sets(np.frombuffer(data, np.uint8), np.array([0, 1024, 2048]))
    assert one.tolist() != two.tolist()
