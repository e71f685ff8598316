"""The language stage rejects by evidence that does not depend on the number of languages."""

import numpy as np

import corpus_pipeline
from curata.llm import langid

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, score int"


def _grams(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return np.unique(langid.grams(data, np.array([0, len(data)]))[0])


def test_short_texts_stay_and_unknown_ones_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = docs.where("lang = 'de'").first().text
    frame = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "123 !!", 5), (4, "Re.", 5), (5, "qzxv", 5), (6, "qzxv jkqw xxzq wvkj " * 20, 5), (7, known, 5)], SCHEMA)
    kept = langid.kept(frame, langid.fit(docs), corpus_pipeline.LEAST_LANGUAGE_SCORE)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 7] and kept.columns == frame.columns


def test_languages_that_share_n_grams_keep_their_texts(spark):
    text = "many related languages have these words alike"
    codes = _grams(text)
    frame = spark.createDataFrame([(1, text, 5), (2, "qzxv jkqw xxzq wvkj " * 20, 5), (3, "qz", 5)], SCHEMA)
    for n in (1, 2, 3, 12, 70):
        filters = langid.Filters({f"l{i}": (codes, np.ones(len(codes), int)) for i in range(n)})
        assert sorted(r.doc_id for r in langid.kept(frame, filters, corpus_pipeline.LEAST_LANGUAGE_SCORE).collect()) == [1, 3]


def test_without_languages_all_texts_with_letters_stay(spark):
    frame = spark.createDataFrame([(1, "some words that no language was learnt for", 5), (2, "12", 5)], SCHEMA)
    nothing = langid.Filters({langid.UNKNOWN: (np.zeros(0, np.uint64), np.zeros(0, np.int64))})
    assert [r.doc_id for r in langid.kept(frame, nothing, corpus_pipeline.LEAST_LANGUAGE_SCORE).collect()] == [1]
