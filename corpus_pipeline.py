"""From documents to token ids: quality, language, near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. ``run``
writes what a stage returns to the shared folder and reads it for the next, so a lost
executor costs one stage's tasks at most. Results of null, empty, repeated and very long
texts are those that the operators' docstrings state.
"""

from __future__ import annotations

import public_tokenizers

from curata.functions.storage import written
from curata.llm import bpe, langid, minhash, mixing, quality

RANKS = "byte_bpe_50k.tiktoken"
LEAST_LANGUAGE_SCORE = 0.2


def by_quality(spark, docs, sf_dir):
    """Documents whose neighbours' vote is below the threshold go."""
    return quality.kept(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def by_language(spark, docs, sf_dir):
    """Documents without a letter, or with enough n-grams of which no language contains LEAST_LANGUAGE_SCORE, go."""
    return langid.kept(docs, langid.fit(docs), LEAST_LANGUAGE_SCORE)


def without_near_duplicates(spark, docs, sf_dir):
    """Of each group of near duplicates the document with the least doc_id stays."""
    return minhash.deduplicated(docs, percent=75)


def mixed(spark, docs, sf_dir):
    """Documents stand as often as the mix of sources repeats them; those it leaves out go."""
    return mixing.apply(docs, max_epochs=3, seed=7)


def encoded(spark, docs, sf_dir):
    """doc_id, n_tokens, ids, ids_sha256 and decoded_sha256 of every row of the mix."""
    return bpe.encoded_and_decoded(docs, public_tokenizers.path(RANKS))


STAGES = [("quality classifier", by_quality), ("language ID", by_language), ("MinHash near-dedup", without_near_duplicates), ("mixing sources", mixed), ("byte-level BPE", encoded)]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
