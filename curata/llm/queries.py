"""The opN_ queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from curata.llm import backoff, bpe, centroids, cover_tree, digest, langid, minhash, mixing, packing, prefix_trie, quality, token_count, token_store

RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"


def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark, sf_dir):
    return bpe.round_trip_digests(_documents(spark, sf_dir), public_tokenizers.path(RANKS))


def op2_cover_tree(spark, sf_dir):
    return cover_tree.links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.9)


def op3_language_id(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_fingerprints(spark, sf_dir):
    return digest.with_next(_documents(spark, sf_dir))


def op5_backoff(spark, sf_dir):
    found = backoff.score(_documents(spark, sf_dir), order=3, alpha=0.4, least=2)
    return found.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log", 6).alias("mean_log"))


def op6_quality(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    found = quality.score(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return found.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op7_mixing(spark, sf_dir):
    return mixing.mix(_documents(spark, sf_dir), max_epochs=3, seed=7)


def op8_token_counts(spark, sf_dir):
    return token_count.token_counts(_documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), limit=1024)


def op9_token_store(spark, sf_dir):
    return token_store.stored(_documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), end_id=2)


def op10_minhash(spark, sf_dir):
    return minhash.near_duplicates(_documents(spark, sf_dir), percent=75)


def op11_packing(spark, sf_dir):
    return packing.pack(_documents(spark, sf_dir), public_tokenizers.path(WORD_VOCABULARY), end_id=1, capacity=2048, with_ids=False)


def op12_centroids(spark, sf_dir):
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=16, rounds=3, dims=64, scale=64, seed=1)


def op13_prefix_trie(spark, sf_dir):
    turns, ids = prefix_trie.rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet"), family=20, shared=4)
    return prefix_trie.trie(turns, ids, ["part", "i"])


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_cover_tree, op3_language_id, op4_fingerprints, op5_backoff, op6_quality, op7_mixing, op8_token_counts, op9_token_store, op10_minhash, op11_packing, op12_centroids, op13_prefix_trie)}
ORACLE_SQL: dict[str, str] = {"op2_cover_tree": cover_tree.ORACLE, "op5_backoff": backoff.ORACLE, "op10_minhash": minhash.ORACLE, "op12_centroids": centroids.ORACLE, "op13_prefix_trie": prefix_trie.ORACLE}
