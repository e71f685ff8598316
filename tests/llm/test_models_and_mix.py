import binascii
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from curata.llm import langid, minhash, mixing, quality, queries

SF = "/root/testdata/sf0.01"


def crc(i):
    return binascii.crc32(str(i).encode())


def test_language_of_held_out_documents(spark):
    got = {r.doc_id: r for r in queries.op3_language_id(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    assert all(got[r.doc_id].held_out == (crc(r.doc_id) % 4 == 2) and 0 <= got[r.doc_id].score <= 1 for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) > 0.97 * len(held) > 100


def test_language_edge_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    filters = langid.fit(docs)
    frame = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "123 !!", 5), (4, "a", 5), (5, "é", 5), (None, "the of and", 5), (7, "the of and " * 20000, 5), (7, "the", 5)], "doc_id long, text string, score int")
    rows = langid.identify(frame, filters).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    assert [r.lang_pred for r in rows if r.doc_id in (1, 2, 3)] == ["und"] * 3
    assert all(r.lang_pred == "en" for r in rows if r.doc_id in (4, 5, None))
    nothing = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.identify(frame, nothing).collect()} == {"und"}
    assert langid.identify(frame.where("false"), filters).count() == 0


def test_masks_name_all_languages():
    import numpy as np

    names = [f"l{i}" for i in range(70)]  # more than one word of bits
    codes = {n: np.arange(i * 50, i * 50 + 200).astype(np.uint64) for i, n in enumerate(names)}
    filters = langid.Filters({n: (c, np.ones(len(c), int)) for n, c in codes.items()})
    for i, n in enumerate(names):
        assert (filters.masks(codes[n])[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).all()
    other = filters.masks(np.arange(10**6, 10**6 + 5000).astype(np.uint64))
    share = (other[:, 0] & np.uint64(1)).mean()
    assert abs(share - filters.rate[0]) < 0.01


def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = {r.doc_id: r for r in queries.op6_quality(spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (crc(i) % 5 == 0) and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [i for i in labels if got[i].held_out]
    assert sum(got[i].predicted == labels[i] for i in held) > 0.95 * len(held) > 50


def test_quality_edge_cases(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels.union(spark.createDataFrame([(None, 1, 1), (5, None, 0), (6, 0, 0)], labels.schema)))
    frame = spark.createDataFrame([(1, None, 5), (2, "", 5), (2, "!", 5), (None, "the of", 5), (9, "THE!! " * 30000, 5)], "doc_id long, text string, predicted int")
    rows = quality.score(frame, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert [r.predicted for r in rows if r.doc_id == 9] == [0]
    none = quality.fit(docs, labels.where("false"))
    assert {r.score for r in quality.score(frame, none).collect()} == {0.5}
    assert quality.score(frame.where("false"), model).count() == 0


def water(sizes, weights, most=3):
    """Targets by repeated clamping and resharing."""
    total, fixed = float(sum(sizes)), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest, weight = total - sum(fixed.values()), sum(weights[i] for i in free)
        over = [i for i in free if rest * weights[i] / weight > most * sizes[i]]
        if not over:
            return [fixed[i] if i in fixed else rest * weights[i] / weight for i in range(len(sizes))]
        fixed |= {i: most * sizes[i] for i in over}


@pytest.mark.parametrize("seed", range(3))
def test_mix(spark, seed):
    rng = random.Random(seed)
    names = [None, "a", "B", "ä", "z", "", "hot", "dry"]
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(0 if s == "dry" else rng.choice([1, 3, 20, 200]))) if rng.random() < 0.95 else None, s, 1) for i in range(900) for s in [rng.choices(names, [1, 1, 3, 2, 1, 1, 9, 1])[0]]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size int").repartition(4)
    got = mixing.mix(frame, seed=seed).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _, _ in rows}
    order = sorted({s for _, _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    totals = [sum(size[i] for i, _, s, _ in rows if s == o) for o in order]
    want = dict(zip(order, water(totals, [k % 3 + 1 for k in range(len(order))]), strict=True))
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert r.size == size[r.doc_id] and abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source]) and r.taken == r.size * r.repetitions <= 3 * r.size
        assert r.source_size == totals[order.index(r.source)]
        taken[r.source] += r.taken
    assert all(abs(taken[o] - want[o]) <= 100 for o in order)
    assert sorted(got) == sorted(mixing.mix(frame.repartition(7), seed=seed).collect())
    assert sorted(r.doc_id for r in mixing.apply(frame, seed=seed).collect()) == sorted(r.doc_id for r in got for _ in range(r.repetitions))


@pytest.mark.parametrize("ids", ["null", "one", "same rows"])
def test_mix_of_rows_without_ids_of_their_own(spark, ids):
    """A source of 1,000 rows that no doc_id tells apart comes near its target, in the mix and in what is counted."""
    text = (lambda i: "w " * 10) if ids == "same rows" else (lambda i: "w " * 10 + f"{i}")
    rows = [(None if ids == "null" else 5, text(i), "a") for i in range(1000)] + [(10 + i, "v " * 11, "b") for i in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(frame).collect()
    for source in ("a", "b"):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 11
    assert mixing.apply(frame).groupBy("source").count().collect() != [] and {r["source"]: r["count"] for r in mixing.apply(frame).groupBy("source").count().collect()} == {s: sum(r.repetitions for r in got if r.source == s) for s in ("a", "b")}


def test_mix_without_rows_or_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).count() == 0 == mixing.apply(empty).count()
    blank = spark.createDataFrame([(1, None, None), (1, " ", "a"), (None, "", "b")], empty.schema)
    assert {(r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0.0, 0)}


def test_pipeline_against_its_parts(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    out = corpus_pipeline.run(spark, sf).collect()
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))).collect()}
    one = docs.where(F.col("doc_id").isin([i for i, s in scores.items() if s >= 0.3]))
    languages = {r.doc_id: r for r in langid.identify(one, langid.fit(one)).collect()}
    two = one.where(F.col("doc_id").isin([i for i, r in languages.items() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_LANGUAGE_SCORE]))
    from test_minhash import brute

    groups = brute([(r.doc_id, r.text) for r in two.collect()])
    three = two.where(F.col("doc_id").isin([i for i, (_, c) in groups.items() if i == c]))
    mix = {r.doc_id: r.repetitions for r in mixing.mix(three).collect()}
    assert sorted(r.doc_id for r in out) == sorted(i for i, n in mix.items() for _ in range(n))
    assert all(len(r.ids) == r.n_tokens for r in out) and len(out) > 100


def test_pipeline_stages_keep_columns(spark):
    """Also those whose names helper columns might have."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({"score": F.lit(1), "_letters": F.lit("x"), "_mix_k": F.lit(77), "_mix_n": F.col("doc_id") * 2, "text_key": F.lit(1), "_key": F.lit(2), "_id": F.lit(3), "_times": F.lit(4), "__copy": F.lit(5)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert all((r._letters, r._mix_k, r._mix_n, r._id, r._times) == ("x", 77, 2 * r.doc_id, 3, 4) for r in out.collect())
    rows = docs.limit(3).union(docs.limit(1).select(*[F.lit(None).cast(f.dataType) for f in docs.schema]))
    assert minhash.deduplicated(rows).count() == 4
