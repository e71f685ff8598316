"""The language and quality queries against plain Python over the smallest tables."""

import binascii
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from curata.llm import langid, quality, queries
from curata.llm.buffers import span_hashes

SF = "/root/testdata/sf0.001"


def crc(i):
    return binascii.crc32(str(i).encode())


def plain_grams(text):
    """4 bytes at a time of the text with letters in lower case and runs of all else below U+0080 as one blank."""
    raw = bytearray((text or "").encode())
    for k, c in enumerate(raw):
        if c < 128:
            raw[k] = ord(chr(c).lower()) if chr(c).isalpha() else 32
        elif k and raw[k - 1] == 0xC3 and 0x80 <= c <= 0x9E:
            raw[k] = c + 32
    folded = re.sub(rb" +", b" ", bytes(raw))
    return [folded[k : k + 4] for k in range(len(folded) - 3)]


def test_grams():
    for text in ("The  QUICK,brown", "Été ÀÉ!! x", "ab", "", "123 456", " a b "):
        data = text.encode()
        codes, _ = langid.grams(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        assert [int(c).to_bytes(4, "big") for c in codes] == plain_grams(text)


def test_languages_as_with_exact_sets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    counts: dict = defaultdict(Counter)
    known = Counter(r.lang for r in docs if r.lang is not None and crc(r.doc_id) % 4 != 2)
    for r in docs:
        if r.lang is not None and crc(r.doc_id) % 4 != 2:
            counts[r.lang].update(plain_grams(r.text))
    counts = {x: {g: n / sum(c.values()) for g, n in c.items() if n >= langid.FLOOR * sum(c.values())} for x, c in counts.items()}
    shares = {x: {g: n / sum(c.values()) for g, n in c.items()} for x, c in counts.items()}
    sets = {x: {g for g, n in c.items() if n >= langid.SHARE * max(o.get(g, 0) for o in shares.values())} for x, c in shares.items()}
    order = sorted(known, key=lambda x: (-known[x], x))
    got = {r.doc_id: r for r in queries.op3_language_id(spark, SF).collect()}
    assert len(got) == len(docs)
    near = 0
    for r in docs:
        grams = plain_grams(r.text)
        hits = {x: sum(g in sets[x] for g in grams) for x in order}
        best = max(order, key=lambda x: (hits[x], -order.index(x))) if re.search(r"[^\W\d_]", r.text or "") else "und"
        row = got[r.doc_id]
        clear = best == "und" or hits[best] > 1.05 * max([0, *(n for x, n in hits.items() if x != best)]) + 2  # beyond the filters' noise
        assert row.lang_pred == best or not clear
        near += row.lang_pred == best
    assert near > 0.99 * len(docs)


def plain_terms(text):
    """quality.terms of one text, a byte and a word at a time."""
    out = np.zeros(quality.TERMS)
    raw = (text or "").encode()
    kind = [1 if c in b" \t\r" else 4 if 48 <= c < 58 else 3 if 65 <= c < 91 else 2 if 97 <= c < 123 or c > 127 else c + 8 for c in raw]
    for width, salt in ((2, 0x9E3779B1), (4, 0x85EBCA6B)):
        for k in range(len(raw) - width + 1):
            code = kind[k]
            for c in kind[k + 1 : k + width]:
                code = (code * 0x01000193 + c) & 0xFFFFFFFF
            out[(((code * salt) & 0xFFFFFFFF) >> 18) % (quality.SHAPES - 8)] += 1
    words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", raw)]
    for lag in (1, 2, 3):
        out[quality.SHAPES - lag] += sum(a == b for a, b in zip(words, words[lag:]))
    out[quality.SHAPES - 4] = len(words)
    for w in words:
        data = np.frombuffer(w, np.uint8)
        out[quality.SHAPES + int(span_hashes(data, np.array([0]), np.array([len(w)]))[0]) % quality.WORDS] += 1
    return out


def test_quality_as_with_exact_directions(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels: dict = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        labels[r.doc_id].append(r.quality)
    ids = sorted(i for i in labels if i in docs and crc(i) % 5 != 0)
    x = np.stack([plain_terms(t) for t in docs.values()])
    place = {i: k for k, i in enumerate(docs)}
    train = x[[place[i] for i in ids]]
    idf = np.log((1 + len(train)) / (1 + (train > 0).sum(axis=0))) + 1
    idf[quality.SHAPES - 3 : quality.SHAPES] *= quality.REPEATS

    def weigh(counts):
        parts = []
        for a, b, w in quality.KINDS:
            v = np.log1p(counts[:, a:b] * 1000 / np.maximum(1, counts[:, a:b].sum(axis=1, keepdims=True))) * idf[a:b]
            parts.append(w * v / np.maximum(1e-9, np.linalg.norm(v, axis=1, keepdims=True)))
        v = np.concatenate(parts, axis=1)
        return v / np.maximum(1e-9, np.linalg.norm(v, axis=1, keepdims=True))

    _, _, directions = np.linalg.svd(weigh(train), full_matrices=False)
    latent = lambda v: (z := v @ directions[: quality.LATENT].T) / np.maximum(1e-9, np.linalg.norm(z, axis=1, keepdims=True))
    base, y = latent(weigh(train)), np.array([float(np.mean(labels[i]) > 0.5) for i in ids])
    got = {r.doc_id: r for r in queries.op6_quality(spark, SF).collect()}
    assert got.keys() == docs.keys()
    off = []
    for i, cosine in zip(docs, latent(weigh(x)) @ base.T, strict=True):
        near = np.argsort(-cosine, kind="stable")[: quality.NEIGHBOURS]
        weight = np.exp(8 * (cosine[near] - 1))
        score = (weight * y[near]).sum() / weight.sum()
        off.append(abs(score - got[i].score))
        assert got[i].predicted == (got[i].score >= 0.3)
    assert np.quantile(off, 0.9) < 0.02 and np.mean(off) < 0.02  # the iteration's directions are nearly the exact ones


def test_language_of_rows_that_share_a_doc_id(spark):
    """Each row teaches its own text under its own lang, a copy of a row nothing more."""
    english, french = (["the night was long and we walked through the old town"], ["la nuit fut longue et nous marchions dans la vieille ville"])
    rows = [(1, english[0] + f" number {i}", "en") for i in range(300)] + [(1, french[0] + f" chiffre {i}", "fr") for i in range(300)] + [(1, french[0], "fr")] * 300 + [(2, None, "en"), (3, "", None), (None, english[0], "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    found = langid.identify(docs.withColumn("doc_id", F.when(F.col("lang") == "en", 1).otherwise(2)), langid.fit(docs, learnt_from=lambda i: F.lit(True)))
    assert {(r.doc_id, r.lang_pred) for r in found.where("score > 0").distinct().collect()} == {(1, "en"), (2, "fr")}
