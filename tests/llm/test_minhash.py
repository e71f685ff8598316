import random
import re

import numpy as np

from curata.llm import minhash


def brute(rows, percent=75):
    """(n_shingles, component) by comparing every pair of full sets."""
    sets = {}
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = sorted((root(a), root(b)))
                label[rb] = ra
    return {i: (len(sets[i]), root(i)) for i in ids}


def made(n=160, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 6)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((i, " ".join(words)))
        else:
            rows.append((i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 5, 40, 120, 200])))))
    return rows


def result(spark, rows):
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, band string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame.repartition(3)).collect()}


def test_as_brute_force(spark):
    rows = made() + [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "A b"), (1004, "a  B"), (1005, "a b c"), (1006, "é É"), (1007, "é É"), (1008, "x y z")]
    assert result(spark, rows) == brute(rows)


def test_tables_as_they_are(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()} == brute(rows)


def test_no_documents(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_groups_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = made(200, seed=8)
    assert result(spark, rows) == brute(rows)


def test_estimates():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 800).astype(np.uint64)
    for share in (0.0, 0.5, 0.86, 1.0):
        k = int(800 * share)
        other = np.concatenate([base[:k], rng.integers(0, 2**63, 800 - k).astype(np.uint64)])
        a, b = (minhash.signature(minhash.minima(np.unique(x))) for x in (base, other))
        est = float(minhash.estimate(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)))
        assert abs(est - k / (1600 - k)) < 0.2
        assert abs(minhash._fast_estimate(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)[None, :])[0] - est) < 1e-9
