import hashlib
import random

import numpy as np

from curata.llm import digest


def slow_features(data: bytes) -> int:
    """Places of a text's features, a window at a time."""
    w = digest.WINDOW
    n = len(data) - w + 1
    rank = []
    for i in range(max(0, n)):
        counts = np.bincount(np.frombuffer(data[i : i + w], np.uint8))
        pairs = int((counts * (counts - 1) // 2).sum())
        rank.append(0 if pairs > digest.WEAK else abs(pairs - digest.TYPICAL) + 1)
    points = [0] * len(rank)
    for i in range(len(rank)):
        near = rank[i : i + w]
        if max(near):
            points[i + near.index(max(near))] += 1
    return [i for i, p in enumerate(points) if p >= digest.POPULAR]


def made(seed, n=30):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäö", k=rng.randint(1, 9))) for _ in range(300)]
    return [" ".join(rng.choices(words, k=rng.choice([2, 15, 90, 700]))) for _ in range(n)]


def test_features_as_one_window_at_a_time():
    texts = [x.encode() for x in made(1, 12)] + [b"a" * 500, b"", b"x" * 64, b"short"]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    _, per = digest.features(np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert per.tolist() == [len(slow_features(x)) or (1 if x else 0) for x in texts]
    alone = [digest.rendered(digest.digests([x])[0]) for x in texts]
    assert alone == [digest.rendered(x) for x in digest.digests(texts)]


def test_likeness():
    a, b = made(2, 2)
    a, b = (a * 5)[:4000], "".join(random.Random(5).choices("qwertyuiop asdfgh", k=4000))
    da, db, half = digest.digests([a.encode(), b.encode(), (a[:2000] + b[:2000]).encode()])
    assert digest.likeness(da, da) == 1 and digest.likeness(da, db) < 0.15 < 0.25 < digest.likeness(da, half) < 0.95
    empty = digest.digests([b""])[0]
    assert digest.likeness(empty, empty) == 1 and digest.likeness(empty, da) == 0


def test_next_and_edited(spark):
    texts = made(3, 60)
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(500, None), (501, ""), (502, "é" * 7), (503, texts[4])]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, bucket string").repartition(5)
    got = {r.doc_id: r for r in digest.with_next(frame, buckets=7).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        new = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        d, e, f = digest.digests([t.encode(), new.encode(), following.encode()])
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(new.encode()).hexdigest(), digest.rendered(d), digest.rendered(e))
        assert (r.near_edited, r.near_next) == (digest.likeness(d, e), digest.likeness(d, f))
    assert {r.doc_id: r.fingerprint for r in digest.fingerprints(frame).collect()} == {i: r.fingerprint for i, r in got.items()}


def test_few_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert digest.with_next(empty).count() == 0
    one = digest.with_next(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in one] == [(5, hashlib.sha256(b"abab").hexdigest(), 1.0)]
    twice = spark.createDataFrame([(5, "ab"), (5, "cd"), (5, "cd"), (None, "x"), (None, None)], "doc_id long, text string")
    assert digest.with_next(twice).count() == 5
