"""Very long texts, and the recall of the candidates near the threshold."""

import random

import numpy as np

from curata.llm import backoff, cover_tree, digest, minhash
from test_backoff import brute as backoff_brute


def long_rows(n=260_000):
    rng = random.Random(4)
    words = [f"word{i}" for i in range(3000)]
    one = rng.choices(words, k=n)
    other = list(one)
    for k in rng.sample(range(n), n // 60):
        other[k] = "changed"
    return [(1, " ".join(one)), (2, " ".join(other)), (3, "x" * 1_500_000), (4, " ".join(one[:50]))]


def test_near_duplicates_of_very_long_texts(spark):
    rows = long_rows()
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, t in rows[:2] for w in [t.split()]]
    linked = 100 * len(sets[0] & sets[1]) >= 75 * len(sets[0] | sets[1])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert linked and got == {1: (len(sets[0]), 1), 2: (len(sets[1]), 1), 3: (1, 3), 4: (46, 4)}


def test_scores_of_very_long_texts(spark):
    rows = long_rows(60_000)
    got = {r.doc_id: (r.n_words, r.log_score) for r in backoff.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, n, s in backoff_brute(rows, 3):
        assert got[i][0] == n and abs(got[i][1] - s) < 1e-6 * abs(s)


def test_fingerprints_of_very_long_texts(spark):
    rows = long_rows()
    got = {r.doc_id: r for r in digest.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.n_chars for i, r in got.items()} == {i: len(t) for i, t in rows}
    assert got[2].near_next > 0.2 > 0.1 > got[3].near_next and got[1].fingerprint == digest.rendered(digest.digests([rows[0][1].encode()])[0])


def test_vectors_of_very_many_dimensions(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal(200_000)
    rows = [(1, x.tolist()), (2, (x + 0.1 * rng.standard_normal(200_000)).tolist()), (3, rng.standard_normal(200_000).tolist())]
    got = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.links(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.9).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def planted(n, seed):
    """Pairs of sets of 60 to 600 hashes with a similarity of 0.75 to 0.80."""
    rng = np.random.default_rng(seed)
    for _ in range(n):
        size, want = int(rng.integers(60, 600)), rng.uniform(0.75, 0.8)
        both = -(-int(2 * size * want * 1000) // int(1000 * (1 + want)))
        pool = rng.integers(0, 2**63, 2 * size - both).astype(np.uint64)
        yield np.unique(pool[:size]), np.unique(np.concatenate([pool[:both], pool[size:]]))


def recall(n, seed=1, least=minhash.PERCENT / 100 - minhash.MARGIN):
    """(shares of pairs with a band in common, of those whose estimate comes near enough, too)."""
    band = both = 0
    for a, b in planted(n, seed):
        x, y = minhash.minima(a), minhash.minima(b)
        met = (minhash.bands(x) == minhash.bands(y)).any()
        near = minhash._fast_estimate(np.frombuffer(minhash.signature(x), np.uint64), np.frombuffer(minhash.signature(y), np.uint64)[None, :])[0] >= least
        band, both = band + met, both + (met and near)
    return band / n, both / n


def test_recall_near_the_threshold():
    band, both = recall(2000)
    assert band >= 0.999 and both >= 0.999
