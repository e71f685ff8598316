import hashlib
import random

import numpy as np
import pytest

from curata.llm import centroids as C


def plain(rows, k, rounds, dims, scale=64, seed=1):
    """(vec_id, cluster, distance, inertias, digest) of every vector kept, told plainly."""
    kept = [(i, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    own = [v for _, v in order[:k]]
    near = lambda v: min(((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(own)), default=None)
    for _ in range(rounds):
        groups = [[] for _ in own]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        own = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, own)]
    found = [(i, *near(v)) for i, v in kept]
    total = [sum(d for _, d, c in found if c == j) for j in range(len(own))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in own]
    return sorted([(i, c, d, total[c], sum(total), digest[c]) for i, d, c in found], key=str)


def got(frame):
    return sorted([tuple(r) for r in frame.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()], key=str)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, cluster string").repartition(parts)


@pytest.mark.parametrize("seed", range(4))
def test_equal_to_the_plain_rounds(spark, monkeypatch, seed):
    monkeypatch.setattr(C, "BLOCK", 40)
    random.seed(seed)
    spread = [0.02, 0.5, 40.0, 1e5][seed]  # from many ties to sums beyond doubles
    middles = [[random.uniform(-1, 1) * spread * 3 for _ in range(3)] for _ in range(6)]
    rows = [(i, [x + random.gauss(0, spread) for x in random.choice(middles)]) for i in range(300)]
    rows += [(i % 7, rows[3][1]) for i in range(60)] + [(None, rows[0][1]), (None, [0.0, 0.0, 0.0])]
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 0.0]), (904, [float("nan"), 0.0, 0.0]), (905, [float("inf"), 0.0, 0.0]), (906, [0.0, -0.0, 1e-300])]
    assert got(C.cluster(frame(spark, rows), k=5, dims=3)) == plain(rows, 5, 3, 3)


def test_ties_and_few_vectors(spark):
    rows = [(i, [x / 64, y / 64]) for i, (x, y) in enumerate([(-1, 0), (1, 0), (0, 0), (0, 0), (0, 1), (0, -1)])]
    assert got(C.cluster(frame(spark, rows), k=2, dims=2)) == plain(rows, 2, 3, 2)
    assert got(C.cluster(frame(spark, rows), k=16, dims=2)) == plain(rows, 16, 3, 2)
    assert got(C.cluster(frame(spark, [(i, [0.5, 0.5]) for i in range(50)]), k=4, dims=2)) == plain([(i, [0.5, 0.5]) for i in range(50)], 4, 3, 2)


def test_no_vectors(spark):
    assert got(C.cluster(frame(spark, [(1, None)]))) == [] and got(C.cluster(frame(spark, []))) == []


def test_too_large_components_are_named(spark):
    with pytest.raises(Exception, match="fits a long"):
        C.cluster(frame(spark, [(1, [1e9, 0.0]), (2, [0.0, 0.0])]), k=1, dims=2)


@pytest.mark.parametrize("scale", [3, 60, 1 << 20, 1 << 26])
def test_pruned_trees_assign_as_brute_force(scale):
    rng = np.random.default_rng(scale)
    points = np.concatenate([rng.integers(-scale, scale, (500, 4)), np.repeat(rng.integers(-scale, scale, (1, 4)), 200, axis=0), np.round(rng.normal(0, scale / 50, (500, 4)) + scale / 2).astype(np.int64)])
    tree, order = C.Tree.over(points)
    tree = C.Tree.opened(tree.packed(), 4)
    assert (tree.points == points[order]).all()
    own = np.concatenate([points[:9], points[4:6]])  # equal centroids: the smaller number wins
    n, sums, label = tree.assign(own, labels=True)
    want = np.array([[int(((p - c) ** 2).sum()) for c in own] for p in tree.points]).argmin(axis=1)
    assert (label == want).all() and (n == np.bincount(want, minlength=len(own))).all()
    assert (sums == np.stack([tree.points[want == c].sum(axis=0) for c in range(len(own))])).all()


def test_whole_nodes_are_assigned_without_their_points(monkeypatch):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(0, 40, (1000, 3)), rng.integers(900, 940, (1000, 3))])
    tree, _ = C.Tree.over(points)
    seen = []
    monkeypatch.setattr(C, "distances", lambda p, c, f=C.distances: seen.append(len(p)) or f(p, c))
    n, _, _ = tree.assign(np.array([[20, 20, 20], [920, 920, 920]]))
    assert n.tolist() == [1000, 1000] and sum(seen) < 20  # nodes' middles only
