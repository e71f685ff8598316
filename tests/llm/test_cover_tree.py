import numpy as np
import pytest

from curata.llm import cover_tree


def brute(rows, cosine):
    """(n_links, component) with every pair compared in double precision."""
    ids, good = [r[0] for r in rows], {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            good[i] = x / np.linalg.norm(x)
    links = {i: {k for k in good if k != i and i in good and len(good[i]) == len(good[k]) and good[i] @ good[k] >= cosine} for i in ids}
    component = {}
    for i in sorted(ids):
        if i not in component:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in component:
                    component[k] = i
                    todo += links[k]
    return {i: (len(links[i]), component[i]) for i in ids}


def found(spark, rows, cosine=0.9, **kw):
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, block string")
    return {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.links(frame, cosine, **kw).collect()}


def cases(seed, n=300, dim=8):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.standard_normal(dim) if i < 20 or rng.random() < 0.3 else np.array(rows[rng.integers(0, i)][1]) + rng.standard_normal(dim) * rng.choice([0.0, 0.05, 0.3])
        rows.append((i, np.float32(v).tolist()))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_as_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(cover_tree, "CELL", 60)
    rows = cases(seed) + [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0, None] * 4), (904, [float("nan")] * 8), (905, [float("inf")] + [0.0] * 7), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, [1e-30] * 8), (909, [1e30] * 8)]
    assert found(spark, rows, block=40) == brute(rows, 0.9)


def test_many_dimensions(spark):
    """1,200 of them, each with a pair that links and one vector that doesn't."""
    rows = [(3 * d + k, [1.0, *[0.01 * k * (k < 2)] * (d - 1)] if k < 2 else [0.0, *[1.0] * (d - 1)]) for d in range(2, 1202) for k in range(3)]
    got = found(spark, rows)
    assert all(got[3 * d + k] == ((1, 3 * d) if k < 2 else (0, 3 * d + 2)) for d in range(2, 60) for k in range(3)) and len(got) == 3600


def test_rows_that_share_a_vec_id(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (3, [1.0, 0.01]), (4, [0.01, 1.0]), (5, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in cover_tree.links(frame, 0.9).collect())
    assert got == [(3, 2, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 2, 3, False), (5, 2, 3, False)]


@pytest.mark.parametrize("limit", [1 << 30, 1])
def test_groups_of_blocks(spark, monkeypatch, limit):
    monkeypatch.setattr(cover_tree, "CELL", 100)
    monkeypatch.setattr(cover_tree, "GROUP_BYTES", limit)
    rows = cases(3, 700)
    assert found(spark, rows, block=10) == brute(rows, 0.9)


def test_no_vectors(spark):
    assert found(spark, []) == {}


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 16))
    x[100:200] = x[:100] + 0.05 * rng.standard_normal((100, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = cover_tree.Tree(x.astype(np.float32), 0.1)
    for level, (centres, up, cover) in enumerate(tree.levels):
        if level:
            assert set(tree.levels[level - 1][0]) <= set(centres)
            assert len(up) == len(centres) == len(cover)
    i, j = cover_tree.near_pairs(tree, tree, 0.4)
    want = {(a, b) for a, b in zip(*np.nonzero(x @ x.T >= 1 - 0.4**2 / 2), strict=True)}
    assert want <= set(zip(i, j, strict=True)) and len(i) < len(want) * 1.2
