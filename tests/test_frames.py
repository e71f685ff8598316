"""The frame of cells and quotas against a walk through its strata."""

import hashlib
import random

import pytest

from curata.operators import sampling


@pytest.mark.parametrize("seed", range(4))
def test_quotas_as_a_walk(spark, seed):
    rng = random.Random(seed)
    members = [(k, s, rng.choice("abc"), rng.choice([0, 0, 1, None])) for k in range(80) for s in ("x", "y", "z") if rng.random() < 0.6]
    quotas = [(s, i, c, None if seed == 3 and s == "z" else rng.choice([0, 2, 5, 40]), total, rng.choice([True, False, None])) for i, (s, total) in enumerate((("x", None), ("y", 12), ("z", rng.choice([None, 3])))) for c in "abc" if rng.random() < 0.9]
    out = set(rng.sample(range(80), 10))
    order = lambda s, k: (hashlib.sha256(f"f:{s}:{k}".encode()).hexdigest(), k)
    want, taken = {}, set()
    for s in ("x", "y", "z"):
        own = [q for q in quotas if q[0] == s]
        pool, drawn = {q[2]: [(k, t or 0) for k, m, c, t in members if m == s and c == q[2] and k not in out] for q in own}, []
        for _, _, cell, n, _, instead in own:
            cells = pool[cell]
            if instead and cells:
                low = min(t for _, t in cells)
                ranked = sorted((c for c in cells), key=lambda c: (c[1], order(s, c[0])))[:n]
                drawn += [(k, cell) for k, t in ranked if t == low]
            else:
                drawn += [(k, cell) for k, _ in sorted(cells, key=lambda c: (c[1], order(s, c[0])))[:n]]
        total = next((q[4] for q in own), None)
        if total is not None:
            keys = {k for k, _ in drawn}
            rest = [(k, c) for _, k, c in sorted(((t, order(s, k)), k, c) for c in pool for k, t in pool[c] if k not in keys)]
            drawn += rest[: max(0, total - len(drawn))]
        for k, cell in drawn:  # each key once, where it was drawn first
            if k not in taken:
                taken.add(k)
                want[k] = (s, cell)
    frame = spark.createDataFrame(members, "k int, stratum string, cell string, tier int").repartition(3)
    table = spark.createDataFrame(quotas, "stratum string, seq int, cell string, n int, total int, instead boolean")
    got = sampling.quota_frame(frame, table, "k", "f", spark.createDataFrame([(k,) for k in out], "k int"))
    assert {r.k: (r.stratum, r.cell) for r in got.collect()} == want
