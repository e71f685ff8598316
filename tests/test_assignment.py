"""Sparse least-cost assignment against the dense one, and bounds that stand before a ratio."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from curata.functions import text
from curata.operators import matching


def total(cost, pairs, n):
    return sum(cost[i, j] for i, j in pairs) + matching.INF * (n - len(pairs))


@pytest.mark.parametrize("seed", range(60))
def test_sparse_equals_dense(seed):
    rng = random.Random(seed)
    n, m = rng.randint(1, 12), rng.randint(1, 12)
    share, tie = rng.choice([0.1, 0.3, 0.7, 1.0]), rng.random() < 0.3
    pairs = [(i, j) for i in range(n) for j in range(m) if rng.random() < share]
    costs = [rng.choice([0.0, 0.5, 0.6, 1.0]) if tie else rng.uniform(0, rng.choice([1, 8.9])) for _ in pairs]
    dense = np.full((n, m), matching.INF)
    for (i, j), c in zip(pairs, costs, strict=True):
        dense[i, j] = c
    again = rng.sample(range(len(pairs)), len(pairs) // 3)  # repeated pairs, dearer
    rows, columns, price = (np.array(x) for x in ([i for i, _ in pairs] + [pairs[k][0] for k in again], [j for _, j in pairs] + [pairs[k][1] for k in again], costs + [costs[k] + 0.1 for k in again]))
    found = [(int(rows[k]), int(columns[k])) for k in matching.sparse_assignment(rows.astype(int), columns.astype(int), price.astype(float))]
    assert len({i for i, _ in found}) == len({j for _, j in found}) == len(found) and set(found) <= set(pairs)
    want = [(i, j) for i, j in matching.hungarian(dense) if dense[i, j] < matching.INF]
    assert abs(total(dense, found, n) - total(dense, want, n)) < 1e-9
    if not tie:
        assert sorted(found) == sorted(want)


def test_long_chains_of_rows_that_push_each_other():
    n = 300  # row i may take column i at 0.01 or i + 1 at 0; the last row has only its first column
    rows = np.array([i for i in range(n) for _ in range(2)] + [n])
    columns = np.array([j for i in range(n) for j in (i, i + 1)] + [n])
    costs = np.array([c for _ in range(n) for c in (0.01, 0.0)] + [0.5])
    found = {int(rows[k]): int(columns[k]) for k in matching.sparse_assignment(rows, columns, costs)}
    assert found == {i: i for i in range(n)} | {n: n}


def test_many_disjoint_pairs_need_little_memory():
    ids = np.arange(60_000)
    tracemalloc.start()
    found = matching.sparse_assignment(ids, ids[::-1].copy(), np.full(len(ids), 0.1))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == len(ids) and most < 100 << 20


@pytest.mark.parametrize("large", [10, matching.LARGE])
def test_one_paper_of_many_pairs_on_both_sides_of_the_threshold(spark, large):
    n = 60_000 if large == matching.LARGE else 300
    pairs = spark.range(n).select(F.lit("p").alias("paper"), F.col("id").alias("gt"), (F.lit(n) - F.col("id")).alias("ext"), (F.col("id") % 7 / 10).alias("cost"))
    more = spark.createDataFrame([("q", 1, 1, 0.1), ("q", 1, 2, 0.2), ("q", 2, 1, 0.3), (None, 1, 1, 0.5), (None, 2, 1, 0.4), ("q", 3, 3, 9.5)], "paper string, gt long, ext long, cost double")
    got = matching.assign(pairs.unionByName(more), large=large)
    assert got.where("paper = 'p'").count() == n
    assert sorted((r.paper or "", r.gt, r.ext, r.cost) for r in got.where("paper is null or paper = 'q'").collect()) == [("", 2, 1, 0.4), ("q", 1, 2, 0.2), ("q", 2, 1, 0.3)]


def test_letters_never_bound_a_ratio_too_low(spark):
    rng = random.Random(3)
    words = ["", " ", "Nan", "a", "The effect of sleep", "effects, of THE sleep 12", "Über", "1234 4321", "sleep of effect the"]
    rows = [(a, b) for a in words for b in words] + [("".join(rng.choices("abcdefg hijk 12é", k=30)), "".join(rng.choices("abcdefg hijk 12é", k=25))) for _ in range(200)] + [(None, "a"), (None, None)]
    for least in (0.3, 0.75):
        frame = spark.createDataFrame(rows, "a string, b string").select("a", "b", text.letters("a").alias("x"), text.letters("b").alias("y"))
        found = frame.select(text.string_ratio("a", "b").alias("r"), text.letters_could_reach(F.col("x"), F.col("y"), least).alias("ok"), text.could_reach("a", "b", least).alias("length")).collect()
        assert all(f.ok for f in found if f.r >= least)
        assert sum(bool(f.ok) for f in found) < sum(bool(f.length) for f in found)
