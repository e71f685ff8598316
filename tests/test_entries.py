"""Assignments of entries whose papers are rows of their own, against those over pairs, and what they shuffle."""

import random
import re

import pytest

from curata.operators import matching
from curata.plans import catalogue
import __spark_entry__  # noqa: F401  registers the queries

SF = "/root/testdata/sf0.001"


def side(spark, p, key, seed):
    """Papers of one to 30 entries, and one of 150; null and blank values, texts that differ in case, length and words."""
    rng = random.Random(seed)
    pick = lambda *xs: rng.choice(xs)
    title = lambda: pick(None, "", " ", "NaN", "On sleep", "ON SLEEP ", "on sleeping late", f"A long title about part {rng.randrange(99)}", "Über große Straßen")
    authors = lambda: pick(None, "", "Smith, J", "J Smith", "Smith, J; Lee, K", "Lee, K; Jones, P; Smith, J", "Jones")
    sizes = {f"p{k}": rng.randint(1, 30 if k % 10 == 0 else 5) for k in range(40)} | {"many": 150, None: 3}
    rows = [(paper, i, pick(None, "", *(f"10.1/{x}" for x in range(n))), f"effect {rng.randrange(9)} of " + "x" * rng.randrange(20), title(), authors(), pick(None, "", "1999", "1999.0", " 1999", "2001")) for paper, n in sizes.items() for i in range(n)]
    names = ", ".join(f"{p}_{c} string" for c in ("doi", "description", "title", "authors", "year"))
    return spark.createDataFrame(rows, f"paper string, {key} long, {names}").repartition(3)


@pytest.mark.parametrize("most", [0, 900, 8_000, 10**9])
def test_papers_as_rows_give_what_pairs_give(spark, most):
    gt, ext = side(spark, "g", "gt", 1), side(spark, "e", "ext", 2)
    costs = matching.pair_costs(matching.pairs_in_block(gt, ext, "paper"))
    rows = lambda x: sorted(tuple(r) for r in x.collect())
    want = rows(matching.assign(costs))
    assert rows(matching.assign_entries(gt, ext, most=most)) == want and len(want) > 50
    want = rows(matching.greedy(costs.withColumn("score", 1 - costs.cost / matching.INF), 0.92))
    assert rows(matching.greedy_entries(gt, ext, 0.92, most=most)) == want and len(want) > 50


@pytest.mark.parametrize("name", ["fuzzy_assign", "greedy_align"])
def test_entries_travel_once(spark, name, monkeypatch):
    """One exchange a side, by paper: pairs and their texts aren't shuffled."""
    plans = []

    def kept(frame, *args):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return written(frame, *args)

    written = matching.written
    monkeypatch.setattr(matching, "written", kept)
    assert catalogue.queries()[name](spark, SF).count() > 0
    assert sum(len(re.findall(r"\bExchange hashpartitioning", p)) for p in plans) == 2, plans
