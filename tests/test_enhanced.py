"""Labels filled and extended by a finder's entries, against plain Python."""

import random
from difflib import SequenceMatcher

import pytest

from curata.operators import gold

FIELDS = ["url", "n"]


def ratio(a, b):
    a, b = (a or "").lower().strip(), (b or "").lower().strip()
    return 0.0 if not a or not b else 1.0 if a == b else SequenceMatcher(None, a, b).ratio()


def names(x):
    return {p.split(",")[0].strip().lower() for p in (x or "").split(";") if p.strip()}


def plain(labels, found):
    out = []
    for p, g, _, title, authors, year, *own in labels:
        entries = sorted((e for e in found if e[0] == p), key=lambda e: e[1])
        agree = lambda e: (ratio(title, e[3]) >= 0.75) + (bool(names(authors) & names(e[4])) and names(authors) == names(e[4])) + (bool(year) and year == e[5])  # noqa: B023, E731
        match = next((e for e in entries if agree(e) >= 2), None)
        if match is None:
            out.append((p, g, None, "review" if entries else "kept", 0, *own))
            continue
        values = [theirs if not (mine or "").strip() and (theirs or "").strip() else mine for mine, theirs in zip(own, match[6:], strict=True)]
        filled = sum(not (mine or "").strip() and bool((theirs or "").strip()) for mine, theirs in zip(own, match[6:], strict=True))
        out.append((p, g, match[1], "filled" if filled else "kept", filled, *values))
        out += [(p, g, e[1], "added", 0, *e[6:]) for e in entries if e[1] != match[1] and not any(ratio(x[3], e[3]) >= 0.8 for x in labels if x[0] == p)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_first_fit(spark, seed):
    rng = random.Random(seed)
    titles = ["Sleep and memory", "sleep and memory ", "Sleep and the memory of mice", "Quite another thing", "", None, "Birds"]
    row = lambda p, k: (p, k, rng.choice(["", "10.1/a"]), rng.choice(titles), rng.choice(["Smith, J", "Jones, K", "", "Smith, J; Jones, K"]), rng.choice(["1999", "2001", ""]), rng.choice(["", None, "u", "v"]), rng.choice(["", "5", " "]))
    labels = [row(f"p{p}", k) for p in range(9) for k in range(3)]
    found = [row(f"p{p}", k) for p in range(7) for k in range(4)]
    frame = lambda rows, s, key: spark.createDataFrame(rows, f"paper string, {key} long, {s}_doi string, {s}_title string, {s}_authors string, {s}_year string, {s}_url string, {s}_n string").repartition(3)
    got = gold.enhanced(frame(labels, "g", "gt"), frame(found, "e", "ext"), FIELDS)
    assert sorted((tuple(r) for r in got.select("paper", "gt", "ext", "change", "n_filled", *FIELDS).collect()), key=str) == plain(labels, found)
