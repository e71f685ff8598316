"""Queries over whole tables against brute force, on tables that a cut by id, length or number would shorten."""

import hashlib
import itertools
import math
import re
from difflib import SequenceMatcher

import pytest

from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from curata.functions.text import CLAIM_FRAME, CLAIM_STOP_WORDS, STUDY_NUMBER
from curata.operators import sampling
from curata.plans import catalogue
from curata.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """Five orders of one to four lines, two of them with keys in the upper half modulo 40; (order, line, part, supplier)."""
    rows = [(3, 1, 5, 1), (3, 2, 9, 2), (25, 1, 7, 1), (25, 2, 7, 2), (25, 3, 8, 6), (25, 4, 10, 3), (39, 1, 999_999_999_999_999, 4), (39, 2, 12, 4), (40, 1, 4, 0), (61, 1, 2, 2), (61, 2, 3, 2), (61, 3, 4, 7)]
    d = str(tmp_path_factory.mktemp("lines"))
    spark.createDataFrame([(*r, float(r[1])) for r in rows], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double").write.parquet(f"{d}/lineitem.parquet")
    orders = {k: list(g) for k, g in itertools.groupby(rows, lambda r: r[0])}
    return d, orders


def _ratio(a, b):
    return SequenceMatcher(None, a.lower(), b.lower()).ratio()


def _title(part):
    return f"A long title about part {part}"


def _costs(order):
    """{(gt, ext): cost} of an order's lines by the rules of matching.pair_costs; other pairs don't match."""
    out = {}
    for (i, g), (j, e) in itertools.product(enumerate(order, 1), repeat=2):
        same = lambda k, x: k % 2 == 0 and x[2] % 3 == g[2] % 3  # noqa: B023, E731
        if same(j, e):
            out[i, j] = 0.05 * (1 - _ratio(f"effect of part {g[2]}", f"effect of part {e[2]}"))
        elif not any(same(k, x) for k, x in enumerate(order, 1)):
            score = (_ratio(_title(g[2]), _title(e[2] + 1)) >= 0.75) + (g[3] % 5 == e[3] % 5) + (i == j)
            if score >= 2:
                out[i, j] = 0.5 + 0.1 * (3 - score)
    return out


def test_fuzzy_assign_covers_all_orders(spark, lines):
    d, orders = lines
    got: dict = {}
    for r in catalogue.queries()["fuzzy_assign"](spark, d).collect():
        got.setdefault(int(r.paper), []).append((r.gt, r.ext, r.cost))
    assert 25 in got
    for paper, order in orders.items():
        costs, own, n = _costs(order), got.get(paper, []), len(order)
        assert len({g for g, _, _ in own}) == len({e for _, e, _ in own}) == len(own)
        assert all(abs(costs[g, e] - c) < 1e-4 for g, e, c in own)
        best = min(sum(costs.get((i, p), 9) for i, p in enumerate(perm, 1)) for perm in itertools.permutations(range(1, n + 1)))
        assert abs(sum(c for _, _, c in own) + 9 * (n - len(own)) - best) < 1e-3


def test_greedy_align_covers_all_orders(spark, lines):
    d, orders = lines
    got = {(int(r.paper), r.gt, r.ext) for r in catalogue.queries()["greedy_align"](spark, d).collect()}
    want = set()
    for paper, order in orders.items():
        used: set = set()
        for _, g, e in sorted((c, g, e) for (g, e), c in _costs(order).items()):
            if ("g", g) not in used and ("e", e) not in used:
                used |= {("g", g), ("e", e)}
                want.add((paper, g, e))
    assert got == want and any(p == 25 for p, _, _ in got)


def test_hungarian_is_least_cost(spark, lines):
    d, orders = lines
    got: dict = {}
    for r in catalogue.queries()["hungarian"](spark, _priced(spark, d)).collect():
        got.setdefault(int(r.paper), []).append((r.gt, r.ext, r.cost))
    for paper, order in orders.items():
        costs = {(i, j): abs(g[2] % 7 - e[3] % 5 / 100 * 500) for (i, g), (j, e) in itertools.product(enumerate(order, 1), repeat=2)}
        costs = {k: c for k, c in costs.items() if c < 9}
        own, n = got.get(paper, []), len(order)
        assert len({g for g, _, _ in own}) == len({e for _, e, _ in own}) == len(own) and all(abs(costs[g, e] - c) < 1e-3 for g, e, c in own)
        best = min(sum(costs.get((i, p), 9) for i, p in enumerate(perm, 1)) for perm in itertools.permutations(range(1, n + 1)))
        assert abs(sum(c for _, _, c in own) + 9 * (n - len(own)) - best) < 1e-2


def _priced(spark, d):
    """The same orders with a quantity and a discount a line."""
    rows = spark.read.parquet(f"{d}/lineitem.parquet").withColumns({"l_quantity": (F.col("l_partkey") % 7).cast("double"), "l_discount": F.col("l_suppkey") % 5 / 100})
    rows.write.mode("overwrite").parquet(f"{d}/priced/lineitem.parquet")
    return f"{d}/priced"


def _request(doc_id, text):
    parts = ["Extract replication data from the paper below.", f"[PAPER DOI]\n{doc_id}"]
    if text is not None:
        t = text.strip(" ")
        if len(t) > 20_000:
            t = t[:11_000] + f"\n\n[... {len(t) - 20_000:,} characters omitted from the middle of the full text ...]\n\n" + t[-9_000:]
        parts.append(f"[FULL TEXT]\n{t}")
    return "\n\n".join([*parts, "[REFERENCE LIST: md]\nr", "Reply with the JSON object only."])


def test_request_assembly_has_every_document(spark, tmp_path):
    body = "".join(f"word{i} " for i in range(6000))
    rows = [(i, body[:n] if n is not None else None) for i, n in enumerate([None, 0, 10, 14_999, 15_000, 19_999, 20_000, 20_001, 20_002, 33_333])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.digest for r in catalogue.queries()["request_assembly"](spark, str(tmp_path)).collect()}
    assert got == {i: hashlib.md5(_request(i, t).encode()).hexdigest() for i, t in rows}


def _walk(sizes, cap):
    """Keys of {key: size} taken in order of size and key."""
    total, kept = 0, set()
    for n, k in sorted((n, k) for k, n in sizes.items()):
        if total + n <= cap:
            total, kept = total + n, kept | {k}
    return kept


def test_row_cap_takes_the_smallest_orders(spark):
    sizes = {r.l_orderkey: r["count"] for r in spark.read.parquet(f"{SF}/lineitem.parquet").groupBy("l_orderkey").count().collect()}
    got = {r.paper for r in catalogue.queries()["row_cap"](spark, SF).collect()}
    assert got == _walk(sizes, 40) and max(got) > 120


@pytest.mark.parametrize("cap", [0, 1, 2, 7, 40])
def test_under_cap_of_many_rows(spark, cap):
    sizes = {k: k * 7919 % 23 for k in range(300)}
    rows = spark.createDataFrame(list(sizes.items()), "k long, n long")
    assert {r.k for r in sampling.under_cap(rows, "n", "k", cap).collect()} == _walk(sizes, cap)
    many = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 3 + 1).alias("n"))
    assert {r.k for r in sampling.under_cap(many, "n", "k", cap).collect()} == _walk({k: k % 3 + 1 for k in range(5000)}, cap)


def test_file_scans_read_every_conversation_and_page(spark, tmp_path):
    d = str(tmp_path)
    spark.range(150).selectExpr("id as conv_id", "explode(array('a', 'b\\nc')) as text").write.parquet(f"{d}/conversations.parquet")
    spark.range(101).withColumnRenamed("id", "page_id").write.parquet(f"{d}/pages.parquet")
    assert {r.state: r.n for r in catalogue.queries()["paper_json_scan"](spark, d).collect()} == {"bad_json": 22, "ok": 128}
    assert {r.kind: r.n for r in catalogue.queries()["page_artifacts"](spark, d).collect()} == {"xml": 51, "pdf": 50}


def _dice(a, b):
    """text.claim_dice, in Python."""
    a, b = ((x or "").strip(" ").lower() for x in (a, b))
    x, y = (set(re.findall("[a-z0-9]+", re.sub(CLAIM_FRAME, "", t))) - set(CLAIM_STOP_WORDS) for t in (a, b))
    m, n = (set(re.findall(STUDY_NUMBER, t)) for t in (a, b))
    return 0 if not x or not y or (m and n and m != n) else 2 * len(x & y) / (len(x) + len(y))


@pytest.fixture(scope="module")
def long_texts(spark, tmp_path_factory):
    """Documents that differ only beyond 300 and 400 characters; null, empty and blank ones."""
    start = " ".join(f"same{i}" for i in range(80))
    rows = [(0, f"{start} one two\n two  end"), (1, f"{start} three one"), (2, f"{start} study 1 here"), (3, f"{start} study 2 here"), (4, None), (5, ""), (6, " \n "), (7, "a b a")]
    d = str(tmp_path_factory.mktemp("texts"))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    return d, dict(rows)


def test_deinvert_abstract_gives_whole_texts(spark, long_texts):
    d, rows = long_texts
    got = {r.doc_id: r.text for r in catalogue.queries()["deinvert_abstract"](spark, d).collect()}
    assert got == {i: None if t is None else hashlib.md5(" ".join(t.split()).encode()).hexdigest() for i, t in rows.items()}


def test_dice_pairs_compares_whole_texts(spark, long_texts):
    d, rows = long_texts
    got = {r.doc_id: r.dice for r in catalogue.queries()["dice_pairs"](spark, d).collect()}
    assert got == {i: pytest.approx(_dice(rows[i], rows[i + 1]), abs=1e-8) for i in range(7)}
    assert 0 < got[0] < 1 and got[2] == 0


def test_bootstrap_ci_draws_2000_replicates(spark):
    sums: dict = {}
    for r in fx.outcomes(spark, SF).collect():
        s, n = sums.get(r.paper, (0, 0))
        sums[r.paper] = s + (r.gt == r.ext), n + 1

    def weight(replicate, paper):
        u = int(hashlib.sha256(f"0:{replicate}:{paper}".encode()).hexdigest()[:12], 16) / (1 << 48)
        return sum(u >= sum(math.exp(-1) / math.factorial(i) for i in range(k)) for k in range(1, 9))

    means = []
    for replicate in range(2000):
        drawn = [(weight(replicate, p), s, n) for p, (s, n) in sums.items()]
        if total := sum(w * n for w, _, n in drawn):
            means.append(sum(w * s for w, s, _ in drawn) / total)
    means.sort()
    (got,) = catalogue.queries()["bootstrap_ci"](spark, SF).collect()
    assert got.n_boot == len(means) > 1900
    assert (got.lo, got.hi) == pytest.approx((means[int(0.025 * len(means))], means[int(0.975 * len(means)) - 1]))


def test_ratios_of_part_names(spark):
    names = {r.p_partkey: r.p_name for r in spark.read.parquet(f"{SF}/part.parquet").collect()}
    rows = catalogue.queries()["title_ratio"](spark, SF).collect()
    assert len(rows) == sum(k + 1 in names for k in names)
    for r in rows:
        a, b = names[r.p_partkey].strip().lower(), names[r.p_partkey + 1].strip().lower()
        ratio = 1.0 if a == b else SequenceMatcher(None, a, b).ratio()
        bound = 2 * min(len(a), len(b)) / max(1, len(a) + len(b))
        assert r.ratio == pytest.approx(ratio if bound >= 0.3 else 0) and r.title_similarity == pytest.approx(ratio if ratio >= 0.9 else 0)


def test_folded_texts(spark):
    import unicodedata

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fold = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c))
    got = {r.doc_id: r.folded for r in catalogue.queries()["folded_names"](spark, SF).collect()}
    assert got == {i: hashlib.md5(fold(t).encode()).hexdigest() for i, t in texts.items()}


def test_replies(spark):
    kinds = [lambda i: f'{{"a": {i}}}', lambda i: f'{{"a": {i}}}', lambda i: f'{{"contains_replications": true, "replications": [{{"a": {i}}}]}}', lambda i: None, lambda i: '{"contains_replications": false, "replications": []}']
    assert all(r.reply == kinds[r.doc_id % 5](r.doc_id) for r in catalogue.queries()["reply_parse"](spark, SF).collect())


def test_spliced_tables(spark):
    for r in catalogue.queries()["table_splice"](spark, SF).collect():
        assert r.text == ("intro\n<table/>\nend" if r.page_id % 2 == 0 else f"intro\n| a | b |\n| 1 | {r.page_id} |\nend")
