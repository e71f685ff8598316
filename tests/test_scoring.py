"""Scored records, blocks and intervals against plain Python."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from curata.operators import matching, metrics, scoring
from curata.functions.validate import RESULTS

RECORD = "paper string, gt_result string, ext_result string, ext_result_raw string, ext_result_paper string, gt_ambiguity string, source string, granularity string, has_reversal_class boolean, effects_complete boolean, collapse_applied boolean, type_scored boolean, type_two_class boolean, type_ok boolean, type_adjacent_ok boolean, gt_type string, ext_type string, doi_scored boolean, doi_ok boolean, doi_missing_ext boolean, bib_scored boolean, title_ok boolean, authors_ok boolean, year_ok boolean, journal_ok boolean, cit_present boolean, cit_author_year_ok boolean"
STATS = "stats struct<" + ", ".join(f"{f}: struct<gt_has: boolean, ext_has: boolean, both: boolean, type_mismatch: boolean, tier1: boolean, tier2: boolean, tier3: boolean>" for f in scoring.STATISTICS) + ">"


def made(n, seed, papers=12):
    rng = random.Random(seed)
    label = lambda: rng.choices([*RESULTS, "", "odd"], [5, 4, 2, 1, 1, 1])[0]
    some = lambda p=0.6: rng.random() < p
    rows = []
    for _ in range(n):
        gt = label() if some(0.9) else ""
        raw = gt if some() else label()
        collapse = raw == "reversal" and some(0.5)
        typed, two = some(0.8), some(0.2)
        kinds = ["direct", "close experiment", "close extension", "conceptual"]
        a = rng.choice(kinds)
        b = a if some(0.5) else rng.choice([*kinds, ""])
        tier = lambda: some() if some(0.9) else None
        stats = {}
        for f in scoring.STATISTICS:
            g, e = some(), some()
            bad = g and e and some(0.2)
            stats[f] = (g, e, g and e, bad, *((some(), some(), some()) if g and e and not bad else (None, None, None)))
        rows.append((f"p{rng.randrange(papers)}", gt, "failure" if collapse else raw, raw, label() if some(0.5) else None, rng.choice(["boundary", "", None]), rng.choice(["s", "", None]), rng.choice(["paper", "effect", None]), rng.choice([True, False, None]), some(0.3), collapse,
                     typed, two if typed else None, (some() if typed else None), (some() if typed and not two else None), a if typed else "", b, some(0.8), some(), some(0.2), some(0.7), tier(), tier(), tier(), tier(), some(0.7), some(), tuple(stats.values())))
    return rows


FIELDS = [x.split()[0] for x in RECORD.split(", ")] + ["stats"]


def plain_block(pairs, classes):
    n = len(pairs)
    if not n:
        return {"n": 0}
    per, f1s = {}, []
    for c in classes:
        tp, s, p = sum(a == b == c for a, b in pairs), sum(a == c for a, _ in pairs), sum(b == c for _, b in pairs)
        pr, rc = tp / p if p else None, tp / s if s else None
        f1 = 2 * pr * rc / (pr + rc) if pr and rc else (0.0 if s or p else None)
        per[c] = (s, p, tp, pr, rc, f1)
        if s:
            f1s.append(f1 or 0.0)
    known = lambda x: x if x in RESULTS else "?"
    po, a, b = sum(x == y for x, y in pairs) / n, Counter(known(x) for x, _ in pairs), Counter(known(y) for _, y in pairs)
    pe = sum(a[c] * b[c] for c in a) / n**2
    return {"n": n, "accuracy": po, "cohen_kappa": (po - pe) / (1 - pe) if pe < 1 else 1.0, "macro_f1": sum(f1s) / len(f1s) if f1s else None, "per_class": per, "confusion": Counter(pairs)}


def plain_blocks(rows):
    recs = [dict(zip(FIELDS, r, strict=True)) for r in rows]
    has = [r for r in recs if r["gt_result"]]
    pairs = lambda rs, k: [(r["gt_result"], r[k]) for r in rs]
    four = [r for r in has if not r["collapse_applied"] and r["source"] and r["granularity"] != "paper" and r["has_reversal_class"]]
    return recs, {
        "result_3class": plain_block(pairs(has, "ext_result"), scoring.THREE), "result_3class_paper": plain_block(pairs([r for r in has if r["ext_result_paper"]], "ext_result_paper"), scoring.THREE),
        "result_3class_clear": plain_block(pairs([r for r in has if r["gt_ambiguity"] != "boundary"], "ext_result"), scoring.THREE), "result_4class": plain_block(pairs(four, "ext_result_raw"), RESULTS), "result_all_rows_raw": plain_block(pairs(has, "ext_result_raw"), RESULTS),
    }


near = lambda a, b: a is b or (a is not None and b is not None and abs(a - b) < 1e-9)


@pytest.mark.parametrize("n,seed", [(400, 1), (9, 2), (0, 3)])
def test_all_blocks_from_one_pass(spark, n, seed):
    rows = made(n, seed)
    got = scoring.summary(spark.createDataFrame(rows, f"{RECORD}, {STATS}").repartition(3)).first()
    recs, blocks = plain_blocks(rows)
    assert got.n_matched_rows == n and got.precision_is_lower_bound == any(r["granularity"] != "paper" and not r["effects_complete"] for r in recs)
    for name, want in blocks.items():
        block = got[name]
        assert block.n == want["n"], name
        if want["n"]:
            assert near(block.accuracy, want["accuracy"]) and near(block.cohen_kappa, want["cohen_kappa"]) and near(block.macro_f1, want["macro_f1"]), name
            for p in block.per_class:
                assert all(near(x, y) for x, y in zip((p.support, p.predicted, p.tp, p.precision, p.recall, p.f1), want["per_class"][p["class"]], strict=True))
            assert {(c.gt, c.ext): c.n for c in block.confusion if c.n} == {k: v for k, v in want["confusion"].items() if set(k) <= {p["class"] for p in block.per_class}}

    def rate(rs, key):
        xs = [r[key] for r in rs if r[key] is not None]
        return sum(xs) / len(xs) if xs else None

    typed, four = [r for r in recs if r["type_scored"]], [r for r in recs if r["type_scored"] and not r["type_two_class"]]
    t = got.replication_type
    assert (t.n, t.n_4class, t.n_2class) == (len(typed), len(four), len(typed) - len(four))
    assert near(t.accuracy_4class, rate(four, "type_ok")) and near(t.adjacent_accuracy, rate(four, "type_adjacent_ok")) and near(t.accuracy_2class_direct_or_close, rate([r for r in typed if r["type_two_class"]], "type_ok"))
    doi, bib = [r for r in recs if r["doi_scored"]], [r for r in recs if r["bib_scored"]]
    assert got.original_doi.n == len(doi) and near(got.original_doi.accuracy, rate(doi, "doi_ok")) and near(got.original_doi.ext_missing_rate, rate(doi, "doi_missing_ext"))
    assert got.bibliographic.n == len(bib) and all(near(got.bibliographic[k], rate(bib, k)) for k in ("title_ok", "authors_ok", "year_ok", "journal_ok"))
    assert near(got.citation_sentence.present_rate, rate(recs, "cit_present")) and near(got.citation_sentence.author_year_ok_rate, rate([r for r in recs if r["cit_present"]], "cit_author_year_ok"))
    for k, s in enumerate(got.statistics):
        xs = [r["stats"][k] for r in recs]
        both = [x for x in xs if x[2]]
        fair = [x for x in both if not x[3]]
        assert (s.gt_has, s.ext_has, s.both_present, s.gt_has_ext_missing, s.ext_has_gt_missing, s.type_mismatch_unscored) == (sum(x[0] for x in xs), sum(x[1] for x in xs), len(both), sum(x[0] and not x[1] for x in xs), sum(x[1] and not x[0] for x in xs), len(both) - len(fair))
        assert all(near(s[f"tier{i}"], sum(x[3 + i] for x in fair) / len(fair) if fair else None) for i in (1, 2, 3))


def weights(spark, clusters, replicates, seed):
    frame = spark.createDataFrame([(c,) for c in clusters], "c string").select("c", F.xxhash64(F.lit(seed), "c").alias("h")).collect()
    return {r.c: metrics.poisson_weights(np.array([r.h], np.int64).view(np.uint64), replicates)[:, 0] for r in frame}


def ends(xs, inner):
    xs = sorted(xs)
    n = len(xs)
    return (xs[int(0.025 * (n - 1))], xs[int(0.975 * (n - 1))]) if inner else (xs[int(0.025 * n)], xs[int(0.975 * n) - 1])


def test_eight_intervals(spark):
    rows, replicates = made(150, 5), 300
    got = {r.metric: r for r in scoring.intervals(spark.createDataFrame(rows, f"{RECORD}, {STATS}").repartition(3), replicates=replicates, seed=4).collect()}
    w = weights(spark, {r[0] for r in rows}, replicates, 4)
    draws = defaultdict(list)
    for k in range(replicates):
        recs, b = plain_blocks([r for r in rows for _ in range(int(w[r[0]][k]))])
        rate = lambda rs, key: (lambda xs: sum(xs) / len(xs) if xs else None)([r[key] for r in rs if r[key] is not None])
        three, four = b["result_3class"], b["result_4class"]
        values = {"result_3class.accuracy": three.get("accuracy"), "result_3class.cohen_kappa": three.get("cohen_kappa"), "result_3class.macro_f1": three.get("macro_f1"), "result_3class.inconclusive_recall": three["per_class"]["inconclusive"][4] if three["n"] else None,
                  "result_4class.accuracy": four.get("accuracy"), "result_4class.reversal_recall": four["per_class"]["reversal"][4] if four["n"] else None, "replication_type.accuracy_4class": rate([r for r in recs if r["type_scored"] and not r["type_two_class"]], "type_ok"), "original_doi.accuracy": rate([r for r in recs if r["doi_scored"]], "doi_ok")}
        for name, v in values.items():
            if v is not None:
                draws[name].append(v)
    assert set(got) == {k for k, v in draws.items() if len(v) >= 100} and len(got) == 8
    for name, xs in draws.items():
        lo, hi = ends(xs, False)
        assert got[name].n_boot == len(xs) and near(got[name].lo, lo) and near(got[name].hi, hi), name


def test_five_intervals_of_set_scores(spark):
    rng = random.Random(2)
    gt = [(f"p{p}", f"10.1000/abcdef{rng.randrange(9)}") for p in range(20) for _ in range(3)]
    ext = [(f"p{p}", f"10.1000/abcdef{rng.randrange(9)}") for p in range(18) for _ in range(2)]
    frame = lambda x: spark.createDataFrame(x, "paper string, item string").repartition(2)
    scores = metrics.set_scores(frame(gt), frame(ext), "paper", "item")
    got = {r.metric: r for r in metrics.set_intervals(scores, "paper", 400, seed=9).collect()}
    per, w = scores.collect(), weights(spark, {f"p{p}" for p in range(20)}, 400, 9)
    draws = defaultdict(list)
    for k in range(400):
        own = [r for r in per for _ in range(int(w[r.paper][k]))]
        tp, n_gt, n_ext = (sum(r[c] for r in own) for c in ("tp", "n_gt", "n_ext"))
        draws["micro_recall"].append(tp / n_gt)
        draws["micro_precision_lb"].append(tp / n_ext)
        for name, c in (("macro_recall", "recall"), ("hit_rate", "hit"), ("exact_rate", "exact")):
            draws[name].append(sum(r[c] for r in own) / len(own))
    assert len(got) == 5
    for name, xs in draws.items():
        assert (near(got[name].lo, ends(xs, True)[0]) and near(got[name].hi, ends(xs, True)[1])), name
    assert metrics.set_intervals(scores.where("paper = 'p1'"), "paper", 400).collect() == []


def test_lenient_hits(spark):
    rng = random.Random(8)
    item = lambda: "10.1000/" + "abcdefgh"[: rng.randrange(9)] + rng.choice(["", ".", ".x", "xyz"])
    gt, ext = ([(f"p{p}", item()) for p in range(40) for _ in range(2)] for _ in range(2))
    frame = lambda x: spark.createDataFrame(x, "paper string, item string")

    def alike(a, b):
        short, long = sorted((a, b), key=len)
        return a == b or len(short) >= 12 and long.startswith(short) and len(long) - len(short) <= 3

    want = {p for p, g in gt for q, e in ext if p == q and alike(g, e)}
    near_ = metrics.lenient(frame(gt), frame(ext), "paper", "item")
    assert {r.paper for r in near_.collect()} == want
    scores = metrics.set_scores(frame(gt), frame(ext), "paper", "item")
    row = metrics.set_extras(scores, near_, "paper", spark.createDataFrame([("p1", 4)], "paper string, n long")).first()
    assert abs(row.hit_rate_lenient - len(want) / 40) < 1e-9 and row.extracted_none == 0 and row.ext_rows_without_doi == 4


def side(p, key, rows):
    names = ["result", "type", "doi", "title", "authors", "year", "journal", "description", "citation", *(x for f, k in scoring.STATISTICS.items() for x in ((f,) if k == "n" else (f, f"{f}_type")))]
    return ", ".join([f"paper string, {key} long", *(f"{p}_{n} string" for n in names)]), [r[:2] + tuple(r[2].get(n) for n in names) for r in rows]


def test_records(spark):
    g = [("a", 0, {"result": "Success ", "type": "direct or close", "doi": "10.1/x", "title": "On sleep", "authors": "Smith, J", "year": "1999", "journal": "J", "original_n": "40", "original_es": "0.5", "original_es_type": "d", "replication_p_value": "0.03", "replication_p_value_type": "="}),
         ("a", 1, {"result": "failure", "type": "direct", "doi": "10.1/pre", "replication_es": "0.3"}), ("b", 0, {"result": "success", "doi": ""})]
    e = [("a", 0, {"result": "reversal", "type": "close", "doi": "10.1/x", "title": "on sleep", "authors": "SMITH, John", "year": "1999.0", "journal": "other things", "citation": "As Smith (1999) says", "original_n": "41", "original_es": "0.52", "original_es_type": "r", "replication_p_value": "0.04", "replication_p_value_type": "<"}),
         ("a", 1, {"result": "failure", "type": "close experiment", "doi": "10.1/y", "replication_es": "0.305"}), ("a", 2, {"result": "success", "doi": "10.1/y"}), ("b", 0, {"result": "success"})]
    gs, gr = side("g", "gt", g)
    es, er = side("e", "ext", e)
    gt = spark.createDataFrame([(*r, f"r{i}", "src", "dev", "psych", "x", "paper" if r[0] == "b" else "effect", "", False, i == 2, "p") for i, r in enumerate(gr)], gs + ", row_id string, source string, split string, discipline_group string, year_bucket string, granularity string, gt_ambiguity string, effects_complete boolean, has_reversal_class boolean, provenance string")
    ext = spark.createDataFrame([(*r, "why " * 200) for r in er], es + ", e_explanation string")
    aliases = spark.createDataFrame([(1, "10.1/pre", "10.1/y", "preprint")], "seq long, alias string, canonical string, kind string")
    matches = spark.createDataFrame([("a", 0, 0), ("a", 1, 1), ("b", 0, 0)], "paper string, gt long, ext long").selectExpr("*", "'doi' as method", "'same_effect' as relation", "'high' as confidence", "0.0D as cost")
    papers = spark.createDataFrame([("a", "xml", "m")], "paper string, tier string, model string")
    got = {(r.paper, r.gt): r for r in scoring.scored(matches, gt, ext, aliases, papers).collect()}
    one, two, three = got["a", 0], got["a", 1], got["b", 0]
    assert (one.ext_result, one.ext_result_raw, one.collapse_applied, one.result_ok, one.tier, len(one.ext_explanation)) == ("failure", "reversal", True, False, "xml", 400)
    assert (one.type_two_class, one.type_ok, one.type_adjacent_ok, one.type_two_ok) == (True, True, None, None)
    assert (one.title_ok, one.authors_ok, one.year_ok, one.journal_ok, one.cit_present, one.cit_author_year_ok, one.cit_overlap_ok) == (True, True, True, False, True, True, None)
    s = one.stats
    assert tuple(s.original_n) == (True, True, True, False, False, True, True) and s.original_es.type_mismatch and s.original_es.tier1 is None
    assert tuple(s.replication_p_value)[2:] == (True, False, False, False, True) and not s.original_p_value.both
    assert (two.doi_ok, two.doi_alias_used, two.type_ok, two.type_adjacent_ok, two.result_ok) == (True, True, False, True, True)
    assert (two.ext_result_paper, two.n_rows_aggregated, two.result_paper_ok) == ("inconclusive", 2, False)
    assert (three.doi_scored, three.ext_result_paper, three.tier, three.type_scored, three.bib_scored) == (False, "success", "unknown", False, False)
    assert two.stats.replication_es.tier1 and not two.cit_present


def test_reports_add_up(spark, tmp_path):
    rows = made(40, 6)
    records = spark.createDataFrame([(*r, i, i) for i, r in enumerate(rows)], f"{RECORD}, {STATS}, gt long, ext long").withColumn("result_ok", F.expr("gt_result <> '' and gt_result = ext_result"))
    more = [("gt_unmatched", "p1", 100 + i, None) for i in range(5)] + [("ext_unmatched", "p2", None, 200 + i) for i in range(7)]
    outcomes = records.select(F.lit("match").alias("outcome"), "paper", "gt", "ext").unionByName(spark.createDataFrame(more, "outcome string, paper string, gt long, ext long"))
    gt, ext = spark.createDataFrame([("p1", 100 + i, "t") for i in range(9)], "paper string, gt long, title string"), spark.createDataFrame([("p2", 200 + i, "t") for i in range(9)], "paper string, ext long, title string")
    found = scoring.write_reports(scoring.reports(outcomes, records, gt, ext), str(tmp_path))
    entry = scoring.entry_counts(outcomes).first()
    assert found["matched"] == entry.tp == 40 and found["unmatched"] == entry.fn == 5 and found["extra"] == entry.fp == 7
    per = spark.read.parquet(f"{tmp_path}/per_paper")
    assert tuple(per.agg(F.sum("n_matched"), F.sum("n_unmatched"), F.sum("n_extra")).first()) == (40, 5, 7) and found["per_paper"] == per.count()
    assert found["disagreements"] == spark.read.parquet(f"{tmp_path}/disagreements").count() == per.agg(F.sum(F.col("n_result_scored") - F.col("n_result_ok"))).first()[0]
