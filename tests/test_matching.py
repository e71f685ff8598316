"""The staged matcher, alignment of sheets and appends to a stream's table against plain Python."""

import itertools
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from curata.functions import text
from curata.operators import gold, matching, metrics, review, sampling
from curata.streaming import events

ENTRY = "doi string, description string, title string, authors string, year string"


def ratio(a, b):
    a, b = a.lower().strip(), b.lower().strip()
    return 0.0 if not a or not b else 1.0 if a == b else SequenceMatcher(None, a, b).ratio()


def brute(gt, ext, aliases, verdicts):
    """Outcomes of one paper: (least total cost, {pair: cost}, listed pairs)."""
    canon = lambda d: aliases.get(d, d)
    cost, listed = {}, set()
    for i, g in enumerate(gt):
        for j, e in enumerate(ext):
            if g[0] and canon(g[0]) == canon(e[0]):
                cost[i, j] = 0.05 * (1 - ratio(g[1], e[1]))
    hits = {i: [j for j in range(len(ext)) if (i, j) in cost] for i in range(len(gt))}
    for i, g in enumerate(gt):
        shared = g[0] and sum(canon(x[0]) == canon(g[0]) for x in gt) > 1
        ambiguous = len(hits[i]) > 1 and shared
        if hits[i] and not ambiguous:
            continue
        v = (verdicts or {}).get(i)
        if v is not None:
            j, relation, confidence, failed = v
            there = j is not None and (j in hits[i] if ambiguous else j < len(ext))
            if there and relation in matching.SAME_RELATIONS:
                cost[i, j] = 0.0 if ambiguous else min(cost.get((i, j), 9), matching.VERDICT_COST.get(confidence, 0.7))
            elif there and relation in ("same_original_other_effect", "different_original"):
                listed.add((i, j, relation))
        if not hits[i] and (v is None or v[3]):
            for j, e in enumerate(ext):
                names = lambda s: {x.strip().lower() for x in s.split(";") if x.strip()}
                a, b = names(g[3]), names(e[3])
                score = (ratio(g[2], e[2]) >= 0.75) + bool(a and b and len(a & b) / len(a | b) >= 0.7) + bool(g[4] and g[4] == e[4])
                if score >= 2:
                    cost[i, j] = min(cost.get((i, j), 9), 0.5 + 0.1 * (3 - score))
    n, m = len(gt), len(ext)
    size = max(n, m)
    best = min(sum(cost.get((i, p[i]), 9) for i in range(n) if p[i] < m) for p in itertools.permutations(range(size), n)) if n and m else 0
    return best, cost, listed


def made(rng):
    doi = lambda: rng.choice(["", "10.1/a", "10.1/b", "10.1/c", "10.1/c2"])
    one = lambda: (doi(), rng.choice(["an effect of x", "an effect of y", "other"]), rng.choice(["a long title of a study", "a long title of a study!", "quite another thing"]), rng.choice(["", "Lee", "Lee; Kim", "Ray"]), rng.choice(["", "1999", "2001"]))
    return [one() for _ in range(rng.randint(1, 4))], [one() for _ in range(rng.randint(1, 4))]


@pytest.mark.parametrize("judged,large", [(True, 10**6), (True, 1), (False, 10**6)])
def test_staged_as_brute_force(spark, judged, large):
    rng = random.Random(7)
    papers = {f"p{k}": made(rng) for k in range(60)}
    relations = ["same_effect", "subanalysis_of_gt", "same_original_other_effect", "different_original", "none"]
    verdicts = {p: {i: (rng.choice([None, *range(len(e))]), rng.choice(relations), rng.choice(["high", "medium", "low", "odd"]), rng.random() < 0.2) for i in range(len(g)) if rng.random() < 0.7} for p, (g, e) in papers.items()}
    names = lambda p: ", ".join(f"{p}_{c}" for c in ENTRY.split(", "))
    gt = spark.createDataFrame([(p, i, *x) for p, (g, _) in papers.items() for i, x in enumerate(g)], f"paper string, gt long, {names('g')}")
    ext = spark.createDataFrame([(p, j, *x) for p, (_, e) in papers.items() for j, x in enumerate(e)], f"paper string, ext long, {names('e')}")
    aliases = spark.createDataFrame([(1, "10.1/c2", "10.1/c", "reprint")], "seq int, alias string, canonical string, kind string")
    told = spark.createDataFrame([(p, i, v[0], v[1], v[2], "why", v[3]) for p, own in verdicts.items() for i, v in own.items()], "paper string, gt long, ext long, relation string, confidence string, reason string, failed boolean")
    rows = matching.staged(gt, ext, aliases, told if judged else None, large).collect()
    for paper, (g, e) in papers.items():
        best, cost, listed = brute(g, e, {"10.1/c2": "10.1/c"}, verdicts[paper] if judged else None)
        own = [r for r in rows if r.paper == paper]
        pairs = {(r.gt, r.ext): r.cost for r in own if r.outcome == "match"}
        assert all(abs(cost[k] - c) < 1e-3 for k, c in pairs.items())
        assert abs(sum(pairs.values()) + 9 * (min(len(g), len(e)) - len(pairs)) - best) < 1e-2
        assert {r.gt for r in own if r.outcome == "gt_unmatched"} == set(range(len(g))) - {i for i, _ in pairs}
        assert {r.ext for r in own if r.outcome == "ext_unmatched"} == set(range(len(e))) - {j for _, j in pairs}
        kind = {"same_original_other_effect": "granularity_miss", "different_original": "wrong_original"}
        assert {(r.gt, r.ext, r.outcome) for r in own if r.outcome in kind.values()} == {(i, j, kind[x]) for i, j, x in listed}


def test_a_large_paper_in_parts_gives_the_same(spark):
    rng = random.Random(3)
    costs = spark.createDataFrame([("hot", i, 10 * (i // 5) + j, rng.random()) for i in range(40) for j in range(7)], "paper string, gt long, ext long, cost double")
    whole, parts = ({(r.gt, r.ext) for r in matching.assign(costs, large).collect()} for large in (10**6, 10))
    assert whole == parts and len(whole) == 40
    scores = costs.withColumnRenamed("cost", "score")
    whole, parts = ({(r.gt, r.ext) for r in matching.greedy(scores, 0.1, large).collect()} for large in (10**6, 10))
    assert whole == parts


def test_padded_titles_are_not_ruled_out_by_their_lengths(spark):
    frame = spark.createDataFrame([("  title \n" + " " * 50, "TITLE"), ("a", "b" * 30)], "a string, b string")
    assert [r.x for r in frame.select(text.could_reach("a", "b", 0.9).alias("x")).collect()] == [True, False]


def test_effect_similarity(spark):
    rows = [("The authors claimed that dogs bark", "dogs bark"), ("study 1 dogs", "study 2 dogs"), ("", "x"), ("abcdef gh", "abcdeg gh"), ("one two three", "three two one")]
    frame = spark.createDataFrame(rows, "a string, b string")
    got = [r.x for r in frame.select(text.effect_similarity(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got[0] == 1 and got[1] == got[2] == 0 and got[3] == pytest.approx(ratio(*rows[3])) and got[4] == 1


BATCH = "seq long, doi string, pmid string"


def put(spark, folder, number, rows):
    events.put_unseen(spark.createDataFrame(rows, BATCH), number, ["doi", "pmid"], folder)
    return sorted(r.seq for r in events.appended(spark, BATCH, folder).collect())


def test_a_replayed_batch_keeps_its_rows(spark, tmp_path):
    folder = str(tmp_path / "table")
    assert put(spark, folder, 0, []) == []
    assert put(spark, folder, 1, [(1, "a", "p"), (2, "b", None), (3, None, "p"), (4, None, None)]) == [1, 2, 4]
    second = [(5, "a", None), (6, "c", "q"), (7, "d", "p"), (8, "", "")]
    assert put(spark, folder, 2, second) == [1, 2, 4, 6, 8]
    assert put(spark, folder, 2, second) == [1, 2, 4, 6, 8]  # the same again, as after a failure
    assert put(spark, folder, 3, second) == [1, 2, 4, 6, 8, 8]  # rows without a key are never known


def test_late_events_are_dropped(spark, tmp_path):
    """Files in order of their time stamps; an event far behind the watermark of the batch before last no longer counts."""
    import os

    source, seen = str(tmp_path / "in"), set()
    batches = [["2024-01-01 00:10", "2024-01-01 00:20"], ["2024-01-01 06:00"], ["2024-01-01 06:10"], ["2024-01-01 00:30", "2024-01-01 05:30"], ["2024-01-01 12:00"], ["2024-01-01 12:10"]]
    for k, times in enumerate(batches):
        spark.createDataFrame([(t, "x", 1.0) for t in times], "ts string, event_type string, value double").selectExpr("cast(ts as timestamp) as ts", "event_type", "value").coalesce(1).write.mode("append").parquet(source)
        for f in set(os.listdir(source)) - seen:
            os.utime(f"{source}/{f}", (10**9 + k, 10**9 + k))
        seen = set(os.listdir(source))
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").option("maxFilesPerTrigger", 1).parquet(source)
    rows = {r.start.hour: r.n for r in events.run_to_table(events.tumbling(stream, late="1 hour"), "late").collect()}
    assert rows[0] == 2 and rows[5] == 1 and rows[6] == 2


def test_loading_truth_refuses_what_it_must(spark, tmp_path):
    def spec(rows, **kw):
        folder = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        spark.createDataFrame(rows, "row_id string, replication_doi string, provenance string, result string").write.option("header", True).csv(folder)
        return gold.Spec(folder, **kw)

    good = [("1", "10.1000/x", "human:a", "success")]
    assert gold.truth(spark, spec(good))[0].count() == 1
    for bad, kw in (([("1", "10.1000/x", "", "success")], {}), ([("1", "10.1000/x", "pipeline:v6", "success")], {}), (good, {"granularity": "paper"})):
        with pytest.raises(ValueError, match="may not be used"):
            gold.truth(spark, spec(bad, **kw))
    rows, _, info = gold.truth(spark, spec([("1", "10.1000/x", "pipeline:v6", "success")]), allow_dirty=True)
    assert rows.count() == info["n_pipeline"] == 1
    s = spec(good)
    s.manifest = {s.path: "0" * 64}
    with pytest.raises(ValueError, match="manifest"):
        gold.truth(spark, s)
    with pytest.raises(ValueError, match="no labels"):
        gold.truth(spark, spec([]))


def test_gold_of_two_coders_and_open_disagreements_are_refused(spark):
    sheet = spark.createDataFrame([("1#1", "f", "10.1000/x", "yes", "", "", "success")], "row_id string, paper_folder string, replication_doi string, is_replication_paper string, why_negative string, gt_ambiguity string, result string")
    frame = spark.createDataFrame([("f", "10.1000/x", "s")], "paper_folder string, replication_doi string, source string")
    queue = spark.createDataFrame([(1, "1#1", "result", "disagreement", "", "", "", "")], "seq int, row_id string, field string, reason string, adjudicated_value string, adjudicator_id string, adjudication_note string, gt_ambiguity string")
    with pytest.raises(ValueError, match="reconciled"):
        gold.build(sheet, frame, queue, ["result"], "a", "s", second_coder="b")
    with pytest.raises(ValueError, match="not adjudicated"):
        gold.build(sheet, frame, queue, ["result"], "a", "s")
    assert gold.build(sheet, frame, queue.where("false"), ["result"], "a", "s")[0].count() == 1


def test_work_on_another_input_is_not_resumed(spark):
    work, done = spark.range(5).withColumnRenamed("id", "k"), spark.range(2).withColumnRenamed("id", "k")
    assert review.resumed(work, done, "k", 5).count() == 3 == review.resumed(work, done, "k", None).count()
    with pytest.raises(ValueError, match="began with 4"):
        review.resumed(work, done, "k", 4)


def test_stratified_of_a_hot_stratum(spark):
    rows = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") < 2900, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("s"))
    got = sampling.stratified(rows, "s", "k", 50, "x").collect()
    import hashlib

    h = lambda r: hashlib.sha256(f"x:{r.k}".encode()).hexdigest()
    every = sorted(rows.collect(), key=lambda r: (h(r), r.k))
    quota = {s: max(1, round(50 * n / 3000)) for s, n in {x: sum(r.s == x for r in every) for x in {r.s for r in every}}.items()}
    place: dict = {}
    order = []
    for r in every:
        place[r.s] = place.get(r.s, 0) + 1
        order.append((place[r.s] > quota[r.s], h(r), r.k))
    assert {r.k for r in got} == {k for _, _, k in sorted(order)[:50]}


def test_set_scores_of_sets_without_overlap(spark):
    gt = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "c"), ("q", "c")], "paper string, item string")
    ext = spark.createDataFrame([("p", "b"), ("p", "a"), ("r", "c")], "paper string, item string")
    got = {r.paper: (r.n_gt, r.n_ext, r.tp, r.precision_lb, r.hit, r.exact) for r in metrics.set_scores(gt, ext, "paper", "item").collect()}
    assert got == {"p": (2, 2, 2, 1.0, True, True), "q": (1, 0, 0, None, False, False)}
