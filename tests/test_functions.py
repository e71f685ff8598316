"""Vectors of the functions' semantics, and properties."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curata.functions import ids, text, validate
from curata.operators import extraction, matching, metrics, resolve, routing, rules, sampling
from curata.operators.components import components
from curata.operators.ordered import prefix
from curata.sources import readers, sinks


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("https://doi.org/10.1037/A0025140.", "10.1037/a0025140"),
        ("10.1044/1092-4388(2004/026)", "10.1044/1092-4388(2004/026)"),
        ("(10.1000/abc)", None),
        ("10.1000/abc)", "10.1000/abc"),
        ("10.1000/a bc", None),
        ("10.1000/abc).];", "10.1000/abc"),
        (None, None),
        ("", None),
        ("10.1000/...", None),
    ],
)
def test_normalize_doi(spark, raw, want):
    assert one(spark, raw, ids.normalize_doi) == want


@pytest.mark.parametrize("doi, folder", [("10.18260/1-2--47556", "10.18260--1-2~2d~~2d~47556"), ("10.1023/a:123", "10.1023--a~123"), ("10.1037//0002-9432.71.3.379", "10.1037----0002-9432.71.3.379"), ("10.1002/1099(200007)7:3<220::aid>3.0.co;2-f", "10.1002--1099(200007)7~3~3c~220~~aid~3e~3.0.co;2-f")])
def test_folder_codec(spark, doi, folder):
    assert one(spark, doi, ids.doi_to_folder) == folder
    assert one(spark, folder, ids.folder_to_doi) == doi


def test_folder_suffix(spark):
    assert one(spark, "10.1001--foo (1)", ids.folder_to_doi) == "10.1001/foo"


def test_codec_round_trip(spark):
    rng = random.Random(1)
    rows = [("10.1000/" + "".join(rng.choices("ab-/:<>?*|.", k=12)).strip("/") + "x",) for _ in range(400)]
    frame = spark.createDataFrame(rows, "v string")
    assert frame.where(ids.folder_to_doi(ids.doi_to_folder(F.col("v"))) != F.col("v")).where(~F.col("v").rlike(r":[0-9a-f]{2}:|~|--")).count() == 0


def test_names(spark):
    assert one(spark, "Smith, John; Jones, Alice", text.last_names) == ["jones", "smith"]
    assert one(spark, "Leigh Ann Vaughn", text.last_names) == ["vaughn"]
    assert one(spark, "nan", text.last_names) == []
    assert one(spark, "J Lukas; Jonathan W Schooler", text.format_initials) == "J. Lukas; Jonathan W. Schooler"
    rows = [("A. Lee; B. Ray", "Ann Lee; Bo Ray", True), ("Ann Lee; Bo Ray", "A. Lee; B. Ray", False), ("A Lee; B Ray; C Fox; D Elk", "Ann Lee", False), ("", "A Lee", True), ("A Lee", None, False), ("A Lee; B Ray; C Fox", "Ann Lee; Bo Ray", True)]
    frame = spark.createDataFrame(rows, "a string, b string, want boolean")
    assert frame.where(text.better_authors(F.col("a"), F.col("b")) != F.col("want")).count() == 0


def test_similarity(spark):
    import difflib

    rows = [("Errors Are Aversive", "Errors Are Aversive: Defensive Motivation"), ("a b c", "a b c"), ("", "x"), (None, "x"), ("Café &amp; Co", "cafe & co")]
    frame = spark.createDataFrame(rows, "a string, b string").select("a", "b", text.string_ratio("a", "b").alias("r"), text.title_similarity(0.9)("a", "b").alias("t"))
    for r in frame.collect():
        a, b = (r.a or "").lower(), (r.b or "").lower()
        assert abs(r.r - (difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0)) < 1e-12
    assert [round(r.t, 2) for r in frame.collect()][:4] == [0.9, 1.0, 0.0, 0.0]
    assert one(spark, "Acemoğlu Ünal", text.fold) == "acemoglu unal"


@pytest.mark.parametrize("raw, want", [('```json\n{"a": 1}\n```', '{"a": 1}'), ('Sure: {"a": 1} done {x}', '{"a": 1}'), ('[{"a": 1}]', '{"contains_replications": true, "replications": [{"a": 1}]}'), ("[]", '{"contains_replications": false, "replications": []}'), ("no json here", None), (None, None)])
def test_replies(spark, raw, want):
    assert one(spark, raw, text.parsed_reply) == want


@pytest.mark.parametrize(
    "title, abstract, keep, reason",
    [
        ("A direct replication of X", "", True, "strong_positive"),
        ("Viral replication in cells", "", False, "bio_replication"),
        ("Replication of SARS-CoV-2", "", False, "bio_replication"),
        ("Replication of the Asch effect", "", True, "weak_positive"),
        ("Assay reproducibility", "", False, "measurement_repro"),
        ("Growth", "Done with technical replicates.", False, "stat_replicates_only"),
        ("Replicating growth", "Done with technical replicates.", True, "title_has_replication"),
        ("Growth", "Something else", False, "no_replication_word"),
        (None, None, False, "no_replication_word"),
        ("Reproducibility", "", False, "weak_replication_word"),
    ],
)
def test_screening_rules(spark, title, abstract, keep, reason):
    r = spark.createDataFrame([(title, abstract)], "t string, a string").select(rules.classify(F.col("t"), F.col("a")).alias("r")).first()["r"]
    assert (r["keep"], r["reason"]) == (keep, reason)
    assert bool(r["detail"]) == (reason in ("strong_positive", "weak_positive"))


def brute_components(links):
    label = {}
    for a, b in links:
        label.setdefault(a, a)
        label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    return label


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(120)], [(0, i) for i in range(1, 40)], [], [(5, 5)], None])
def test_components(spark, links):
    if links is None:
        rng = random.Random(4)
        links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in components(frame).collect()}
    want = brute_components([(a, b) for a, b in links if a != b])
    assert got == want


def test_bridging_row_and_short_titles(spark):
    rows = [(0, "10.1000/x", "", "first title of a certain length", ""), (1, "", "7", "second one", ""), (2, "10.1000/X", "7", "third", ""), (3, "", "", "short", ""), (4, "", "", "short", "")]
    frame = spark.createDataFrame(rows, "seq long, doi string, pmid string, title string, abstract string")
    assert {r.seq: r.root for r in resolve.resolve(frame).collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4}


def test_manifest_vector(spark):
    c = spark.createDataFrame([("10.1/a", "p", "0"), ("10.1/b", "q", "")], "doi string, path string, contains string")
    got = {r.doi: r.contains for r in routing.manifest(c, spark.createDataFrame([("10.1/A",), ("10.1/new",)], "doi string")).collect()}
    assert got == {"10.1/a": "1", "10.1/b": "", "10.1/new": "1"}


@pytest.mark.parametrize("labels, want", [(["success", "inconclusive"], "success"), (["success", "inconclusive", "inconclusive"], "inconclusive"), (["reversal", "success"], "inconclusive"), ([""], ""), (["failure"], "failure"), (["success", "failure"], "inconclusive")])
def test_paper_verdict(spark, labels, want):
    assert metrics.paper_verdict(spark.createDataFrame([("p", x) for x in labels], "p string, l string"), "p", "l").first()["verdict"] == want


def test_metric_vectors(spark):
    pairs = spark.createDataFrame([("success", "success"), ("success", "success"), ("failure", "failure"), ("inconclusive", "success")], "gt string, ext string")
    per = {r["class"]: r for r in metrics.class_metrics(pairs, ["success", "failure", "inconclusive", "reversal"]).collect()}
    assert abs(per["success"].precision - 2 / 3) < 1e-12 and per["inconclusive"].recall == 0 and per["inconclusive"].f1 == 0 and per["reversal"].f1 is None
    assert metrics.overall(pairs, ["success", "failure", "inconclusive"]).first()["accuracy"] == 0.75
    same = spark.createDataFrame([("x", "x")], "a string, b string")
    assert metrics.kappa(same).first()["kappa"] == 1.0
    assert metrics.kappa(same.where("false")).collect()[0]["n"] == 0
    n = spark.createDataFrame([("100", "104")], "a string, b string").select(metrics.stat_tiers("n", F.col("a"), F.col("b")).alias("t")).first()["t"]
    assert (n.tier1, n.tier2, n.tier3) == (False, True, True)
    s = metrics.set_scores(spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "z")], "p string, i string"), spark.createDataFrame([("p", "a"), ("p", "c")], "p string, i string"), "p", "i")
    assert {r.p: (r.recall, r.precision_lb) for r in s.collect()} == {"p": (0.5, 0.5), "q": (0.0, None)}
    assert abs(metrics.set_summary(s).first()["micro_recall"] - 1 / 3) < 1e-12


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.randoms())
def test_hungarian_is_least(n, m, rng):
    cost = np.array([[rng.choice([0.1, 0.5, 1, 3, 9]) + rng.random() for _ in range(m)] for _ in range(n)])
    pairs = matching.hungarian(cost)
    assert len(pairs) == min(n, m) == len({i for i, _ in pairs}) == len({j for _, j in pairs})
    small, large = (range(n), range(m)) if n <= m else (range(m), range(n))
    best = min(sum(cost[i, j] if n <= m else cost[j, i] for i, j in zip(small, p, strict=True)) for p in itertools.permutations(large, len(small)))
    assert abs(sum(cost[i, j] for i, j in pairs) - best) < 1e-9


def test_corrections_vector(spark):
    rows = spark.createDataFrame([("a", "x", "h"), ("b", "y", "h"), ("c", "z", "h")], "id string, f string, provenance string")
    changes = spark.createDataFrame([(1, "a", "set", "f", "1"), (2, "a", "set", "f", "2"), (3, "b", "drop", "", ""), (4, "c", "flag", "", "")], "seq int, id string, action string, field string, value string")
    assert sorted(map(tuple, extraction.corrected(rows, changes, "id", ["f"]).collect())) == [("a", "2", "h+corrected"), ("c", "z", "h+corrected")]


def test_blinding():
    from pyspark.sql import types as T

    schema = T._parse_datatype_string("id int, rows array<struct<id int, secret string>>")
    assert extraction.wrong_schema_fields(schema, {"id", "rows"}) == ["rows.secret"]


def test_split_share_and_samples(spark):
    rows = spark.range(2000).withColumnRenamed("id", "k").withColumn("s", F.col("k") % 7)
    share = rows.select(F.avg((ids.split_of(F.col("k").cast("string"), "x") == "test").cast("double"))).first()[0]
    assert 0.55 < share < 0.65
    a, b = (sorted(r.k for r in sampling.stratified(rows.repartition(n), "s", "k", 50, "q").collect()) for n in (2, 5))
    assert a == b and len(a) == 50
    assert sorted(r.k for r in sampling.under_cap(spark.createDataFrame([(1, 5), (2, 6), (3, 9), (4, 1)], "k long, n long"), "n", "k", 12).collect()) == [1, 2, 4]


def test_positions_and_sums(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(50)]), rng.randint(0, 9), i) for i in range(300)]
    got = prefix(spark.createDataFrame(rows, "k long, v long, t long").repartition(4), "k", "v", ["t"], buckets=8).orderBy("position").collect()
    start = 0
    for p, (k, v, t) in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))):
        assert (got[p].position, got[p].start, got[p].k, got[p].t) == (p, start, k, t)
        start += v
    assert prefix(spark.createDataFrame([], "k long, v long, t long"), "k", "v", ["t"]).count() == 0


def test_csv_round_trip(spark, tmp_path):
    rows = [("1", 'a "quoted", cell\nover lines', None), ("2", "", "é")]
    sinks.write_csv(spark.createDataFrame(rows, "id string, t string, u string"), str(tmp_path / "x"), ["id", "t", "u"], files=1)
    got = sorted(map(tuple, readers.csv(spark, str(tmp_path / "x")).select("id", F.coalesce("t", F.lit("")), F.coalesce("u", F.lit(""))).collect()))
    assert got == [("1", 'a "quoted", cell\nover lines', ""), ("2", "", "é")]


def test_append_to_table(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "seq long, doi string, pmid string, title string"
    spark.createDataFrame([(0, "10.1000/a", "", "")], schema).write.parquet(path)
    new = spark.createDataFrame([(1, "https://doi.org/10.1000/A", "", ""), (2, "", "5", ""), (3, "", "5", ""), (4, "", "", "tiny")], schema)
    assert sinks.append_unseen(new, path) == 2
    assert sorted(r.seq for r in spark.read.parquet(path).collect()) == [0, 2, 4]


def test_verdicts(spark):
    rows = [("True", "high", None, True), ("x", "high", None, False), ("false", "direct", "direct", False), ("false", "LOW", "Direct", True)]
    frame = spark.createDataFrame(rows, "a string, b string, c string, ok boolean")
    assert frame.where(validate.verdict(F.col("a"), F.col("b"), F.col("c")).isNotNull() != F.col("ok")).count() == 0


def test_order_of_partitions_does_not_matter(spark):
    from curata.plans import fixtures as fx

    c = fx.candidates(spark, "/root/testdata/sf0.001")
    results = [sorted(map(tuple, resolve.golden(x, resolve.resolve(x)).collect())) for x in (c.repartition(3), c.repartition(7, "title"))]
    assert results[0] == results[1]
