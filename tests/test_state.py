"""What is kept between runs: the index of keys of a stream's table, versions of a snapshot; and the range probe."""

import os
import random

import pytest
from pyspark.sql import functions as F

from curata.operators import catalog, review
from curata.sources import versions
from curata.streaming import events

BATCH = "seq long, doi string, pmid string, title string"
KEYS = ["doi", "pmid", "title"]


def put(spark, folder, number, rows):
    events.put_unseen(spark.createDataFrame(rows, BATCH), number, KEYS, folder)


def test_a_batch_reads_its_own_buckets_only(spark, tmp_path):
    folder = str(tmp_path / "table")
    put(spark, folder, 0, [(i, f"d{i}", None, None) for i in range(500)])
    files = lambda buckets: {f.split("bucket=")[1].split("/")[0] for f in events.known_keys(spark, folder, 1, buckets).inputFiles()}
    everything = events.known_keys(spark, folder, 1, list(range(events.BUCKETS)))
    assert everything.count() == 500 and len(files(list(range(events.BUCKETS)))) > 50
    plan = events.known_keys(spark, folder, 1, [3, 9])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "IN (3,9)" in plan.replace("bucket#", "").replace(" IN ", " IN ") or "bucket" in plan
    rows = events.known_keys(spark, folder, 1, [3, 9])
    assert 0 < rows.count() < 60 and {r.b for r in rows.select(F.pmod(F.xxhash64("kind", "key"), F.lit(events.BUCKETS)).alias("b")).distinct().collect()} <= {3, 9}


def test_any_key_counts_and_restarts_keep_every_row(spark, tmp_path):
    rng = random.Random(4)
    folder, known, want = str(tmp_path / "table"), set(), []
    value = lambda kind: rng.choice([None, "", *(f"{kind}{k}" for k in range(60))])
    seq = 0
    for number in range(4):
        rows = [(seq + i, value("d"), value("p"), value("t")) for i in range(25)]
        seq += 25
        before, inside = set(known), set()
        for r in rows:
            own = {(k, v) for k, v in zip(KEYS, r[1:], strict=True) if v}
            if not own & before and not own & inside:
                want.append(r[0])
                known |= own
            inside |= own
        put(spark, folder, number, rows)
        if number == 2:
            put(spark, folder, number, rows)  # the same again, as after a failure
        assert sorted(r.seq for r in events.appended(spark, BATCH, folder).collect()) == sorted(want)


def test_versions(spark, tmp_path):
    folder = str(tmp_path / "snapshot")
    make = lambda rows: spark.createDataFrame(rows, "k string, v int")
    assert versions.current(spark, folder) is None
    versions.create(make([(f"k{i}", i) for i in range(100)] + [(None, 7)]), folder, "k", 16)
    v = versions.upsert(make([("k1", -1), ("new", 5), (None, 8)]), folder, "k")
    assert v == versions.current(spark, folder) == 1
    rows = lambda version=None: {(r.k, r.v) for r in versions.read(spark, folder, version).collect()}
    first = {(f"k{i}", i) for i in range(100)} | {(None, 7)}
    assert rows(0) == first and rows() == first - {("k1", 1)} | {("k1", -1), ("new", 5), (None, 8)}
    paths = lambda version: {r.bucket: r.path for r in versions.manifest(spark, folder, version).collect()}
    moved = {b for b in paths(0) if paths(0)[b] != paths(1)[b]}
    assert 1 <= len(moved) <= 3 and len(paths(1)) == 16
    versions.drop_stale(make([(f"k{i}", 0) for i in range(0, 100, 2)] + [("new", 0)]), folder, "k")
    assert rows() == {(f"k{i}", i) for i in range(0, 100, 2)} | {("new", 5)} and rows(0) == first
    versions.drop_stale(make([(f"k{i}", 0) for i in range(100)] + [("new", 0)]), folder, "k")
    assert paths(3) == paths(2) and versions.current(spark, folder) == 3
    versions.drop_stale(make([]), folder, "k")
    assert rows() == set() and rows(0) == first


def test_a_writer_that_died_leaves_no_version(spark, tmp_path):
    folder = str(tmp_path / "snapshot")
    frame = spark.createDataFrame([(i, i) for i in range(20)], "k long, v long")
    versions.create(frame, folder, "k", 4)
    versions.upsert(frame.where("k < 3").withColumn("v", -F.col("v")), folder, "k")
    os.remove(f"{folder}/manifest/version=1/_SUCCESS")  # as if it had died before the end
    assert versions.current(spark, folder) == 0 and versions.read(spark, folder).agg(F.sum("v")).first()[0] == 190
    import shutil

    shutil.rmtree(f"{folder}/manifest/version=1")
    assert versions.upsert(frame.where("k = 19").withColumn("v", F.lit(0)), folder, "k") == 1
    assert versions.read(spark, folder).agg(F.sum("v")).first()[0] == 171
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        versions._commit(frame, folder, "k", 1, [0], [], 4)


def test_probes_below_one_prefix(spark):
    keys = spark.range(100_000).select(F.format_string("10.1000--same%07d", F.col("id")).alias("key"))
    probes = spark.range(100_000).select(F.format_string("10.1000--same%06d", F.col("id") % 10_000).alias("probe")).union(keys.limit(10)).union(spark.range(1).select(F.lit("10.1000--other").alias("probe")))
    found = catalog.prefix_probe(probes, keys)
    assert found.count() == 10 and found.where("probe <> key").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_probes_as_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choices("ab", k=n))
    keys = ["prefix-" + word(rng.randint(3, 9)) for _ in range(60)] + ["prefix-ü" + word(6), None]
    probes = ["prefix-" + word(rng.randint(3, 8)) for _ in range(60)] + ["short", None, "prefix-üabab", *keys[:9]]
    want = {}
    for p in probes:
        hit = [k for k in keys if p and len(p) >= 12 and k and k.startswith(p)]
        if len(hit) == 1:
            want[p] = hit[0]
    frame = lambda x, c: spark.createDataFrame([(v,) for v in x], f"{c} string").repartition(3)
    assert {r.probe: r.key for r in catalog.prefix_probe(frame(probes, "probe"), frame(keys, "key")).collect()} == want


def test_complete_labels(spark):
    wanted = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("d", 1), ("e", 1)], "u string, r int")
    given = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "bad"), ("c", 1, "x"), ("c", 2, "x"), ("f", 1, "x"), ("e", 1, None)], "u string, r int, label string")
    assert {r.u: r.complete for r in review.complete(given, wanted, "u", "r", ["x", "y"]).collect()} == {"a": True, "b": False, "c": False, "d": False, "e": False}
