import math
import random
import re
from collections import Counter

import duckdb
import pytest

from curata.llm import backoff, queries


def brute(rows, order, alpha=0.4, least=2):
    texts = [[*re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))] for _, t in rows]
    counts = Counter(tuple(w[i : i + k]) for w in texts for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total = sum(map(len, texts))

    def one(gram):
        if len(gram) == 1:
            return counts[gram] / total
        return counts[gram] / counts[gram[:-1]] if counts[gram] >= least else alpha * one(gram[1:])

    return [(i, len(w), sum(math.log(one(tuple(w[max(0, k - order + 1) : k + 1]))) for k in range(len(w)))) for (i, _), w in zip(rows, texts, strict=True)]


@pytest.mark.parametrize("order", [1, 2, 4])
def test_as_brute_force(spark, order, monkeypatch):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("a b c d e f gg HH ii jj éé".split(), k=rng.choice([0, 1, 2, 5, 60])))) for i in range(150)] + [(500, None), (501, " \n"), (502, "a b"), (502, "a b")]
    monkeypatch.setattr(backoff, "BLOCK_BYTES", 66000)
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int").repartition(3)
    got = sorted((r.doc_id, r.n_words, round(r.log_score, 8)) for r in backoff.score(frame, order).collect())
    assert got == sorted((i, n, round(s, 8)) for i, n, s in brute(rows, order))
    assert all((r.mean_log is None) == (r.n_words == 0) for r in backoff.score(frame, order).collect())


def test_no_documents(spark):
    assert backoff.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sql_gives_the_same(spark):
    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = {r[0]: r[1:] for r in duckdb.sql(backoff.ORACLE).fetchall()}
    got = {r.doc_id: (r.n_words, r.log_score, r.mean_log) for r in queries.op5_backoff(spark, sf).collect()}
    assert got.keys() == want.keys()
    for k, (n, s, m) in got.items():
        assert n == want[k][0] and abs(s - want[k][1]) < 2e-4 and (m is None or abs(m - want[k][2]) < 2e-6)
