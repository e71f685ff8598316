import hashlib
import random
import zlib

import numpy as np
import pytest

from curata.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth int, hash string"


def plain(rows):
    """The nodes, told plainly."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = c - int(np.fmod(c, 20))
        paths[c] = turns.get(head, [])[:h] + v[h:]
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(tuple(p[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        leaf = lambda p: not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes)
        count = lambda p: len([w for w in T_WORD.findall(p[-1][1])]) if p else 0
        ends = ",".join(str(c) for c in sorted(c for c in members if len(paths[c]) == len(path)))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), sum(len(p) == len(path) + 1 for p in below), sum(map(leaf, below)), sum((len(nodes[p]) - 1) * count(p) for p in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


import re  # noqa: E402

T_WORD = re.compile(T.WORD)


def cases(seed, n=60):
    random.seed(seed)
    said = ["hello there", "", None, "a  b\tc", "x", "yes", "hello there "]
    rows = [(c, t if random.random() < 0.9 else None, random.choice(["user", "assistant", None]), random.choice(said[: 2 + seed % 5])) for c in random.sample(range(-30, 90), n) for t in range(random.randint(1, 6))]
    return rows + [rows[0]] * 3 + [(None, 1, "user", "nobody"), (7, None, None, None)]


def got(frame):
    return sorted([tuple(r) for r in frame.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()], key=lambda r: r[:2])


def built(spark, rows, bits=61, parts=3):
    return T.trie(*T.rebuilt(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)), ["part", "i"], bits=bits)


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_the_plain_trie(spark, monkeypatch, seed):
    monkeypatch.setattr(T, "SEGMENT", 2)
    monkeypatch.setattr(T, "CHUNK", 3)
    rows = cases(seed)
    assert got(built(spark, rows)) == sorted(plain(rows), key=lambda r: r[:2])


@pytest.mark.parametrize("bits", [0, 2])
def test_colliding_fingerprints_are_split(spark, bits):
    rows = cases(3, 25)
    assert got(built(spark, rows, bits=bits)) == sorted(plain(rows), key=lambda r: r[:2])


def test_one_conversation_over_many_tasks(spark):
    rows = [(0, i, "user", f"word {i % 7}") for i in range(3000)] + [(20, i, "user", f"word {i % 7}") for i in range(0, 2000)] + [(c, i, "user", "same") for c in range(40, 60) for i in range(5)]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r[:2]: r for r in got(built(spark, rows))}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[0, 0][3] == 22 and found[0, 1999][3] == 2 and found[0, 2500][3] == 1  # 3,000 turns over seven tasks, one trie path
    assert found[0, 0][6] == 2 * 2000 + 19 * 5 and found[0, 1][6] == 2 * 2000 and found[0, 1500][6] == 2 * 501
    assert len(found) == 1 + 3000 + 5 and (20, 1) not in found


def test_no_conversations(spark):
    assert got(built(spark, [])) == [] and got(built(spark, [(None, 1, "a", "b")])) == []


def test_products_and_sums_modulo_the_prime():
    rng = np.random.default_rng(2)
    a, b = (np.concatenate([rng.integers(0, T.PRIME, 500, dtype=np.uint64), np.array([0, 1, T.PRIME - 1, 1 << 31, (1 << 31) - 1], np.uint64)]) for _ in range(2))
    assert T.times(a, b[::-1]).tolist() == [x * y % T.PRIME for x, y in zip(a.tolist(), b[::-1].tolist())]
    keys, hashes = np.sort(rng.integers(0, 5, 400)), rng.integers(0, 1 << 64, 400, dtype=np.uint64)
    real, scan, want = (rng.random(400) < 0.9).astype(np.int64), T.Scan(), []
    found = [np.concatenate(x) for x in zip(*(scan(keys[i : i + 37], hashes[i : i + 37], real[i : i + 37]) for i in range(0, 400, 37)))]
    for i in range(400):
        own = [h for k, h, r in zip(keys[: i + 1].tolist(), hashes[: i + 1].tolist(), real[: i + 1].tolist()) if k == keys[i] and r]
        total = sum(h * pow(T.BASE, j, T.PRIME) for j, h in enumerate(own)) % T.PRIME
        last = own[-1] * pow(T.BASE, len(own) - 1, T.PRIME) if real[i] else 0
        want.append((len(own), total, (total - last) % T.PRIME))
    assert list(zip(*(x.tolist() for x in found))) == want
