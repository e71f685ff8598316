"""The prefix trie of conversations, from polynomial rolling fingerprints.

1. Turns are range-sorted by conversation and order; one long conversation spreads over many
   tasks. A numpy scan gives every prefix its fingerprint, the sum of hash(turn i) * BASE^i
   modulo 2**61 - 1. The part of a conversation that stands in earlier tasks is carried over by
   one small row a task, as fingerprints of parts add up.
2. Prefixes of one depth and fingerprint are a candidate group. It is verified turn by turn:
   every member must have its representative's last turn and its representative's parent
   group, seen from the least and the greatest turn of the group, so that tasks combine before
   the shuffle and a group of any size costs one row a task. With all groups of lesser depth
   verified too, members share the whole prefix. Where a member differs, the fingerprints
   have collided: from that depth on its conversation moves to a group of its own kind, and
   all groups are verified again, until none differs.
3. Each node is named by its smallest conversation. The nodes that a conversation names are the
   lower end of its path, so a subtree's sum is the sum of what its members' own nodes hold,
   less what the naming conversation holds above: one aggregation, whatever the depth.
4. The ids of conversations that end in a node are sorted by range and joined to lines of
   ``CHUNK`` ids in parallel; only the SHA-256 over those lines, which can't be split, is one
   task's for each node, and it streams.

Defined results: null role or text counts as empty; null turns come first; rows with equal
conv_id and turn are turns of their own, in order of role and text; rows without conv_id are
left out; a table without conversations has no nodes; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curata.functions.storage import written
from curata.llm.buffers import column, tune

PRIME = (1 << 61) - 1
BASE = 0x1D8AF066C9E1A3B5 % PRIME
WORD = r"[^\x20\x09-\x0D]+"
CHUNK, SEGMENT = 8192, 4096
MOST_ROUNDS = 100
KEY = ["depth", "print", "split"]
_P, _LOW = np.uint64(PRIME), np.uint64((1 << 31) - 1)


def reduced(x: np.ndarray) -> np.ndarray:
    """64-bit numbers modulo PRIME."""
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo PRIME of numbers below it, from 31-bit halves."""
    ah, al, bh, bl = a >> np.uint64(31), a & _LOW, b >> np.uint64(31), b & _LOW
    middle = ah * bl + al * bh
    return reduced(np.uint64(2) * (ah * bh) + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << np.uint64(31)) + al * bl)


class Scan:
    """Counts and fingerprints of prefixes over rows sorted by key, batch after batch."""

    def __init__(self):
        self.key, self.n, self.sum, self.powers = None, 0, 0, np.ones(1, np.uint64)

    def __call__(self, keys: np.ndarray, hashes: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(turns so far, fingerprint, fingerprint without the row's own turn) of each row; rows that aren't real are no turns."""
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        begin = np.flatnonzero(first)[np.cumsum(first) - 1]
        count = np.cumsum(real)
        before = count - real
        n = count - before[begin]
        while len(self.powers) <= len(keys):
            self.powers = np.concatenate([self.powers, times(self.powers, np.full_like(self.powers, pow(BASE, len(self.powers), PRIME)))])
        term = np.where(real, times(reduced(hashes), self.powers[n - real]), np.uint64(0))
        low, high = np.cumsum(term & _LOW), np.cumsum(term >> np.uint64(31))
        low0, high0 = (low - (term & _LOW))[begin], (high - (term >> np.uint64(31)))[begin]
        sums = reduced(times(reduced(high - high0), np.full(len(keys), 1 << 31, np.uint64)) + reduced(low - low0))
        if self.key is not None and keys[0] == self.key:  # goes on with the conversation of the batch before
            own = begin == 0
            sums[own] = reduced(times(sums[own], np.full(int(own.sum()), pow(BASE, self.n, PRIME), np.uint64)) + np.uint64(self.sum))
            term[own] = times(term[own], np.full(int(own.sum()), pow(BASE, self.n, PRIME), np.uint64))
            n[own] += self.n
        self.key, self.n, self.sum = keys[-1], int(n[-1]), int(sums[-1])
        return n, sums, reduced(sums + (_P - term))


def _sorted(rows: DataFrame, order: list, name: str) -> DataFrame:
    """rows(conv_id, hash (null: no turn), ...) in order within each conversation: adds depth (turns so far), print, above."""
    names = [c for c in rows.columns if c != "hash"]
    tune(rows.sparkSession)

    def run(batches):
        scan, part = Scan(), TaskContext.get().partitionId()
        for batch in batches:
            if len(batch):
                hashes = column(batch, "hash")
                real = np.asarray(hashes.is_valid())
                found = scan(column(batch, "conv_id").to_numpy(), hashes.fill_null(0).to_numpy().view(np.uint64), real.astype(np.int64))
                yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in names), *(pa.array(x.astype(np.int64)) for x in found), pa.array(np.full(len(batch), part, np.int32))], [*names, "depth", "print", "above", "task"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "hash")
    ordered = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    local = written(ordered.mapInArrow(run, f"{schema}, depth long, print long, above long, task int"), name)
    ends = local.groupBy("task").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "depth", "print")).alias("last")).orderBy("task").collect()  # one row a task
    carried, key, n, total = [], None, 0, 0
    for r in ends:
        n, total = (n, total) if r["first"] == key else (0, 0)
        if n:
            carried.append((r["task"], r["first"], n, total, pow(BASE, n, PRIME)))
        one, last = r["first"] == r["last"]["conv_id"], r["last"]
        n, total = (n + last["depth"], (total + pow(BASE, n, PRIME) * last["print"]) % PRIME) if one else (last["depth"], last["print"])
        key = last["conv_id"]
    if not carried:
        return local.drop("task")
    small = rows.sparkSession.createDataFrame(carried, "task int, conv_id long, n long, total long, factor long")
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731 - products of 122 bits fit a decimal
    moved = lambda c: F.when(F.col("n").isNull(), F.col(c)).otherwise(((wide(c) * wide("factor") + wide("total")) % F.lit(PRIME).cast("decimal(19,0)")).cast("long")).alias(c)
    out = local.join(F.broadcast(small), ["task", "conv_id"], "left")
    return out.select(*names, (F.col("depth") + F.coalesce("n", F.lit(0))).alias("depth"), moved("print"), moved("above"))


def _turns(conversations: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text"))


def rebuilt(conversations: DataFrame, family: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns: conv_id, part, i, role, text; ids: conv_id of all).

    Each conversation begins with the first h turns of the one whose id is the multiple of family at or before its
    own, and goes on with its own turns after h; h is the CRC-32 of its id modulo shared.
    """
    turns = _turns(conversations).withColumn("hash", F.lit(0).cast("long"))
    turns = _sorted(turns, [F.col("turn").asc_nulls_first(), "role", "text"], "turns").withColumnRenamed("depth", "i").drop("print", "above")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    ids = turns.where("i = 1").select("conv_id")
    own = turns.where(F.col("i") > h).select("conv_id", F.lit(1).alias("part"), "i", "role", "text")
    heads = turns.where((F.col("conv_id") % family == 0) & (F.col("i") < shared)).select(F.col("conv_id").alias("head"), "i", "role", "text")
    takers = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("head"), h.alias("h")).where("h > 0")
    given = takers.join(heads, "head").where("i <= h").select("conv_id", F.lit(0).alias("part"), "i", "role", "text")
    return own.unionByName(given), ids


def prefixes(turns: DataFrame, ids: DataFrame, order: list[str], bits: int = 61) -> DataFrame:
    """conv_id, depth, print, split, above, above_split, role, text of every prefix, from the empty one."""
    empty = [F.lit(None).cast(turns.schema[c].dataType).alias(c) for c in order]
    marks = ids.select("conv_id", *empty, F.lit("").alias("role"), F.lit("").alias("text"), F.lit(None).cast("long").alias("hash"))
    rows = turns.select("conv_id", *order, "role", "text", F.xxhash64("role", "text").alias("hash")).unionByName(marks)
    rows = _sorted(rows, [F.col("hash").isNotNull(), *(F.col(c).asc_nulls_first() for c in order), "role", "text"], "prefixes")
    fewer = lambda c: (F.col(c) % (1 << bits) if bits < 61 else F.col(c)).alias(c)
    none = F.lit(0).cast("long")
    return rows.select("conv_id", "depth", fewer("print"), none.alias("split"), fewer("above"), none.alias("above_split"), "role", "text")


def verified(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prefixes with splits, groups: depth, print, split, conv_id, n_convs, above, above_split, text), each group of one sequence only."""
    turn = F.struct("above", "above_split", "role", "text")
    for number in range(MOST_ROUNDS):
        groups = rows.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min(turn).alias("turn"), F.max(turn).alias("other"))
        groups = written(groups.select(*KEY, "conv_id", "n_convs", "turn", (F.col("turn") == F.col("other")).alias("same")), "groups")
        apart = groups.where("not same")
        if apart.isEmpty():
            return rows, groups.select(*KEY, "conv_id", "n_convs", "turn.above", "turn.above_split", "turn.text")
        unlike = rows.join(apart.select(*KEY, F.col("turn").alias("representative")), KEY).where(turn != F.col("representative"))
        moved = unlike.groupBy("conv_id").agg(F.min(F.struct("depth", F.xxhash64(F.lit(number), *KEY, "above", "above_split", "role", "text").alias("to"))).alias("first"))
        rows = rows.join(moved.select("conv_id", F.col("first.depth").alias("from"), F.col("first.to").alias("to")), "conv_id", "left")
        again = lambda c, go: F.when(F.coalesce(go, F.lit(False)), F.xxhash64("to", c)).otherwise(F.col(c)).alias(c)
        rows = written(rows.select("conv_id", "depth", "print", again("split", F.col("depth") >= F.col("from")), "above", again("above_split", F.col("depth") > F.col("from")), "role", "text"), "prefixes")
    raise RuntimeError(f"fingerprints still collide after {MOST_ROUNDS} rounds")


def ends(rows: DataFrame) -> DataFrame:
    """depth, print, split, ends_sha256 of the nodes in which conversations end."""
    last = rows.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("k")).select("k.*", "conv_id")

    def lines(batches):
        key, some, least = None, [], 0

        def line():
            return pa.RecordBatch.from_pylist([dict(zip(KEY, key, strict=True)) | {"least": least, "line": ",".join(some)}], pa.schema([*((k, pa.int64()) for k in KEY), ("least", pa.int64()), ("line", pa.string())]))

        for batch in batches:
            for *own, conv in zip(*(column(batch, c).to_pylist() for c in (*KEY, "conv_id")), strict=True):
                if own != key or len(some) == CHUNK:
                    if some:
                        yield line()
                    key, some, least = own, [], conv
                some.append(str(conv))
        if some:
            yield line()

    def digests(batches):
        key, state = None, None
        schema = pa.schema([*((k, pa.int64()) for k in KEY), ("ends_sha256", pa.string())])
        for batch in batches:
            out = []
            for *own, line in zip(*(column(batch, c).to_pylist() for c in (*KEY, "line")), strict=True):
                if own != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256(line.encode())
                else:
                    state.update(b"," + line.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, state.hexdigest()), strict=True))], schema)

    schema = "depth long, print long, split long"
    chunks = last.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInArrow(lines, f"{schema}, least long, line string")
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "least").mapInArrow(digests, f"{schema}, ends_sha256 string")


def trie(turns: DataFrame, ids: DataFrame, order: list[str], bits: int = 61) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    turns: conv_id, role, text and the order columns; ids: all conversations, also those without turns. bits: of the fingerprints.
    """
    rows, groups = verified(written(prefixes(turns, ids, order, bits), "keyed"))
    parents = groups.select((F.col("depth") + 1).alias("depth"), F.col("print").alias("above"), F.col("split").alias("above_split"), F.col("conv_id").alias("parent_conv_id"))
    children = groups.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("above").alias("print"), F.col("above_split").alias("split")).agg(F.count("*").alias("n_children"))
    words = F.when(F.col("depth") > 0, F.regexp_count("text", F.lit(WORD))).otherwise(0).cast("long")
    nodes = groups.withColumn("saved", (F.col("n_convs") - 1) * words).drop("text").join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = nodes.join(parents, ["depth", "above", "above_split"], "left").withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
    nodes = written(nodes.withColumn("segment", F.floor(F.col("depth") / SEGMENT).cast("long")).drop("above", "above_split"), "nodes")
    # what each conversation's own nodes hold: in all, and above each of them, by segments of its path and within one
    segments = nodes.groupBy("conv_id", "segment").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"))
    totals = segments.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).where("saved > 0 or leaves > 0")
    sums = rows.select("conv_id", *KEY).join(totals, "conv_id").groupBy(*KEY).agg(F.sum("saved").alias("all_saved"), F.sum("leaves").alias("all_leaves"))
    above = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole, inside = Window.partitionBy("conv_id").orderBy("segment"), Window.partitionBy("conv_id", "segment").orderBy("depth")
    segments = segments.select("conv_id", "segment", above("saved", whole).alias("saved_0"), above("leaves", whole).alias("leaves_0"))
    nodes = nodes.withColumns({"saved_1": above("saved", inside), "leaves_1": above("leaf", inside)}).join(segments, ["conv_id", "segment"])
    nodes = nodes.join(sums, KEY, "left").join(ends(rows), KEY, "left")
    of = lambda c, *less: F.coalesce(F.col(c), F.lit(0)) - sum((F.col(x) for x in less), F.lit(0))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", of("all_leaves", "leaves_0", "leaves_1").cast("long").alias("n_leaves"), of("all_saved", "saved_0", "saved_1").cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


ORACLE = """
WITH RECURSIVE o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, c - c % 20 AS head, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: list_reduce(list_concat([xor(a, b)], [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295) % 4 AS h FROM o),
t AS (SELECT ids.c, 0 AS part, o.i, o.role, o.text FROM ids JOIN o ON o.c = ids.head AND o.i <= ids.h UNION ALL SELECT ids.c, 1, o.i, o.role, o.text FROM ids JOIN o ON o.c = ids.c AND o.i > ids.h),
n AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d, {'role': role, 'text': text} AS turn FROM t),
p AS MATERIALIZED (SELECT c, 0 AS d, []::STRUCT(role VARCHAR, "text" VARCHAR)[] AS path, 0 AS words FROM ids UNION ALL SELECT a.c, a.d, list(b.turn ORDER BY b.d) AS path, any_value(len(regexp_extract_all(a.turn.text, '[^\\x20\\x09-\\x0D]+'))) AS words FROM n a JOIN n b ON a.c = b.c AND b.d <= a.d GROUP BY a.c, a.d),
k AS (SELECT c, max(d) AS most FROM p GROUP BY c),
u AS MATERIALIZED (SELECT path, d, min(c) AS c, count(*) AS n_convs, any_value(words) AS words, coalesce(string_agg(CASE WHEN d = most THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends FROM p JOIN k USING (c) GROUP BY path, d),
e AS (SELECT x.path, x.d, (SELECT count(*) FROM u y WHERE y.d = x.d + 1 AND y.path[: x.d] = x.path) AS n_children FROM u x)
SELECT u.c AS conv_id, u.d::BIGINT AS depth, (SELECT y.c FROM u y WHERE y.d = u.d - 1 AND y.path = u.path[: u.d - 1]) AS parent_conv_id, u.n_convs, any_value(e.n_children) AS n_children,
count(*) FILTER (g.n_children = 0) AS n_leaves, (sum((w.n_convs - 1) * w.words))::BIGINT AS saved_tokens, sha256(any_value(u.ends)) AS ends_sha256
FROM u JOIN e USING (path, d) JOIN u w ON w.d >= u.d AND w.path[: u.d] = u.path JOIN e g ON g.path = w.path AND g.d = w.d GROUP BY u.path, u.c, u.d, u.n_convs
"""
