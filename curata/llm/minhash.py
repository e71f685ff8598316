"""b-bit MinHash near-duplicates over distinct five-word shingles, confirmed on full sets.

1. Every document's set of 64-bit shingle hashes is made with array operations over the raw
   bytes; 128 minima follow. Each is kept twice: whole, hashed by bands of ``ROWS`` for the
   candidates, and by its low ``BITS`` bits, packed into a signature of 32 bytes.
2. Documents with equal sets form a class at once (by a 128-bit digest of the set). Only
   class representatives go on, so copies never meet each other in a bucket.
3. Members of a band bucket are compared by signature: the estimate, corrected for chance
   collisions, must come within ``MARGIN`` of the threshold. Each bucket gives a spanning
   forest of such pairs, and what the forests connect is a family: every pair that shares a
   band and could be a link lies within one family.
4. Each member of a family is held against the least one that it is near to, on full sets.
   In a family that this leaves in several parts, signatures meet in blocks, and only members
   of pairs whose sizes and estimates allow a link between parts bring their sets, where such
   pairs are confirmed unless connected meanwhile. Blocks give spanning forests, so neither
   step emits pairs, and the sets of a family of near copies are compared once each.

Sharing a band of 4 equal minima in 32 has probability above 1 - 1e-5 at the threshold and
grows above it. Estimates below the threshold less ``MARGIN`` (over four standard errors) are
passed over; all others are confirmed by exact intersection and union sizes.

Every row is a document of its own, known by a number given once its sketch is written.

Defined results: null, empty and blank texts have no shingle, link with nothing and keep
their own id; fewer words than five are one shingle of all words; rows with equal doc_id
are documents of their own, each with its own set and component (named by the least doc_id
in it); rows without doc_id link with nothing, keep a null component and are kept; further
columns are ignored. ``deduplicated`` leaves one row of each component: of the least doc_id,
then of the least digest of its text, then of the least hash of its other columns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.storage import written
from curata.llm.buffers import column, mix, powers, slices, span_hashes, texts, tune
from curata.llm.columns import fresh
from curata.operators.components import components

WORDS, PERCENT = 5, 75
HASHES, ROWS, BITS = 128, 4, 2
MARGIN = 0.2
BLOCK, BLOCK_SHINGLES = 512, 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_seeds = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_XOR, _TIMES = (_seeds[:HASHES] >> np.uint64(32)).astype(np.uint32)[:, None], ((_seeds[HASHES:] >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)[:, None]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    data = _LOWER[data]
    solid = ~_BLANK[data]
    begin = np.zeros(len(data) + 1, bool)
    begin[offsets[:-1]] = True
    begin = begin[:-1]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | begin[1:]
    ends = np.zeros(len(data), bool)
    ends[:-1] = solid[:-1] & (~solid[1:] | begin[1:])
    if len(data):
        ends[-1] = solid[-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    word = span_hashes(data, starts, ends)
    bounds = np.searchsorted(starts, offsets)
    n = len(word)
    factor = powers(words, 0xD6E8FEB86659FD93)
    rolled = np.zeros(n, np.uint64)
    for k in range(min(words, n)):
        rolled[: n - k] += word[k:] * factor[k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:  # all words as one shingle; their number sets it apart from others
            with np.errstate(over="ignore"):
                out.append(mix(np.array([(word[a:b] * factor[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(hashes: np.ndarray) -> np.ndarray:
    """HASHES minima of a set of one element at least."""
    x, best = (hashes >> np.uint64(32)).astype(np.uint32), None
    for k in range(0, len(x), 4096):
        least = ((x[None, k : k + 4096] ^ _XOR) * _TIMES).min(axis=1)
        best = least if best is None else np.minimum(best, least)
    return best


def signature(least: np.ndarray) -> bytes:
    """The low BITS bits of each minimum, packed. The top bits of a product are the well-mixed ones, so minima are mixed once more first."""
    low = mix(least.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
    return np.packbits(((low[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()).tobytes()


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity by the shares of equal b-bit minima, corrected for chance: packed signatures [n, bytes] each."""
    apart = np.unpackbits(a ^ b, axis=-1).reshape(*np.broadcast_shapes(a.shape, b.shape)[:-1], HASHES, BITS).any(axis=-1)
    equal = 1 - apart.mean(axis=-1)
    chance = 0.5**BITS
    return (equal - chance) / (1 - chance)


_EVEN = np.uint64(0x5555555555555555)


def _fast_estimate(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """As estimate(), for signatures of BITS = 2 as 64-bit words: one [words] against others [n, words]."""
    apart = others ^ one
    apart = np.bitwise_count((apart | (apart >> np.uint64(1))) & _EVEN).sum(axis=1, dtype=np.int64)
    chance = 0.5**BITS
    return (1 - apart / HASHES - chance) / (1 - chance)


def bands(least: np.ndarray) -> np.ndarray:
    keys = least.reshape(-1, ROWS).astype(np.uint64) * powers(ROWS + 1, 0xC2B2AE3D27D4EB4F)[1:]
    return mix(keys.sum(axis=1) + np.arange(HASHES // ROWS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _class(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame) -> DataFrame:
    """row, doc_id, text_key, n_shingles, class (digest of the set; null if empty), signature, bands. Sets themselves aren't kept: they are larger than the texts."""
    tune(docs.sparkSession)
    names = ["row", "doc_id", "text_key", "n_shingles", "class", "signature", "bands"]

    def run(batches):
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            for i, j in slices(offsets):
                found = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                rows = []
                for x in found:
                    if len(x):
                        least = minima(x)
                        rows.append((len(x), _class(x), signature(least), bands(least)))
                    else:
                        rows.append((0, None, None, None))
                types = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
                own = [pa.array(np.arange(row, row + j - i)), column(batch, "doc_id")[i:j], column(batch, "text_key")[i:j]]
                row += j - i
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True))], names)

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").withColumn("text_key", _text_key(F.col("text")))
    return own.mapInArrow(run, "row long, doc_id long, text_key binary, n_shingles long, class binary, signature binary, bands array<long>")


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    """Which of the edges (i, j) over n points join two parts not joined by those before."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[y] = x
            kept.append(k)
    return kept


def _estimated(buckets: DataFrame, least: float) -> DataFrame:
    """(a, b): links that join, within each bucket, all members whose estimates reach ``least`` to one another.

    buckets: band, id, signature. A bucket is dealt into blocks of about BLOCK, and pairs of blocks are
    compared; of each comes a spanning forest, so rows grow with members, not with their pairs.
    """

    def run(batches):
        for batch in batches:
            out_a, out_b = [], []
            for one, two in zip(column(batch, "one").to_pylist(), column(batch, "two").to_pylist(), strict=True):
                same = two is None
                rows = one if same else one + two
                ids = np.array([x["id"] for x in rows])
                marks = np.frombuffer(b"".join(x["signature"] for x in rows), np.uint64).reshape(len(rows), -1)
                left, right = [], []
                for k in range(len(one)):
                    first = k + 1 if same else len(one)
                    near = np.flatnonzero(_fast_estimate(marks[k], marks[first:]) >= least) + first
                    left.append(np.full(len(near), k))
                    right.append(near)
                i, j = np.concatenate(left), np.concatenate(right)
                kept = _forest(len(rows), i, j)
                out_a += ids[i[kept]].tolist()
                out_b += ids[j[kept]].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return _paired(buckets, ["band"], "struct(id, signature)").select("one", "two").mapInArrow(run, "a long, b long").distinct()


def _paired(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """one, two: the values of each block of each group, and (null: itself) of each further block of the group; keys, block, other.

    rows: keys, block, n_blocks and what value names. Only groups of several blocks are joined with themselves.
    """
    packed = F.array_sort(F.collect_list(F.expr(value))).alias("one")
    blocks = rows.groupBy(*keys, "block", "n_blocks").agg(packed)
    kind = blocks.schema["one"].dataType
    alone = blocks.select(*keys, "block", F.col("block").alias("other"), "one", F.lit(None).cast(kind).alias("two"))
    large = rows.where("n_blocks > 1").groupBy(*keys, "block", "n_blocks").agg(packed)
    left = large.select(*keys, "block", "one", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")).where("block < other")
    right = large.select(*keys, F.col("block").alias("other"), F.col("one").alias("two"))
    return alone.unionByName(left.join(right, [*keys, "other"]).select(*keys, "block", "other", "one", "two"))


def _sets(members: DataFrame, docs: DataFrame) -> DataFrame:
    """members(id, doc_id, text_key, ...) with shingles (the set, as little-endian words) in place of what names their text.

    Texts travel once, by what names a row; copies of a row, however many, are one before they do. The join is a merge
    whatever the sizes, so that small tables take the way of large ones.
    """
    marked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").withColumn("text_key", _text_key(F.col("text")))
    once = marked.groupBy("doc_id", "text_key").agg(F.first("text").alias("text"))
    kept = [f for f in members.schema if f.name not in ("doc_id", "text_key")]
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            for i, j in slices(offsets):
                found = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([*(column(batch, c)[i:j] for c in names), pa.array([x.astype("<u8").tobytes() for x in found], pa.binary())], [*names, "shingles"])

    joined = once.join(members.hint("merge"), ["doc_id", "text_key"]).select("text", *names)
    return joined.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", shingles binary")


def _confirmed(rows: DataFrame, percent: int, least: float) -> DataFrame:
    """(a, b): links that connect what all links within each task connect, confirmed on full sets.

    rows: id, label, signature, side, shingles and the task they are for, in all other columns: members of side 0 meet those
    of side 1, and all of side 2 one another, unless their labels are equal. A task has two blocks of members at most.
    """

    def run(batches):
        for batch in batches:
            out_a, out_b = [], []
            for rows in column(batch, "members"):
                rows = rows.values
                ids, label, side = (rows.field(c).to_numpy() for c in ("id", "label", "side"))
                own = [np.frombuffer(x.as_buffer(), "<u8") for x in rows.field("shingles")]
                size, label = np.array([len(x) for x in own]), label.copy()
                marks = np.frombuffer(b"".join(rows.field("signature").to_pylist()), np.uint64).reshape(len(ids), -1)
                for i in np.flatnonzero(side != 1).tolist():
                    there = np.flatnonzero((side == 1) if side[i] == 0 else (np.arange(len(ids)) > i))
                    there = there[(label[there] != label[i]) & (100 * np.minimum(size[there], size[i]) >= percent * np.maximum(size[there], size[i]))]
                    there = there[_fast_estimate(marks[i], marks[there]) >= least]
                    for j in there.tolist():
                        if label[i] == label[j]:
                            continue
                        both = np.intersect1d(own[i], own[j], assume_unique=True).size
                        if 100 * both >= percent * (size[i] + size[j] - both):
                            out_a.append(ids[i])
                            out_b.append(ids[j])
                            label[label == label[j]] = label[i]
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    names = [c for c in rows.columns if c not in ("id", "label", "signature", "side", "shingles")]
    tasks = rows.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("id", "label", "side", "signature", "shingles"))).alias("members"))
    return tasks.select("members").mapInArrow(run, "a long, b long")


def _needed(families: DataFrame, percent: int, least: float) -> DataFrame:
    """Tasks for ``_confirmed``: of each pair of blocks the members in pairs that could be links and aren't connected yet, by signatures alone.

    families: id, label, family, block, n_blocks, signature, n_shingles.
    """

    def run(batches):
        names = ["family", "block", "other", "id", "label", "signature", "side"]
        for batch in batches:
            for k in range(len(batch)):
                one, two = column(batch, "one")[k].values, column(batch, "two")[k].values
                out = []
                same = two is None
                ids, label, size = (np.concatenate([x.field(c).to_numpy() for x in ((one,) if same else (one, two))]) for c in ("id", "label", "n_shingles"))
                raw = [*one.field("signature").to_pylist(), *([] if same else two.field("signature").to_pylist())]
                marks, wanted = np.frombuffer(b"".join(raw), np.uint64).reshape(len(ids), -1), np.zeros(len(ids), bool)
                for i in range(len(one)):
                    there = np.arange(i + 1 if same else len(one), len(ids))
                    there = there[(label[there] != label[i]) & (100 * np.minimum(size[there], size[i]) >= percent * np.maximum(size[there], size[i]))]
                    there = there[_fast_estimate(marks[i], marks[there]) >= least]
                    if len(there):
                        wanted[i] = wanted[there] = True
                family, block, other = (column(batch, c)[k].as_py() for c in names[:3])
                out = [(family, block, other, int(ids[i]), int(label[i]), raw[i], 2 if same else int(i >= len(one))) for i in np.flatnonzero(wanted)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32()), strict=True)], names)

    return _paired(families, ["family"], "struct(id, label, n_shingles, signature)").mapInArrow(run, "family long, block int, other int, id long, label long, signature binary, side int")


def _linked(near: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, least: float) -> DataFrame:
    """(id, component) of what links connect. near(a, b): pairs that join all that could be linked; classes: id, doc_id, text_key, signature, n_shingles.

    Each class is first held against the least one that it is near to: one comparison a class settles families of near
    copies. Only families that this leaves in parts are compared as a whole, and of them only what signatures leave open.
    """
    families = components(near).withColumnRenamed("component", "family")
    families = families.join(classes.select("id", "doc_id", "text_key", "signature", "n_shingles"), "id")
    heads = near.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("head")).groupBy("id").agg(F.min("head").alias("head"))
    families = written(families.join(heads, "id", "left"), "families")
    parts = families.where("head is not null").groupBy("head").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("n_parts"))
    members = families.join(parts, "head", "left").withColumn("part", F.pmod(F.xxhash64("id"), F.col("n_parts")).cast("int")).drop("n_parts", "family", "n_shingles")
    members = members.join(parts.select(F.col("head").alias("id"), F.col("n_parts").alias("led")), "id", "left")
    sets = written(_sets(members, docs), "sets")
    task = ["head", "part", "id", F.col("id").alias("label"), "signature"]
    ones = sets.where("head is not null").select(*task, F.lit(1).alias("side"), "shingles")
    led = sets.where("led is not null").withColumn("head", F.col("id")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("led") - 1)))
    first = components(_confirmed(ones.unionByName(led.select(*task, F.lit(0).alias("side"), "shingles")), percent, least))
    labelled = families.join(first, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
    labelled = written(labelled.select("id", "family", "label", "signature", "n_shingles"), "labelled")
    stats = labelled.groupBy("family").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("n_blocks"))
    open_ = labelled.join(stats.where("x <> y").select("family", "n_blocks"), "family").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
    needed = _needed(open_, percent, least).join(sets.select("id", "shingles").hint("merge"), "id")
    more = written(_confirmed(needed, percent, least), "confirmed")
    if more.isEmpty():
        return first
    return components(more.unionByName(first.select(F.col("id").alias("a"), F.col("component").alias("b"))))


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """row, doc_id, text_key, n_shingles, component (the row number of one member; null without a set), component_id."""
    least = percent / 100 - MARGIN
    found = sketches(docs)
    rows = written(found.withColumn("class", F.when(F.col("doc_id").isNotNull(), F.col("class"))), "sketches")
    # a class is named by one of its rows, of least doc_id; what a set gives is the same in all its rows
    same = [F.first(c).alias(c) for c in ("signature", "n_shingles", "bands")]
    classes = rows.where("class is not null").groupBy("class").agg(F.min(F.struct("doc_id", "text_key", "row")).alias("head"), *same)
    classes = written(classes.select("class", F.col("head.row").alias("id"), F.col("head.doc_id").alias("doc_id"), F.col("head.text_key").alias("text_key"), "signature", "n_shingles", "bands"), "classes")
    # bands are dealt once, without signatures: most hold one class only. Both sides of the join need both columns, so they share the shuffle
    members = classes.select("id", F.explode("bands").alias("band")).repartition("band")
    sizes = members.groupBy("band").agg(F.count("*").alias("size"), F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    members = members.join(sizes.select("band", "size"), "band").withColumn("n_blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    members = members.join(classes.select("id", "signature"), "id")
    members = written(members.select("band", "id", "signature", "n_blocks", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int").alias("block")), "buckets")
    near = written(_estimated(members, least), "near")
    linked = classes.select("class", "id", "doc_id").join(_linked(near, classes, docs, percent, least), "id", "left").withColumn("component", F.coalesce("component", "id"))
    ids = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = linked.join(ids, "component").select("class", "component", "component_id")
    named = rows.select("row", "doc_id", "text_key", "n_shingles", "class").join(linked, "class", "left").drop("class")
    return named.withColumn("component_id", F.coalesce("component_id", "doc_id"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (doc_id = component_id) of every row."""
    found = _grouped(docs, percent).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, of which one row of each group stays.

    Rows go by doc_id, the digest of their text and a hash of their other columns: texts travel once, by a merge join
    whatever the number of rows that go.
    """
    own, text_key, rest = fresh(docs, "id", "text_key", "rest")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    marked = docs.withColumns({own: docs["doc_id"].cast("long"), text_key: _text_key(docs["text"]), rest: F.xxhash64(F.to_json(F.struct(*[docs[c] for c in others]))) if others else F.lit(0).cast("long")})
    groups = _grouped(docs, percent).where("component is not null").select(F.col("doc_id").alias(own), F.col("text_key").alias(text_key), "component").distinct()
    rows = marked.groupBy(own, text_key, rest).agg(F.count("*").alias("n")).join(groups, [own, text_key])
    rows = written(rows, "groups")
    stays = rows.groupBy("component").agg(F.min(F.struct(own, text_key, rest)).alias("head"))
    keys = rows.join(stays, "component").select(own, text_key, rest, "n", (F.struct(own, text_key, rest) == F.col("head")).alias("stays"))
    keys = written(keys.where("not stays or n > 1"), "decisions")
    out = marked.join(keys.select(own, text_key, rest).hint("merge"), [own, text_key, rest], "left_anti")
    if not (again := keys.where("stays")).isEmpty():  # rows that repeat: one of each stays
        out = out.unionByName(marked.join(again.select(own, text_key, rest).hint("merge"), [own, text_key, rest], "left_semi").dropDuplicates([own, text_key, rest]))
    return out.select(*docs.columns)


ORACLE = """
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
d AS (SELECT r, doc_id, CASE WHEN len(w) >= 5 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
c AS (SELECT row_number() OVER () AS c, s, min(doc_id) AS least, len(s) AS n FROM d WHERE len(s) > 0 AND doc_id IS NOT NULL GROUP BY s),
u AS (SELECT c, unnest(s) AS x FROM c),
i AS (SELECT a.c AS a, b.c AS b, count(*) AS n FROM u a JOIN u b ON a.x = b.x AND a.c <> b.c GROUP BY ALL),
l AS (SELECT i.a, i.b FROM i JOIN c x ON x.c = i.a JOIN c y ON y.c = i.b WHERE 100 * i.n >= 75 * (x.n + y.n - i.n)),
reach(c, root) AS (SELECT c, least FROM c UNION SELECT l.a, reach.root FROM reach JOIN l ON l.b = reach.c JOIN c ON c.c = l.a WHERE reach.root < c.least),
k AS (SELECT c.s, min(root) AS root FROM reach JOIN c USING (c) GROUP BY c.s)
SELECT doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id, doc_id IS NOT DISTINCT FROM coalesce(root, doc_id) AS kept FROM d LEFT JOIN k ON d.s = k.s AND d.doc_id IS NOT NULL
"""
