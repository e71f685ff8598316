"""Exact near pairs of embeddings by dual traversal of cover trees.

Vectors are scaled to length 1, where cosine >= c is Euclidean distance <= sqrt(2 - 2c).
Equal vectors form a class and are handled once, with their number. Classes are dealt into
cells by the nearest of a few pivots (fitted on a bounded sample; a dimension of up to
``CELL`` classes is one cell), cells into blocks of about ``BLOCK``. Each block is a cover
tree: nested levels whose radii halve, every centre of a level staying a centre below, each
node with the radius that covers what is beneath it. Blocks travel in groups, up to
``GROUP`` together where there are many, as every group meets every other one of its cell.

Pairs of cells whose covering radii keep them apart are never joined. A remaining pair of
blocks is traversed level by level with both trees at once: node pairs further apart than
both radii and the threshold are pruned; of the points left, distances in single precision
(with a margin) leave the pairs that are confirmed in double precision. A task emits one row
for each linked vector - its number of links and one link to the local component's least
id - so the output grows with vectors, not with pairs.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component
links with nothing and keeps its id; vectors of different dimension never link; every row is
a vector of its own, also where vec_ids repeat (n_links counts rows, a component is named by
its least vec_id); a row without vec_id links with nothing and has
a null component; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.storage import written
from curata.llm.buffers import column, tune
from curata.operators.components import components

BLOCK, SAMPLE, CELL = 4096, 4096, 8192
SLACK = 1e-3
MOST_PIVOTS, GROUP, GROUP_BYTES = 1024, 8, 24 << 20
TREE = pa.struct([("id", pa.binary()), ("m", pa.binary()), ("x", pa.binary()), ("levels", pa.list_(pa.struct([("centres", pa.binary()), ("up", pa.binary()), ("cover", pa.binary())])))])


def units(lists: pa.Array) -> list[bytes | None]:
    """Each vector scaled to length 1, as bytes of doubles; None where it can't link."""
    lists = lists.cast(pa.large_list(pa.float64())) if not pa.types.is_large_list(lists.type) else lists
    out: list[bytes | None] = [None] * len(lists)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    whole = lists.flatten()
    holes = np.asarray(whole.is_null()) if whole.null_count else np.zeros(len(whole), bool)
    values, ends = whole.fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(sizes)
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        index = (ends[rows] - size)[:, None] + np.arange(size)
        x, bad = values[index], holes[index].any(axis=1)
        bad |= ~np.isfinite(x).all(axis=1)
        x[bad] = 0
        top = np.abs(x).max(axis=1, keepdims=True)
        x /= np.where(top > 0, top, 1)  # so that squares neither overflow nor vanish
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        x /= np.where(norm > 0, norm, 1)
        for k, r in enumerate(rows):
            if top[k, 0] > 0:
                out[r] = x[k].tobytes()
    return out


def pivots(sample: np.ndarray, k: int) -> np.ndarray:
    """k centres of the sample, each the farthest from those before: a cover of shrinking radius."""
    if not len(sample):
        return sample
    chosen, near = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(k, len(sample)):
        near = np.minimum(near, 2 - 2 * sample @ sample[chosen[-1]])
        far = int(near.argmax())
        if near[far] <= 1e-12:
            break
        chosen.append(far)
    return sample[chosen]


class Tree:
    """A cover tree over rows of x (length 1). Levels: radius, centres, the node of each centre one level up, covering radii."""

    def __init__(self, x: np.ndarray, finest: float):
        self.x = x
        member = np.zeros(len(x), np.int64)  # the node of each point on the level so far
        centres, radius = np.zeros(1, np.int64), 2.0
        self.levels = [(centres, np.zeros(1, np.int64), self._cover(centres, member))]
        while radius > finest and len(centres) < len(x):
            radius /= 2
            own, up, node = [], [], np.empty(len(x), np.int64)
            order = np.argsort(member, kind="stable")
            for parent, points in enumerate(np.split(order, np.searchsorted(member[order], np.arange(1, len(centres))))):
                rest, centre = points, centres[parent]  # the parent's centre stays one
                while len(rest):
                    inside = 2 - 2 * (x[rest] @ x[centre]) <= radius * radius
                    inside |= rest == centre
                    node[rest[inside]] = len(own)
                    own.append(centre)
                    up.append(parent)
                    rest = rest[~inside]
                    if len(rest):
                        centre = rest[0]
            centres, member = np.array(own), node
            self.levels.append((centres, np.array(up), self._cover(centres, member)))
        if len(centres) < len(x):  # the points themselves
            self.levels.append((np.arange(len(x)), member, np.zeros(len(x))))
        elif (centres != np.arange(len(x))).any():
            self.levels.append((np.arange(len(x)), member, np.zeros(len(x))))

    @classmethod
    def of(cls, x: np.ndarray, levels: list) -> Tree:
        """A tree built before, over the same points."""
        tree = cls.__new__(cls)
        tree.x, tree.levels = x, levels
        return tree

    def _cover(self, centres, member):
        apart = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", self.x, self.x[centres[member]], dtype=np.float64)))
        apart[centres[member] == np.arange(len(member))] = 0  # not the rounding error of a centre's distance to itself
        out = np.zeros(len(centres))
        np.maximum.at(out, member, apart)
        return out


def _least_product(bound: np.ndarray) -> np.ndarray:
    """The inner product of two unit vectors that far apart."""
    return (1 - bound * bound / 2).astype(np.float32)


def near_pairs(a: Tree, b: Tree, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points (of a, of b) that may be within eps: those that no covering-radius bound keeps apart."""
    rows, columns = np.zeros(1, np.int64), np.zeros(1, np.int64)
    active = np.ones((1, 1), bool)
    for level in range(max(len(a.levels), len(b.levels))):
        sides = []
        for tree, had in ((a, rows), (b, columns)):
            if level < len(tree.levels):
                centres, up, cover = tree.levels[level]
                place = np.full((len(tree.levels[level - 1][0]) if level else 1), -1, np.int64)
                place[had] = np.arange(len(had))
                nodes = np.flatnonzero(place[up] >= 0)
                sides.append((nodes, place[up[nodes]], centres[nodes], cover[nodes]))
            else:
                centres, _, cover = tree.levels[-1]
                sides.append((had, np.arange(len(had)), centres[had], cover[had]))
        (rows, up_a, ca, ra), (columns, up_b, cb, rb) = sides
        if not len(rows) or not len(columns):
            break
        product = a.x[ca] @ b.x[cb].T
        close = product >= np.float32(1 - (eps + SLACK) ** 2 / 2)  # as if no node covered more than its centre
        wide_a, wide_b = np.flatnonzero(ra), np.flatnonzero(rb)
        if len(wide_a):
            close[wide_a] = product[wide_a] >= _least_product(ra[wide_a, None] + rb[None, :] + (eps + SLACK))
        if len(wide_b):
            close[:, wide_b] = product[:, wide_b] >= _least_product(ra[:, None] + rb[None, wide_b] + (eps + SLACK))
        if not active.all():
            close &= active[np.ix_(up_a, up_b)]
        active = close
        keep_a, keep_b = active.any(axis=1), active.any(axis=0)
        rows, columns, active = rows[keep_a], columns[keep_b], active[np.ix_(keep_a, keep_b)]
    i, j = np.nonzero(active) if len(rows) and len(columns) else (np.zeros(0, np.int64),) * 2
    return rows[i] if len(i) else i, columns[j] if len(j) else j


def confirmed(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, cosine: float) -> np.ndarray:
    """Which of the pairs reach the cosine in double precision."""
    out = np.zeros(len(i), bool)
    for k in range(0, len(i), 1 << 16):
        out[k : k + (1 << 16)] = np.einsum("ij,ij->i", x[i[k : k + (1 << 16)]], y[j[k : k + (1 << 16)]]) >= cosine
    return out


def _local_least(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id that links reach from each of n points."""
    label = ids.copy()
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        if (label == before).all():
            return label


def _links(one: dict, two: dict, cosine: float, eps: float, same: bool) -> tuple:
    """id, links and least id reached, of the points of two blocks that are linked between (or, if same, within) them."""
    i, j = near_pairs(one["tree"], two["tree"], eps)
    if same:
        i, j = i[i < j], j[i < j]
    real = confirmed(one["x"], two["x"], i, j, cosine)
    i, j = i[real], j[real]
    if same:
        ids, weight, k = one["id"], one["m"], j
    else:
        ids, weight, k = np.concatenate([one["id"], two["id"]]), np.concatenate([one["m"], two["m"]]), j + len(one["id"])
    n = np.zeros(len(ids), np.int64)
    np.add.at(n, i, weight[k])
    np.add.at(n, k, weight[i])
    linked = np.flatnonzero(n)
    return ids[linked], n[linked], _local_least(len(ids), i, k, ids)[linked]


def links(vectors: DataFrame, cosine: float = 0.9, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors(vec_id, embedding)."""
    spark, eps = vectors.sparkSession, float(np.sqrt(2 - 2 * cosine))
    tune(spark)

    def read(batches):
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            unit = units(column(batch, "embedding"))
            unit = [u if i is not None else None for u, i in zip(unit, column(batch, "vec_id").to_pylist(), strict=True)]
            key = [hashlib.blake2b(u, digest_size=16).digest() if u is not None else None for u in unit]
            number = pa.array(np.arange(row, row + len(batch)))
            row += len(batch)
            yield pa.RecordBatch.from_arrays([number, column(batch, "vec_id"), pa.array(key, pa.binary()), pa.array(unit, pa.binary())], ["row", "vec_id", "key", "unit"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(read, "row long, vec_id long, key binary, unit binary")
    rows = written(rows, "units")
    # a class is named by one of its rows, of least vec_id
    distinct = rows.where("key is not null").groupBy("key").agg(F.min(F.struct("vec_id", "row")).alias("head"), F.count("*").alias("m"), F.min("unit").alias("unit"))
    distinct = distinct.select("key", F.col("head.row").alias("id"), F.col("head.vec_id").alias("vec_id"), "m", "unit", (F.octet_length("unit") / 8).cast("int").alias("dim"))
    distinct = written(distinct, "vectors")

    # a dimension of few vectors is one cell; only larger ones need pivots
    large = {r["dim"]: r["n"] for r in distinct.groupBy("dim").agg(F.count("*").alias("n")).where(F.col("n") > CELL).collect()}
    centres = {}
    for dim, n in large.items():
        some = distinct.where(F.col("dim") == dim).select("unit").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
        centres[dim] = pivots(np.stack([np.frombuffer(r["unit"]) for r in some]), min(MOST_PIVOTS, n // CELL))
    shared = spark.sparkContext.broadcast(centres)

    def dealt(batches):
        own = shared.value
        for batch in batches:
            cell, apart = [], []
            for unit, dim in zip(column(batch, "unit").to_pylist(), column(batch, "dim").to_pylist(), strict=True):
                near = own[dim] @ np.frombuffer(unit) if dim in own else np.full(1, -1.0)  # one cell, which covers the sphere
                cell.append(int(near.argmax()))
                apart.append(float(np.sqrt(max(0.0, 2 - 2 * near.max()))))
            yield pa.RecordBatch.from_arrays([*(column(batch, x) for x in ("id", "m", "unit", "dim")), pa.array(cell, pa.int32()), pa.array(apart)], ["id", "m", "unit", "dim", "cell", "apart"])

    placed = written(distinct.select("id", "m", "unit", "dim").mapInArrow(dealt, "id long, m long, unit binary, dim int, cell int, apart double"), "placed")
    cells = placed.groupBy("dim", "cell").agg(F.max("apart").alias("radius"), F.count("*").alias("n")).toPandas()  # MOST_PIVOTS a dimension at most
    joined = []
    for dim, own in cells.groupby("dim"):
        cell, radius = own["cell"].to_numpy(), own["radius"].to_numpy()
        p = centres[dim][cell] if dim in centres else np.zeros((len(cell), 1))
        apart = np.sqrt(np.maximum(0, 2 - 2 * p @ p.T)) if dim in centres else np.zeros((len(cell), len(cell)))
        i, j = np.nonzero(np.triu(np.ones_like(apart, bool)) & (apart <= radius[:, None] + radius[None, :] + eps + SLACK))
        joined += [(int(dim), int(min(x, y)), int(max(x, y))) for x, y in zip(cell[i], cell[j], strict=True)]
    pairs = spark.createDataFrame(joined, "dim int, cell int, other int")
    many = int(cells["n"].sum()) // (16 * block)

    def together(dim: int) -> int:
        return block * min(GROUP, max(1, many), max(1, GROUP_BYTES // (8 * dim * block)))

    blocks_of = spark.createDataFrame([(int(r.dim), int(r.cell), -(-int(r.n) // together(int(r.dim)))) for r in cells.itertuples()], "dim int, cell int, blocks int")
    rows_in = placed.join(F.broadcast(blocks_of), ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    packed = rows_in.groupBy("dim", "cell", "block").agg(F.collect_list(F.struct("id", "m", "unit")).alias("points"))

    def built(batches):
        for batch in batches:
            for k in range(len(batch)):
                points = column(batch, "points")[k].values
                ids, m = points.field("id").to_numpy(), points.field("m").to_numpy()
                x = np.frombuffer(b"".join(points.field("unit").to_pylist())).reshape(len(points), -1)
                trees = []
                for i in range(0, len(x), block):
                    tree = Tree(x[i : i + block].astype(np.float32), eps / 4)
                    levels = [{"centres": c.astype(np.int64).tobytes(), "up": u.astype(np.int64).tobytes(), "cover": r.tobytes()} for c, u, r in tree.levels]
                    trees.append({"id": ids[i : i + block].tobytes(), "m": m[i : i + block].tobytes(), "x": x[i : i + block].tobytes(), "levels": levels})
                yield pa.RecordBatch.from_arrays([column(batch, c)[k : k + 1] for c in ("dim", "cell", "block")] + [pa.array([trees], pa.list_(TREE))], ["dim", "cell", "block", "points"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # rows are groups of blocks from here on
    packed = written(packed.mapInArrow(built, "dim int, cell int, block int, points array<struct<id: binary, m: binary, x: binary, levels: array<struct<centres: binary, up: binary, cover: binary>>>>"), "blocks")
    one = packed.join(F.broadcast(pairs), ["dim", "cell"]).select("dim", F.col("cell").alias("c1"), F.col("block").alias("b1"), F.col("other").alias("c2"), F.col("points").alias("one"))
    two = packed.select("dim", F.col("cell").alias("c2"), F.col("block").alias("b2"), F.col("points").alias("two"))
    # the ids of the pairs first, then each side's points; both joins are on blocks, spread over all tasks
    names = one.drop("one").join(two.drop("two"), ["dim", "c2"]).where("c1 < c2 or b1 <= b2").repartition("dim", "c1", "b1", "c2", "b2")
    work = names.join(one.select("dim", "c1", "b1", "c2", "one"), ["dim", "c1", "b1", "c2"]).join(two, ["dim", "c2", "b2"]).select((F.expr("c1 = c2 and b1 = b2")).alias("same"), "one", "two")

    def traversed(batches):
        def opened(p):
            ids = np.frombuffer(p["id"], np.int64)
            x = np.frombuffer(p["x"]).reshape(len(ids), -1)
            levels = [(np.frombuffer(v["centres"], np.int64), np.frombuffer(v["up"], np.int64), np.frombuffer(v["cover"])) for v in p["levels"]]
            return {"id": ids, "m": np.frombuffer(p["m"], np.int64), "x": x, "tree": Tree.of(x.astype(np.float32), levels)}

        for batch in batches:
            for k in range(len(batch)):
                x, y, same = (column(batch, c)[k].as_py() for c in ("one", "two", "same"))
                first = [opened(p) for p in x]
                second = first if same else [opened(p) for p in y]
                for i, a in enumerate(first):
                    for j in range(i if same else 0, len(second)):
                        found = _links(a, second[j], cosine, eps, same and i == j)
                        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in found], ["id", "n", "least"])

    found = written(work.mapInArrow(traversed, "id long, n long, least long"), "links")
    tune(spark)
    comps = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")))
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    named = distinct.select("key", "id", "vec_id", "m").join(counts, "id", "left").join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = named.join(least, "component").select("key", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "key").join(named, "key", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
f AS (SELECT r, vec_id, list_transform(e, lambda x: CASE WHEN isfinite(x) THEN x ELSE 0 END) AS e, len(list_filter(e, lambda x: isfinite(x))) = len(e) AS whole FROM v WHERE vec_id IS NOT NULL AND len(e) > 0),
g AS (SELECT *, sqrt(list_dot_product(e, e)) AS n FROM f WHERE whole AND list_dot_product(e, e) > 0),
l AS (SELECT a.r AS a, a.vec_id, b.r AS b FROM g a JOIN g b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9),
n AS (SELECT a AS r, count(*) AS n FROM l GROUP BY 1),
reach(r, root) AS (SELECT r, vec_id FROM v UNION SELECT l.a, reach.root FROM reach JOIN l ON l.b = reach.r WHERE reach.root < l.vec_id),
k AS (SELECT r, min(root) AS root FROM reach GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, root AS component_id, vec_id IS NOT DISTINCT FROM root AS kept FROM v JOIN k USING (r) LEFT JOIN n USING (r)
"""
