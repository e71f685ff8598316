"""Centroid clustering (Lloyd's rounds) by kd-tree filtering, in exact integers.

Each task lays its vectors into kd-trees of up to ``BLOCK`` points, built once and written. A
node holds its count, its componentwise integer sums and its bounding box. In a round the
centroids go down each tree: of a node's candidates, the one nearest the middle of its box
strictly dominates any other to which even the box's farthest corner in that one's direction
is further; dominated ones are pruned. A node with one candidate left is assigned whole, by
its count and sums; leaves resolve their candidates point by point. A task sends one row a
centroid, and Spark sums them up, so what reaches the driver is k rows a round.

Boxes, sums and distances are integers: components are floor(scale * x), and no result depends
on how vectors are dealt. Up to 2**22 in magnitude, distances are products of doubles, which
hold them exactly; up to ``MOST`` they are computed in 64-bit integers; beyond it squared
distances would not fit a long, and the job fails and says so.

Defined results: a vector that is null, of another number of components, or with a null or
non-finite one is left out; every row is a vector of its own, also where vec_ids repeat (equal
hashes are ordered by components); rows without vec_id take part and come last in the order
that the first centroids are drawn in; with fewer than k vectors there are as many
centroids; without any there are no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.storage import written
from curata.llm.buffers import column, settings, tune

BLOCK, LEAF = 4096, 32
EXACT_DOUBLES, MOST = 1 << 22, 1 << 27
CELLS = 1 << 21  # of node, candidate and dimension, compared at once
#: Rows are whole trees of a megabyte, so few of them are read, and sent to Python, at once.
FEW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4", "spark.sql.parquet.columnarReaderBatchSize": "8"}


class Tree:
    """points [n, d] in the order of the leaves; nodes by number: begin, end, left, right (-1: a leaf), lo, hi, sums."""

    NODES = (("begin", "<i4"), ("end", "<i4"), ("left", "<i4"), ("right", "<i4"), ("lo", "<i8"), ("hi", "<i8"), ("sums", "<i8"))

    @classmethod
    def over(cls, points: np.ndarray, leaf: int = LEAF) -> tuple[Tree, np.ndarray]:
        """The tree, and which of the points stands where."""
        order, found, open_ = np.arange(len(points)), [], [(0, len(points), -1, 0)]
        while open_:
            begin, end, parent, side = open_.pop()
            own = points[order[begin:end]]
            lo, hi = own.min(axis=0), own.max(axis=0)
            node = [begin, end, -1, -1, lo, hi, own.sum(axis=0)]
            if parent >= 0:
                found[parent][2 + side] = len(found)
            if end - begin > leaf and (widest := int((hi - lo).argmax())) >= 0 and hi[widest] > lo[widest]:
                half = (end - begin) // 2
                order[begin:end] = order[begin:end][np.argpartition(own[:, widest], half)]
                open_ += [(begin + half, end, len(found), 1), (begin, begin + half, len(found), 0)]
            found.append(node)
        tree = cls()
        tree.points = points[order]
        for (name, kind), values in zip(cls.NODES, zip(*found, strict=True), strict=True):
            setattr(tree, name, np.array(values, kind))
        return tree, order

    def packed(self) -> dict[str, bytes]:
        return {"points": self.points.astype("<i4").tobytes()} | {name: getattr(self, name).tobytes() for name, _ in self.NODES}

    @classmethod
    def opened(cls, row: dict, dims: int) -> Tree:
        tree = cls()
        tree.points = np.frombuffer(row["points"], "<i4").reshape(-1, dims).astype(np.int64)
        for name, kind in cls.NODES:
            flat = np.frombuffer(row[name], kind)
            setattr(tree, name, flat.reshape(-1, dims) if kind == "<i8" else flat)
        return tree

    def assign(self, centroids: np.ndarray, labels: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """(vectors of each centroid, their componentwise sums, and if asked for the centroid of each point)."""
        k, dims = centroids.shape
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        label = np.zeros(len(self.points), np.int64) if labels else None
        nodes, open_ = np.zeros(1, np.int64), np.ones((1, k), bool)
        step = max(1, CELLS // (k * dims))
        while len(nodes):
            open_ = np.concatenate([self._undominated(nodes[i : i + step], open_[i : i + step], centroids) for i in range(0, len(nodes), step)])
            alone, leaf = open_.sum(axis=1) == 1, self.left[nodes] < 0
            one = open_[alone].argmax(axis=1)
            np.add.at(n, one, (self.end - self.begin)[nodes[alone]])
            np.add.at(sums, one, self.sums[nodes[alone]])
            if labels:
                for node, c in zip(nodes[alone].tolist(), one.tolist(), strict=True):
                    label[self.begin[node] : self.end[node]] = c
            for node, candidates in zip(nodes[leaf & ~alone].tolist(), open_[leaf & ~alone], strict=True):
                some, own = np.flatnonzero(candidates), self.points[self.begin[node] : self.end[node]]
                near = some[distances(own, centroids[some]).argmin(axis=1)]  # the first of equal ones, so the smaller number
                np.add.at(n, near, 1)
                np.add.at(sums, near, own)
                if labels:
                    label[self.begin[node] : self.end[node]] = near
            go = ~leaf & ~alone
            nodes, open_ = np.concatenate([self.left[nodes[go]], self.right[nodes[go]]]), np.concatenate([open_[go], open_[go]])
        return n, sums, label

    def _undominated(self, nodes: np.ndarray, open_: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        lo, hi = self.lo[nodes], self.hi[nodes]
        apart = np.where(open_, distances(lo + hi, 2 * centroids), np.iinfo(np.int64).max)
        best = centroids[apart.argmin(axis=1)][:, None, :]
        toward = centroids[None] - best
        corner = np.where(toward > 0, hi[:, None, :], lo[:, None, :])
        # |z - corner|^2 - |best - corner|^2; the best itself gives 0
        further = (toward * (centroids[None] + best - 2 * corner)).sum(axis=2)
        return open_ & (further <= 0)


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances [points, centroids], exact."""
    most = max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0))
    if 4 * points.shape[1] * int(most) ** 2 < 1 << 53:
        p, c = points.astype(np.float64), centroids.astype(np.float64)
        return ((p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _sound(embedding: Column, dims: int) -> Column:
    x = lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf")))
    return F.coalesce((F.size(embedding) == dims) & F.forall(embedding, x), F.lit(False))


def starts(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors (vec_id, v) with the smallest hashes of their ids."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(key.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in rows], np.int64)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector kept."""
    spark = vectors.sparkSession
    tune(spark)
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(_sound(F.col("embedding"), dims))
    kept = kept.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    first = starts(kept, k, seed)
    names = ["ids", "points", *(name for name, _ in Tree.NODES)]

    def built(batches):
        def row(ids, points):
            tree, order = Tree.over(points)
            return pa.RecordBatch.from_pylist([{"ids": ids.take(pa.array(order)).to_pylist()} | tree.packed()], schema)

        schema = pa.schema([("ids", pa.list_(pa.int64())), *((x, pa.binary()) for x in names[1:])])
        ids, points, n = [], [], 0
        for batch in batches:
            own = column(batch, "v").flatten().to_numpy().reshape(-1, dims)
            if len(own) and max(int(own.max()), -int(own.min())) > MOST:
                raise ValueError(f"components beyond {MOST} have no squared distance that fits a long")
            ids, points, n = [*ids, column(batch, "vec_id")], [*points, own], n + len(own)
            while n >= BLOCK:
                all_ids, all_points = pa.concat_arrays(ids), np.concatenate(points)
                yield row(all_ids[:BLOCK], all_points[:BLOCK])
                ids, points, n = [all_ids[BLOCK:]], [all_points[BLOCK:]], n - BLOCK
        if n:
            yield row(pa.concat_arrays(ids), np.concatenate(points))

    def summed(centroids):
        def run(batches):
            n, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
            for batch in batches:
                for tree in batch.select(names[1:]).to_pylist():
                    own_n, own_sums, _ = Tree.opened(tree, dims).assign(centroids)
                    n, sums = n + own_n, sums + own_sums
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n)), pa.int32()), pa.array(n), pa.array(list(sums), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

        return run

    def labelled(centroids):
        def run(batches):
            for batch in batches:
                for tree in batch.to_pylist():
                    own = Tree.opened(tree, dims)
                    label = own.assign(centroids, labels=True)[2]
                    apart = ((own.points - centroids[label]) ** 2).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(tree["ids"], pa.int64()), pa.array(label, pa.int32()), pa.array(apart)], ["vec_id", "cluster", "distance"])

        return run

    with settings(spark, FEW):
        centroids = first
        if len(first):
            trees = written(kept.mapInArrow(built, "ids array<long>, " + ", ".join(f"{x} binary" for x in names[1:])), "trees")
            for _ in range(rounds):
                found = trees.mapInArrow(summed(centroids), "cluster int, n long, sums array<long>")
                totals = found.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims))).where("n > 0").collect()  # k rows
                centroids = centroids.copy()
                for r in totals:
                    centroids[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]
            labels = written(trees.mapInArrow(labelled(centroids), "vec_id long, cluster int, distance long"), "assigned")
        else:
            labels = spark.createDataFrame([], "vec_id long, cluster int, distance long")
    inertia = {r["cluster"]: int(r["d"]) for r in labels.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # k rows
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    each = [(c, d, sum(inertia.values()), digest[c]) for c, d in inertia.items()]
    return labels.join(F.broadcast(spark.createDataFrame(each, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> str:
    near = """a{r} AS (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT v.r, m.c, list_sum(list_transform(list_zip(v.v, m.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d FROM v CROSS JOIN c{r} m) GROUP BY r)"""
    moved = """s{r} AS (SELECT c, list(s ORDER BY i) AS v FROM (SELECT c, i, floor_div(sum(x), count(*)) AS s FROM (SELECT a.c, unnest(range(1, {dims} + 1)) AS i, unnest(v.v) AS x FROM a{r} a JOIN v USING (r)) GROUP BY c, i) GROUP BY c),
c{n} AS (SELECT m.c, coalesce(s.v, m.v) AS v FROM c{r} m LEFT JOIN s{r} s USING (c))"""
    moved = moved.replace("floor_div(sum(x), count(*))", "((sum(x)::BIGINT - (((sum(x)::BIGINT % count(*)) + count(*)) % count(*))) // count(*))")
    steps = [f"""v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
             f"""c0 AS (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v FROM (SELECT sha256('{seed}:' || vec_id::VARCHAR) AS h, v FROM v ORDER BY h NULLS LAST, v LIMIT {k}))"""]
    for r in range(rounds):
        steps += [near.format(r=r), moved.format(r=r, n=r + 1, dims=dims)]
    steps.append(near.format(r=rounds))
    return f"WITH {',\n'.join(s.replace(' AS (', ' AS MATERIALIZED (', 1) for s in steps)}\nSELECT vec_id, a.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256 FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} m ON m.c = a.c"


ORACLE = _oracle()
