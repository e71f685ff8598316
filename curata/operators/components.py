"""Connected components of a link table, by min-label exchange with pointer jumping."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from curata.functions.storage import written

FEW = 200_000  # links of one task's memory: some tens of megabytes


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id that links reach from each id which occurs in links(a, b).

    Alternating large-star and small-star steps: every round joins each vertex's larger
    (then smaller) neighbours to its least one, so long chains shrink in a logarithmic
    number of rounds and no vertex ever gathers its neighbours. Each round is written to
    the shared folder; it ends when a round changes nothing. Once no more than ``FEW`` links
    are left, one task joins them. Links of an id with itself and nulls are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v and u is not null and v is not null").distinct()
    edges = written(edges, "links")
    known = _digest(edges)
    for _ in range(most_rounds):
        if known[0] <= FEW:
            return _joined(edges)
        # large star: neighbours above a vertex go to the least of its neighbourhood
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a vertex and its smaller neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        new = written(small, "links")
        edges, before, known = new, known, _digest(new)
        if known == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _joined(edges: DataFrame) -> DataFrame:
    """(id, component) of few links (u, v), in one task."""
    kind = edges.schema["u"].dataType.simpleString()

    def run(batches):
        root: dict = {}

        def find(x):
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root[up]
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                u, v = sorted((find(u), find(v)))
                root[v] = u
        ids = list(root)
        schema = pa.schema([("id", to_arrow), ("component", to_arrow)])
        yield pa.RecordBatch.from_arrays([pa.array(ids, to_arrow), pa.array([find(x) for x in ids], to_arrow)], schema=schema)

    to_arrow = to_arrow_type(edges.schema["u"].dataType)
    return edges.select("u", "v").repartition(1).mapInArrow(run, f"id {kind}, component {kind}")


def _digest(edges: DataFrame) -> tuple:
    """Order-independent; equal for equal sets of edges."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)).first())
