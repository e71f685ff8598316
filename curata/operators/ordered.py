"""Global order without a single task: range buckets, positions and prefix sums over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.functions.storage import estimated_bytes


BUCKET_BYTES, MOST_BUCKETS = 64 << 20, 16_384


def buckets_for(frame: DataFrame, least: int) -> int:
    """How many range buckets keep each near BUCKET_BYTES, by the size that the optimizer knows (columns unpack to about three times it)."""
    size = estimated_bytes(frame)
    return least if size is None else min(MOST_BUCKETS, max(least, -(-3 * size // BUCKET_BYTES)))


def splitters(frame: DataFrame, key: str, n: int) -> list[int]:
    """Up to n - 1 distinct values that part the (integer) key into ranges of like size."""
    accuracy = 100 * n if n <= 1000 else 10 * n
    row = frame.agg(F.percentile_approx(F.col(key).cast("long"), [i / n for i in range(1, n)], accuracy).alias("q")).first()
    return sorted(set(row["q"] or []))


def _below(key: Column, bounds: list[int]) -> Column:
    """How many of the (sorted) bounds lie below the key: first among every m-th of them, then among the m that follow."""
    constant = lambda x: F.expr(f"cast(split('{','.join(map(str, x))}', ',') as array<bigint>)")  # noqa: E731 - folded to a literal
    if len(bounds) <= 64:
        return F.size(F.filter(constant(bounds), lambda b: b < key))
    m = int(len(bounds) ** 0.5)
    coarse = F.size(F.filter(constant(bounds[::m]), lambda b: b < key))
    fine = F.size(F.filter(F.slice(constant(bounds), (coarse - 1) * m + 1, m), lambda b: b < key))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * m + fine)


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """0 for keys up to the first bound, and so on upwards; nulls come after all others."""
    if not bounds:
        return F.when(key.isNull(), F.lit(1)).otherwise(F.lit(0))
    return F.when(key.isNull(), F.lit(len(bounds) + 1)).otherwise(_below(key, bounds))


def prefix(frame: DataFrame, key: str, value: str, ties: list[str], buckets: int | None = None) -> DataFrame:
    """Adds ``bucket``, ``position`` (0 for the first row in ascending order of key, nulls last)
    and ``start`` (sum of value over all rows before).

    One shuffle of the rows, by range bucket (96, or more for large frames). Of the totals there
    is one row a bucket; only they are summed up in one place and broadcast.
    """
    buckets = buckets or buckets_for(frame, 96)
    rows = frame.withColumn("bucket", bucket_of(F.col(key), splitters(frame, key, buckets)))
    order = Window.partitionBy("bucket").orderBy(F.col(key).asc_nulls_last(), *ties)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("bucket").agg(F.count("*").alias("_n"), F.sum(value).alias("_v"))
    all_before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("bucket", F.coalesce(F.sum("_n").over(all_before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_v").over(all_before), F.lit(0)).alias("_v0"))
    rows = rows.withColumns({"position": F.row_number().over(order) - 1, "start": F.coalesce(F.sum(value).over(before), F.lit(0))})
    return rows.join(F.broadcast(totals), "bucket").withColumns({"position": (F.col("position") + F.col("_n0")).cast("long"), "start": (F.col("start") + F.col("_v0")).cast("long")}).drop("_n0", "_v0")
