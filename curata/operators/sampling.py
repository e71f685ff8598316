"""Seeded, reproducible samples: the order is a hash of (seed, id), not a generator's state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_of(seed: str, key: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(seed), key.cast("string")), 256)


def stratified(rows: DataFrame, stratum: str, key: str, n: int, seed: str) -> DataFrame:
    """n rows (or all), in proportion to strata, one of each at least; trimmed or extended in hash order.

    A row that more than n - 1 of its stratum precede cannot be among the n, so each task keeps n rows of a stratum.
    """
    sizes = rows.groupBy(stratum).agg(F.count("*").alias("_m"))
    total = sizes.agg(F.sum("_m").alias("_total"))
    quotas = sizes.join(F.broadcast(total)).withColumn("_quota", F.greatest(F.lit(1), F.bround(n * F.col("_m") / F.col("_total"))).cast("int"))  # total is one row
    w = Window.partitionBy(stratum).orderBy("_h", key)
    own = rows.withColumn("_h", order_of(seed, F.col(key)))
    ranked = own.join(quotas.select(stratum, "_quota"), stratum).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return ranked.withColumn("_late", (F.col("_r") > F.col("_quota")).cast("int")).orderBy("_late", "_h", key).limit(n).drop("_h", "_quota", "_r", "_late")


def top_of_each(rows: DataFrame, stratum: str, key: str, n: int, seed: str) -> DataFrame:
    """The first n rows of each stratum in hash order."""
    w = Window.partitionBy(stratum).orderBy(order_of(seed, F.col(key)), key)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def bernoulli(rows: DataFrame, key: str, share: float, seed: str, always: Column | None = None) -> DataFrame:
    """A share of the rows by hash, and all rows for which always holds."""
    from curata.functions.ids import unit_hash

    hit = unit_hash(F.lit(seed), F.col(key).cast("string")) < share
    return rows.where(hit if always is None else always | hit)


def in_bands(rows: DataFrame, size: str, key: str, bands: list[tuple[int, int]], per_band: int, seed: str) -> DataFrame:
    """per_band rows of each band of sizes, with band."""
    band = F.coalesce(*[F.when(F.col(size).between(lo, hi), F.lit(f"{lo}-{hi}")) for lo, hi in bands])
    return top_of_each(rows.withColumn("band", band).where("band is not null"), "band", key, per_band, seed)


def under_cap(rows: DataFrame, size: str, key: str, cap: int) -> DataFrame:
    """Rows by rising size, then key, while they fit below the cap; one that doesn't is passed over and later ones tried.

    size is a count. Those of size 0 all fit; of size s at most cap / s do, so the list that is walked has some
    cap * ln(cap) rows, however many rows there are.
    """
    item = F.struct(F.col("_n").alias("n"), F.col(key).alias("k"))
    step = lambda acc, x: F.when(acc["total"] + x["n"] <= cap, F.struct((acc["total"] + x["n"]).alias("total"), F.concat(acc["kept"], F.array(x["k"])).alias("kept"))).otherwise(acc)
    kind = rows.schema[key].dataType.simpleString()
    start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast(f"array<{kind}>").alias("kept"))
    own = rows.select(key, F.col(size).cast("long").alias("_n"))
    free = own.where((F.col("_n") == 0) & (F.col("_n") <= cap)).select(key)
    first = own.where((F.col("_n") > 0) & (F.col("_n") <= cap)).withColumn("_r", F.row_number().over(Window.partitionBy("_n").orderBy(key)))
    # the first bound is a constant, so that each task keeps its own first rows of a size before the shuffle
    able = first.where(F.col("_r") <= cap).where(F.col("_r") * F.col("_n") <= cap)
    return able.agg(F.aggregate(F.array_sort(F.collect_list(item)), start, step)["kept"].alias("kept")).select(F.explode("kept").alias(key)).unionByName(free)


def frame(rows: DataFrame, strata: list[tuple[str, Column, int]], key: str, seed: str) -> DataFrame:
    """key, stratum: strata in order, each drawing its number from what those before left. A few strata, so a loop of plans."""
    out, rest = None, rows
    for name, condition, n in strata:
        got = rest.where(condition).orderBy(order_of(seed, F.col(key)), key).limit(n).select(key).withColumn("stratum", F.lit(name))
        rest = rest.join(got.select(key), key, "left_anti")
        out = got if out is None else out.unionByName(got)
    return out


def quota_frame(members: DataFrame, quotas: DataFrame, key: str, seed: str, excluded: DataFrame | None = None) -> DataFrame:
    """key, stratum, cell: a sampling frame of strata with cells and quotas, told as data, in one plan whatever their number.

    members(key, stratum, cell, tier): what each key could stand for; several strata are allowed. quotas(stratum, seq, cell, n,
    total, instead): n rows of a cell in hash order (null: all), rows of a lower tier first - or, with instead, rows of
    the lowest tier there is alone; then rows of any cell of the stratum, lower tiers first, up to its total (null: none). Strata draw from
    all of their members, and a key that several draw stands in the first by seq. excluded(key) is never drawn.
    """
    rows = members if excluded is None else members.join(excluded.select(key).distinct(), key, "left_anti")
    most = quotas.agg(F.max(F.greatest(F.coalesce("n", F.lit(0)), F.coalesce("total", F.lit(0)))).alias("m"), F.count_if(F.col("n").isNull()).alias("open")).first()
    q = F.broadcast(quotas.select("stratum", "seq", "cell", "n", "total", F.coalesce("instead", F.lit(False)).alias("instead")))  # one row a cell
    own = rows.select(key, "stratum", "cell", F.coalesce("tier", F.lit(0)).alias("tier")).join(q, ["stratum", "cell"])
    own = own.withColumn("_h", order_of(seed, F.concat_ws(":", "stratum", F.col(key).cast("string"))))
    lowest = own.groupBy("stratum", "cell").agg(F.min("tier").alias("_lowest"))
    # a row that more of its cell precede than any quota asks for can't be drawn, so each task keeps few of a cell
    first = own.withColumn("_r", F.row_number().over(Window.partitionBy("stratum", "cell").orderBy("tier", "_h", key)))
    first = first if most["open"] else first.where(F.col("_r") <= int(most["m"] or 0))
    first = first.join(F.broadcast(lowest), ["stratum", "cell"])  # one row a cell
    drawn = (F.col("n").isNull() | (F.col("_r") <= F.col("n"))) & (~F.col("instead") | (F.col("tier") == F.col("_lowest")))
    first = first.withColumn("_late", F.when(drawn, 0).otherwise(1))
    rank = F.row_number().over(Window.partitionBy("stratum").orderBy("_late", "tier", "_h", key))
    named = first.where("_late = 0").select(key, "seq", "stratum", "cell")
    more = first.where("total is not null").withColumn("_t", rank).where((F.col("_late") == 1) & (F.col("_t") <= F.col("total"))).select(key, "seq", "stratum", "cell")
    taken = named.unionByName(more).groupBy(key).agg(F.min(F.struct("seq", "stratum", "cell")).alias("x"))
    return taken.select(key, "x.stratum", "x.cell")
