"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Each source's target is its weight's share of all words, at most ``max_epochs`` times its own
size; what a capped source leaves is reshared by weight until none is above its cap. Sorted by
cap over weight, the capped sources are a prefix, so the level is found with window sums over
the source table (one row a source).

A source is repeated a whole number of times; of the rest, documents are taken in the order of
a seeded hash of doc_id and text until the fraction is filled, a document counting once its
middle is reached. That order is cut at one hash value for each source, found from sums by hash
range and then within one range: no task sorts a source, and texts are never shuffled. Where the
cut falls among rows equal in doc_id and text, a second hash, of their places in the table,
divides them in the same way.

Defined results: a null, empty or blank text has size 0 and takes 0 words; null is a source of
its own and comes last; rows without doc_id, or with equal ones, are documents of their own, and
of rows equal in doc_id and text those taken depend on how the table is stored, their number
doesn't; a table without words gives targets of 0; further columns are ignored (or, by ``apply``, kept).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.functions.storage import written
from curata.llm.columns import fresh

WORD = r"[^\x20\x09-\x0D]+"
RANGE_BITS = 12  # of the hash, at least: half as many as number the rows, so that neither ranges nor rows of one are many
BROADCAST_BYTES, ROW_BYTES = 16 << 20, 256  # of a source: its numbers, and a name of usual length


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """Equal for equal sources, never null."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def _hash(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, text)


def _cut(rows: DataFrame, rest: DataFrame, sources: DataFrame, bits: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(k, cut: rows with an h up to it fill rest, a hash value counting once its middle is reached; k, edge, left: the next
    hash value, if rest ends within several rows that have it, and what is left of rest for them).

    rows: k, h, size; rest: k, rest. The sums by range of h show in which one the order is cut, those within it where.
    """
    ranges = written(rows.withColumn("range", F.shiftright("h", 64 - bits)).groupBy("k", "range").agg(F.sum("size").alias("size")), name)
    w = Window.partitionBy("k").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    at = ranges.withColumn("before", F.coalesce(F.sum("size").over(w), F.lit(0))).join(rest, "k").where("before < rest")
    at = at.groupBy("k").agg(F.max(F.struct("before", "range", "rest")).alias("x")).select("k", "x.*")
    near = rows.withColumn("range", F.shiftright("h", 64 - bits)).join(_small(at, sources), ["k", "range"]).groupBy("k", "range", "h").agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    w = Window.partitionBy("k", "range").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    near = written(near.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(w), F.lit(0))), name)
    inside = near.where("before + size / if(n > 1, 1, 2) < rest").groupBy("k").agg(F.max("h").alias("inside"))
    edge = near.where("n > 1 and before + size >= rest and before < rest").select("k", F.col("h").alias("edge"), (F.col("rest") - F.col("before")).alias("left"))
    # none of the range's documents: the cut is just below the range
    below = F.shiftleft(F.col("range").cast("long"), 64 - bits) - 1
    cut = at.join(inside, "k", "left").select("k", F.when(F.col("inside").isNotNull(), F.col("inside")).when(F.col("range") > -(1 << (bits - 1)), below).alias("cut"))
    return cut, edge


def targets(sources: DataFrame, max_epochs: int = 3) -> DataFrame:
    """sources(k, source, source_size): adds weight (1, 2, 3 by code point of the source, null last) and target."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = sources.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    rows = rows.withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    spent = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.sum("source_size").over(everything) - spent) / weights)
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return rows.withColumn("target", target).drop("cap", "level")


def plan(docs: DataFrame, max_epochs: int = 3, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, k, h, place, size of every document; sources: k, source, source_size, target, whole, cut, edge, inner).

    A document is repeated whole times, and once more if its h is at most cut, or is edge and its place is at most inner.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size_of(F.col("text")).alias("size"), _hash(F.col("doc_id").cast("long"), F.col("text"), seed).alias("h"), _place(seed).alias("place"))
    rows = written(rows.withColumn("k", _key(F.col("source"))), "mix-sizes")
    bits = max(RANGE_BITS, rows.count().bit_length() // 2)
    sources = targets(rows.groupBy("k", "source").agg(F.sum("size").alias("source_size")), max_epochs)
    sources = sources.withColumn("epochs", F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0)))
    sources = written(sources.withColumn("whole", F.floor("epochs").cast("long")).withColumn("rest", (F.col("epochs") - F.floor("epochs")) * F.col("source_size")), "mix-sources")
    cut, edge = _cut(rows, sources.select("k", "rest"), sources, bits, "mix-ranges")
    edge = written(edge, "mix-edges")
    equal = rows.join(_small(edge, sources), "k").where("h = edge").select("k", F.col("place").alias("h"), "size")
    inner, _ = _cut(equal, edge.select("k", F.col("left").alias("rest")), sources, bits, "mix-equal")
    found = sources.join(cut, "k", "left").join(edge.select("k", "edge"), "k", "left").join(inner.withColumnRenamed("cut", "inner"), "k", "left")
    return rows, written(found, "mix-cuts")


def _small(side: DataFrame, sources: DataFrame) -> DataFrame:
    """Broadcast where the bytes of the source table were summed up and are few; else Spark chooses."""
    size = sources.agg(F.sum(ROW_BYTES + F.octet_length("k")).alias("n")).first()["n"] or 0
    return F.broadcast(side) if size <= BROADCAST_BYTES else side


def _place(seed: int) -> Column:
    """Tells rows apart that are equal in doc_id and text, by where they stand in the table."""
    return F.xxhash64(F.lit(seed), F.monotonically_increasing_id())


def _once_more(h: str, place: str, cut: str, edge: str, inner: str) -> Column:
    more = (F.col(h) <= F.col(cut)) | ((F.col(h) == F.col(edge)) & (F.col(place) <= F.col(inner)))
    return F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)


def mix(docs: DataFrame, max_epochs: int = 3, seed: int = 7) -> DataFrame:
    """doc_id, source, size, source_size, target, repetitions, taken (words) of every document."""
    rows, sources = plan(docs, max_epochs, seed)
    joined = rows.drop("source").join(_small(sources, sources), "k")
    return joined.withColumn("repetitions", F.col("whole") + _once_more("h", "place", "cut", "edge", "inner")).select("doc_id", "source", "size", "source_size", "target", "repetitions", (F.col("size") * F.col("repetitions")).alias("taken"))


def apply(docs: DataFrame, max_epochs: int = 3, seed: int = 7) -> DataFrame:
    """The mix itself: every document as often as it is repeated, with all columns of docs."""
    _, sources = plan(docs, max_epochs, seed)
    names = ["h", "place", "cut", "edge", "inner"]
    key, whole, times, copy, *own = fresh(docs, "key", "whole", "times", "copy", *names)
    h, place, *_ = own
    small = sources.select(F.col("k").alias(key), F.col("whole").alias(whole), *(F.col(c).alias(o) for c, o in zip(names[2:], own[2:], strict=True)))
    rows = docs.withColumns({key: _key(docs["source"]), h: _hash(docs["doc_id"].cast("long"), docs["text"], seed), place: _place(seed)}).join(_small(small, sources), key)
    rows = rows.withColumn(times, (F.col(whole) + _once_more(*own)).cast("int")).where(F.col(times) > 0)
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
