"""Which records are settled already and which need work: manifests, prior verdicts, queues, state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.functions.validate import verdict


def manifest(catalog: DataFrame, published: DataFrame) -> DataFrame:
    """doi, path, contains: catalog(doi, path, contains) and published(doi), which forces '1'."""
    p = published.select(F.lower("doi").alias("k")).distinct().withColumn("db", F.lit(True))
    c = catalog.withColumn("k", F.lower("doi"))
    return c.join(p, "k", "full").select(F.coalesce("doi", "k").alias("doi"), F.coalesce("path", F.lit("")).alias("path"), F.when(F.col("db"), "1").otherwise(F.col("contains")).alias("contains"))


def routes(rows: DataFrame, settled: DataFrame, prior: DataFrame) -> DataFrame:
    """Adds route and is_replication. rows: seq, doi (normalised), pmid, title, abstract; settled: doi, verdict '1'/'0';
    prior: line, doi, pmid, is_replication, confidence, replication_type. Order: blank, settled, valid prior (by doi, else pmid), work."""
    prior = prior.withColumn("v", verdict(F.col("is_replication"), F.col("confidence"), F.col("replication_type")))
    last = lambda key: prior.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(F.col(key).alias(f"p_{key}")).agg(F.max_by(F.struct("v", "line"), "line").alias(f"by_{key}"))
    out = rows.join(settled.select(F.col("doi").alias("s_doi"), "verdict"), F.col("doi") == F.col("s_doi"), "left").join(last("doi"), F.col("doi") == F.col("p_doi"), "left").join(last("pmid"), F.col("pmid") == F.col("p_pmid"), "left")
    found = F.coalesce("by_doi", "by_pmid")["v"]
    blank = (F.coalesce("title", F.lit("")) == "") & (F.coalesce("abstract", F.lit("")) == "")
    route = F.when(blank, "blank").when(F.col("verdict").isNotNull(), "settled").when(found.isNotNull(), "prior").otherwise("work")
    flag = F.when(blank, F.lit(False)).when(F.col("verdict").isNotNull(), F.col("verdict") == "1").otherwise(found["is_replication"])
    return out.select(*rows.columns, route.alias("route"), flag.alias("is_replication"))


def queue(rows: DataFrame, present: DataFrame, published: DataFrame, rank: dict[str, int], limit: int) -> DataFrame:
    """rows(seq, doi, kind) of the ranked kinds that are neither present nor published, by rank and arrival."""
    order = F.element_at(F.create_map(*[F.lit(x) for kv in rank.items() for x in kv]), F.col("kind"))
    return rows.withColumn("rank", order).where("rank is not null").join(present.select("doi"), "doi", "left_anti").join(published.select("doi"), "doi", "left_anti").orderBy("rank", "seq").limit(limit)


def coverage(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """One row: total, covered and missing keys, and the share covered."""
    w = wanted.select(key).distinct().join(have.select(key).distinct().withColumn("_h", F.lit(True)), key, "left")
    return w.agg(F.count("*").alias("total"), F.count("_h").alias("covered"), (F.count("*") - F.count("_h")).alias("missing"), F.try_divide(F.count("_h").cast("double"), F.count("*").cast("double")).alias("share"))


def type_map(first: DataFrame, fallback: DataFrame, keys: DataFrame) -> DataFrame:
    """doi, types (sorted set): of first, else of fallback, else ['unclassified']."""
    own = first.groupBy("doi").agg(F.array_sort(F.collect_set("type")).alias("types"))
    other = fallback.groupBy("doi").agg(F.array_sort(F.collect_set("type")).alias("types")).join(own.select("doi"), "doi", "left_anti")
    return keys.select("doi").distinct().join(own.unionByName(other), "doi", "left").select("doi", F.coalesce("types", F.array(F.lit("unclassified"))).alias("types"))


def alias_once(rows: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """Adds canonical: the alias table's answer for the key, one hop only, else the key."""
    return rows.join(aliases.select(F.col("alias").alias(key), F.col("canonical").alias("_c")), key, "left").withColumn("canonical", F.coalesce("_c", key)).drop("_c")


def carried_over(new: DataFrame, old: DataFrame, keys: list[str], evidence: list[str], kept: list[str]) -> DataFrame:
    """The kept columns of old rows with the same keys and the very same evidence (NULL-safe), else ''."""
    o = old.select(*[F.col(c).alias(f"_{c}") for c in [*keys, *evidence, *kept]])
    on = [F.col(c) == F.col(f"_{c}") for c in keys] + [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in evidence]
    return new.join(o, on, "left").select(*new.columns, *[F.coalesce(F.col(f"_{c}"), F.lit("")).alias(c) for c in kept])


def query_done(failed: Column, recorded_cap: Column, asked_cap: Column, legacy_cap: int = 1000) -> Column:
    """A search is done if it didn't fail and was recorded with at least the cap asked for."""
    return ~F.coalesce(failed, F.lit(False)) & (F.coalesce(recorded_cap, F.lit(legacy_cap)) >= asked_cap)


def latest_wins(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Upsert into a snapshot: new rows replace old ones of the same key, the last of several wins by _seq."""
    both = old.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1)))
    w = Window.partitionBy(key).orderBy(F.desc("_v"), F.desc("_seq"))
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_v")


def changed_fingerprint(history: DataFrame, new: DataFrame) -> DataFrame:
    """new(ts, fp), unless fp is that of the last row of history(ts, fp)."""
    last = history.agg(F.max_by("fp", "ts").alias("last"))
    return new.join(F.broadcast(last), F.col("fp").eqNullSafe(F.col("last")), "left_anti")  # last is one row
