"""Entity resolution: components over shared identifiers, golden records, first discoverers, append with dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.ids import normalize_doi
from curata.functions.text import normalize_title
from curata.operators.components import components

BLANKABLE = ["pmid", "doi", "title", "abstract", "authors", "journal", "year"]


def identifiers(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """(seq, kind, key): a row's normalised DOI, PMID and title of more than 20 characters."""
    title = normalize_title(F.col("title"))
    keys = F.array(
        F.struct(F.lit("doi").alias("kind"), normalize_doi(F.col("doi")).alias("key")),
        F.struct(F.lit("pmid").alias("kind"), F.trim(F.col("pmid")).alias("key")),
        F.struct(F.lit("title").alias("kind"), F.when(F.length(title) > 20, title).alias("key")),
    )
    return rows.select(F.col(seq).alias("seq"), F.explode(keys).alias("x")).select("seq", "x.*").where("key is not null and key <> ''")


def resolve(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """(seq, root): rows that share an identifier, directly or over others; the root is the earliest."""
    ids = identifiers(rows, seq)
    first = ids.groupBy("kind", "key").agg(F.min("seq").alias("head"))
    comps = components(ids.join(first, ["kind", "key"]).select(F.col("seq").alias("a"), F.col("head").alias("b")))
    return rows.select(F.col(seq).alias("seq")).join(comps.withColumnRenamed("id", "seq"), "seq", "left").select("seq", F.coalesce("component", "seq").alias("root"))


def completeness(columns: list[str]) -> Column:
    """How many of the columns aren't blank."""
    return sum((F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", 1).otherwise(0) for c in columns), F.lit(0))


def golden(rows: DataFrame, groups: DataFrame, seq: str = "seq") -> DataFrame:
    """One record a group: the most complete row (earliest of equals), blanks filled from the next ones, provenance merged."""
    columns = [*BLANKABLE, "source_api", "source_query"]
    rows = rows.withColumn("_score", completeness(columns)).join(groups.withColumnRenamed("seq", seq), seq)
    order = F.struct((-F.col("_score")).alias("s"), F.col(seq).alias("q"))
    best = [F.coalesce(F.min_by(F.when(F.trim(F.col(c)) != "", F.col(c)), F.when(F.trim(F.col(c)) != "", order)), F.lit("")).alias(c) for c in BLANKABLE]
    many = lambda c, glue: F.array_join(F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c)))), glue).alias(c)
    return rows.groupBy("root").agg(*best, many("source_api", "; "), many("source_query", " | "), F.count("*").cast("string").alias("match_count"))


def in_order(groups: DataFrame, seq: str = "seq") -> DataFrame:
    """root, position: groups(seq, root) by their earliest member, counted from 0 over range buckets."""
    from curata.operators.ordered import prefix

    first = groups.groupBy("root").agg(F.min(seq).alias("earliest"), F.lit(1).alias("one"))
    return prefix(first, "earliest", "one", ["root"]).select("root", "position")


def first_by_key(rows: DataFrame, key: Column, seq: str = "seq") -> DataFrame:
    """The earliest row of each key; rows without a key stay."""
    keyed = rows.withColumn("_key", key)
    best = F.min_by(F.struct(*rows.columns), seq).alias("_row")
    found = keyed.where("_key is not null and _key <> ''").groupBy("_key").agg(best).select("_row.*")
    return found.unionByName(keyed.where("_key is null or _key = ''").drop("_key"))


def unseen(new: DataFrame, known: DataFrame, seq: str = "seq") -> DataFrame:
    """Rows of new without an identifier in known or in an earlier row of new."""
    ids, old = identifiers(new, seq), identifiers(known, seq).select("kind", "key").distinct()
    first = ids.groupBy("kind", "key").agg(F.min("seq").alias("head"))
    bad = ids.join(old, ["kind", "key"], "left_semi").select("seq").union(ids.join(first, ["kind", "key"]).where("seq > head").select("seq")).distinct()
    return new.join(bad.withColumnRenamed("seq", seq), seq, "left_anti")


def unambiguous(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one distinct value, and that value."""
    return rows.groupBy(key).agg(F.count_distinct(value).alias("_n"), F.min(value).alias(value)).where("_n = 1").drop("_n")


def mode(rows: DataFrame, group: str, label: Column, seq: str) -> DataFrame:
    """The most frequent non-blank label of each group; the first seen wins ties; '' if there is none."""
    counted = rows.select(group, F.lower(F.trim(label)).alias("label"), F.col(seq).alias("s")).groupBy(group, "label").agg(F.count("*").alias("n"), F.min("s").alias("p"))
    real = F.coalesce(F.col("label"), F.lit("")) != ""
    return counted.groupBy(group).agg(F.coalesce(F.max_by(F.when(real, F.col("label")), F.when(real, F.struct("n", (-F.col("p")).alias("p")))), F.lit("")).alias("mode"))
