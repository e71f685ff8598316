"""Nested extraction results: choosing a run, flattening, folding metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chosen_run(runs: DataFrame, paper: str, tag_rank: Column, suffix_rank: Column) -> DataFrame:
    """The best run of each paper by tag, then suffix; runs of unknown tag or suffix don't count."""
    w = Window.partitionBy(paper).orderBy("_t", "_s")
    return runs.withColumns({"_t": tag_rank, "_s": suffix_rank}).where("_t is not null and _s is not null").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_t", "_s")


def load_status(converted: Column, extracted: Column, parses: Column, wrong: Column) -> Column:
    return F.when(~converted, "not_converted").when(~extracted, "not_extracted").when(~parses, "bad_json").when(wrong, "wrong_document_on_disk").otherwise("ok")


def collated(papers: DataFrame, entries: str = "entries") -> DataFrame:
    """One row an entry of the array column, a single one with blanks where there is none; entry_no from 0."""
    kept = [c for c in papers.columns if c != entries]
    flat = papers.select(*kept, F.posexplode_outer(entries).alias("entry_no", "e"))
    fields = papers.schema[entries].dataType.elementType.fieldNames()
    return flat.select(*kept, F.coalesce("entry_no", F.lit(0)).alias("entry_no"), *[F.coalesce(F.col(f"e.{c}").cast("string"), F.lit("")).alias(c) for c in fields])


def tag_findings(entries: Column, version: str = "ai_version", result: str = "result") -> Column:
    """struct(ai_version, n, results): the first version that is there, number of entries, results that aren't blank."""
    return F.struct(F.get(F.filter(F.transform(entries, lambda e: e[version]), lambda v: v.isNotNull()), F.lit(0)).alias("ai_version"), F.coalesce(F.size(entries), F.lit(0)).alias("n"), F.filter(F.transform(entries, lambda e: e[result]), lambda r: F.coalesce(r, F.lit("")) != "").alias("results"))


def folded(rows: DataFrame, key: str, rank: str, fields: list[str]) -> DataFrame:
    """Of each field the first value by rank that isn't missing."""
    order = lambda f: F.min_by(F.when(F.coalesce(F.trim(F.col(f)), F.lit("")) != "", F.col(f)), F.when(F.coalesce(F.trim(F.col(f)), F.lit("")) != "", F.col(rank))).alias(f)
    return rows.groupBy(key).agg(*[order(f) for f in fields])


def with_core_fields(entry: Column, core: list[str]) -> Column:
    """The core fields of a struct as strings, '' where missing; all other fields go."""
    return F.struct(*[F.coalesce(entry[c].cast("string"), F.lit("")).alias(c) for c in core])


def wrong_schema_fields(schema, allowed: set[str], path: str = "") -> list[str]:
    """Names in a (nested) schema that a blinded sheet may not have."""
    from pyspark.sql import types as T

    out = []
    if isinstance(schema, T.ArrayType):
        return wrong_schema_fields(schema.elementType, allowed, path)
    if isinstance(schema, T.StructType):
        for f in schema.fields:
            if f.name not in allowed:
                out.append(path + f.name)
            out += wrong_schema_fields(f.dataType, allowed, f"{path}{f.name}.")
    return out


def provenance_problems(rows: DataFrame, allow_pipeline: bool = False, allow_paper_level: bool = False) -> DataFrame:
    """reason, n: rows that may not be evaluated against. rows: provenance, granularity."""
    p = F.coalesce(F.trim("provenance"), F.lit(""))
    reason = F.when(p == "", "blank provenance").when(F.lit(not allow_pipeline) & p.startswith("pipeline:"), "pipeline provenance").when(F.lit(not allow_paper_level) & (F.col("granularity") == "paper"), "paper-level truth")
    return rows.select(reason.alias("reason")).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def corrected(rows: DataFrame, changes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """rows after changes(seq, key, action set|drop|flag, field, value): the last set of a field wins, dropped keys go, provenance is stamped once."""
    drops = changes.where("action = 'drop'").select(key).distinct()
    sets = changes.where("action = 'set'").groupBy(key).pivot("field", fields).agg(F.max_by("value", "seq"))
    sets = sets.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    touched = changes.where("action in ('set', 'flag')").select(key).distinct().withColumn("_touched", F.lit(True))
    out = rows.join(drops, key, "left_anti").join(sets, key, "left").join(touched, key, "left")
    stamp = F.when(F.col("_touched"), F.concat("provenance", F.lit("+corrected"))).otherwise(F.col("provenance"))
    return out.select(key, *[F.coalesce(F.col(f"_{f}"), F.col(f)).alias(f) for f in fields], stamp.alias("provenance"))
