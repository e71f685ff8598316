"""The flagship query: how many distinct records survive entity resolution, by language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.operators import resolve
from curata.plans import fixtures as fx


def survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, n_records, n_rows, most_merged: golden records of shared-identifier components."""
    rows = fx.candidates(spark, sf_dir)
    merged = resolve.golden(rows, resolve.resolve(rows))
    n = F.col("match_count").cast("long")
    return merged.groupBy(F.col("source_query").alias("lang")).agg(F.count("*").alias("n_records"), F.sum(n).alias("n_rows"), F.max(n).alias("most_merged"))
