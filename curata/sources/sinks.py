"""Sinks: CSV, snapshots, append with dedup, versioned upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.ids import doi_to_folder
from curata.functions.storage import written
from curata.operators.resolve import unseen
from curata.sources import readers


def write_csv(frame: DataFrame, path: str, columns: list[str], files: int | None = None) -> None:
    """These columns in this order, further ones left out, NULL as nothing."""
    have = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in frame.columns else F.lit("").alias(c) for c in columns]
    out = frame.select(*have)
    (out.coalesce(files) if files else out).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def write_snapshot(frame: DataFrame, path: str, key: str) -> None:
    """A new snapshot in ranges of the key, each file sorted: readers see the old one or the new one."""
    frame.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def append_unseen(frame: DataFrame, path: str) -> int:
    """Appends candidate rows without an identifier already in the table or earlier in frame; their number."""
    known = frame.sparkSession.read.schema(frame.schema).parquet(path)
    new = written(unseen(frame, known), "append")
    new.write.mode("append").parquet(path)
    return new.count()


def write_run(cells: DataFrame, slug: str, folder: str) -> None:
    """A run over the DOIs of a pasted table (readers.doi_column): its DOIs with their folder names, and its counts."""
    dois = readers.doi_list(cells).withColumn("folder", doi_to_folder(F.col("doi")))
    dois.write.mode("overwrite").parquet(f"{folder}/dois/run={slug}")
    n = dois.agg(F.count("*").alias("n_dois"))
    readers.doi_counts(cells).join(F.broadcast(n)).write.mode("overwrite").parquet(f"{folder}/counts/run={slug}")  # two tables of one row
