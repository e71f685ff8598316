"""Yield and recall over stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def yields(expected: DataFrame, raw: DataFrame, downstream: DataFrame, completed: DataFrame) -> DataFrame:
    """api, query, raw, completed, classified, confirmed, confirm_rate, zero_yield, not_searched.

    expected(api, query), raw(api, query), downstream(stage, query joined by ' | '), completed(api, query)."""
    counts = raw.groupBy("api", "query").agg(F.count("*").alias("raw"))
    down = downstream.select("stage", F.explode(F.split("query", r" \| ")).alias("query")).groupBy("query").agg(F.count_if(F.col("stage") == "classified").alias("classified"), F.count_if(F.col("stage") == "confirmed").alias("confirmed"))
    out = expected.join(counts, ["api", "query"], "left").join(completed.distinct().withColumn("completed", F.lit(True)), ["api", "query"], "left").join(down, "query", "left")
    out = out.na.fill(0, ["raw", "classified", "confirmed"]).na.fill(False, ["completed"])
    return out.select("api", "query", "raw", "completed", "classified", "confirmed", F.try_divide(F.col("confirmed").cast("double"), F.col("classified").cast("double")).alias("confirm_rate"), (F.col("completed") & (F.col("raw") == 0)).alias("zero_yield"), (~F.col("completed")).alias("not_searched"))


def orphans(expected: DataFrame, raw: DataFrame, completed: DataFrame) -> DataFrame:
    """api, query, raw, in_progress of what was found or searched but isn't expected any more."""
    counts = raw.groupBy("api", "query").agg(F.count("*").alias("raw"))
    seen = counts.select("api", "query").union(completed.select("api", "query")).distinct().join(expected, ["api", "query"], "left_anti")
    return seen.join(counts, ["api", "query"], "left").join(completed.distinct().withColumn("c", F.lit(True)), ["api", "query"], "left").select("api", "query", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("c", F.lit(False)).alias("in_progress"))


def recall(truth: DataFrame, stages: list[tuple[str, DataFrame]], key: str, label: str) -> DataFrame:
    """label, stage_no, stage, present, total, pct, lost_here (less than the stage before; may be negative). One row for each stage."""
    flags = reduce(lambda acc, s: acc.join(s[1][1].select(key).distinct().withColumn(f"_s{s[0]}", F.lit(1)), key, "left"), enumerate(stages), truth)
    wide = flags.groupBy(label).agg(F.count("*").alias("total"), *[F.count(f"_s{i}").alias(f"n{i}") for i in range(len(stages))])
    rows = F.array(*[F.struct(F.lit(i).alias("stage_no"), F.lit(name).alias("stage"), F.col(f"n{i}").alias("present"), ((F.col("total") if i == 0 else F.col(f"n{i - 1}")) - F.col(f"n{i}")).alias("lost_here")) for i, (name, _) in enumerate(stages)])
    return wide.select(label, "total", F.explode(rows).alias("r")).select(label, "r.stage_no", "r.stage", "r.present", "total", (100.0 * F.col("r.present") / F.col("total")).alias("pct"), "r.lost_here")


def profile(missed: DataFrame, fields: list[str], top: int = 12) -> DataFrame:
    """field, value, n: the commonest values of each field, ties by value. A report of top rows a field."""
    pairs = missed.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("")).alias("value")) for f in fields])).alias("x")).select("x.*")
    counted = pairs.groupBy("field", "value").agg(F.count("*").alias("n"))
    w = Window.partitionBy("field").orderBy(F.desc("n"), "value")
    return counted.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top).drop("_r")


def baseline_delta(now: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    return now.join(before.select(*keys, F.col("pct").alias("pct_before")), keys).withColumn("delta", F.col("pct") - F.col("pct_before"))


def stale(files: DataFrame) -> DataFrame:
    """name of files(stage_no, name, mtime) older than the first stage's."""
    top = files.where("stage_no = 0").select(F.col("mtime").alias("_m"))  # one row
    return files.where("stage_no > 0").join(F.broadcast(top), F.col("mtime") < F.col("_m"), "left_semi").select("stage_no", "name")


def clamped(counts: list) -> list:
    """Each stage's count, but no more than any stage before: expressions of one row."""
    return [F.least(*counts[: i + 1]) if i else counts[0] for i in range(len(counts))]
