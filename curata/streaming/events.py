"""Event-time and stateful variants over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions.storage import new_folder, shared_dir


def source(spark: SparkSession, path: str, files: int = 4) -> DataFrame:
    """The events as a stream of several files in order of time, one a trigger; ts as a timestamp, which watermarks need."""
    folder = new_folder(spark, "events")
    table = spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    table.repartitionByRange(files, "ts").write.parquet(folder)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def tumbling(events: DataFrame, late: str = "1 hour", size: str = "1 hour") -> DataFrame:
    g = events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, late: str = "1 hour", size: str = "2 hours", step: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", size, step)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")


def sessions(events: DataFrame, late: str = "1 hour", gap: str = "30 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def distinct_events(events: DataFrame, key: str = "event_id", late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a query over what is there now and returns its rows from the shared folder."""
    spark, folder = stream.sparkSession, new_folder(stream.sparkSession, name)
    q = stream.writeStream.outputMode(mode).format("parquet").option("path", folder).option("checkpointLocation", f"{folder}-state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(folder)


def run_complete(stream: DataFrame, name: str) -> DataFrame:
    """Runs an aggregation in complete mode over what is there now; the last batch's result."""
    spark, folder = stream.sparkSession, new_folder(stream.sparkSession, name)
    q = stream.writeStream.outputMode("complete").option("checkpointLocation", f"{folder}-state").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(folder)).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(folder)


def append_unseen(rows: DataFrame, keys: list[str], name: str, folder: str | None = None) -> DataFrame:
    """foreachBatch append of rows none of whose keys is in the table or in an earlier row of the batch (seq orders a batch).

    folder: where the table is, to go on from an earlier run; a new one by default.
    """
    spark, folder = rows.sparkSession, folder or new_folder(rows.sparkSession, name)
    shared_dir(spark)
    q = rows.writeStream.option("checkpointLocation", f"{folder}-state").foreachBatch(lambda batch, number: put_unseen(batch, number, keys, folder)).trigger(availableNow=True).start()
    q.awaitTermination()
    return appended(spark, rows.schema, folder)


def appended(spark: SparkSession, schema, folder: str) -> DataFrame:
    """The table that batches are put into, without the number of the batch."""
    return spark.read.schema(schema).option("basePath", folder).parquet(f"{folder}/batch=*")


BUCKETS = 64  # of the index of keys, beside the table: a batch reads those that its own keys fall into


def put_unseen(batch: DataFrame, number: int, keys: list[str], folder: str, buckets: int = BUCKETS) -> None:
    """Puts a batch's new rows where they replace those of an earlier attempt at it, which don't count as known.

    What the table knows is kept by key: each batch writes the keys of the rows it put, in buckets of their hashes, and a
    later one looks its own keys up in the buckets they fall into, whatever columns and rows the table has.
    """
    spark = batch.sparkSession

    def pairs(df):
        one = df.select("seq", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key")) for k in keys])).alias("x"))
        return one.select("seq", "x.*").where("key is not null and key <> ''").withColumn("bucket", F.pmod(F.xxhash64("kind", "key"), F.lit(buckets)).cast("int"))

    mine = pairs(batch)
    first = mine.groupBy("kind", "key").agg(F.min("seq").alias("head"))
    bad = mine.join(first, ["kind", "key"]).where("seq > head").select("seq")
    if number:
        bad = bad.union(mine.join(known_keys(spark, folder, number, [r["bucket"] for r in mine.select("bucket").distinct().collect()]), ["kind", "key"], "left_semi").select("seq"))
    batch.join(bad.distinct(), "seq", "left_anti").select(*batch.columns).write.mode("overwrite").parquet(f"{folder}/batch={number}")
    put = spark.read.schema(batch.schema).parquet(f"{folder}/batch={number}")
    pairs(put).select("kind", "key", "bucket").distinct().repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}-keys/batch={number}")


def known_keys(spark: SparkSession, folder: str, number: int, buckets: list[int]) -> DataFrame:
    """kind, key of the rows put by batches before that number, of these buckets (one value a bucket) alone."""
    index = spark.read.schema("kind string, key string, batch long, bucket int").option("basePath", f"{folder}-keys").parquet(f"{folder}-keys")
    return index.where((F.col("batch") < number) & F.col("bucket").isin(buckets)).select("kind", "key")
