"""Versioned snapshots: buckets of keys of which only touched ones are rewritten, and a manifest that names each version's files.

Below one folder, ``data/version=v/bucket=b`` has the rows of a bucket that version v rewrote, and ``manifest/version=v``
one row a bucket: where its rows are in version v, and how many. A version is there once its manifest is complete,
which Spark marks by a file written last; so readers see all of a version or none, older ones stay readable, and a
writer that dies leaves rows that no manifest names. Two writers of one version can't both end: the second finds it there.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "bucket int, path string, n_rows long, schema string"


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def current(spark: SparkSession, folder: str) -> int | None:
    """The number of the last complete version, found by doubling and halving: versions have no gaps."""
    there = lambda v: _exists(spark, f"{folder}/manifest/version={v}/_SUCCESS")
    if not there(0):
        return None
    low, high = 0, 1
    while there(high):
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if there(middle) else (low, middle)
    return low


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """bucket, path, n_rows, schema: one row a bucket."""
    v = current(spark, folder) if version is None else version
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest/version={v}")


def read(spark: SparkSession, folder: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a version, the last by default; of these buckets alone, if named."""
    rows = manifest(spark, folder, version).collect()  # one row a bucket
    schema = T.StructType.fromJson(json.loads(rows[0]["schema"]))
    paths = [f"{folder}/{r['path']}" for r in rows if r["n_rows"] and (buckets is None or r["bucket"] in buckets)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _commit(rows: DataFrame, folder: str, key: str, version: int, touched: list[int], before: list, buckets: int) -> None:
    """Writes the touched buckets' rows as a version, and its manifest after them."""
    spark, schema = rows.sparkSession, rows.schema.json()
    rows.withColumn("bucket", _bucket(key, buckets)).repartition("bucket").sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/data/version={version}")
    put = spark.read.schema("bucket int").option("basePath", f"{folder}/data/version={version}").parquet(f"{folder}/data/version={version}")
    counts = {r["bucket"]: r["n"] for r in put.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    new = [(b, f"data/version={version}/bucket={b}", counts.get(b, 0), schema) for b in touched]
    kept = [(r["bucket"], r["path"], r["n_rows"], schema) for r in before if r["bucket"] not in set(touched)]
    spark.createDataFrame(new + kept, MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest/version={version}")


def create(frame: DataFrame, folder: str, key: str, buckets: int = 64) -> int:
    """Version 0, of all rows."""
    _commit(frame, folder, key, 0, list(range(buckets)), [], buckets)
    return 0


def upsert(new: DataFrame, folder: str, key: str, seq: str | None = None) -> int:
    """The next version: new rows replace those of their keys, the last by seq of several; buckets without new keys keep their files.

    Rows without a key are added and replace none.
    """
    spark, version = new.sparkSession, current(new.sparkSession, folder)
    before = manifest(spark, folder, version).collect()
    buckets = len(before)
    touched = sorted(r["b"] for r in new.select(_bucket(key, buckets).alias("b")).distinct().collect())  # one row a bucket
    old = read(spark, folder, version, touched)
    if seq is not None:
        w = Window.partitionBy(key).orderBy(F.desc(seq))
        new = new.withColumn("_n", F.row_number().over(w)).where(F.col(key).isNull() | (F.col("_n") == 1)).drop("_n")
    merged = old.join(new.select(key).distinct(), key, "left_anti").unionByName(new.select(*old.columns))
    _commit(merged, folder, key, version + 1, touched, before, buckets)
    return version + 1


def drop_stale(keys: DataFrame, folder: str, key: str) -> int:
    """The next version, without the rows whose key isn't among keys; buckets without such rows keep their files, and keys alone are read of them."""
    spark, version = keys.sparkSession, current(keys.sparkSession, folder)
    before = manifest(spark, folder, version).collect()
    buckets, wanted = len(before), keys.select(key).distinct()
    stale = read(spark, folder, version).select(key).join(wanted, key, "left_anti")
    touched = sorted(r["b"] for r in stale.select(_bucket(key, buckets).alias("b")).distinct().collect())
    left = read(spark, folder, version, touched).join(wanted, key, "left_semi")
    _commit(left, folder, key, version + 1, touched, before, buckets)
    return version + 1
