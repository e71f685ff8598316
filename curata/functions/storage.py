"""Where intermediate tables are written: the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; only where that is unset and the master is local (tests), a folder of our own."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="curata-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends there and a lost executor costs nothing."""
    spark, folder = frame.sparkSession, new_folder(frame.sparkSession, name)
    frame.write.partitionBy(*partition_by).parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def estimated_bytes(frame: DataFrame) -> int | None:
    """The optimizer's estimate of a frame's size, from its files'; None where it knows nothing."""
    size = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else None


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the queries that end within are removed with them, where this version of Spark can do so."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "true")
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
