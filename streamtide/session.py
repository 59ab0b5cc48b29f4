"""Session helpers: settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for; most are Spark's defaults and are repeated
# so that a site default cannot silently change a plan. Partition counts are
# left to the submitter: start high and let AQE coalesce.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def apply_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Without that setting it lies below the warehouse, which all executors share
    as well. ``drop_folder`` removes one that is no longer read.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def has_folder(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def drop_folder(spark: SparkSession, path: str) -> bool:
    """Deletes a folder on any file system that Spark reaches; False if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to a scratch folder and read back.

    For a result that is used more than once, or whose size the planner should
    know before it picks a join: a stored table has one, an aggregation only an
    estimate. Files survive the loss of an executor.
    """
    path = scratch_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
