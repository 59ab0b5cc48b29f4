"""Scans of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtide import schemas


def read_stream_day(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The wide table, optionally only some of its nested columns."""
    table = spark.read.schema(schemas.STREAM_DAY).parquet(path)
    return table.select("name", "day", "run_ts", "part", *columns) if columns else table


def read_run(spark: SparkSession, path: str, run: str, schema: str) -> DataFrame:
    """The rows of one run; no other folder is listed."""
    return spark.read.schema(schema).parquet(f"{path}/run={run}")


def read_runs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All runs with their ``run`` stamp, a column that prunes the folders."""
    return spark.read.schema(f"{schema}, run string").parquet(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """The observation log with its ``day``, which prunes the folders (K2)."""
    return spark.read.schema(schemas.WEATHER_LOG).parquet(path)


def prefix_scan(table: DataFrame, name: str, day: str) -> DataFrame:
    """All rows of one stream (case-insensitive argument) and one day.

    On a table partitioned by ``day`` only that day's folder is read.
    """
    return table.where(
        (F.col("name") == F.lower(F.lit(name))) & (F.col("day") == F.lit(day).cast("date"))
    )


def key_prefix_scan(table: DataFrame, key: str, prefix: str | Column) -> DataFrame:
    """The literal form over a single text key; pushed to Parquet as a prefix filter."""
    return table.where(F.col(key).startswith(prefix))
