"""Series for charts: unpivot and ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sentiment_series(minutes: DataFrame) -> DataFrame:
    """The three counts of each minute as keyed series."""
    return minutes.select("name", F.col("minute").alias("ts"), "positive", "neutral", "negative") \
        .unpivot(["name", "ts"], ["positive", "neutral", "negative"], "series", "value") \
        .select("name", "series", "ts", F.col("value").cast("double").alias("value"))


def viewer_series(minutes: DataFrame) -> DataFrame:
    return minutes.select(
        "name", F.lit("viewers").alias("series"), F.col("minute").alias("ts"),
        F.col("viewers").alias("value"),
    )


def time_ordered(series: DataFrame) -> DataFrame:
    """O1; the value settles ties between runs."""
    return series.orderBy("name", "series", "ts", "value")


def sorted_files(rows: DataFrame, key: str) -> DataFrame:
    """Each output file sorted by the key as text (O2)."""
    return rows.sortWithinPartitions(F.col(key).cast("string"))


def sort_ignoring_case(rows: DataFrame, field: str, reverse: bool = False) -> DataFrame:
    """O4

    The other columns settle ties, so that rows sharing a frequent value spread
    over several range partitions.
    """
    key = F.lower(F.col(field))
    rest = [c for c, dtype in rows.dtypes if not dtype.startswith("map")]
    return rows.orderBy(key.desc() if reverse else key.asc(), *rest)
