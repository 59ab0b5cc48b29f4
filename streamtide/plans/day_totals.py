"""Day totals kept up to date by arrivals.

Each arrival adds its minute sums to a table by day and arrival; sums and counts merge, so a
minute may come in parts. Then only the days that it touched are added up again, from their own
folders, and replaced in the table of totals. An arrival that is written again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtide.operators import rollups
from streamtide.sinks import tables as sinks

COUNTS = ["viewers_sum", "viewers_cnt", "positive", "negative", "neutral"]
MINUTES = f"name string, minute timestamp, {', '.join(f'{c} long' for c in COUNTS)}, day date, arrival string"
TOTALS = "name string, viewers double, positive long, negative long, neutral long, day date"


def minute_parts(viewers: DataFrame, chat: DataFrame) -> DataFrame:
    """Viewer and chat minutes as rows of one shape; each has values of its own only."""
    none = F.lit(None).cast("long")

    def shaped(rows: DataFrame) -> DataFrame:
        return rows.select("name", "minute", *[F.col(c) if c in rows.columns else none.alias(c) for c in COUNTS], "day")

    return shaped(viewers).unionByName(shaped(chat)).where("name is not null and day is not null")


def totals_of(minutes: DataFrame) -> DataFrame:
    """Mean viewers over the minutes, and sentiment sums, per stream and day."""
    merged = minutes.groupBy("name", "day", "minute").agg(*[F.sum(c).alias(c) for c in COUNTS])
    return merged.groupBy("name", "day").agg(
        F.avg(rollups.viewer_mean()).alias("viewers"), *[F.sum(c).alias(c) for c in ("positive", "negative", "neutral")])


def minutes_of(spark: SparkSession, root: str, days: list) -> DataFrame:
    """The stored minutes of some days; only their folders are read."""
    return spark.read.schema(MINUTES).parquet(f"{root}/minutes").where(F.col("day").isin(*days))


def add(spark: SparkSession, root: str, arrival: str, viewers: DataFrame, chat: DataFrame) -> list:
    """Takes an arrival in; the days it touched."""
    rows = minute_parts(viewers, chat).withColumn("arrival", F.lit(arrival))
    sinks.replace_partitions(rows, f"{root}/minutes", "day", "arrival")
    own = spark.read.schema(MINUTES).parquet(f"{root}/minutes").where(F.col("arrival") == arrival)
    days = [r["day"] for r in own.select("day").distinct().collect()]  # a row for each day
    if days:
        totals = totals_of(minutes_of(spark, root, days))
        sinks.replace_partitions(totals.select("name", "viewers", "positive", "negative", "neutral", "day"), f"{root}/totals", "day")
    return days


def totals(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(TOTALS).parquet(f"{root}/totals")
