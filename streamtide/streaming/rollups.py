"""Minute rollups of streams.

Two forms. The windowed form keeps state and emits a minute once, when the
watermark has passed it; later rows are dropped. The partial form keeps no
state: every micro-batch appends its own sums, and the reader merges them, so
late rows count whenever they arrive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamtide import schemas
from streamtide.operators import rollups
from streamtide.streaming.chat import LATENESS


def chat_windows(chat: DataFrame, width: str = "1 minute", lateness: str = LATENESS) -> DataFrame:
    """Sentiment counts per channel and closed window."""
    rows = (
        chat.withWatermark("ts", lateness)
        .groupBy(F.window("ts", width), F.col("channel").alias("name"))
        .agg(*rollups.sentiment_sums())
    )
    return _flat(rows, "positive", "negative", "neutral")


def viewer_windows(
    samples: DataFrame, width: str = "1 minute", lateness: str = LATENESS
) -> DataFrame:
    """Viewer sums and means per stream and closed window (T4, T5)."""
    rows = (
        samples.withWatermark("created", lateness)
        .groupBy(F.window("created", width), "name")
        .agg(*rollups.viewer_sums())
        .withColumn("viewers", rollups.viewer_mean())
    )
    return _flat(rows, "viewers_sum", "viewers_cnt", "viewers")


def _flat(rows: DataFrame, *values: str) -> DataFrame:
    return rows.select(
        "name", F.to_date("window.start").alias("day"), F.col("window.start").alias("minute"),
        *values,
    )


def write_partials(
    rows: DataFrame,
    rollup: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    until_done: bool = True,
    every: str = "10 minutes",
) -> StreamingQuery:
    """Per micro-batch: the batch rollup of its rows into ``query=<id>/batch=<id>``.

    A batch that is run again after a failure replaces its own folder, so the
    table holds every row exactly once; a new checkpoint is another query and
    leaves the older folders alone. ``day`` is a folder too, for pruned reads.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"{path}/query={query}/batch={batch_id}"
        rollup(batch).write.partitionBy("day").mode("overwrite").parquet(folder)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if until_done else writer.trigger(
        processingTime=every
    )
    return writer.start()


def complete(partials: DataFrame, windows: DataFrame) -> DataFrame:
    """All minutes, with whether their window was ``closed``.

    ``partials`` are the merged partial sums of the same stream and exact: they
    have the minutes that a stopped run left open and the rows that came too
    late for a closed window, so nothing a window drops is lost or uncounted.
    """
    emitted = windows.select("name", "minute", F.lit(True).alias("closed"))
    rows = partials.join(emitted, ["name", "minute"], "left")
    return rows.withColumn("closed", F.coalesce("closed", F.lit(False)))


def read_chat_partials(spark: SparkSession, path: str) -> DataFrame:
    """Chat minutes merged over all micro-batches."""
    return rollups.merge_chat(spark.read.schema(schemas.CHAT_PARTIAL).parquet(path))


def read_viewer_partials(spark: SparkSession, path: str) -> DataFrame:
    """Viewer minutes merged over all micro-batches."""
    return rollups.merge_viewers(spark.read.schema(schemas.VIEWER_PARTIAL).parquet(path))
