"""Aggregations: per minute, per session, per day, latest value.

Everything here is algebraic (sum, count, min, max, max_by), so each task
reduces its own rows before the shuffle and a key that holds a large share of
the input sends one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtide.functions import classes, times


def viewer_sums() -> list[Column]:
    """Mergeable viewer aggregates; also used by the streaming jobs."""
    return [
        F.sum("viewers").alias("viewers_sum"),
        F.count("viewers").alias("viewers_cnt"),
    ]


def viewer_mean() -> Column:
    return F.try_divide("viewers_sum", "viewers_cnt")


def sentiment_sums() -> list[Column]:
    """Positive, negative and neutral counts; also used by the streaming jobs (X11)."""
    code = F.col("sentiment")
    return [
        F.sum(classes.indicator(code == 1)).alias("positive"),
        F.sum(classes.indicator(code == 2)).alias("negative"),
        F.sum(classes.indicator(code == 0)).alias("neutral"),
    ]


def _with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.to_date("minute"))


def viewers_per_bucket(samples: DataFrame, width: str = "1 minute", key: str = "name") -> DataFrame:
    """Mean viewers per stream and minute, with sum and count for exact merging (A1)."""
    rows = samples.groupBy(
        key, times.bucket_start(F.col("created"), width).alias("minute")
    ).agg(*viewer_sums())
    return _with_day(rows).withColumn("viewers", viewer_mean())


def merge_viewers(parts: DataFrame, key: str = "name") -> DataFrame:
    """One row per stream and minute out of partial rows of several runs."""
    rows = parts.groupBy(key, "day", "minute").agg(
        F.sum("viewers_sum").alias("viewers_sum"),
        F.sum("viewers_cnt").alias("viewers_cnt"),
    )
    return rows.withColumn("viewers", viewer_mean())


def chat_per_bucket(chat: DataFrame, width: str = "1 minute") -> DataFrame:
    """Sentiment counts per channel and minute (A2); ``name`` is the channel."""
    rows = chat.groupBy(
        F.col("channel").alias("name"),
        times.bucket_start(F.col("ts"), width).alias("minute"),
    ).agg(*sentiment_sums())
    return _with_day(rows)


def merge_chat(parts: DataFrame) -> DataFrame:
    """One row per channel and minute out of partial rows of several runs."""
    return parts.groupBy("name", "day", "minute").agg(
        *[F.sum(c).alias(c) for c in ("positive", "negative", "neutral")]
    )


def session_summary(samples: DataFrame, *batch: str) -> DataFrame:
    """Sessions per (name, game): means, duration, start, daytime class, polls (A3).

    Extra ``batch`` columns keep the sessions of separate runs apart. Names
    have to be cleaned before, so that equal tokens meet in one group.
    """
    rows = samples.groupBy(*batch, "name", "game").agg(
        F.avg("viewers").alias("viewers"),
        F.avg("fps").alias("fps"),
        F.min("created").alias("starttime"),
        F.max("created").alias("endtime"),
        F.count(F.lit(1)).alias("polls"),
    )
    return rows.select(
        *batch, "name", "game",
        times.minutes_between(F.col("starttime"), F.col("endtime")).alias("dur"),
        classes.daytime_class(F.col("starttime")).alias("daytime"),
        "fps", "viewers", "starttime", "polls",
    )


def reaggregate_sessions(sessions: DataFrame, weight: str | None = None) -> DataFrame:
    """Sessions of many batches per (name, game) (A4).

    Frame rate and viewers are means of the batch means; with ``weight``, the
    column that counts a batch's polls, they are weighted means.
    """
    def mean(name: str) -> Column:
        if weight is None:
            return F.avg(name)
        counted = F.when(F.col(name).isNotNull(), F.col(weight))
        return F.try_divide(F.sum(F.col(name) * F.col(weight)), F.sum(counted))

    return sessions.groupBy("name", "game").agg(
        F.sum("dur").alias("dur"),
        F.min("daytime").alias("daytime"),
        mean("fps").alias("fps"),
        mean("viewers").alias("viewers"),
        F.min("starttime").alias("starttime"),
    )


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key in the order of ``order``.

    The order columns should identify a row within its key; ties between
    different rows are otherwise settled by the engine.
    """
    payload = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*payload), F.struct(*order)).alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, "last.*")


def distinct_names(rows: DataFrame, column: str = "name") -> DataFrame:
    """A8"""
    return rows.select(column).distinct()


def newest_batch(rows: DataFrame, batch: str, newest: str | None = None) -> DataFrame:
    """The rows of the highest ``batch`` value (O3).

    ``newest`` is that value where a catalogue has it (``plans.catalogue``): the data is then
    scanned once, and only that batch. Else the maximum is a scalar subquery, which reads the
    column of all rows first and filters the scan with the result.
    """
    if newest is not None:
        return rows.where(F.col(batch) == F.lit(newest))
    return rows.where(F.col(batch) == rows.agg(F.max(batch)).scalar())
