"""Minutes as an upsert stream: a late row corrects its minute.

State holds the sums of a stream and minute while rows come in. Every micro-batch that has rows
for a minute emits its sums as a new version. The state is kept by spans of arrival time: when
one is over, its minutes leave the state; a row that comes still later opens the minute again,
under a new opening. Reading takes the last version of each opening and adds the openings up, so
no row is lost or counted twice however late it is, and the state only holds minutes that have
had rows of late.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtide.functions import classes, times

OUT = "name string, minute timestamp, opening long, version long, positive long, negative long, neutral long"
SUMS = ("positive", "negative", "neutral")


def chat_corrections(chat: DataFrame, keep_ms: int = 3_600_000) -> DataFrame:
    """Versions of each channel and minute (OUT), for an update sink.

    ``keep_ms``: how long a span of arrival time is, and so how long a minute without rows stays
    in the state at most; the first span begins now. An opening is named by the begin of its span,
    a version by the rows that it has. The watermark is on the time at which rows come in, not on
    their own: none is ever too late, and the state is still closed as time goes on.
    """
    codes = {"positive": 1, "negative": 2, "neutral": 0}  # those of ``rollups.sentiment_sums``
    rows = chat.select(
        F.col("channel").alias("name"), times.bucket_start(F.col("ts"), "1 minute").alias("minute"),
        F.current_timestamp().alias("seen"), *[classes.indicator(F.col("sentiment") == code).alias(c) for c, code in codes.items()])
    now = int(time.time() * 1000)
    span = F.window("seen", f"{keep_ms} milliseconds", startTime=f"{now % keep_ms} milliseconds")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS]
    openings = rows.withWatermark("seen", "0 seconds").groupBy("name", "minute", span).agg(F.count("*").alias("version"), *sums)
    return openings.select("name", "minute", F.unix_millis("window.start").alias("opening"), "version", *SUMS)


def last_versions(versions: DataFrame) -> DataFrame:
    """One row per channel and minute out of all versions."""
    last = F.max_by(F.struct(*SUMS), "version").alias("last")
    openings = versions.groupBy("name", "minute", "opening").agg(last)
    rows = openings.groupBy("name", "minute").agg(*[F.sum(f"last.{c}").alias(c) for c in SUMS])
    return rows.withColumn("day", F.to_date("minute"))
