"""Streaming jobs over the events table; each works off what has landed and stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamtide.operators import rollups
from streamtide.plans import ingest
from streamtide.session import scratch_folder
from streamtide.streaming import chat as chat_jobs
from streamtide.streaming import corrections
from streamtide.streaming import rollups as stream_rollups
from workload import roles
from workload.registry import query
from workload.roles import six_digits
from workload.rollups import keyed_minutes


def event_stream(spark, sf_dir):
    """The events file, or folder of files, as a stream; a glob allows both."""
    schema = roles.table(spark, sf_dir, "events").schema
    rows = chat_jobs.file_stream(spark, f"{sf_dir}/events.parquet*", schema, fmt="parquet")
    return roles.as_events(rows)


@query("stream_sentiment", f"""WITH {roles.CHAT_MINUTES}
SELECT name, day, minute, positive, negative, neutral FROM chat_minutes""")
def stream_sentiment(spark, sf_dir):
    """Partial sums per micro-batch, merged when read."""
    root = scratch_folder(spark, "sentiment")
    stream_rollups.write_partials(
        roles.as_chat(event_stream(spark, sf_dir)), rollups.chat_per_bucket,
        f"{root}/table", f"{root}/checkpoint",
    ).awaitTermination()
    rows = stream_rollups.read_chat_partials(spark, f"{root}/table")
    return keyed_minutes(rows, "positive", "negative", "neutral")


@query("stream_viewers", f"""WITH {roles.VIEWER_MINUTES}
SELECT name, day, minute, viewers_sum, viewers_cnt, round(viewers, 6) AS viewers
FROM viewer_minutes""")
def stream_viewers(spark, sf_dir):
    """Partial sums per micro-batch, merged when read."""
    root = scratch_folder(spark, "viewers")
    stream_rollups.write_partials(
        roles.as_samples(event_stream(spark, sf_dir)), rollups.viewers_per_bucket,
        f"{root}/table", f"{root}/checkpoint",
    ).awaitTermination()
    rows = stream_rollups.read_viewer_partials(spark, f"{root}/table")
    return keyed_minutes(rows, "viewers_sum", "viewers_cnt", six_digits("viewers"))


#: A window is closed when the watermark, 20 minutes behind the latest row, has passed its end.
CLOSED = """closed AS (
  SELECT strftime(date_trunc('millisecond', max(ts)) - INTERVAL 21 MINUTE, '%Y%m%d%H%M') AS last_minute
  FROM events)"""


def closed_and_open(spark, rows, window, rollup, read):
    """The windowed and the partial form of one stream, put together."""
    root = scratch_folder(spark, "windows")
    windows = window(rows)
    chat_jobs.write_rolled(
        windows, f"{root}/table", f"{root}/checkpoint", until_done=True
    ).awaitTermination()
    stream_rollups.write_partials(
        rows, rollup, f"{root}/partials", f"{root}/partials_checkpoint"
    ).awaitTermination()
    emitted = spark.read.schema(windows.schema).parquet(f"{root}/table")
    return stream_rollups.complete(read(spark, f"{root}/partials"), emitted)


@query("stream_sentiment_windows", f"""WITH {roles.CHAT_MINUTES}, {CLOSED}
SELECT name, day, minute, positive, negative, neutral, minute <= last_minute AS closed
FROM chat_minutes, closed""")
def stream_sentiment_windows(spark, sf_dir):
    """All minutes, closed by the watermark or still open."""
    rows = closed_and_open(
        spark, roles.as_chat(event_stream(spark, sf_dir)), stream_rollups.chat_windows,
        rollups.chat_per_bucket, stream_rollups.read_chat_partials,
    )
    return keyed_minutes(rows, "positive", "negative", "neutral", "closed")


@query("stream_viewer_windows", f"""WITH {roles.VIEWER_MINUTES}, {CLOSED}
SELECT name, day, minute, viewers_sum, viewers_cnt, round(viewers, 6) AS viewers,
       minute <= last_minute AS closed
FROM viewer_minutes, closed""")
def stream_viewer_windows(spark, sf_dir):
    """All minutes, closed by the watermark or still open."""
    rows = closed_and_open(
        spark, roles.as_samples(event_stream(spark, sf_dir)), stream_rollups.viewer_windows,
        rollups.viewers_per_bucket, stream_rollups.read_viewer_partials,
    )
    return keyed_minutes(rows, "viewers_sum", "viewers_cnt", six_digits("viewers"), "closed")


@query("stream_archived_files", f"""WITH {roles.CHAT}
SELECT name AS channel, count(*) AS messages FROM chat GROUP BY 1""")
def stream_archived_files(spark, sf_dir):
    """Four landed files, one per micro-batch, moved to the archive once done."""
    root = scratch_folder(spark, "landing")
    roles.chat(spark, sf_dir).repartition(4).write.parquet(f"{root}/landing")
    rows = chat_jobs.file_stream(
        spark, f"{root}/landing", "ts timestamp, channel string, msg string, sentiment int", fmt="parquet",
        max_files=1, archive=f"{root}/archive",
    )
    for _ in range(2):  # the second run finds nothing new
        chat_jobs.write_rolled(
            rows, f"{root}/table", f"{root}/checkpoint", until_done=True
        ).awaitTermination()
    table = spark.read.schema(rows.schema).parquet(f"{root}/table")
    return table.groupBy("channel").agg(F.count("*").alias("messages"))


@query("stream_observations", f"""WITH {roles.OBSERVATIONS}
SELECT hour_key, place, main, wind, round(temp, 6) AS temp, event_id FROM latest_obs""")
def stream_observations(spark, sf_dir):
    """Observations appended by a stream; the latest resolved when read."""
    root = scratch_folder(spark, "observations")
    obs = roles.as_observations(event_stream(spark, sf_dir))
    chat_jobs.write_rolled(
        obs, f"{root}/table", f"{root}/checkpoint", until_done=True
    ).awaitTermination()
    latest = ingest.latest_weather(spark.read.parquet(f"{root}/table"), "event_id")
    return latest.select("hour_key", "place", "main", "wind", six_digits("temp"), "event_id")


@query("stream_ingest", f"""WITH {roles.CHAT}
SELECT name AS channel, msg, CAST(sentiment AS BIGINT) AS sentiment, epoch_us(ts) AS ts_us FROM chat""")
def stream_ingest(spark, sf_dir):
    """Chat rows from the landing folder to rolled files."""
    root = scratch_folder(spark, "ingest")
    chat_jobs.write_rolled(
        roles.as_chat(event_stream(spark, sf_dir)), f"{root}/table", f"{root}/checkpoint",
        until_done=True,
    ).awaitTermination()
    return spark.read.parquet(f"{root}/table").select(
        "channel", "msg", F.col("sentiment").cast("long").alias("sentiment"),
        F.unix_micros("ts").alias("ts_us"),
    )


@query("stream_bounded", f"""WITH {roles.CHAT}
SELECT name AS channel, msg, CAST(sentiment AS BIGINT) AS sentiment, epoch_us(ts) AS ts_us, FALSE AS too_many FROM chat""")
def stream_bounded(spark, sf_dir):
    """Chat in micro-batches of a bounded number of records, in lanes side by side and in two runs
    (S13, T1, T7); with each row whether its batch had more."""
    root = scratch_folder(spark, "bounded")
    limit = 4 * chat_jobs.MAX_RECORDS

    def writer(lane, rows):
        def write(batch, batch_id):
            batch.coalesce(1).write.mode("overwrite").parquet(f"{root}/table/lane={lane}/batch={batch_id}")

        return rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint-{lane}")

    for _ in range(2):  # the second run finds nothing new
        lanes = chat_jobs.buffered_lanes(
            spark, roles.as_chat(event_stream(spark, sf_dir)), f"{root}/buffer", f"{root}/buffer_checkpoint", max_files=4)
        chat_jobs.work_off([writer(lane, rows) for lane, rows in enumerate(lanes)])
    schema = "ts timestamp, channel string, msg string, sentiment int, lane long, batch long"
    table = spark.read.schema(schema).parquet(f"{root}/table")
    sizes = table.groupBy("lane", "batch").agg((F.count("*") > limit).alias("too_many"))
    return table.join(sizes, ["lane", "batch"]).select(
        "channel", "msg", F.col("sentiment").cast("long").alias("sentiment"), F.unix_micros("ts").alias("ts_us"), "too_many")


@query("stream_corrections", f"""WITH {roles.CHAT_MINUTES}
SELECT name, day, minute, positive, negative, neutral FROM chat_minutes""")
def stream_corrections(spark, sf_dir):
    """Four landed files, one per micro-batch, so that most minutes are corrected by late rows;
    the last version of each minute (T3, T4, T5)."""
    root = scratch_folder(spark, "corrections")
    roles.chat(spark, sf_dir).repartition(4).write.parquet(f"{root}/landing")
    chat = chat_jobs.file_stream(
        spark, f"{root}/landing", "ts timestamp, channel string, msg string, sentiment int", fmt="parquet", max_files=1)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/versions/batch={batch_id}")

    writer = corrections.chat_corrections(chat).writeStream.outputMode("update").foreachBatch(write)
    writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    versions = spark.read.schema(corrections.OUT).parquet(f"{root}/versions")
    return keyed_minutes(corrections.last_versions(versions), "positive", "negative", "neutral")
