"""Minute tables, sessions, latest values, discovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamtide.functions import classes, text, times
from streamtide.operators import joins, quality, rollups, series
from streamtide.plans import catalogue, discovery, ingest
from streamtide.session import scratch_folder
from streamtide.sinks import tables as sinks
from workload import roles
from workload.registry import query
from workload.roles import day_text, six_digits


def keyed_minutes(rows, *values):
    return rows.select(
        "name", day_text().alias("day"), times.minute_key(F.col("minute")).alias("minute"), *values
    )


@query("viewers_per_minute", f"""WITH {roles.VIEWER_MINUTES}
SELECT name, day, minute, viewers_sum, viewers_cnt, round(viewers, 6) AS viewers
FROM viewer_minutes""")
def viewers_per_minute(spark, sf_dir):
    minutes = rollups.viewers_per_bucket(roles.samples(spark, sf_dir))
    return keyed_minutes(minutes, "viewers_sum", "viewers_cnt", six_digits("viewers"))


@query("viewers_per_hour", f"""WITH {roles.SAMPLES}
SELECT game, strftime(created, '%Y%m%d%H') AS hour_key, round(avg(viewers), 6) AS viewers,
       CAST(sum(viewers) AS BIGINT) AS viewers_sum, count(viewers) AS viewers_cnt
FROM samples GROUP BY 1, 2""")
def viewers_per_hour(spark, sf_dir):
    hours = rollups.viewers_per_bucket(roles.samples(spark, sf_dir), "1 hour", key="game")
    return hours.select(
        "game", times.hour_key(F.col("minute")).alias("hour_key"), six_digits("viewers"),
        "viewers_sum", "viewers_cnt",
    )


@query("chat_sentiment_per_minute", f"""WITH {roles.CHAT_MINUTES}
SELECT name, day, minute, positive, negative, neutral FROM chat_minutes""")
def chat_sentiment_per_minute(spark, sf_dir):
    minutes = rollups.chat_per_bucket(roles.chat(spark, sf_dir))
    return keyed_minutes(minutes, "positive", "negative", "neutral")


@query("chat_sentiment_per_day", f"""WITH {roles.CHAT_MINUTES}
SELECT name, day, CAST(sum(positive) AS BIGINT) AS positive,
       CAST(sum(negative) AS BIGINT) AS negative, CAST(sum(neutral) AS BIGINT) AS neutral
FROM chat_minutes GROUP BY 1, 2""")
def chat_sentiment_per_day(spark, sf_dir):
    days = rollups.chat_per_bucket(roles.chat(spark, sf_dir), "1 day")
    return days.select("name", day_text().alias("day"), "positive", "negative", "neutral")


SESSIONS = """sessions AS (
  SELECT {batch} name, game, avg(viewers) AS viewers, avg(fps) AS fps,
         min(created) AS starttime, count(*) AS polls,
         floor((epoch_us(max(created)) - epoch_us(min(created))) / 1000000) / 60.0::DOUBLE AS dur,
         CASE WHEN hour(min(created)) < 6 THEN 1 WHEN hour(min(created)) < 12 THEN 2
              WHEN hour(min(created)) < 15 THEN 3 WHEN hour(min(created)) < 18 THEN 4
              WHEN hour(min(created)) < 22 THEN 5 ELSE 1 END AS daytime
  FROM samples WHERE fps IS NOT NULL AND viewers > 500 GROUP BY {batch} name, game)"""


@query("session_summary", f"""WITH {roles.SAMPLES}, {SESSIONS.format(batch='')}
SELECT name, game, round(viewers, 6) AS viewers, round(fps, 6) AS fps, round(dur, 6) AS dur,
       CAST(daytime AS BIGINT) AS daytime, strftime(starttime, '%Y%m%d%H%M%S') AS starttime, polls
FROM sessions""")
def session_summary(spark, sf_dir):
    return _session_columns(ingest.sessions_of(roles.samples(spark, sf_dir)))


def _session_columns(rows):
    return rows.select(
        "name", "game", six_digits("viewers"), six_digits("fps"), six_digits("dur"),
        F.col("daytime").cast("long").alias("daytime"),
        F.date_format("starttime", "yyyyMMddHHmmss").alias("starttime"),
        *[c for c in rows.columns if c == "polls"],
    )


def daily_sessions(spark, sf_dir):
    """One batch of sessions per day."""
    polls = roles.samples(spark, sf_dir).withColumn("day", F.to_date("created"))
    return ingest.sessions_of(polls, batch=["day"])


DAILY_SESSIONS = f"{roles.SAMPLES}, {SESSIONS.format(batch='day,')}"

MERGED_SESSIONS = DAILY_SESSIONS + """,
merged AS (
  SELECT name, game, sum(dur) AS dur, min(daytime) AS daytime, avg(fps) AS fps,
         avg(viewers) AS viewers, min(starttime) AS starttime
  FROM sessions GROUP BY 1, 2)"""


@query("session_reaggregate", f"""WITH {MERGED_SESSIONS}
SELECT name, game, round(viewers, 6) AS viewers, round(fps, 6) AS fps, round(dur, 6) AS dur,
       CAST(daytime AS BIGINT) AS daytime, strftime(starttime, '%Y%m%d%H%M%S') AS starttime
FROM merged""")
def session_reaggregate(spark, sf_dir):
    return _session_columns(rollups.reaggregate_sessions(daily_sessions(spark, sf_dir)))


@query("session_reaggregate_weighted", f"""WITH {roles.SAMPLES}, days AS (
  SELECT day, name, game, min(created) AS starttime, max(created) AS endtime,
         sum(viewers) AS viewers_sum, sum(fps) AS fps_sum, count(*) AS polls
  FROM samples WHERE fps IS NOT NULL AND viewers > 500 GROUP BY 1, 2, 3)
SELECT name, game,
       round(CAST(sum(viewers_sum) AS DOUBLE) / CAST(sum(polls) AS DOUBLE), 6) AS viewers,
       round(CAST(sum(fps_sum) AS DOUBLE) / CAST(sum(polls) AS DOUBLE), 6) AS fps,
       round(sum(floor((epoch_us(endtime) - epoch_us(starttime)) / 1000000) / 60.0::DOUBLE), 6) AS dur,
       CAST(min(CASE WHEN hour(starttime) < 6 OR hour(starttime) >= 22 THEN 1
                     WHEN hour(starttime) < 12 THEN 2 WHEN hour(starttime) < 15 THEN 3
                     WHEN hour(starttime) < 18 THEN 4 ELSE 5 END) AS BIGINT) AS daytime,
       strftime(min(starttime), '%Y%m%d%H%M%S') AS starttime
FROM days GROUP BY 1, 2""")
def session_reaggregate_weighted(spark, sf_dir):
    sessions = daily_sessions(spark, sf_dir)
    return _session_columns(rollups.reaggregate_sessions(sessions, weight="polls"))


@query("merge_partials", f"""WITH {roles.VIEWER_MINUTES}
SELECT name, day, minute, viewers_sum, viewers_cnt, round(viewers, 6) AS viewers
FROM viewer_minutes""")
def merge_partials(spark, sf_dir):
    """Two runs that split every minute between them, merged by sum and count."""
    polls = roles.samples(spark, sf_dir)
    first, second = quality.split_valid(polls, F.col("mature"))
    parts = rollups.viewers_per_bucket(first).unionByName(rollups.viewers_per_bucket(second))
    merged = rollups.merge_viewers(parts)
    return keyed_minutes(merged, "viewers_sum", "viewers_cnt", six_digits("viewers"))


@query("weather_latest", f"""WITH {roles.OBSERVATIONS}
SELECT hour_key, place, main, wind, round(temp, 6) AS temp, event_id FROM latest_obs""")
def weather_latest(spark, sf_dir):
    latest = ingest.latest_weather(roles.observations(spark, sf_dir), "event_id")
    return latest.select("hour_key", "place", "main", "wind", six_digits("temp"), "event_id")


@query("latest_per_stream", f"""WITH {roles.SAMPLES}
SELECT name, game, status, viewers, strftime(created, '%Y%m%d%H%M%S') AS created
FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY created DESC, channel_id DESC) AS rn
      FROM samples) WHERE rn = 1""")
def latest_per_stream(spark, sf_dir):
    polls = roles.samples(spark, sf_dir)
    latest = rollups.latest_per_key(polls, ["name"], ["created", "channel_id"])
    return latest.select(
        "name", "game", "status", "viewers",
        F.date_format("created", "yyyyMMddHHmmss").alias("created"),
    )


@query("newest_batch", f"""WITH {roles.SAMPLES}
SELECT channel_id, name, viewers FROM samples WHERE day = (SELECT max(day) FROM samples)""")
def newest_batch(spark, sf_dir):
    """A run for each day; the catalogue names the newest, and only that is scanned (O3)."""
    root = scratch_folder(spark, "polls")
    polls = roles.samples(spark, sf_dir).withColumn("run", F.date_format("created", "yyyy-MM-dd'T'00-00-00"))
    sinks.replace_partitions(polls, f"{root}/samples", "run")
    runs = catalogue.Catalogue(f"{root}/manifest")
    for r in polls.select("run").distinct().collect():  # a row for each run
        runs.record(spark, "samples", r["run"], f"{root}/samples/run={r['run']}", r["run"])
    table = spark.read.schema(polls.schema).parquet(f"{root}/samples")
    return rollups.newest_batch(table, "run", runs.newest(spark, "samples")).select("channel_id", "name", "viewers")


ACTIVE = """last_day AS (SELECT max(CAST(created AS DATE)) AS d FROM samples),
active AS (
  SELECT name FROM samples, last_day
  WHERE game = 'purchase' AND CAST(created AS DATE) >= d - INTERVAL 7 DAY
    AND CAST(created AS DATE) < d),
latest AS (
  SELECT DISTINCT name FROM samples, last_day WHERE CAST(created AS DATE) = d)"""


def _tracked(spark, sf_dir):
    """All polls by day, and the streams with a purchase in the week before the last day."""
    polls = roles.samples(spark, sf_dir).withColumn("day", F.to_date("created"))
    last = polls.agg(F.max("day")).scalar()
    active = polls.where(
        (F.col("game") == "purchase")
        & (F.col("day") >= F.date_sub(last, 7)) & (F.col("day") < last)
    )
    return polls, active


@query("new_users", f"""WITH {roles.SAMPLES}, {ACTIVE}
SELECT name FROM latest WHERE NOT EXISTS (SELECT 1 FROM active WHERE active.name = latest.name)""")
def new_users(spark, sf_dir):
    polls, active = _tracked(spark, sf_dir)
    return discovery.new_channels(polls, active, batch="day")


@query("known_users", f"""WITH {roles.SAMPLES}, {ACTIVE}
SELECT name FROM latest WHERE EXISTS (SELECT 1 FROM active WHERE active.name = latest.name)""")
def known_users(spark, sf_dir):
    polls, active = _tracked(spark, sf_dir)
    return joins.known_names(rollups.newest_batch(polls, "day"), active)


@query("allowed_channels", f"""WITH {roles.CHAT}
SELECT name, count(*) AS messages FROM chat WHERE name IN ('u7', 'u42') GROUP BY 1""")
def allowed_channels(spark, sf_dir):
    kept = quality.only_channels(roles.chat(spark, sf_dir), ["u7", "u42"])
    return kept.groupBy(F.col("channel").alias("name")).agg(F.count("*").alias("messages"))


@query("document_sentiment", """
SELECT d.doc_id, d.lang AS channel,
       CAST(CASE WHEN l.toxic = 1 THEN 2 WHEN l.quality = 1 THEN 1 ELSE 0 END AS BIGINT) AS sentiment
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def document_sentiment(spark, sf_dir):
    messages = roles.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("msg_id"), F.col("lang").alias("channel")
    )
    scored = joins.attach_sentiment(messages, document_scores(spark, sf_dir))
    return scored.select(
        F.col("msg_id").alias("doc_id"), "channel",
        F.col("sentiment").cast("long").alias("sentiment"),
    )


def document_scores(spark, sf_dir):
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
    return roles.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("msg_id"), label.otherwise("neutral").alias("label")
    )


@query("sentiment_by_source", """
SELECT d.source AS name,
       CAST(sum(CASE WHEN l.toxic IS DISTINCT FROM 1 AND l.quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positive,
       CAST(sum(CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS negative,
       CAST(sum(CASE WHEN l.toxic IS DISTINCT FROM 1 AND l.quality IS DISTINCT FROM 1 THEN 1 ELSE 0 END)
            AS BIGINT) AS neutral
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""")
def sentiment_by_source(spark, sf_dir):
    messages = roles.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("msg_id"), F.col("source").alias("channel")
    )
    scored = joins.attach_sentiment(messages, document_scores(spark, sf_dir))
    return scored.groupBy(F.col("channel").alias("name")).agg(*rollups.sentiment_sums())


@query("sentiment_series", f"""WITH {roles.CHAT_MINUTES}
SELECT name, minute AS ts, 'positive' AS series, CAST(positive AS DOUBLE) AS value FROM chat_minutes
UNION ALL SELECT name, minute, 'neutral', CAST(neutral AS DOUBLE) FROM chat_minutes
UNION ALL SELECT name, minute, 'negative', CAST(negative AS DOUBLE) FROM chat_minutes""")
def sentiment_series(spark, sf_dir):
    rows = series.sentiment_series(rollups.chat_per_bucket(roles.chat(spark, sf_dir)))
    return rows.withColumn("ts", times.minute_key(F.col("ts")))


@query("sorted_output", f"""WITH {roles.VIEWER_MINUTES}
SELECT name, 'viewers' AS series, minute AS ts, round(viewers, 6) AS value FROM viewer_minutes""")
def sorted_output(spark, sf_dir):
    minutes = rollups.viewers_per_bucket(roles.samples(spark, sf_dir))
    rows = series.time_ordered(series.viewer_series(minutes))
    return rows.select(
        "name", "series", times.minute_key(F.col("ts")).alias("ts"), six_digits("value")
    )


@query("sort_ci", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sort_ci(spark, sf_dir):
    customers = roles.table(spark, sf_dir, "customer")
    rows = series.sort_ignoring_case(customers, "c_name", reverse=True)
    return rows.select("c_custkey", "c_name", "c_mktsegment")


@query("viewer_class", f"""WITH {roles.SAMPLES}, classed AS (
  SELECT channel_id, CAST(floor(viewers / 1000.0::DOUBLE + 0.5) AS BIGINT) AS viewer_class,
         CAST(floor(viewers / 1000.0::DOUBLE) AS BIGINT) AS floor_class FROM samples)
SELECT channel_id, viewer_class, floor_class,
       CAST(greatest(viewer_class * 1000 - 500, 0) AS VARCHAR) || ' bis '
         || CAST(viewer_class * 1000 + 500 AS VARCHAR) AS range_text,
       CAST(floor_class * 1000 AS VARCHAR) || ' bis '
         || CAST((floor_class + 1) * 1000 AS VARCHAR) AS floor_text
FROM classed""")
def viewer_class(spark, sf_dir):
    rounded = classes.viewer_class(F.col("viewers"))
    floored = classes.viewer_class(F.col("viewers"), "floor")
    return roles.samples(spark, sf_dir).select(
        "channel_id",
        rounded.cast("long").alias("viewer_class"),
        floored.cast("long").alias("floor_class"),
        classes.range_text(rounded).alias("range_text"),
        classes.range_text(floored, "floor").alias("floor_text"),
    )


@query("rated_samples", f"""WITH {roles.SAMPLES}
SELECT channel_id, name, game, viewers, fps FROM samples WHERE fps IS NOT NULL AND viewers > 500""")
def rated_samples(spark, sf_dir):
    rows = quality.rated_samples(roles.samples(spark, sf_dir))
    return rows.select("channel_id", "name", "game", "viewers", "fps")


@query("clean_session_names", f"""WITH {roles.SAMPLES}
SELECT regexp_replace(status, '[ ,]', '_', 'g') AS token, count(*) AS polls
FROM samples GROUP BY 1""")
def clean_session_names(spark, sf_dir):
    rows = roles.samples(spark, sf_dir)
    return rows.groupBy(text.clean_name(F.col("status")).alias("token")).agg(
        F.count("*").alias("polls")
    )
