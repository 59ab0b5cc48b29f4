"""The driver's tables in the roles of this package, in Spark and in SQL.

``events`` plays polls, chat, weather, forecast and requests; ``documents``
with ``labels`` plays messages and their scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtide.functions import classes, times

PLACES = ["p0", "p1", "p2", "p3", "p4"]
RUN_TS = "2024-02-01 11:53:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a zoned timestamp; the files hold wall-clock time."""
    return as_events(table(spark, sf_dir, "events"))


def as_events(raw: DataFrame) -> DataFrame:
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def stream_name():
    return F.concat(F.lit("u"), F.col("user_id").cast("string"))


def detail():
    return F.get_json_object("props", "$.k")


def as_samples(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("event_id").alias("channel_id"),
        F.floor(F.col("value") * 100).alias("viewers"),
        F.col("event_type").alias("game"),
        stream_name().alias("name"),
        F.col("props").alias("status"),
        F.col("ts").alias("created"),
        (detail().cast("int") % 2 == 0).alias("mature"),
        detail().cast("double").alias("fps"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_samples(events(spark, sf_dir))


SAMPLES = """samples AS (
  SELECT event_id AS channel_id, CAST(floor(value * 100) AS BIGINT) AS viewers,
         event_type AS game, 'u' || CAST(user_id AS VARCHAR) AS name, props AS status,
         ts AS created, CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0 AS mature,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS fps,
         strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y%m%d%H%M') AS minute
  FROM events)"""


def label_of_type():
    """Score label by event type; clicks have no score, views are neutral."""
    kind = F.col("event_type")
    return (
        F.when(kind.isin("purchase", "signup"), "positive")
        .when(kind == "error", "negative")
        .when(kind == "view", "neutral")
    )


def as_chat(rows: DataFrame) -> DataFrame:
    return rows.select(
        "ts",
        stream_name().alias("channel"),
        F.col("props").alias("msg"),
        classes.sentiment_code(label_of_type()).alias("sentiment"),
    )


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_chat(events(spark, sf_dir))


CHAT = """chat AS (
  SELECT ts, 'u' || CAST(user_id AS VARCHAR) AS name, props AS msg,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 1
              WHEN event_type = 'error' THEN 2 ELSE 0 END AS sentiment,
         strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y%m%d%H%M') AS minute
  FROM events)"""

CHAT_MINUTES = CHAT + """,
chat_minutes AS (
  SELECT name, day, minute,
         CAST(sum(CASE WHEN sentiment = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positive,
         CAST(sum(CASE WHEN sentiment = 2 THEN 1 ELSE 0 END) AS BIGINT) AS negative,
         CAST(sum(CASE WHEN sentiment = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neutral
  FROM chat GROUP BY 1, 2, 3)"""

VIEWER_MINUTES = SAMPLES + """,
viewer_minutes AS (
  SELECT name, day, minute, CAST(sum(viewers) AS BIGINT) AS viewers_sum,
         count(viewers) AS viewers_cnt, avg(viewers) AS viewers
  FROM samples GROUP BY 1, 2, 3)"""


def as_observations(rows: DataFrame) -> DataFrame:
    return rows.select(
        times.hour_key(F.col("ts")).alias("hour_key"),
        place().alias("place"),
        F.col("event_type").alias("main"),
        detail().cast("double").alias("wind"),
        classes.kelvin_to_celsius(F.col("value") + 250).alias("temp"),
        F.col("ts").alias("obs_ts"),
        "event_id",
    )


def place():
    return F.concat(F.lit("p"), (F.col("user_id") % 5).cast("string"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_observations(events(spark, sf_dir))


OBSERVATIONS = """obs AS (
  SELECT strftime(ts, '%Y%m%d%H') AS hour_key, 'p' || CAST(user_id % 5 AS VARCHAR) AS place,
         event_type AS main, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS wind,
         floor(((value + 250) - 273.0::DOUBLE) * 100 + 0.5) / 100 AS temp,
         ts AS obs_ts, event_id
  FROM events),
latest_obs AS (
  SELECT hour_key, place, main, wind, temp, obs_ts, event_id FROM (
    SELECT *, row_number() OVER (
      PARTITION BY hour_key, place ORDER BY obs_ts DESC, event_id DESC) AS rn FROM obs)
  WHERE rn = 1)"""

WEATHER_TEXT = OBSERVATIONS + """,
cells AS (
  SELECT hour_key,
         max(CASE WHEN place = 'p0' THEN main || ' ' || CAST(wind AS VARCHAR) || ' ' || CAST(temp AS VARCHAR) END) AS w0,
         max(CASE WHEN place = 'p1' THEN main || ' ' || CAST(wind AS VARCHAR) || ' ' || CAST(temp AS VARCHAR) END) AS w1,
         max(CASE WHEN place = 'p2' THEN main || ' ' || CAST(wind AS VARCHAR) || ' ' || CAST(temp AS VARCHAR) END) AS w2,
         max(CASE WHEN place = 'p3' THEN main || ' ' || CAST(wind AS VARCHAR) || ' ' || CAST(temp AS VARCHAR) END) AS w3,
         max(CASE WHEN place = 'p4' THEN main || ' ' || CAST(wind AS VARCHAR) || ' ' || CAST(temp AS VARCHAR) END) AS w4
  FROM latest_obs GROUP BY 1),
weather AS (
  SELECT hour_key, w0 || ' ' || w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 AS strict_text,
         concat_ws(' ', w0, w1, w2, w3, w4) AS loose_text FROM cells)"""


def as_forecast(rows: DataFrame, *more: str) -> DataFrame:
    """Three-hour slots; the event id is the position within the document."""
    hour = F.lpad((F.floor(F.hour("ts") / 3) * 3).cast("string"), 2, "0")
    return rows.select(
        place().alias("place"),
        F.col("event_id").alias("pos"),
        F.concat(F.date_format("ts", "yyyy-MM-dd "), hour, F.lit(":00:00")).alias("dt_txt"),
        F.col("event_type").alias("main"),
        detail().cast("double").alias("wind"),
        classes.kelvin_to_celsius(F.col("value") + 250).alias("temp"),
        *more,
    )


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_forecast(events(spark, sf_dir))


FORECAST = """forecast AS (
  SELECT 'p' || CAST(user_id % 5 AS VARCHAR) AS place, event_id AS pos,
         strftime(ts, '%Y-%m-%d ') || lpad(CAST(hour(ts) // 3 * 3 AS VARCHAR), 2, '0')
           || ':00:00' AS dt_txt,
         event_type AS main, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS wind,
         floor(((value + 250) - 273.0::DOUBLE) * 100 + 0.5) / 100 AS temp
  FROM events),
first_slots AS (
  SELECT place, dt_txt, main || ' ' || CAST(wind AS VARCHAR) || ' ' || CAST(temp AS VARCHAR) AS cell
  FROM (SELECT *, row_number() OVER (PARTITION BY place, dt_txt ORDER BY pos) AS rn FROM forecast)
  WHERE rn = 1),
slots AS (
  SELECT dt_txt, concat_ws(' ',
           max(CASE WHEN place = 'p0' THEN cell END), max(CASE WHEN place = 'p1' THEN cell END),
           max(CASE WHEN place = 'p2' THEN cell END), max(CASE WHEN place = 'p3' THEN cell END),
           max(CASE WHEN place = 'p4' THEN cell END)) AS weather
  FROM first_slots GROUP BY 1)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction request per event; views ask for an unknown daytime."""
    ts = F.col("ts")
    known = classes.daytime_label(classes.daytime_class(ts))
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        stream_name().alias("name"),
        F.col("event_type").alias("game"),
        F.floor("value").cast("double").alias("duration"),
        F.when(F.col("event_type") != "view", known).otherwise("irgendwann").alias("daytime"),
        detail().cast("double").alias("fps"),
        ts.alias("day"),
    )


REQUESTS = """requests AS (
  SELECT event_id AS id, 'u' || CAST(user_id AS VARCHAR) AS name, event_type AS game,
         floor(value) AS dur,
         CASE WHEN event_type = 'view' THEN 'irgendwann'
              WHEN hour(ts) < 6 OR hour(ts) >= 22 THEN 'Nachts' WHEN hour(ts) < 12 THEN 'Morgens'
              WHEN hour(ts) < 15 THEN 'Mittags' WHEN hour(ts) < 18 THEN 'Nachmittags'
              ELSE 'Abends' END AS daytime,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS fps, ts AS day
  FROM events),
slotted AS (
  SELECT *, strftime(day, '%Y-%m-%d ') || CASE daytime
           WHEN 'Morgens' THEN '06' WHEN 'Mittags' THEN '12' WHEN 'Nachmittags' THEN '15'
           WHEN 'Abends' THEN '18' WHEN 'Nachts' THEN '21' ELSE '12' END || ':00:00' AS dt_txt
  FROM requests)"""


def day_text(column: str = "day"):
    return F.date_format(column, "yyyyMMdd")


def six_digits(name: str):
    return F.round(F.col(name), 6).alias(name)
