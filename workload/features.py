"""Column functions and the feature text."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamtide.functions import classes, text, times
from streamtide.operators import joins, rollups
from streamtide.plans import ingest, training
from streamtide.session import stored
from workload import roles
from workload.registry import query
from workload.roles import six_digits
from workload.rollups import MERGED_SESSIONS, daily_sessions


@query("clean_names", r"""
SELECT conv_id, turn, regexp_replace(text, '[ ,]', '_', 'g') AS cleaned,
       replace(text, ',', ' ') AS blanks, replace(text, ',', ';') AS message,
       replace(replace(text, ';', ''), '#', '') AS stripped,
       string_split(text, ',')[1] AS first_field, string_split(text, ',')[2] AS second_field,
       CAST(regexp_full_match(text, '.*[0-9].*') AS INTEGER) AS one_line_with_digit
FROM conversations""")
def clean_names(spark, sf_dir):
    body = F.col("text")
    first, second = text.fields(body, ",", 2)
    return roles.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        text.clean_name(body).alias("cleaned"),
        text.commas_to_blanks(body).alias("blanks"),
        text.message_text(body).alias("message"),
        text.channel_name(text.strip_separator(body)).alias("stripped"),
        first.alias("first_field"),
        second.alias("second_field"),
        text.full_match(body, ".*[0-9].*").cast("int").alias("one_line_with_digit"),
    )


@query("cut_text", """WITH heads AS (
  SELECT doc_id, text, substr(text, 1, 80) AS head FROM documents), words AS (
  SELECT *, instr(reverse(head), ' ') AS back FROM heads)
SELECT doc_id,
       CASE WHEN length(text) > 80 THEN head || ' …' ELSE text END AS plain,
       CASE WHEN length(text) <= 80 THEN text
            WHEN back = 0 THEN head || ' …'
            ELSE substr(head, 1, 80 - back) || ' …' END AS wordwise
FROM words""")
def cut_text(spark, sf_dir):
    body = F.col("text")
    return roles.table(spark, sf_dir, "documents").select(
        "doc_id",
        text.cut_text(body, 80).alias("plain"),
        text.cut_text(body, 80, wordwise=True).alias("wordwise"),
    )


@query("hours_to_time", """WITH m AS (
  SELECT event_id, CAST(floor(value) * 60 + floor((value - floor(value)) * 60 + 0.5) AS BIGINT) AS m
  FROM events)
SELECT event_id,
       CASE WHEN m // 60 < 10 THEN '0' ELSE '' END || CAST(m // 60 AS VARCHAR) || ':'
         || lpad(CAST(m % 60 AS VARCHAR), 2, '0') AS clock
FROM m""")
def hours_to_time(spark, sf_dir):
    return roles.table(spark, sf_dir, "events").select(
        "event_id", text.hours_to_time(F.col("value")).alias("clock")
    )


@query("kelvin_to_celsius", """
SELECT event_id, floor((value + 250 - 273.0::DOUBLE) * 100 + 0.5) / 100 AS celsius,
       floor((value + 250 - 273.15::DOUBLE) * 100 + 0.5) / 100 AS exact_celsius
FROM events""")
def kelvin_to_celsius(spark, sf_dir):
    kelvin = F.col("value") + 250
    return roles.table(spark, sf_dir, "events").select(
        "event_id",
        classes.kelvin_to_celsius(kelvin).alias("celsius"),
        classes.kelvin_to_celsius(kelvin, 273.15).alias("exact_celsius"),
    )


@query("time_keys", """WITH t AS (
  SELECT event_id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S') AS polled,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y%m%d%H%M') AS minute_key
  FROM events)
SELECT event_id, minute_key, strftime(ts, '%Y%m%d%H') AS hour_key, substr(minute_key, 1, 8) AS day_part,
       strftime(ts, '#%H%M') AS suffix, strftime(ts, '%Y-%m-%dT%H-%M-%S') AS stamp,
       epoch_us(strptime(polled, '%Y-%m-%d %H:%M:%S')) AS polled_us,
       epoch_us(strptime(iso, '%Y-%m-%dT%H:%M:%SZ')) AS iso_us,
       epoch_us(strptime(minute_key, '%Y%m%d%H%M')) AS minute_us,
       epoch_us(ts) // 1000 * 1000 AS epoch_us,
       strftime(CAST(ts AS DATE) + INTERVAL 1 DAY, '%Y%m%d') AS next_day,
       hour(ts) AS hour,
       CASE WHEN hour(ts) < 6 THEN 1 WHEN hour(ts) < 12 THEN 2 WHEN hour(ts) < 15 THEN 3
            WHEN hour(ts) < 18 THEN 4 WHEN hour(ts) < 22 THEN 5 ELSE 1 END AS daytime,
       CASE WHEN hour(ts) < 6 OR hour(ts) >= 22 THEN 'Nachts' WHEN hour(ts) < 12 THEN 'Morgens'
            WHEN hour(ts) < 15 THEN 'Mittags' WHEN hour(ts) < 18 THEN 'Nachmittags'
            ELSE 'Abends' END AS daytime_label
FROM t""")
def time_keys(spark, sf_dir):
    ts = F.col("ts")
    polled = F.date_format(ts, times.POLL_TIME)
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    key = times.minute_key(ts)
    daytime = classes.daytime_class(ts)
    return roles.events(spark, sf_dir).select(
        "event_id",
        key.alias("minute_key"),
        times.hour_key(ts).alias("hour_key"),
        text.day_part(key).alias("day_part"),
        times.run_suffix(ts).alias("suffix"),
        times.run_stamp(ts).alias("stamp"),
        F.unix_micros(times.parse_poll_time(polled)).alias("polled_us"),
        F.unix_micros(times.parse_iso(iso)).alias("iso_us"),
        F.unix_micros(times.from_minute_key(key)).alias("minute_us"),
        F.unix_micros(times.from_epoch_ms(F.unix_millis(ts))).alias("epoch_us"),
        times.day_key(times.next_day(F.to_date(ts))).alias("next_day"),
        F.hour(ts).cast("long").alias("hour"),
        daytime.alias("daytime"),
        classes.daytime_label(daytime).alias("daytime_label"),
    )


@query("weather_text", f"""WITH {roles.WEATHER_TEXT}
SELECT hour_key, strict_text, loose_text FROM weather""")
def weather_text(spark, sf_dir):
    obs = ingest.latest_weather(roles.observations(spark, sf_dir), "event_id")
    hours = joins.weather_by_hour(obs, roles.PLACES)
    every = obs.select("hour_key").distinct().join(hours, "hour_key", "left")
    cells, places = F.col("weather"), roles.PLACES
    return every.select(
        "hour_key",
        joins.place_text(cells, places).alias("strict_text"),
        joins.place_text(cells, places, strict=False).alias("loose_text"),
    )


@query("null_text", f"""WITH {roles.WEATHER_TEXT}
SELECT hour_key, coalesce(strict_text, '') AS weather,
       strict_text IS NULL AS incomplete, hour_key || ' ' || strict_text AS joined
FROM weather""")
def null_text(spark, sf_dir):
    rows = weather_text(spark, sf_dir)
    return rows.select(
        "hour_key",
        text.empty_if_null(F.col("strict_text")).alias("weather"),
        F.col("strict_text").isNull().alias("incomplete"),
        text.join_key(F.col("hour_key"), F.lit(" "), F.col("strict_text")).alias("joined"),
    )


TRAINING_ROWS = f"""{MERGED_SESSIONS}, {roles.WEATHER_TEXT}, training AS (
  SELECT CAST(1 AS BIGINT) AS id,
         m.name || ' ' || m.game || ' '
           || CAST(floor(m.dur * 1000000.0::DOUBLE + 0.5) / 1000000.0::DOUBLE AS VARCHAR) || ' '
           || CASE daytime WHEN 1 THEN 'Nachts' WHEN 2 THEN 'Morgens' WHEN 3 THEN 'Mittags'
                           WHEN 4 THEN 'Nachmittags' ELSE 'Abends' END || ' '
           || CAST(floor(m.fps * 1000000.0::DOUBLE + 0.5) / 1000000.0::DOUBLE AS VARCHAR) || ' '
           || coalesce(w.{{text}}, '') AS text,
         CAST(floor(m.viewers / 1000 + 0.5) AS DOUBLE) AS target
  FROM merged m LEFT JOIN weather w ON strftime(m.starttime, '%Y%m%d%H') = w.hour_key)"""


def training_set(spark, sf_dir, strict=True):
    obs = ingest.latest_weather(roles.observations(spark, sf_dir), "event_id")
    return training.build_training_set(
        daily_sessions(spark, sf_dir), obs, roles.PLACES, strict=strict, digits=6
    )


@query("training_rows", f"""WITH {TRAINING_ROWS.format(text='strict_text')}
SELECT id, text, target FROM training WHERE text IS NOT NULL""")
def training_rows(spark, sf_dir):
    return training_set(spark, sf_dir)


@query("training_rows_loose", f"""WITH {TRAINING_ROWS.format(text='loose_text')}
SELECT id, text, target FROM training WHERE text IS NOT NULL""")
def training_rows_loose(spark, sf_dir):
    return training_set(spark, sf_dir, strict=False)


def forecast_slots(spark, sf_dir):
    """Stored: their size is known when the join with the requests is planned."""
    slots = joins.forecast_by_slot(roles.forecast(spark, sf_dir), roles.PLACES)
    return stored(slots, "slots")


@query("forecast_hour", f"""WITH {roles.REQUESTS}, {roles.FORECAST}
SELECT id, s.dt_txt, coalesce(weather, '') AS weather
FROM slotted s LEFT JOIN slots ON s.dt_txt = slots.dt_txt""")
def forecast_hour(spark, sf_dir):
    requests = roles.requests(spark, sf_dir)
    rows = joins.join_forecast(requests, forecast_slots(spark, sf_dir), roles.PLACES)
    slot = classes.forecast_time(F.col("day"), F.col("daytime"))
    return rows.select("id", slot.alias("dt_txt"), "weather")


@query("prediction_batch", f"""WITH {roles.REQUESTS}, {roles.FORECAST}
SELECT id, name || ' ' || game || ' ' || CAST(dur AS VARCHAR) || ' ' || daytime || ' '
             || CAST(fps AS VARCHAR) || ' ' || coalesce(weather, '') AS text
FROM slotted s LEFT JOIN slots ON s.dt_txt = slots.dt_txt""")
def prediction_batch(spark, sf_dir):
    rows = training.enrich_requests(
        roles.requests(spark, sf_dir), forecast_slots(spark, sf_dir), roles.PLACES
    )
    return rows.select("id", "text")


@query("drop_last_char", """
SELECT doc_id, n_chars, md5(left(text, greatest(length(text) - 1, 0))) AS shortened FROM documents""")
def drop_last_char(spark, sf_dir):
    return roles.table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.md5(text.drop_last_char(F.col("text"))).alias("shortened")
    )


@query("expressions", f"""WITH {roles.SAMPLES}
SELECT game, CAST(sum(CASE WHEN viewers > 500 AND NOT mature THEN 1 ELSE 0 END) AS BIGINT) AS kept,
       round(avg(viewers / 1000.0::DOUBLE), 6) AS thousands, count(*) AS polls
FROM samples GROUP BY 1""")
def expressions(spark, sf_dir):
    """Arithmetic, comparison and three-valued logic."""
    kept = classes.indicator((F.col("viewers") > 500) & ~F.col("mature"))
    return roles.samples(spark, sf_dir).groupBy("game").agg(
        F.sum(kept).alias("kept"),
        F.round(F.avg(F.col("viewers") / 1000), 6).alias("thousands"),
        F.count("*").alias("polls"),
    )


@query("session_classes", f"""WITH {MERGED_SESSIONS}
SELECT CAST(floor(viewers / 1000 + 0.5) AS BIGINT) AS viewer_class, count(*) AS sessions
FROM merged GROUP BY 1""")
def session_classes(spark, sf_dir):
    """How often each class occurs: the order of the label index (M3)."""
    merged = rollups.reaggregate_sessions(daily_sessions(spark, sf_dir))
    cls = classes.viewer_class(F.col("viewers")).cast("long")
    return merged.groupBy(cls.alias("viewer_class")).agg(F.count("*").alias("sessions"))
