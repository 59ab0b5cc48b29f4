"""The wide row, its round trips and the dashboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamtide.functions import bags, text, times
from streamtide.operators import joins, rollups, wide
from streamtide.plans import dashboard, day_totals
from streamtide.session import scratch_folder, stored
from streamtide.sinks import tables as sinks
from streamtide.sources import tables as sources
from workload import roles
from workload.registry import query
from workload.roles import day_text, six_digits
from workload.rollups import keyed_minutes


def nested(spark, sf_dir, rows=None, run_ts=roles.RUN_TS):
    """The flagship: one nested row per stream and day, of all events or of ``rows``."""
    events = roles.events(spark, sf_dir) if rows is None else rows
    polls = roles.as_samples(events)
    return wide.stream_day(
        polls,
        rollups.viewers_per_bucket(polls),
        rollups.chat_per_bucket(roles.as_chat(events)),
        times.run_time(run_ts),
    )


@query("stream_day", f"""WITH {roles.VIEWER_MINUTES}, {roles.CHAT_MINUTES}
SELECT v.name, v.day, v.name || v.day || '#1153' AS row_key, v.polls, v.minutes, v.viewers_sum,
       c.positive, c.negative, c.neutral
FROM (SELECT name, day, CAST(sum(viewers_cnt) AS BIGINT) AS polls, count(*) AS minutes,
             CAST(sum(viewers_sum) AS BIGINT) AS viewers_sum FROM viewer_minutes GROUP BY 1, 2) v
LEFT JOIN (SELECT name, day, CAST(sum(positive) AS BIGINT) AS positive,
                  CAST(sum(negative) AS BIGINT) AS negative, CAST(sum(neutral) AS BIGINT) AS neutral
           FROM chat_minutes GROUP BY 1, 2) c ON v.name = c.name AND v.day = c.day""")
def stream_day(spark, sf_dir):
    """The nested rows, summarised without taking the lists apart."""
    rows = nested(spark, sf_dir)

    def total(bag, field):
        zero = F.lit(0).cast("long")
        return F.aggregate(bag, zero, lambda acc, x: acc + F.coalesce(x[field], zero))

    summed = rows.groupBy("name", "day", wide.row_key(times.run_suffix("run_ts")).alias("row_key"))
    return summed.agg(
        F.sum(total("metadata", "polls")).alias("polls"),
        F.sum(F.size("viewerspermin")).alias("minutes"),
        F.sum(total("viewerspermin", "viewers_sum")).alias("viewers_sum"),
        F.sum(total("chatspermin", "positive")).alias("positive"),
        F.sum(total("chatspermin", "negative")).alias("negative"),
        F.sum(total("chatspermin", "neutral")).alias("neutral"),
    ).withColumn("day", day_text())


@query("stream_day_minutes", f"""WITH {roles.VIEWER_MINUTES}
SELECT name, day, minute, viewers_sum, viewers_cnt, round(viewers, 6) AS viewers
FROM viewer_minutes""")
def stream_day_minutes(spark, sf_dir):
    rows = wide.flatten(nested(spark, sf_dir), "viewerspermin")
    return keyed_minutes(rows, "viewers_sum", "viewers_cnt", six_digits("viewers"))


@query("stream_day_metadata", f"""WITH {roles.SAMPLES}
SELECT name, day, strftime(created, '%Y%m%d%H%M%S') AS created, game, status,
       CAST(mature AS INTEGER) AS mature, fps
FROM samples""")
def stream_day_metadata(spark, sf_dir):
    """The stored metadata list back to one row per poll."""
    table = stored(nested(spark, sf_dir), "stream-day")
    entries = wide.repeat_polls(wide.flatten(table, "metadata"))
    return entries.select(
        "name", day_text().alias("day"),
        F.date_format("created", "yyyyMMddHHmmss").alias("created"),
        "game", "status", F.col("mature").cast("int").alias("mature"), "fps",
    )


@query("stream_day_all", f"""WITH {roles.SAMPLES}, {roles.CHAT_MINUTES}, m AS (
  SELECT name, day, count(*) AS polls FROM samples GROUP BY 1, 2), c AS (
  SELECT name, day, count(*) AS minutes FROM chat_minutes GROUP BY 1, 2)
SELECT coalesce(m.name, c.name) AS name, coalesce(m.day, c.day) AS day,
       coalesce(polls, 0) AS polls, coalesce(minutes, 0) AS minutes
FROM m FULL JOIN c ON m.name = c.name AND m.day = c.day""")
def stream_day_all(spark, sf_dir):
    """The full form: streams and days with chat but no poll stay."""
    polls = roles.samples(spark, sf_dir)
    rows = wide.stream_day(
        polls,
        rollups.viewers_per_bucket(polls),
        rollups.chat_per_bucket(roles.chat(spark, sf_dir)),
        times.run_time(roles.RUN_TS),
        how="full",
    )
    polled = F.aggregate("metadata", F.lit(0).cast("long"), lambda acc, x: acc + x["polls"])
    return rows.groupBy("name", day_text().alias("day")).agg(
        F.sum(polled).alias("polls"), F.sum(F.size("chatspermin").cast("long")).alias("minutes")
    )


DAY_ROLLUP = f"""WITH {roles.VIEWER_MINUTES}, {roles.CHAT_MINUTES}
SELECT v.name, v.day, round(v.viewers, 6) AS viewers, c.positive, c.negative, c.neutral
FROM (SELECT name, day, avg(viewers) AS viewers FROM viewer_minutes GROUP BY 1, 2) v
JOIN (SELECT name, day, CAST(sum(positive) AS BIGINT) AS positive,
             CAST(sum(negative) AS BIGINT) AS negative, CAST(sum(neutral) AS BIGINT) AS neutral
      FROM chat_minutes GROUP BY 1, 2) c ON v.name = c.name AND v.day = c.day"""


@query("day_rollup", DAY_ROLLUP)
def day_rollup(spark, sf_dir):
    rows = wide.day_rollup(nested(spark, sf_dir))
    return rows.select(
        "name", day_text().alias("day"), six_digits("viewers"), "positive", "negative", "neutral"
    )


@query("day_rollup_incremental", DAY_ROLLUP)
def day_rollup_incremental(spark, sf_dir):
    """Three arrivals that split days and minutes between them; the last one came twice."""
    root = scratch_folder(spark, "day-totals")
    events = roles.events(spark, sf_dir)
    for k in (0, 1, 2, 2):
        own = events.where(F.col("event_id") % 3 == k)
        day_totals.add(
            spark, root, f"arrival-{k}", rollups.viewers_per_bucket(roles.as_samples(own)), rollups.chat_per_bucket(roles.as_chat(own)))
    return day_totals.totals(spark, root).select(
        "name", day_text().alias("day"), six_digits("viewers"), "positive", "negative", "neutral")


@query("wide_table_round_trip", f"""WITH {roles.CHAT_MINUTES}
SELECT name, day, minute, positive, negative, neutral FROM chat_minutes""")
def wide_table_round_trip(spark, sf_dir):
    """Written by day, read back with one nested column."""
    path = scratch_folder(spark, "stream-day")
    sinks.write_stream_day(nested(spark, sf_dir), path, "one")
    rows = sources.read_stream_day(spark, path, "chatspermin")
    return keyed_minutes(
        wide.flatten(rows, "chatspermin"), "positive", "negative", "neutral"
    )


@query("multi_run_union", f"""WITH {roles.SAMPLES}, halves AS (
  SELECT name, day, minute, mature, avg(viewers) AS viewers FROM samples GROUP BY 1, 2, 3, 4)
SELECT name, day, minute, CASE WHEN mature THEN '#1153' ELSE '#1203' END AS run,
       round(viewers, 6) AS viewers FROM halves""")
def multi_run_union(spark, sf_dir):
    """Two runs written to one table; their minutes concatenated, repeats kept."""
    path = scratch_folder(spark, "runs")
    events = roles.events(spark, sf_dir)
    mature = roles.detail().cast("int") % 2 == 0
    sinks.write_stream_day(nested(spark, sf_dir, events.where(mature)), path, "one")
    second = nested(spark, sf_dir, events.where(~mature), "2024-02-01 12:03:00")
    sinks.write_stream_day(second, path, "two")
    rows = sources.read_stream_day(spark, path, "viewerspermin")
    minutes = rows.select("name", "day", "run_ts", F.inline("viewerspermin"))
    return keyed_minutes(
        minutes, times.run_suffix("run_ts").alias("run"), six_digits("viewers")
    )


@query("project_entries", f"""WITH {roles.VIEWER_MINUTES}
SELECT name, minute, viewers_sum FROM viewer_minutes""")
def project_entries(spark, sf_dir):
    """Two fields of the entries only."""
    rows = nested(spark, sf_dir)
    slim = rows.select(
        "name", wide.project_entries("viewerspermin", "minute", "viewers_sum").alias("bag")
    )
    flat = slim.select("name", F.inline("bag"))
    return flat.withColumn("minute", times.minute_key(F.col("minute")))


@query("bag_text_import", f"""WITH {roles.CHAT_MINUTES}
SELECT name, minute, positive, negative, neutral FROM chat_minutes""")
def bag_text_import(spark, sf_dir):
    """The nested minutes as transport text and back."""
    keyed = F.transform("chatspermin", lambda x: F.struct(
        times.minute_key(x["minute"]).alias("minute"), x["positive"].alias("positive"),
        x["negative"].alias("negative"), x["neutral"].alias("neutral"),
    ))
    cells = nested(spark, sf_dir).withColumn("keyed", keyed).select(
        "name",
        F.base64(bags.bag_text(F.col("keyed"), "minute", "positive", "negative", "neutral")
                 .cast("binary")).alias("cell"),
    )
    columns = {"minute": "string", "positive": "long", "negative": "long", "neutral": "long"}
    parsed = bags.parse_bag(text.decode_cell(F.col("cell")), columns)
    rows = cells.select("name", F.inline(parsed))
    return rows.withColumn("minute", times.minute_key(times.from_minute_key(F.col("minute"))))


@query("metadata_bag_import", f"""WITH {roles.SAMPLES}
SELECT DISTINCT name, game, 'a, b,' || status AS status, fps, CAST(mature AS INTEGER) AS mature,
       strftime(created, '%Y%m%d%H%M%S') AS created
FROM samples""")
def metadata_bag_import(spark, sf_dir):
    """Metadata text whose status holds commas."""
    rows = nested(spark, sf_dir)
    entries = F.transform("metadata", lambda x: F.struct(
        wide.row_key(F.lit("")).alias("key"), F.col("name").alias("name"), x["game"].alias("game"),
        F.concat(F.lit("a, b,"), x["status"]).alias("status"), x["mature"].alias("mature"),
        x["fps"].alias("fps"), x["created"].alias("created"),
    ))
    order = ["key", "name", "game", "status", "mature", "fps", "created"]
    cells = rows.withColumn("keyed", entries).select(
        bags.bag_text(F.col("keyed"), *order).alias("cell")
    )
    parsed = cells.select(F.inline(bags.parse_metadata_bag(F.col("cell"))))
    return parsed.select(
        "name", "game", "status", "fps", F.col("mature").cast("int").alias("mature"),
        F.date_format("created", "yyyyMMddHHmmss").alias("created"),
    )


@query("minute_lookup", f"""WITH {roles.VIEWER_MINUTES}, last AS (
  SELECT name, minute, game, status, fps FROM (
    SELECT *, row_number() OVER (PARTITION BY name, minute
                                 ORDER BY created DESC, game DESC, status DESC, fps DESC) AS rn
    FROM samples) WHERE rn = 1)
SELECT v.name, v.minute, round(v.viewers, 6) AS viewers, game, status, fps
FROM viewer_minutes v LEFT JOIN last ON v.name = last.name AND v.minute = last.minute""")
def minute_lookup(spark, sf_dir):
    polls = roles.samples(spark, sf_dir)
    minutes = rollups.viewers_per_bucket(polls).select("name", "minute", "viewers")
    rows = joins.minute_lookup(minutes, polls)
    return rows.select(
        "name", times.minute_key(F.col("minute")).alias("minute"), six_digits("viewers"),
        "game", "status", "fps",
    )


@query("prefix_scan", f"""WITH {roles.SAMPLES}
SELECT channel_id, name, viewers FROM samples WHERE name = 'u7' AND day = '20240105'""")
def prefix_scan(spark, sf_dir):
    """On the table stored by day: one folder is read, and the name is pushed down."""
    path = scratch_folder(spark, "polls")
    polls = roles.samples(spark, sf_dir).withColumn("day", F.to_date("created"))
    sinks.replace_partitions(polls, path, "day")
    table = spark.read.schema(polls.schema).parquet(path)
    return sources.prefix_scan(table, "U7", "2024-01-05").select("channel_id", "name", "viewers")


@query("key_prefix_scan", f"""WITH {roles.SAMPLES}
SELECT channel_id, name || day AS row_key FROM samples WHERE starts_with(name || day, 'u1202401')""")
def key_prefix_scan(spark, sf_dir):
    day = F.date_format("created", "yyyyMMdd")
    polls = roles.samples(spark, sf_dir).withColumn("row_key", text.join_key(F.col("name"), day))
    table = stored(polls.select("channel_id", "row_key"), "keyed")
    return sources.key_prefix_scan(table, "row_key", "u1202401").select("channel_id", "row_key")


def stored_days(spark, sf_dir):
    """The wide table, written once by day; the dashboard reads one day's folder."""
    path = scratch_folder(spark, "stream-day")
    sinks.write_stream_day(nested(spark, sf_dir), path, "one")
    return sources.read_stream_day(spark, path)


@query("dashboard_series", f"""WITH {roles.VIEWER_MINUTES}, {roles.CHAT_MINUTES}
SELECT minute AS ts, 'viewers' AS series, round(viewers, 6) AS value FROM viewer_minutes
WHERE name = 'u7' AND day = '20240105'
UNION ALL SELECT minute, 'positive', CAST(positive AS DOUBLE) FROM chat_minutes
WHERE name = 'u7' AND day = '20240105'
UNION ALL SELECT minute, 'neutral', CAST(neutral AS DOUBLE) FROM chat_minutes
WHERE name = 'u7' AND day = '20240105'
UNION ALL SELECT minute, 'negative', CAST(negative AS DOUBLE) FROM chat_minutes
WHERE name = 'u7' AND day = '20240105'""")
def dashboard_series(spark, sf_dir):
    rows = dashboard.day_series(stored_days(spark, sf_dir), "U7", "2024-01-05")
    return rows.select(
        times.minute_key(F.col("ts")).alias("ts"), "series", six_digits("value")
    )


@query("dashboard_details", f"""WITH {roles.VIEWER_MINUTES}, last AS (
  SELECT name, minute, game, fps FROM (
    SELECT *, row_number() OVER (PARTITION BY name, minute
                                 ORDER BY created DESC, game DESC, status DESC, fps DESC) AS rn
    FROM samples) WHERE rn = 1)
SELECT v.name, v.minute, round(v.viewers, 6) AS viewers, game, fps
FROM viewer_minutes v LEFT JOIN last ON v.name = last.name AND v.minute = last.minute
WHERE v.name = 'u7' AND v.day = '20240105'""")
def dashboard_details(spark, sf_dir):
    rows = dashboard.minute_details(stored_days(spark, sf_dir), "U7", "2024-01-05")
    return rows.select(
        "name", times.minute_key(F.col("minute")).alias("minute"), six_digits("viewers"),
        "game", "fps",
    )
