"""Sources and sinks: the tables through files and documents and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamtide import schemas
from streamtide.functions import times
from streamtide.operators import joins, quality, series, wide
from streamtide.plans import archive, ingest, runs, upsert
from streamtide.session import scratch_folder, stored
from streamtide.sinks import tables as sinks
from streamtide.sources import documents, files
from streamtide.sources import tables as sources
from workload import roles
from workload.features import TRAINING_ROWS, training_set
from workload.registry import query
from workload.roles import six_digits
from workload.rollups import DAILY_SESSIONS, daily_sessions, keyed_minutes


def _sample_text(rows):
    """Polls as they land in text; errors carry an ISO stamp, views no frame rate."""
    created = F.when(F.col("game") == "error", F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss"))
    return rows.select(
        "channel_id", "viewers", "game", "name", "status",
        created.otherwise(F.date_format("created", times.POLL_TIME)).alias("created"),
        "mature", F.lit("n/a").alias("updated_at"),
        F.when(F.col("game") != "view", F.col("fps")).alias("fps"),
    )


@query("delimited_scan", f"""WITH {roles.SAMPLES}
SELECT channel_id, viewers, game, name, status, strftime(created, '%Y%m%d%H%M%S') AS created,
       CAST(mature AS INTEGER) AS mature, CASE WHEN game <> 'view' THEN fps END AS fps
FROM samples WHERE game <> 'error'""")
def delimited_scan(spark, sf_dir):
    """Through ``;`` text in nested folders and back."""
    root = scratch_folder(spark, "polls")
    rows = _sample_text(roles.samples(spark, sf_dir))
    first, second = quality.split_valid(rows, F.col("mature"))
    sinks.write_delimited(first, f"{root}/2024/1/10")
    sinks.write_delimited(second, f"{root}/2024/1/20")
    polls = quality.clean_samples(files.read_stream_samples(spark, root, recursive=True))
    return polls.withColumns({
        "created": F.date_format("created", "yyyyMMddHHmmss"),
        "mature": F.col("mature").cast("int"),
    })


@query("delimited_quarantine", f"""WITH {roles.SAMPLES}
SELECT channel_id, game IN ('click', 'view') AS malformed,
       CASE game WHEN 'click' THEN 'many;' || channel_id WHEN 'view' THEN CAST(channel_id AS VARCHAR) || ';1;short' END AS line
FROM samples""")
def delimited_quarantine(spark, sf_dir):
    """Lines of clicks have text for a number, those of views too few fields; rows and quarantine
    make up all lines (S2, F7)."""
    path = scratch_folder(spark, "lines")
    full = F.concat_ws(
        ";", "channel_id", "viewers", "game", "name", F.lit("s"), F.date_format("created", times.POLL_TIME),
        F.col("mature").cast("string"), F.lit("u"), F.col("fps").cast("string"))
    kind = F.col("game")
    line = F.when(kind == "click", F.concat(F.lit("many;"), full)).when(
        kind == "view", F.concat(F.col("channel_id").cast("string"), F.lit(";1;short"))).otherwise(full)
    roles.samples(spark, sf_dir).select(line.alias("value")).write.text(path)
    checked = stored(files.checked_samples(spark, path), "checked")
    bad = files.delimited_quarantine(checked).select(
        F.regexp_extract("line", "^(?:many;)?([0-9]+);", 1).cast("long").alias("channel_id"), F.lit(True).alias("malformed"),
        F.regexp_extract("line", "^(many;[0-9]+|[0-9]+;1;short)", 1).alias("line"))
    good = files.good_lines(checked).select("channel_id", F.lit(False).alias("malformed"), F.lit(None).cast("string").alias("line"))
    return good.unionByName(bad)


@query("two_runs_one_landing", f"""WITH {roles.VIEWER_MINUTES}
SELECT name, day, minute, viewers_sum, viewers_cnt, round(viewers, 6) AS viewers FROM viewer_minutes""")
def two_runs_one_landing(spark, sf_dir):
    """Two ten-minute runs over one folder, the second after more polls have landed: each poll
    enters one run, so the merged minutes are those of all polls (C4, C5)."""
    root = scratch_folder(spark, "runs")
    layout = runs.Layout(f"{root}/tables")
    roles.chat(spark, sf_dir).write.parquet(f"{root}/chat")
    early, late = quality.split_valid(roles.samples(spark, sf_dir), F.col("channel_id") % 3 != 0)
    for k, (polls, at) in enumerate(((early, "12:00:00"), (late, "12:10:00"))):
        rows = polls.select(
            "channel_id", "viewers", "game", "name", "status",
            F.date_format("created", times.POLL_TIME).alias("created"),
            "mature", F.lit("n/a").alias("updated_at"), "fps")
        sinks.write_delimited(rows, f"{root}/polls/{k}")
        runs.minute_run(spark, layout, f"{root}/polls", f"{root}/chat", f"2024-02-01 {at}")
    table = sources.read_stream_day(spark, layout.folder("stream_day"), "viewerspermin")
    return keyed_minutes(wide.merged_viewers(table), "viewers_sum", "viewers_cnt", six_digits("viewers"))


@query("scored_messages", """
SELECT CAST(CASE WHEN length(text) % 3 = 0 THEN 1 WHEN length(text) % 3 = 1 THEN 2 ELSE 0 END AS BIGINT) AS sentiment,
       count(*) AS messages FROM documents GROUP BY 1""")
def scored_messages(spark, sf_dir):
    """A caller's scorer over all messages, in Arrow batches."""
    def scorer(texts):
        return (texts.str.len() % 3).map({0: "positive", 1: "negative", 2: "neutral"})

    scored = joins.score_messages(roles.table(spark, sf_dir, "documents"), scorer, "text")
    return scored.groupBy(F.col("sentiment").cast("long").alias("sentiment")).agg(F.count("*").alias("messages"))


@query("sorted_files", """
SELECT CAST(custkey AS VARCHAR) AS key, count(*) AS orders, TRUE AS in_order FROM (
  SELECT o_custkey AS custkey FROM orders) GROUP BY 1""")
def sorted_files(spark, sf_dir):
    """Each file sorted by the key as text; read back, no row precedes a smaller one (O2)."""
    path = scratch_folder(spark, "sorted")
    series.sorted_files(roles.table(spark, sf_dir, "orders").select("o_custkey"), "o_custkey").write.parquet(path)
    rows = spark.read.parquet(path).select(
        F.col("o_custkey").cast("string").alias("key"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("place"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("place"))
    checked = rows.withColumn("in_order", F.coalesce(before <= F.col("key"), F.lit(True)))
    return checked.groupBy("key").agg(F.count("*").alias("orders"), F.min("in_order").alias("in_order"))


@query("session_text_scan", f"""WITH {DAILY_SESSIONS}
SELECT name, game, round(dur, 6) AS dur, CAST(daytime AS BIGINT) AS daytime, round(fps, 6) AS fps,
       round(viewers, 6) AS viewers, strftime(starttime, '%Y%m%d%H%M%S') AS starttime
FROM sessions""")
def session_text_scan(spark, sf_dir):
    """Sessions through tab text, one run, and back."""
    path = scratch_folder(spark, "sessions")
    columns = ["name", "game", "dur", "daytime", "fps", "viewers", "starttime"]
    iso = F.date_format("starttime", "yyyy-MM-dd'T'HH:mm:ssXXX")
    rows = daily_sessions(spark, sf_dir).select(columns).withColumn("starttime", iso)
    sinks.write_delimited(rows, path, sep="\t")
    back = files.read_sessions(spark, path)
    return back.select(
        "name", "game", six_digits("dur"), F.col("daytime").cast("long").alias("daytime"),
        six_digits("fps"), six_digits("viewers"),
        F.date_format("starttime", "yyyyMMddHHmmss").alias("starttime"),
    )


@query("session_runs", f"""WITH {DAILY_SESSIONS}
SELECT name, game, polls, CASE WHEN daytime < 3 THEN 'early' ELSE 'late' END AS run FROM sessions""")
def session_runs(spark, sf_dir):
    """Two runs in one table (K3)."""
    path = scratch_folder(spark, "runs")
    early, late = quality.split_valid(daily_sessions(spark, sf_dir), F.col("daytime") < 3)
    sinks.write_run(early, path, "early")
    sinks.write_run(late, path, "late")
    return spark.read.parquet(path).select("name", "game", "polls", "run")


@query("legacy_chat_scan", f"""WITH {roles.CHAT}
SELECT epoch_us(ts) // 1000 AS ts_ms, name AS channel, msg, CAST(sentiment AS BIGINT) AS sentiment
FROM chat""")
def legacy_chat_scan(spark, sf_dir):
    """Through a sequence file and back."""
    path = scratch_folder(spark, "chat")
    rows = roles.chat(spark, sf_dir).select(
        F.unix_millis("ts").alias("key"), files.chat_value().alias("value")
    )
    rows.rdd.map(tuple).saveAsSequenceFile(path)
    return files.read_sequence_chat(spark, path).select(
        F.unix_millis("ts").alias("ts_ms"), "channel", "msg",
        F.col("sentiment").cast("long").alias("sentiment"),
    )


@query("archive_round_trip", """
SELECT event_id, user_id, event_type, value, props FROM events""")
def archive_round_trip(spark, sf_dir):
    """Landed lines compacted to bzip2 and read back."""
    root = scratch_folder(spark, "archive")
    columns = ["event_id", "user_id", "event_type", "value", "props"]
    rows = roles.table(spark, sf_dir, "events").select(columns)
    rows.select(F.to_json(F.struct(*columns)).alias("value")).write.text(f"{root}/processing")
    archive.archive_text(spark, f"{root}/processing", f"{root}/completed")
    lines = files.read_lines(spark, f"{root}/completed")
    return lines.select(F.from_json("value", rows.schema).alias("row")).select("row.*")


@query("archive_chat_rows", f"""WITH {roles.CHAT}
SELECT name AS channel, msg, CAST(sentiment AS BIGINT) AS sentiment FROM chat""")
def archive_chat_rows(spark, sf_dir):
    """Typed rows archived as bzip2 text instead of raw binary lines (K6)."""
    path = scratch_folder(spark, "archive")
    chat = roles.chat(spark, sf_dir).select("channel", "msg", "sentiment")
    archive.archive_rows(chat, path)
    return spark.read.schema("channel string, msg string, sentiment long").csv(path, sep="\t")


@query("training_lines", f"""WITH {TRAINING_ROWS.format(text='loose_text')}
SELECT id, text, target FROM training WHERE text IS NOT NULL""")
def training_lines(spark, sf_dir):
    """Training rows as ``id,text,target`` lines and back; short lines are dropped."""
    path = scratch_folder(spark, "lines")
    rows = training_set(spark, sf_dir, strict=False)
    line = F.concat_ws(",", F.col("id").cast("string"), "text", F.col("target").cast("string"))
    short = rows.select(F.col("text").alias("value"))
    rows.select(line.alias("value")).unionAll(short).write.text(path)
    return files.read_training_lines(spark, path)


@query("training_publish", f"""WITH {TRAINING_ROWS.format(text='strict_text')}
SELECT id, text, target, CAST(target AS BIGINT) % 2 AS half FROM training WHERE text IS NOT NULL""")
def training_publish(spark, sf_dir):
    """Published twice; the second write replaces the first (K4)."""
    path = scratch_folder(spark, "training")
    rows = training_set(spark, sf_dir).withColumn("half", F.col("target").cast("long") % 2)
    sinks.replace_partitions(rows, path, "half")
    sinks.replace_partitions(rows, path, "half")
    back = spark.read.parquet(path)
    return back.withColumn("half", F.col("half").cast("long"))


@query("weather_upsert_log", f"""WITH {roles.OBSERVATIONS}
SELECT hour_key, place, main, wind, round(temp, 6) AS temp, event_id FROM latest_obs""")
def weather_upsert_log(spark, sf_dir):
    """Later observations first, earlier ones after; the latest still wins (K2)."""
    path = scratch_folder(spark, "weather")
    late, early = quality.split_valid(
        roles.observations(spark, sf_dir), F.minute("obs_ts") >= 30
    )
    sinks.append_weather(late, path, "late")
    sinks.append_weather(early, path, "early")
    latest = ingest.latest_weather(spark.read.parquet(path), "event_id")
    return latest.select("hour_key", "place", "main", "wind", six_digits("temp"), "event_id")


@query("weather_compacted", f"""WITH {roles.OBSERVATIONS}
SELECT hour_key, place, main, wind, round(temp, 6) AS temp, event_id FROM latest_obs""")
def weather_compacted(spark, sf_dir):
    """The log folded twice, with rows that come late for days already folded and days still open."""
    root = scratch_folder(spark, "weather")
    schema = f"{schemas.WEATHER_OBS}, event_id long"
    late, early = quality.split_valid(roles.observations(spark, sf_dir), F.minute("obs_ts") >= 30)
    upsert.append(late, root, "first")
    upsert.fold(spark, root, "2024-01-10", "event_id", schema=schema)
    upsert.append(early, root, "second")
    upsert.fold(spark, root, "2024-01-05", "event_id", schema=schema)
    rows = upsert.latest(spark, root, "event_id", schema=schema)
    return rows.select("hour_key", "place", "main", "wind", six_digits("temp"), "event_id")


@query("training_nights", f"""WITH {DAILY_SESSIONS}
SELECT strftime(starttime, '%Y-%m-%d') AS night, name, game, round(viewers, 6) AS viewers, round(dur, 6) AS dur, polls FROM sessions
WHERE strftime(starttime, '%Y%m%d') BETWEEN '20240105' AND '20240107'""")
def training_nights(spark, sf_dir):
    """Three nights of sessions, out of a run that began the evening before the first of them and
    one that ended after the last (C7)."""
    layout = runs.Layout(scratch_folder(spark, "nights"))
    polls = roles.samples(spark, sf_dir).withColumn("day", F.to_date("created"))
    for rest, stamp in enumerate(("2024-01-04T23-50-00", "2024-01-08T00-10-00")):
        sinks.write_run(polls.where(F.col("channel_id") % 2 == rest), layout.folder("samples"), stamp, "day")
    nights = [
        ingest.sessions_of(runs.night_samples(spark, layout, night)).withColumn("night", F.lit(night))
        for night in ("2024-01-05", "2024-01-06", "2024-01-07")]
    rows = reduce(DataFrame.unionByName, nights)
    return rows.select("night", "name", "game", six_digits("viewers"), six_digits("dur"), "polls")


@query("place_scan", "SELECT DISTINCT trim(c_mktsegment) AS place, count(*) AS customers FROM customer GROUP BY 1")
def place_scan(spark, sf_dir):
    """A place list as text lines."""
    path = scratch_folder(spark, "places")
    segments = roles.table(spark, sf_dir, "customer").select("c_mktsegment")
    segments.select(F.concat(F.lit(" "), "c_mktsegment").alias("value")).write.text(path)
    return files.read_places(spark, path).groupBy("place").agg(F.count("*").alias("customers"))


def stream_pages(spark, sf_dir):
    """One listing page per event: the stream, one without a game, one without a channel, and
    one whose channel is text.

    Pages of errors are cut off in the middle.
    """
    def stream(game):
        return F.struct(
            F.col("channel_id").cast("string").alias("_id"),
            F.when(F.col("game") == "click", "many").otherwise(
                F.col("viewers").cast("string")).alias("viewers"),
            F.col("fps").alias("average_fps"),
            F.struct(
                game.alias("game"), "name", F.concat(F.col("status"), F.lit(";")).alias("status"),
                F.when(F.col("game") != "view", F.col("mature")).alias("mature"),
                F.lit("2024-01-01T00:00:00Z").alias("updated_at"),
            ).alias("channel"),
        )

    real, nameless = stream(F.col("game")), stream(F.lit("null"))
    no_channel = real.withField("channel", F.lit(None).cast(
        "struct<game: string, name: string, status: string, mature: boolean, updated_at: string>"
    ))
    body = F.to_json(F.struct(F.array(real, nameless, no_channel).alias("streams")))
    malformed = F.lit(',{"_id":"9","channel":"broken"}]}')
    body = F.concat(F.substr(body, F.lit(1), F.length(body) - 2), malformed)
    cut = F.when(F.col("game") == "error", F.substring(body, 1, 60)).otherwise(body)
    return roles.samples(spark, sf_dir).select(
        cut.alias("body"), F.col("created").alias("landed_at"), "channel_id"
    )


@query("stream_page_rows", f"""WITH {roles.SAMPLES}
SELECT channel_id, CAST(CASE WHEN game <> 'click' THEN viewers END AS DOUBLE) AS viewers,
       game, name, status,
       strftime(created, '%Y%m%d%H%M%S') AS created,
       CASE WHEN game = 'view' THEN 0 ELSE CAST(mature AS INTEGER) END AS mature, fps
FROM samples WHERE game <> 'error'""")
def stream_page_rows(spark, sf_dir):
    rows, _ = ingest.ingest_metadata(stream_pages(spark, sf_dir))
    return rows.select(
        "channel_id", F.col("viewers").cast("double").alias("viewers"), "game", "name", "status",
        F.date_format("created", "yyyyMMddHHmmss").alias("created"),
        F.col("mature").cast("int").alias("mature"), "fps",
    )


@query("stream_page_quarantine", f"""WITH {roles.SAMPLES}
SELECT channel_id, game = 'error' AS whole_page,
       CASE WHEN game <> 'error' THEN '{{"_id":"9","channel":"broken"}}' END AS element FROM samples""")
def stream_page_quarantine(spark, sf_dir):
    """Pages that are cut off, and the one malformed element of each other page."""
    _, bad = ingest.ingest_metadata(stream_pages(spark, sf_dir))
    return bad.select("channel_id", F.col("body").isNotNull().alias("whole_page"), "element")


@query("weather_from_json", """
SELECT strftime(ts, '%Y%m%d%H') AS hour_key, 'p' || CAST(user_id % 5 AS VARCHAR) AS place,
       event_type AS main, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS wind,
       floor((value + 250 - 273.0::DOUBLE) * 100 + 0.5) / 100 AS temp
FROM events WHERE event_type <> 'click'""")
def weather_from_json(spark, sf_dir):
    """Weather documents; those of clicks hold no weather element."""
    return ingest.ingest_weather(weather_pages(spark, sf_dir)).drop("obs_ts")


@query("weather_quarantine", """
SELECT 'p' || CAST(user_id % 5 AS VARCHAR) AS place, count(*) AS pages
FROM events WHERE event_type = 'click' GROUP BY 1""")
def weather_quarantine(spark, sf_dir):
    """Weather documents without a value."""
    bad = documents.weather_quarantine(documents.weather_parts(weather_pages(spark, sf_dir)))
    return bad.groupBy("place").agg(F.count("*").alias("pages"))


def weather_pages(spark, sf_dir):
    kind = F.col("event_type")
    body = F.to_json(F.struct(
        F.when(kind != "click", F.array(F.struct(kind.alias("main")))).otherwise(
            F.array().cast("array<struct<main: string>>")).alias("weather"),
        F.struct((F.col("value") + 250).alias("temp")).alias("main"),
        F.struct(roles.detail().cast("int").alias("speed")).alias("wind"),
    ))
    return roles.events(spark, sf_dir).select(
        body.alias("body"), roles.place().alias("place"), F.col("ts").alias("landed_at")
    )


@query("forecast_from_json", f"""WITH {roles.FORECAST}
SELECT place, dt_txt, main, wind, temp, pos - event_offset AS slot FROM (
  SELECT *, 0 AS event_offset FROM (SELECT place, dt_txt, main, wind, temp, CAST(0 AS BIGINT) AS pos FROM forecast)
  UNION ALL
  SELECT place, dt_txt, 'later', wind, temp, CAST(1 AS BIGINT), 0 FROM forecast)""")
def forecast_from_json(spark, sf_dir):
    """Forecast documents of two slots each."""
    def slot(main):
        return F.struct(
            "dt_txt", F.struct("wind").withField("speed", F.col("wind")).alias("wind"),
            F.struct((F.col("value") + 250).alias("temp")).alias("main"),
            F.array(F.struct(main.alias("main"))).alias("weather"),
        )

    keyed = roles.as_forecast(roles.events(spark, sf_dir), "value")
    body = F.to_json(F.struct(F.array(slot(F.col("main")), slot(F.lit("later"))).alias("list")))
    rows = documents.forecast_rows(documents.forecast_parts(keyed.select(body.alias("body"), "place")))
    return rows.withColumn("slot", F.col("pos").cast("long")).drop("pos")


@query("forecast_quarantine", """
SELECT event_id % 3 = 0 AS unreadable, count(*) AS pages FROM events WHERE event_id % 3 < 2 GROUP BY 1""")
def forecast_quarantine(spark, sf_dir):
    """Every third document is cut, every third has no slots."""
    kind = F.col("event_id") % 3
    body = F.when(kind == 0, '{"list": [').when(kind == 1, '{"city": "x"}').otherwise(
        '{"list": [{"dt_txt": "2024-01-01 06:00:00"}]}')
    docs = roles.events(spark, sf_dir).select(body.alias("body"), roles.place().alias("place"))
    bad = documents.forecast_quarantine(documents.forecast_parts(docs))
    cut = F.col("body").startswith('{"list"')
    return bad.groupBy(cut.alias("unreadable")).agg(F.count("*").alias("pages"))


@query("json_props", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       try_cast(event_type AS BIGINT) IS NULL AS no_number, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value,
       json_extract_string(props, '$.missing') IS NULL AS without_field
FROM events""")
def json_props(spark, sf_dir):
    """JSON fields, present and missing, and text to numbers."""
    doc = F.from_json("props", "k string, missing string")
    return roles.table(spark, sf_dir, "events").select(
        "event_id",
        doc["k"].try_cast("long").alias("k"),
        F.col("event_type").try_cast("long").isNull().alias("no_number"),
        F.col("value").cast("string").try_cast("double").alias("value"),
        doc["missing"].isNull().alias("without_field"),
    )


def _checked_rows(spark, sf_dir):
    """Rows whose text columns are partly missing, 'null' or of the wrong type."""
    kind = F.col("event_type")
    rows = roles.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", "null").when(kind != "view", kind).alias("game"),
        roles.stream_name().alias("name"),
        F.col("props").alias("status"),
        F.when(kind == "signup", kind).otherwise(F.col("value").cast("string")).alias("amount"),
    )
    return rows.withColumn("amount", F.col("amount").try_cast("double"))


@query("valid_records", """
SELECT event_id, event_type AS game, value AS amount FROM events
WHERE event_type IN ('click', 'purchase')""")
def valid_records(spark, sf_dir):
    """F3, F4"""
    rows = quality.required_fields(_checked_rows(spark, sf_dir))
    return quality.not_null(rows, "amount").select("event_id", "game", "amount")


@query("quarantined_records", """
SELECT event_id, event_type = 'signup' AS bad_amount FROM events
WHERE event_type NOT IN ('click', 'purchase')""")
def quarantined_records(spark, sf_dir):
    """The complement."""
    rule = F.col("amount").isNotNull() & F.nullif(F.col("game"), F.lit("null")).isNotNull()
    _, bad = quality.split_valid(_checked_rows(spark, sf_dir), rule)
    return bad.select("event_id", F.col("amount").isNull().alias("bad_amount"))


@query("chat_ingest", """
SELECT 's' || d.source AS channel, count(*) AS messages,
       CAST(sum(length(d.text)) AS BIGINT) AS chars,
       CAST(sum(CASE WHEN l.toxic = 1 THEN 2 WHEN l.quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS codes
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.doc_id IS NULL OR l.quality = 1 OR l.toxic = 1 GROUP BY 1""")
def chat_ingest(spark, sf_dir):
    """Messages with an unlabelled score are dropped."""
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
    scores = roles.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("msg_id"), label.alias("label")
    )
    messages = roles.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("msg_id"),
        F.lit("2024-01-01").cast("timestamp").alias("ts"),
        F.concat(F.lit("#s"), "source").alias("channel"),
        F.col("text").alias("msg"),
    )
    chat = ingest.ingest_chat(messages, scores)
    return chat.groupBy("channel").agg(
        F.count("*").alias("messages"),
        F.sum(F.length("msg")).alias("chars"),
        F.sum("sentiment").alias("codes"),
    )
