from datetime import date, datetime

import pandas as pd
import pytest
from rows import rows_of
from pyspark.sql import functions as F

from streamtide.operators import joins, rollups, series
from streamtide.plans import discovery, ingest

SAMPLE = "name string, game string, viewers long, fps double, created timestamp"


def at(hour=0, minute=0, second=0, day=1, micro=0):
    return datetime(2024, 1, day, hour, minute, second, micro)


def test_viewers_per_minute(spark):
    rows = spark.createDataFrame([
        ("a", "g", 100, 1.0, at(second=1)), ("a", "g", 300, 1.0, at(second=59, micro=999000)),
        ("a", "g", 7, 1.0, at(minute=1)), ("b", "g", None, 1.0, at()), (None, "g", 1, 1.0, at()),
    ], SAMPLE)
    minutes = rollups.viewers_per_bucket(rows)
    assert rows_of(minutes, "name", "minute", "viewers_sum", "viewers_cnt", "viewers") == [
        (None, at(), 1, 1, 1.0),
        ("a", at(), 400, 2, 200.0),
        ("a", at(minute=1), 7, 1, 7.0),
        ("b", at(), None, 0, None),
    ]


def test_merged_halves_equal_the_whole(spark):
    rows = spark.range(500).selectExpr(
        "concat('n', id % 3) name", "'g' game", "id viewers", "1D fps",
        "timestamp_seconds(1704067200 + id * 7) created",
    )
    whole = rollups.viewers_per_bucket(rows)
    halves = rollups.viewers_per_bucket(rows.where("viewers % 5 < 2")).unionByName(
        rollups.viewers_per_bucket(rows.where("viewers % 5 >= 2"))
    )
    assert rows_of(rollups.merge_viewers(halves), *whole.columns) == rows_of(whole)


def test_sentiment_counts(spark):
    rows = spark.createDataFrame(
        [("c", s, at()) for s in (0, 1, 1, 2, 3, None)] + [("d", None, at())],
        "channel string, sentiment int, ts timestamp",
    )
    assert rows_of(rollups.chat_per_bucket(rows), "name", "positive", "negative", "neutral") == [
        ("c", 2, 1, 1), ("d", None, None, None)
    ]


def test_session_summary(spark):
    rows = spark.createDataFrame([
        ("a b", "g,x", 600, 60.0, at(5)), ("a b", "g,x", 800, 30.0, at(6, 30, 30)),
        ("a_b", "g,x", 1000, 30.0, at(6)), ("a b", "g,x", 500, 60.0, at(1)),
        ("single", "g", 501, 60.0, at(22)), ("single", "h", 501, None, at(22)),
    ], SAMPLE)
    got = rows_of(
        ingest.sessions_of(rows), "name", "game", "viewers", "fps", "dur", "daytime", "polls"
    )
    assert got == [("a_b", "g_x", 800.0, 40.0, 90.5, 1, 3), ("single", "g", 501.0, 60.0, 0.0, 1, 1)]


def test_reaggregate_is_a_mean_of_means(spark):
    rows = spark.createDataFrame([
        ("n", "g", 10.0, 3, 60.0, 1000.0, at(12, day=2), 1),
        ("n", "g", 20.0, 2, 30.0, 2000.0, at(9), 3),
    ], "name string, game string, dur double, daytime int, fps double, viewers double, "
       "starttime timestamp, polls long")
    columns = ["dur", "daytime", "fps", "viewers", "starttime"]
    assert rows_of(rollups.reaggregate_sessions(rows), *columns) == [
        (30.0, 2, 45.0, 1500.0, at(9))
    ]
    assert rows_of(rollups.reaggregate_sessions(rows, weight="polls"), *columns) == [
        (30.0, 2, 37.5, 1750.0, at(9))
    ]


def test_latest_weather(spark):
    rows = spark.createDataFrame([
        ("2024010100", "p", "Rain", "1", 1.0, at(0, 50), 2),
        ("2024010100", "p", "Clear", "2", 2.0, at(0, 10), 1),
        ("2024010100", "p", "Fog", "3", 3.0, at(0, 50), 1),
        ("2024010100", "q", "Snow", "4", 4.0, at(0, 1), 1),
    ], "hour_key string, place string, main string, wind string, temp double, "
       "obs_ts timestamp, seq int")
    assert rows_of(ingest.latest_weather(rows, "seq"), "place", "main") == [
        ("p", "Rain"), ("q", "Snow")
    ]


OBS = "hour_key string, place string, main string, wind string, temp double"


def weather(spark):
    return spark.createDataFrame([
        ("h1", "p", "Rain", "1.5", 2.0), ("h1", "q", "Fog", "2", -1.25),
        ("h2", "p", "Clear", "3", 4.0), ("h1", "elsewhere", "Snow", "9", 0.0),
    ], OBS)


def test_weather_join(spark):
    hours = joins.weather_by_hour(weather(spark), ["p", "q"])
    assert {k: sorted(v) for k, v in hours.collect()} == {"h1": ["p", "q"], "h2": ["p"]}
    rows = spark.createDataFrame([("h1",), ("h2",), ("h3",), (None,)], "weatherkey string")
    strict = joins.join_weather(rows, hours, ["q", "p"])
    assert rows_of(strict, "weatherkey", "weather") == [
        (None, ""), ("h1", "Fog 2 -1.25 Rain 1.5 2.0"), ("h2", ""), ("h3", "")
    ]
    loose = joins.join_weather(rows, hours, ["q", "p"], strict=False)
    assert rows_of(loose, "weatherkey", "weather")[2] == ("h2", "Clear 3 4.0")


def test_attach_sentiment(spark):
    messages = spark.createDataFrame([(i, "c") for i in range(1, 6)], "msg_id long, channel string")
    scores = spark.createDataFrame(
        [(1, "positive"), (2, "negative"), (3, "neutral"), (4, None)], "msg_id long, label string"
    )
    got = joins.attach_sentiment(messages, scores)
    assert rows_of(got, "msg_id", "sentiment") == [(1, 1), (2, 2), (3, 0), (5, 0)]


def test_pluggable_scorer(spark):
    def scorer(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: "positive" if "good" in t else "negative")

    rows = spark.createDataFrame([("good",), ("bad",)], "msg string")
    assert rows_of(joins.score_messages(rows, scorer)) == [("bad", 2), ("good", 1)]


def test_forecast_join(spark):
    requests = spark.createDataFrame([
        (1, "Morgens", at(20)), (2, "gleich", at(20)), (3, "Nachts", at(20)),
    ], "id long, daytime string, day timestamp")
    forecast = spark.createDataFrame([
        ("p", 1, "2024-01-01 06:00:00", "Second", 1.0, 1.0),
        ("p", 0, "2024-01-01 06:00:00", "First", 1.5, 2.25),
        ("q", 0, "2024-01-01 06:00:00", "Fog", 3.0, 4.0),
        ("q", 1, "2024-01-01 12:00:00", "Rain", 5.0, 6.0),
        ("q", 2, "2024-01-01 21:00:00", "Rain", 5.0, None),
    ], "place string, pos int, dt_txt string, main string, wind double, temp double")
    slots = joins.forecast_by_slot(forecast, ["p", "q"])
    got = joins.join_forecast(requests, slots, ["p", "q"])
    assert rows_of(got, "id", "weather") == [
        (1, "First 1.5 2.25 Fog 3.0 4.0"), (2, "Rain 5.0 6.0"), (3, "")
    ]


def test_new_and_known_channels(spark):
    rows = spark.createDataFrame(
        [("old", 1), ("known", 2), ("new", 2), ("new", 2), ("other", 2)], "name string, run int"
    )
    active = spark.createDataFrame([("known",), ("known",)], "name string")
    assert rows_of(discovery.new_channels(rows, active)) == [("new",), ("other",)]
    assert rows_of(discovery.new_channels(rows, active, allowed=["new"])) == [("new",)]
    assert rows_of(joins.known_names(rows, active)) == [("known",)]


def test_newest_batch_is_filtered_by_a_subquery(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id div 3 batch").write.partitionBy("batch").parquet(path)
    newest = rollups.newest_batch(spark.read.parquet(path), "batch")
    assert rows_of(newest, "id") == [(9,)]
    assert "PartitionFilters: [isnotnull(batch" in newest._jdf.queryExecution().executedPlan().toString()


def test_minute_lookup(spark):
    minutes = spark.createDataFrame(
        [("n", at(minute=1), 5.0), ("n", at(minute=2), 6.0)],
        "name string, minute timestamp, viewers double",
    )
    metadata = spark.createDataFrame([
        ("n", at(minute=1, second=5), "early", "s", 1.0),
        ("n", at(minute=1, second=50), "late", "s", 2.0),
        ("n", at(day=2, minute=2), "other day", "s", 2.0),
    ], "name string, created timestamp, game string, status string, fps double")
    got = joins.minute_lookup(minutes, metadata)
    assert rows_of(got, "viewers", "game") == [(5.0, "late"), (6.0, None)]


def test_series_and_order(spark):
    rows = spark.createDataFrame(
        [("n", at(minute=1), 1, 2, 3), ("n", at(minute=0), 4, 5, 6)],
        "name string, minute timestamp, positive long, negative long, neutral long",
    )
    ordered = [tuple(r)[1:] for r in series.time_ordered(series.sentiment_series(rows)).collect()]
    assert ordered == [
        ("negative", at(minute=0), 5.0), ("negative", at(minute=1), 2.0),
        ("neutral", at(minute=0), 6.0), ("neutral", at(minute=1), 3.0),
        ("positive", at(minute=0), 4.0), ("positive", at(minute=1), 1.0),
    ]


@pytest.mark.parametrize("reverse, expected", [(False, ["a", "B", "c"]), (True, ["c", "B", "a"])])
def test_sort_ignoring_case(spark, reverse, expected):
    rows = spark.createDataFrame([("B",), ("c",), ("a",)], "f string")
    assert [r.f for r in series.sort_ignoring_case(rows, "f", reverse).collect()] == expected


def test_sorted_files(spark):
    rows = spark.createDataFrame([(10,), (9,), (1,)], "id long").coalesce(1)
    assert [r.id for r in series.sorted_files(rows, "id").collect()] == [1, 10, 9]


def test_day_column_of_buckets(spark):
    rows = spark.createDataFrame([("a", "g", 1, 1.0, at(23, 59, 59))], SAMPLE)
    assert rows_of(rollups.viewers_per_bucket(rows), "day") == [(date(2024, 1, 1),)]


def test_minute_rollups_of_raw_polls(spark):
    raw = spark.createDataFrame([
        (1, 10, "g", "n", "s", "2024-01-01 00:00:05", True, "u", 1.0),
        (1, 30, "g", "n", "s", "2024-01-01T00:00:05", True, "u", 1.0),
        (1, 30, "g", "n", "s", None, True, "u", 1.0),
    ], "channel_id long, viewers long, game string, name string, status string, "
       "created string, mature boolean, updated_at string, fps double")
    chat = spark.createDataFrame([("n", 1, at())], "channel string, sentiment int, ts timestamp")
    viewers, counts = ingest.minute_rollups(raw, chat)
    assert rows_of(viewers, "name", "viewers") == [("n", 10.0)]
    assert counts.select(F.sum("positive")).first()[0] == 1
