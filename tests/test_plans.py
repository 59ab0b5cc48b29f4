"""Plans: what must never appear in them, and what must."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from streamtide.operators import joins, rollups, wide
from streamtide.plans import ingest
from streamtide.session import stored

DATA = "/root/testdata/sf0.001"

# queries that only build a plan when called; the others write a table first
LAZY = [
    "viewers_per_minute", "viewers_per_hour", "chat_sentiment_per_minute", "session_summary",
    "session_reaggregate", "training_rows", "weather_latest", "weather_text", "new_users",
    "known_users", "stream_day", "stream_day_minutes", "day_rollup", "minute_lookup",
    "document_sentiment", "sentiment_series", "dashboard_series", "dashboard_details",
    "stream_page_rows", "weather_from_json", "bag_text_import", "cut_text", "time_keys",
    "latest_per_stream", "newest_batch", "chat_ingest", "stream_day_all", "merge_partials",
]


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")
@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = physical(driver.queries()[name](spark, DATA))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "PandasUDF", "Arrow"):
        assert operator not in plan


def columns_read(frame):
    plan = physical(frame)
    return {p.split(":")[0] for p in plan.split("ReadSchema: struct<")[1].split(">")[0].split(",")}


def test_rollups_read_only_their_columns(spark, tmp_path):
    path = str(tmp_path / "samples")
    spark.sql(
        "select 1L channel_id, 2L viewers, 'g' game, 'n' name, 's' status, "
        "timestamp'2024-01-01 00:00:00' created, true mature, 1D fps"
    ).write.parquet(path)
    samples = spark.read.parquet(path)
    assert columns_read(rollups.viewers_per_bucket(samples)) == {"name", "created", "viewers"}
    assert "GreaterThan(viewers,500)" in physical(ingest.sessions_of(samples))


@pytest.mark.parametrize("build", [
    rollups.viewers_per_bucket, ingest.sessions_of,
    lambda s: rollups.latest_per_key(s, ["name"], ["created"]),
    lambda s: wide.metadata_entries(s),
])
def test_every_rollup_reduces_before_its_only_shuffle(spark, build):
    samples = spark.sql(
        "select id viewers, 'g' game, 'n' name, 's' status, "
        "timestamp'2024-01-01 00:00:00' created, true mature, 1D fps from range(10)"
    )
    plan = physical(build(samples))
    assert plan.count("Exchange") == 1
    assert "partial_" in plan[plan.index("Exchange"):]


def test_the_wide_row_adds_one_shuffle_to_its_inputs(spark):
    samples = spark.sql(
        "select id viewers, 'g' game, 'n' name, 's' status, "
        "timestamp'2024-01-01 00:00:00' created, true mature, 1D fps from range(10)"
    )
    chat = spark.sql("select 'n' channel, 1 sentiment, timestamp'2024-01-01 00:00:00' ts")
    table = wide.stream_day(
        samples, rollups.viewers_per_bucket(samples), rollups.chat_per_bucket(chat), F.lit(None)
    )
    plan = physical(table)
    assert plan.count("hashpartitioning(name") >= 1
    # after the union of the three inputs there is a single exchange
    assert plan[:plan.index("Union")].count("Exchange") == 1


def test_a_small_stored_table_is_broadcast_by_its_size(spark, tmp_path):
    requests = spark.range(5).selectExpr(
        "id", "'Morgens' daytime", "timestamp_seconds(1704067200 + id) day"
    )
    forecast = spark.createDataFrame(
        [("p", 0, "2024-01-01 06:00:00", "Clear", 1.5, 2.0)],
        "place string, pos int, dt_txt string, main string, wind double, temp double",
    )
    slots = stored(joins.forecast_by_slot(forecast, ["p"]), "slots")
    joined = joins.join_forecast(requests, slots, ["p"])
    assert "BroadcastHashJoin" in physical(joined) and "SortMergeJoin" not in physical(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = joins.join_forecast(requests, slots, ["p"])
        assert "SortMergeJoin" in physical(shuffled)
        assert shuffled.where("weather = 'Clear 1.5 2.0'").count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
