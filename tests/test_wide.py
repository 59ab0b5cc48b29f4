from datetime import date, datetime

import pytest
from rows import rows_of
from pyspark.sql import functions as F

from streamtide.functions import times
from streamtide.operators import rollups, wide
from streamtide.plans import dashboard
from streamtide.sinks import tables as sinks
from streamtide.sources import tables

POLL = "name string, game string, status string, mature boolean, fps double, viewers long, created timestamp"
CHAT = "channel string, sentiment int, ts timestamp"


def at(hour=0, minute=0, second=0, day=1):
    return datetime(2024, 1, day, hour, minute, second)


def polls(spark):
    return spark.createDataFrame([
        ("a", "g", "s", True, 60.0, 100, at(10, 0, 30)),
        ("a", "g", "s", True, 60.0, 300, at(10, 0, 0)),
        ("a", "h", "s", None, None, 50, at(10, 1)),
        ("a", "g", "s", True, 60.0, 10, at(10, day=2)),
        ("silent", "g", "s", True, 60.0, 5, at(9)),
        (None, "g", "s", True, 60.0, 1, at(9)),
    ], POLL)


def chat(spark):
    return spark.createDataFrame([
        ("a", 1, at(10, 0, 1)), ("a", 2, at(10, 0, 2)), ("a", 0, at(10, 5)),
        ("ghost", 1, at(10)), (None, 1, at(10)),
    ], CHAT)


def build(spark, run="2024-01-03 11:53:00", **options):
    rows = polls(spark)
    return wide.stream_day(
        rows, rollups.viewers_per_bucket(rows), rollups.chat_per_bucket(chat(spark)),
        times.run_time(run), **options,
    )


def whole(table):
    """The parts of each stream and day put together."""
    rows = {}
    for r in table.collect():
        lists = rows.setdefault((r.name, r.day.day), {bag: [] for bag in wide.BAGS})
        for bag in wide.BAGS:
            lists[bag] = sorted(lists[bag] + r[bag])
    return rows


def test_stream_day_keeps_streams_with_metadata(spark):
    table = build(spark)
    assert {r.run_ts for r in table.collect()} == {datetime(2024, 1, 3, 11, 53)}
    rows = whole(table)
    assert set(rows) == {("a", 1), ("a", 2), ("silent", 1)}
    row = rows["a", 1]
    assert [(m.created, m.game, m.polls) for m in row["metadata"]] == [
        (at(10, 0, 0), "g", 1), (at(10, 0, 30), "g", 1), (at(10, 1), "h", 1)
    ]
    assert [(v.minute, v.viewers_sum, v.viewers_cnt, v.viewers) for v in row["viewerspermin"]] == [
        (at(10, 0), 400, 2, 200.0), (at(10, 1), 50, 1, 50.0)
    ]
    assert [tuple(c)[1:] for c in row["chatspermin"]] == [(1, 1, 0), (0, 0, 1)]
    assert rows["silent", 1]["chatspermin"] == []


def test_full_form_keeps_chat_without_metadata(spark):
    rows = whole(build(spark, how="full"))
    assert [name for (name, _), lists in rows.items() if not lists["metadata"]] == ["ghost"]
    with pytest.raises(ValueError):
        build(spark, how="inner")


def test_flatten_drops_rows_with_an_empty_list(spark):
    rows = wide.flatten(build(spark), "chatspermin")
    assert rows_of(rows, "name", "minute") == [("a", at(10)), ("a", at(10, 5))]


def test_row_key(spark):
    key = wide.row_key(times.run_suffix("run_ts"))
    keys = {r[0] for r in build(spark).select(key).collect()}
    assert keys == {"a20240101#1153", "a20240102#1153", "silent20240101#1153"}


def large(spark, copies=1):
    """One stream and day with 900 different polls and 600 equal ones, beside small ones."""
    different = spark.range(900).selectExpr(
        "'hot' name", "concat('g', id % 7) game", "cast(id as string) status", "true mature",
        "1D fps", "id viewers", "timestamp_seconds(1704067200 + id * 90) created",
    )
    equal = spark.range(600).selectExpr(
        "'hot' name", "'same' game", "'same' status", "true mature", "1D fps", "1L viewers",
        "timestamp'2024-01-01 12:00:00' created",
    )
    small = spark.range(20).selectExpr(
        "concat('n', id) name", "'g' game", "'s' status", "true mature", "1D fps", "id viewers",
        "timestamp'2024-01-01 12:00:00' created",
    )
    return different.unionAll(equal).unionAll(small)


def table_of(spark, rows):
    return wide.stream_day(
        rows, rollups.viewers_per_bucket(rows),
        rollups.chat_per_bucket(spark.createDataFrame([], CHAT)), times.run_time("2024-01-03 11:53:00"),
    )


def test_parts_follow_from_the_entries_and_stay_whole(spark):
    rows = large(spark)
    table = table_of(spark, rows)
    parts = {r[0] for r in table.where("name = 'hot'").select("part").collect()}
    assert 60 < len(parts) <= 24 * wide.SLICES and parts <= set(range(24 * wide.SLICES))
    hours = table.select("part", F.inline("metadata")).selectExpr(f"part div {wide.SLICES} = hour(created)")
    assert {r[0] for r in hours.collect()} == {True}
    back = wide.repeat_polls(wide.flatten(table, "metadata"), block=100)
    columns = ["name", "created", "game", "status", "mature", "fps"]
    assert rows_of(back, *columns) == rows_of(rows, *columns)
    minutes = rollups.viewers_per_bucket(rows)
    assert rows_of(wide.merged_viewers(table), *minutes.columns) == rows_of(minutes)


def test_the_number_of_rows_does_not_depend_on_a_count(spark):
    rows = large(spark)
    once, often = (table_of(spark, r) for r in (rows, rows.unionAll(rows).unionAll(rows)))
    assert rows_of(once, "name", "day", "part") == rows_of(often, "name", "day", "part")


def test_plan_has_no_join_and_reads_each_input_once_per_list(spark, tmp_path):
    polls(spark).write.parquet(str(tmp_path / "polls"))
    chat(spark).write.parquet(str(tmp_path / "chat"))
    rows = spark.read.parquet(str(tmp_path / "polls"))
    table = wide.stream_day(
        rows, rollups.viewers_per_bucket(rows),
        rollups.chat_per_bucket(spark.read.parquet(str(tmp_path / "chat"))), times.run_time("2024-01-03 11:53:00"),
    )
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and plan.count("Exchange hashpartitioning") <= 5 and "Join" not in plan


def test_day_rollup(spark):
    got = rows_of(wide.day_rollup(build(spark)), "name", "day", "viewers", "positive", "negative", "neutral")
    assert got == [
        ("a", date(2024, 1, 1), 125.0, 1, 1, 1),
        ("a", date(2024, 1, 2), 10.0, None, None, None),
        ("silent", date(2024, 1, 1), 5.0, None, None, None),
    ]


def test_two_runs_of_one_day(spark, tmp_path):
    path = str(tmp_path / "wide")
    sinks.write_stream_day(build(spark), path, "one")
    sinks.write_stream_day(build(spark, "2024-01-03 12:03:00"), path, "two")
    table = tables.read_stream_day(spark, path)
    assert {r.day for r in table.select("day").distinct().collect()} == {
        date(2024, 1, 1), date(2024, 1, 2)
    }
    both = dashboard.day_series(table, "A", "2024-01-01", merge=False)
    merged = dashboard.day_series(table, "A", "2024-01-01")
    assert both.count() == 2 * merged.count() == 16
    viewers = [(r.ts, r.value) for r in merged.collect() if r.series == "viewers"]
    assert viewers == [(at(10, 0), 200.0), (at(10, 1), 50.0)]
    positive = [r.value for r in merged.collect() if r.series == "positive"]
    assert positive == [2.0, 0.0]


def test_dashboard_details(spark):
    got = dashboard.minute_details(build(spark), "a", "2024-01-01")
    assert rows_of(got, "minute", "viewers", "game", "fps") == [
        (at(10, 0), 200.0, "g", 60.0), (at(10, 1), 50.0, "h", None)
    ]


def test_reading_one_bag_reads_one_column(spark, tmp_path):
    path = str(tmp_path / "wide")
    sinks.write_stream_day(build(spark), path, "one")
    rows = wide.flatten(tables.read_stream_day(spark, path, "viewerspermin"), "viewerspermin")
    plan = rows.select("name", "viewers")._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema"):]
    assert "chatspermin" not in read and "metadata" not in read


def test_project_entries(spark):
    slim = build(spark).select(wide.project_entries(F.col("viewerspermin"), "viewers").alias("v"))
    assert slim.schema["v"].dataType.simpleString() == "array<struct<viewers:double>>"


def test_one_stream_opens_few_row_groups(spark, tmp_path):
    """Clustered by name: the scan hands on the rows of a few row groups, not those of the day."""
    rows = spark.range(0, 60_000).selectExpr(
        "concat('s', id % 600) as name", "date'2024-01-01' + cast(id % 2 as int) as day", "timestamp'2024-01-01' as run_ts", "cast(id % 96 as int) as part",
        "array(named_struct('created', timestamp'2024-01-01', 'game', cast(id as string), 'status', 's', 'mature', true, 'fps', 1.0D, 'polls', 1L)) as metadata",
        "cast(null as array<struct<minute: timestamp, viewers_sum: bigint, viewers_cnt: bigint, viewers: double>>) as viewerspermin",
        "cast(null as array<struct<minute: timestamp, positive: bigint, negative: bigint, neutral: bigint>>) as chatspermin")
    path = str(tmp_path / "wide")
    sinks.write_stream_day(rows, path, "one", row_group_bytes=64 * 1024)
    own = tables.prefix_scan(tables.read_stream_day(spark, path), "S7", "2024-01-01")
    assert own.count() == 0
    own = tables.prefix_scan(tables.read_stream_day(spark, path), "S8", "2024-01-01")
    assert len(own.collect()) == 100
    plan = own._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().apply(0)
    assert 100 <= leaf.metrics().apply("numOutputRows").value() < 6_000  # of 30,000 of the day
