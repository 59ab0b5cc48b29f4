"""Properties over generated rows, checked against plain Python."""

from collections import defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamtide.functions import bags, classes, text
from streamtide.operators import rollups, wide

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
START = datetime(2024, 1, 1)

polls = st.lists(st.tuples(
    st.sampled_from(["a", "b", "hot", "hot", "hot"]),
    st.integers(0, 5000) | st.none(),
    st.integers(0, 3 * 24 * 3600),
), min_size=1, max_size=60)


@FEW
@given(polls)
def test_viewer_minutes_equal_a_plain_loop(spark, rows):
    frame = spark.createDataFrame(
        [(n, v, START + timedelta(seconds=s)) for n, v, s in rows],
        "name string, viewers long, created timestamp",
    )
    expected = defaultdict(list)
    for name, viewers, second in rows:
        expected[name, START + timedelta(seconds=second // 60 * 60)].append(viewers)
    got = {(r.name, r.minute): (r.viewers_sum, r.viewers_cnt)
           for r in rollups.viewers_per_bucket(frame).collect()}
    assert got == {
        key: (sum(v for v in values if v is not None) if any(v is not None for v in values) else None,
              sum(v is not None for v in values))
        for key, values in expected.items()
    }


@FEW
@given(polls, st.integers(1, 4))
def test_split_bags_hold_every_poll(spark, rows, block):
    frame = spark.createDataFrame(
        [(n, "g", str(v), None, float(v or 0), START + timedelta(seconds=s)) for n, v, s in rows],
        "name string, game string, status string, mature boolean, fps double, created timestamp",
    )
    table = wide.stream_day(
        frame, rollups.viewers_per_bucket(frame.selectExpr("*", "1L viewers")),
        rollups.chat_per_bucket(frame.selectExpr("name channel", "1 sentiment", "created ts")),
        F.lit(None).cast("timestamp"),
    )
    assert wide.merged_viewers(table).agg(F.sum("viewers_sum")).first()[0] == len(rows)
    assert wide.merged_chat(table).agg(F.sum("positive")).first()[0] == len(rows)
    back = wide.repeat_polls(wide.flatten(table, "metadata"), block=block)
    columns = ["name", "game", "status", "mature", "fps", "created"]
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, back.select(columns).collect()), key=order) == sorted(
        map(tuple, frame.select(columns).collect()), key=order
    )


@FEW
@given(st.lists(st.tuples(
    st.text("abc {}x", min_size=1, max_size=5), st.integers(-9, 9) | st.none()
), max_size=5))
def test_bag_text_round_trip(spark, items):
    frame = spark.createDataFrame([(items,)], "x array<struct<k: string, n: bigint>>")
    column = bags.parse_bag(bags.bag_text(F.col("x"), "k", "n"), {"k": "string", "n": "long"})
    assert [tuple(r) for r in frame.select(column).first()[0]] == items


@FEW
@given(st.lists(st.floats(0, 500, allow_nan=False), min_size=1, max_size=30))
def test_numbers(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    rows = frame.select(
        text.hours_to_time(F.col("x")), classes.viewer_class(F.col("x") * 100)
    ).collect()
    for value, (clock, cls) in zip(values, rows, strict=True):
        hours, minutes = clock.split(":")
        assert len(minutes) == 2 and int(minutes) < 60 and len(hours) >= 2
        assert abs(int(hours) * 60 + int(minutes) - value * 60) <= 0.5 + 1e-6
        assert abs(cls * 1000 - value * 100) <= 500 + 1e-6


@FEW
@given(st.text("ab \n", max_size=12), st.integers(1, 8))
def test_cut_at_a_word(spark, value, limit):
    frame = spark.createDataFrame([(value,)], "x string")
    got = frame.select(text.cut_text(F.col("x"), limit, wordwise=True)).first()[0]
    if len(value) <= limit:
        assert got == value
    else:
        head = value[:limit]
        assert got == (head[:head.rindex(" ")] if " " in head else head) + " …"
