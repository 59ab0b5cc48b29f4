from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from streamtide.functions import bags, classes, text, times



def test_clean_name_and_replacements(values):
    rows = [("a b,c",), (None,), (";x#;",)]
    assert values(rows, "x string", text.clean_name(F.col("x"))) == ["a_b_c", None, ";x#;"]
    assert values([("a,b",)], "x string", text.commas_to_blanks(F.col("x"))) == ["a b"]
    assert values([("a;b;",)], "x string", text.strip_separator(F.col("x"))) == ["ab"]
    assert values([("a,b",)], "x string", text.message_text(F.col("x"))) == ["a;b"]
    assert values([("#chan",)], "x string", text.channel_name(F.col("x"))) == ["chan"]


def test_join_key_is_null_with_a_null_part(values):
    key = text.join_key(F.col("x"), F.lit("20240101"))
    assert values([("a",), (None,)], "x string", key) == ["a20240101", None]


def test_fields_beyond_the_split_are_null(values):
    first, _, third = text.fields(F.col("x"), ",", 3)
    assert values([("a,b",)], "x string", F.struct(first, third)) == [("a", None)]


def test_full_match_covers_the_whole_value(values):
    rows = [("2024-01-01T00:00",), ("2024-01-01 00:00",), (None,), ("T\n",)]
    assert values(rows, "x string", text.full_match(F.col("x"), ".*T.*")) == [True, False, None, False]


def test_decode_and_drop_last(values):
    assert values([("YWJj",)], "x string", text.decode_cell(F.col("x"))) == ["abc"]
    assert values([("abc",), ("",), (None,)], "x string", text.drop_last_char(F.col("x"))) == ["ab", "", None]


@pytest.mark.parametrize("value, limit, wordwise, expected", [
    ("short", 10, False, "short"),
    ("exactly ten", 11, True, "exactly ten"),
    ("one two three", 9, False, "one two t …"),
    ("one two three", 9, True, "one two …"),
    ("onetwothree", 5, True, "onetw …"),
    (" lead", 3, True, " …"),
    (None, 5, False, ""),
    ("anything", 0, False, "anything"),
])
def test_cut_text(values, value, limit, wordwise, expected):
    column = text.cut_text(F.col("x"), limit, wordwise)
    assert values([(value,)], "x string", column) == [expected]


def test_hours_to_time(values):
    rows = [(1.5,), (123.5,), (1.999,), (0.0,), (9.25,), (None,)]
    assert values(rows, "x double", text.hours_to_time(F.col("x"))) == [
        "01:30", "123:30", "02:00", "00:00", "09:15", None
    ]


def test_time_parsing(values):
    rows = [("2024-03-01 10:11:12",), ("2024-03-01",), ("junk",), (None,)]
    assert values(rows, "x string", times.parse_poll_time(F.col("x"))) == [
        datetime(2024, 3, 1, 10, 11, 12), None, None, None
    ]
    rows = [("2024-03-01T10:11:12+02:00",), ("junk",)]
    assert values(rows, "x string", F.date_format(times.parse_iso(F.col("x")), "yyyyMMddHHmmss")) == [
        "20240301081112", None
    ]
    assert values([("202403011011",), ("x",)], "x string", times.from_minute_key(F.col("x"))) == [
        datetime(2024, 3, 1, 10, 11), None
    ]
    assert values([(1709287872123,)], "x long", F.date_format(times.from_epoch_ms(F.col("x")), "HHmmss")) == [
        "101112"
    ]


def test_keys_of_a_run(values):
    rows = [(datetime(2024, 3, 1, 11, 53, 7),)]
    column = F.struct(
        times.run_suffix(F.col("x")), times.run_stamp(F.col("x")), times.minute_key(F.col("x")), times.hour_key(F.col("x")),
        times.day_key(F.col("x")),
    )
    assert values(rows, "x timestamp", column) == [
        ("#1153", "2024-03-01T11-53-07", "202403011153", "2024030111", "20240301")
    ]


def test_bucket_start_and_next_day(values):
    rows = [(datetime(2024, 2, 28, 11, 53, 59, 999000),)]
    assert values(rows, "x timestamp", times.bucket_start(F.col("x"))) == [datetime(2024, 2, 28, 11, 53)]
    assert values(rows, "x timestamp", times.bucket_start(F.col("x"), "1 hour")) == [datetime(2024, 2, 28, 11)]
    assert values(rows, "x timestamp", times.bucket_start(F.col("x"), "10 minutes")) == [
        datetime(2024, 2, 28, 11, 50)
    ]
    assert values(rows, "x timestamp", times.bucket_start(F.col("x"), "1 day")) == [
        datetime(2024, 2, 28)
    ]
    assert values([(date(2024, 2, 29),)], "x date", times.next_day(F.col("x"))) == [date(2024, 3, 1)]


def test_minutes_between_counts_whole_seconds(spark):
    rows = [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 1, 30, 899999))]
    frame = spark.createDataFrame(rows, "a timestamp, b timestamp")
    assert frame.select(times.minutes_between(F.col("a"), F.col("b"))).first()[0] == 89 / 60


def test_sentiment_code(values):
    rows = [("positive",), ("negative",), ("neutral",), ("odd",), (None,)]
    assert values(rows, "x string", classes.sentiment_code(F.col("x"))) == [1, 2, 0, 0, 0]


def test_daytime_class_and_label(values):
    hours = [5, 6, 11, 12, 14, 15, 17, 18, 21, 22]
    rows = [(datetime(2024, 1, 1, h),) for h in hours] + [(None,)]
    assert values(rows, "x timestamp", classes.daytime_class(F.col("x"))) == [
        1, 2, 2, 3, 3, 4, 4, 5, 5, 1, None
    ]
    rows = [(1,), (2,), (3,), (4,), (5,), (9,), (None,)]
    assert values(rows, "x int", classes.daytime_label(F.col("x"))) == [
        "Nachts", "Morgens", "Mittags", "Nachmittags", "Abends", "Abends", None
    ]


def test_forecast_time(values):
    day = F.lit("2024-03-01 20:00:00").cast("timestamp")
    rows = [("Morgens",), ("Mittags",), ("Nachmittags",), ("Abends",), ("Nachts",), ("x",), (None,)]
    hours = ["06", "12", "15", "18", "21", "12", "12"]
    assert values(rows, "x string", classes.forecast_time(day, F.col("x"))) == [
        f"2024-03-01 {h}:00:00" for h in hours
    ]


def test_viewer_class_and_range(values):
    rows = [(499.0,), (500.0,), (1499.0,), (1500.0,), (None,)]
    assert values(rows, "x double", classes.viewer_class(F.col("x"))) == [0, 1, 1, 2, None]
    assert values(rows, "x double", classes.viewer_class(F.col("x"), "floor")) == [0, 0, 1, 1, None]
    assert values([(0,), (2,)], "x int", classes.range_text(F.col("x"))) == ["0 bis 500", "1500 bis 2500"]
    assert values([(0,), (2,)], "x int", classes.range_text(F.col("x"), "floor")) == [
        "0 bis 1000", "2000 bis 3000"
    ]
    with pytest.raises(ValueError):
        classes.viewer_class(F.col("x"), "ceil")


def test_kelvin_to_celsius(values):
    rows = [(273.0,), (285.444,), (None,)]
    assert values(rows, "x double", classes.kelvin_to_celsius(F.col("x"))) == [0.0, 12.44, None]
    assert values([(273.15,)], "x double", classes.kelvin_to_celsius(F.col("x"), 273.15)) == [0.0]


def test_parse_bag(values):
    column = bags.parse_bag(F.col("x"), {"key": "string", "n": "long"})
    rows = [("{}",), ("{(a,1)}",), ("{(a,1),(b,x)}",), (None,), ("",)]
    assert values(rows, "x string", column) == [
        [], [("a", 1)], [("a", 1), ("b", None)], None, []
    ]


def test_bag_text_round_trip(values):
    column = bags.parse_bag(
        bags.bag_text(F.col("x"), "key", "n"), {"key": "string", "n": "long"}
    )
    rows = [([("a", 1), ("b", None)],), ([],)]
    assert values(rows, "x array<struct<key: string, n: bigint>>", column) == [
        [("a", 1), ("b", None)], []
    ]


def test_metadata_bag_keeps_commas_of_the_status(values):
    cell = "{(k,n,g,a, b,c,true,60.0,2024-01-01T10:00:00Z),(k,n,g,plain,false,30.5,2024-01-01T10:10:00Z)}"
    got = values([(cell,)], "x string", bags.parse_metadata_bag(F.col("x")))[0]
    assert [(r.game, r.status, r.mature, r.fps) for r in got] == [
        ("g", "a, b,c", True, 60.0), ("g", "plain", False, 30.5)
    ]
    assert got[1].created == datetime(2024, 1, 1, 10, 10)
