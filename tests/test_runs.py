"""From landed files to predictions, through every job."""

import json
from datetime import datetime

import pytest
from rows import rows_of
from pyspark.sql import functions as F

from streamtide import schemas
from streamtide.plans import dashboard, discovery, runs
from streamtide.sinks import tables as sinks
from streamtide.sources import documents, files, tables

PLACES = ["01067", "48149"]
FIRST, SECOND = "2024-01-01 13:00:00", "2024-01-01 13:10:00"


def land(folder, name, polls):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(
        f"1;{viewers};Some Game;{stream};live, now;{at};false;u;60.0" for stream, viewers, at in polls))


def polls_of(hour, day=1):
    return [(name, viewers, f"2024-01-{day:02} {hour}:{minute:02}:30")
            for minute in range(0, 60, 10) for name, viewers in (("big one", 4200), ("small", 700), ("tiny", 10))]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return tmp_path_factory.mktemp("root")


@pytest.fixture(scope="module")
def layout(spark, root):
    layout = runs.Layout(str(root / "tables"))
    land(root / "polls" / "2024" / "1" / "1", "part-00000", polls_of(12))
    spark.createDataFrame([
        (datetime(2024, 1, 1, 12, 0, 5), "big one", "hi", 1),
        (datetime(2024, 1, 1, 12, 0, 50), "big one", "no", 2),
        (datetime(2024, 1, 1, 12, 3), "nobody", "hm", 0),
    ], schemas.CHAT_MESSAGE).write.parquet(str(root / "chat"))
    for run in (FIRST, FIRST, SECOND):
        runs.minute_run(spark, layout, str(root / "polls"), str(root / "chat"), run)

    for place in PLACES:
        folder = root / "weather" / f"place={place}"
        folder.mkdir(parents=True)
        (folder / "now.json").write_text(json.dumps(
            {"weather": [{"main": "Rain"}], "main": {"temp": 280.5}, "wind": {"speed": 2}}
        ))
    (root / "weather" / "place=01067" / "bad.json").write_text("{")
    runs.weather_run(spark, layout, str(root / "weather"), FIRST)
    runs.weather_run(spark, layout, str(root / "weather"), SECOND)
    log = tables.read_weather(spark, layout.folder("weather"))
    past = log.drop("day", "batch").withColumn("hour_key", F.lit("2024010112"))
    sinks.append_weather(spark.createDataFrame(past.collect(), past.schema), layout.folder("weather"), "past")
    runs.training_run(spark, layout, PLACES, "2024-01-01")
    return layout


def test_landed_files_enter_one_run(spark, layout):
    samples = tables.read_runs(spark, layout.folder("samples"), schemas.CLEAN_SAMPLE)
    assert rows_of(samples.groupBy("run").count()) == [("2024-01-01T13-00-00", 18)]
    sessions = tables.read_runs(spark, layout.folder("sessions"), schemas.SESSION_ROW)
    assert rows_of(sessions, "name", "game", "dur", "polls", "run") == [
        ("big_one", "Some_Game", 50.0, 6, "2024-01-01T13-00-00"),
        ("small", "Some_Game", 50.0, 6, "2024-01-01T13-00-00"),
    ]


def test_dashboard_of_the_run(spark, layout):
    table = tables.read_stream_day(spark, layout.folder("stream_day"))
    assert rows_of(table.select("name").distinct()) == [("big one",), ("small",), ("tiny",)]
    rows = dashboard.day_series(table, "Big One", "2024-01-01")
    assert rows.where("series = 'viewers'").count() == 6
    assert rows_of(rows.where("series <> 'viewers'"), "series", "value") == [
        ("negative", 1.0), ("neutral", 0.0), ("positive", 1.0)
    ]
    details = dashboard.minute_details(table, "small", "2024-01-01")
    assert {r.status for r in details.collect()} == {"live, now"}


def test_one_day_reads_one_folder(spark, layout):
    table = tables.read_stream_day(spark, layout.folder("stream_day"), "viewerspermin")
    plan = tables.prefix_scan(table, "Small", "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert "day" in filters[:filters.index("]")] and "EqualTo(name,small)" in plan


def test_weather_log_and_quarantine(spark, layout):
    log = tables.read_weather(spark, layout.folder("weather"))
    assert log.count() == 4
    bad = spark.read.parquet(layout.folder("weather_quarantine"))
    assert rows_of(bad, "place", "body") == [("01067", "{")]


def test_training_set_and_prediction(spark, layout):
    training = spark.read.schema(schemas.TRAINING_ROW).parquet(layout.folder("training"))
    assert rows_of(training, "text", "target") == [
        ("big_one Some_Game 50.0 Mittags 60.0 Rain 2.0 7.5 Rain 2.0 7.5", 4.0),
        ("small Some_Game 50.0 Mittags 60.0 Rain 2.0 7.5 Rain 2.0 7.5", 1.0),
    ]
    requests = spark.createDataFrame(
        [(9, "big one", "Some Game", 50.0, "Mittags", 60.0, datetime(2024, 1, 2))],
        schemas.PREDICTION_REQUEST,
    )
    body = json.dumps({"list": [{
        "dt_txt": "2024-01-02 12:00:00", "wind": {"speed": 2.0}, "main": {"temp": 280.5},
        "weather": [{"main": "Rain"}],
    }]})
    docs = spark.createDataFrame([(body, p) for p in PLACES], "body string, place string")
    forecast = documents.forecast_rows(documents.forecast_parts(docs))
    got = runs.prediction_run(spark, layout, requests, forecast, PLACES)
    text = "big_one Some_Game 50.0 Mittags 60.0 Rain 2.0 7.5 Rain 2.0 7.5"
    assert rows_of(got, "id", "text", "viewer_class", "range_text") == [(9, text, 4.0, "3500 bis 4500")]
    assert text in {r.text for r in training.collect()}  # a request is worded as its training row


def test_new_channels_of_the_run(spark, layout):
    samples = tables.read_runs(spark, layout.folder("samples"), schemas.CLEAN_SAMPLE)
    active = spark.createDataFrame([("tiny",)], "name string")
    assert rows_of(discovery.new_channels(samples, active)) == [("big one",), ("small",)]


def test_places_from_a_file(spark, tmp_path):
    (tmp_path / "places.csv").write_text("\n".join(PLACES))
    assert rows_of(files.read_places(spark, str(tmp_path))) == [(p,) for p in PLACES]


def test_first_run_on_empty_folders(spark, tmp_path):
    for name in ("polls", "chat", "pages"):
        (tmp_path / name).mkdir()
    layout = runs.Layout(str(tmp_path / "tables"))
    for _ in range(2):
        runs.minute_run(spark, layout, str(tmp_path / "polls"), str(tmp_path / "chat"), FIRST, str(tmp_path / "pages"))
        assert tables.read_stream_day(spark, layout.folder("stream_day")).count() == 0


def test_pages_and_archive(spark, tmp_path):
    page = {"streams": [
        {"_id": 1, "viewers": 900, "average_fps": 30, "channel": {"game": "g", "name": "n", "status": "s"}}, {"_id": 2, "channel": "text"}]}
    for name in ("polls", "chat", "pages"):
        (tmp_path / name).mkdir()
    (tmp_path / "pages" / "1.json").write_text(json.dumps(page))
    layout = runs.Layout(str(tmp_path / "tables"), archive=str(tmp_path / "archive"))
    for k, run in enumerate((FIRST, SECOND)):
        land(tmp_path / "polls", f"{k}", polls_of(14 + k))
        runs.minute_run(spark, layout, str(tmp_path / "polls"), str(tmp_path / "chat"), run, str(tmp_path / "pages"))
    samples = tables.read_runs(spark, layout.folder("samples"), schemas.CLEAN_SAMPLE)
    assert rows_of(samples.groupBy("run").count()) == [("2024-01-01T13-00-00", 19), ("2024-01-01T13-10-00", 18)]
    bad = spark.read.parquet(layout.folder("pages_quarantine"))
    assert rows_of(bad, "element") == [('{"_id":2,"channel":"text"}',)]


def test_a_shrunken_run_leaves_nothing_behind(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-02")], "name string, day string")
    rows = rows.withColumn("day", F.col("day").cast("date"))
    sinks.write_stream_day(rows, str(tmp_path / "wide"), "one")
    sinks.write_stream_day(rows.limit(1), str(tmp_path / "wide"), "one")
    assert spark.read.parquet(str(tmp_path / "wide")).count() == 1
    sinks.write_run(rows, str(tmp_path / "run"), "one")
    sinks.write_run(rows.limit(0), str(tmp_path / "run"), "one")
    assert spark.read.schema("name string").parquet(str(tmp_path / "run")).count() == 0


def test_each_night_is_a_row(spark, tmp_path):
    (tmp_path / "chat").mkdir()
    layout = runs.Layout(str(tmp_path / "tables"))
    weather = [(f"2024010{day}12", p, "Rain", 2.0, 7.5, datetime(2024, 1, day, 12)) for day in (1, 2, 3) for p in PLACES]
    sinks.append_weather(spark.createDataFrame(weather, schemas.WEATHER_OBS), layout.folder("weather"), "all")
    for day in (1, 2, 3):
        land(tmp_path / "polls", f"{day}", polls_of(12, day))
        runs.minute_run(spark, layout, str(tmp_path / "polls"), str(tmp_path / "chat"), f"2024-01-0{day} 13:00:00")
        runs.training_run(spark, layout, PLACES, f"2024-01-0{day}")
    runs.training_run(spark, layout, PLACES, "2024-01-02")
    table = spark.read.schema(f"{schemas.TRAINING_ROW}, run string").parquet(layout.folder("training"))
    text = "Some_Game 50.0 Mittags 60.0 Rain 2.0 7.5 Rain 2.0 7.5"
    assert rows_of(table, "run", "text") == [
        (f"2024-01-0{d}", f"{n} {text}") for d in (1, 2, 3) for n in ("big_one", "small")]
    plan = runs.night_samples(spark, layout, "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


def test_a_run_of_the_evening_before_counts_for_the_night(spark, tmp_path):
    (tmp_path / "chat").mkdir()
    layout = runs.Layout(str(tmp_path / "tables"))
    land(tmp_path / "polls", "1", polls_of(23, 1) + polls_of("00", 2))
    runs.minute_run(spark, layout, str(tmp_path / "polls"), str(tmp_path / "chat"), "2024-01-01 23:50:00")
    for day in (1, 2):
        assert runs.night_samples(spark, layout, f"2024-01-0{day}").count() == 18
    assert "day" not in runs.night_samples(spark, layout, "2024-01-01").columns
    active = spark.createDataFrame([("tiny",)], "name string")
    land(tmp_path / "polls", "2", [("new", 9, "2024-01-02 01:00:00")])
    runs.minute_run(spark, layout, str(tmp_path / "polls"), str(tmp_path / "chat"), "2024-01-02 01:10:00")
    assert rows_of(runs.newest_channels(spark, layout, active)) == [("new",)]
