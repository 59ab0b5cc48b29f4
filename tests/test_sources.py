import json
from datetime import datetime

import pytest
from rows import rows_of
from pyspark.sql import functions as F

from streamtide import schemas
from streamtide.operators import quality
from streamtide.plans import archive, ingest
from streamtide.session import scratch_folder
from streamtide.sinks import tables as sinks
from streamtide.sources import documents, files, tables


def test_stream_samples_tolerate_bad_fields(spark, tmp_path):
    (tmp_path / "2024" / "1").mkdir(parents=True)
    (tmp_path / "2024" / "1" / "part-00000").write_text(
        "1;abc;ga\"me;n;s;2024-01-01 00:00:01;null;u;60.0\n"
        "2;7;game;n\n"
        "3;8;game;n;s;2024-01-01 00:00:02;true;u;59.5;extra\n"
        "4;9;game;n;s;2024-01-01T00:00:02;true;u;59.5\n"
    )
    rows = files.read_stream_samples(spark, str(tmp_path), recursive=True)
    assert rows_of(rows, "channel_id", "viewers", "game", "mature", "fps") == [
        (1, None, 'ga"me', None, 60.0),
        (2, 7, "game", None, None),
        (3, 8, "game", True, 59.5),
        (4, 9, "game", True, 59.5),
    ]
    cleaned = quality.clean_samples(rows)
    assert rows_of(cleaned, "channel_id", "created") == [
        (1, datetime(2024, 1, 1, 0, 0, 1)), (3, datetime(2024, 1, 1, 0, 0, 2))
    ]
    assert "updated_at" not in cleaned.columns


def test_sessions_from_tab_text(spark, tmp_path):
    (tmp_path / "part").write_text(
        "n\tg\t12.5\t3\t60.0\t700.0\t2024-01-01T10:00:00Z\nn\tg\tx\t3\t60.0\t700.0\t\n"
    )
    rows = files.read_sessions(spark, str(tmp_path))
    assert rows_of(rows, "name", "dur", "starttime") == [
        ("n", None, None), ("n", 12.5, datetime(2024, 1, 1, 10))
    ]


def test_several_folders_are_one_relation(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f").write_text(f"{name}1\n{name}2\n")
    rows = files.read_lines(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert rows_of(rows) == [("a1",), ("a2",), ("b1",), ("b2",)]


def test_short_training_lines_are_dropped(spark):
    lines = spark.createDataFrame(
        [("1,some text,2.0",), ("1,text",), ("",), ("1,text,x",)], "value string"
    )
    assert rows_of(files.parse_training_lines(lines)) == [(1, "some text", 2.0)]


def test_places(spark, tmp_path):
    (tmp_path / "places").write_text("48149\n01067 \n\n")
    places = files.read_places(spark, str(tmp_path))
    assert rows_of(places) == [("01067",), ("48149",)]


def test_sequence_file_chat(spark, tmp_path):
    path = str(tmp_path / "chat")
    values = [(1704067200000, "chan,hello; you,1"), (1704067201000, "chan,no code"), (1704067202000, "c,m,x")]
    spark.sparkContext.parallelize(values, 1).saveAsSequenceFile(path)
    rows = files.read_sequence_chat(spark, path)
    assert rows_of(rows, "channel", "msg", "sentiment") == [
        ("c", "m", None), ("chan", "hello; you", 1), ("chan", "no code", None)
    ]
    assert rows.agg(F.min("ts")).first()[0] == datetime(2024, 1, 1)


def test_chat_value_escapes(spark):
    rows = spark.createDataFrame([("#chan", "a,b", 2)], "channel string, msg string, sentiment int")
    assert rows.select(files.chat_value()).first()[0] == "chan,a;b,2"


def stream(**changes):
    channel = {"game": "g", "name": "n", "status": "s;t", "mature": None, "updated_at": "u"}
    channel.update({k: v for k, v in changes.items() if k in channel})
    row = {"_id": 5, "viewers": 10, "average_fps": 59.9, "channel": channel}
    row.update({k: v for k, v in changes.items() if k in row})
    return row


def test_stream_pages(spark, tmp_path):
    page = {"streams": [
        stream(), stream(game=None), stream(game="null"), stream(channel=None),
        stream(_id=6, viewers="x", mature=True), {"_id": 7, "viewers": 1}, {"_id": 8, "channel": "text"}, 5,
    ]}
    (tmp_path / "good.json").write_text(json.dumps(page, indent=1))
    (tmp_path / "cut.json").write_text(json.dumps(page)[:50])
    pages = documents.read_documents(spark, str(tmp_path))
    rows, bad = ingest.ingest_metadata(pages)
    assert rows_of(rows, "channel_id", "viewers", "game", "status", "mature", "fps") == [
        (5, 10, "g", "st", False, 59.9), (6, None, "g", "st", True, 59.9)
    ]
    assert rows_of(bad.selectExpr("regexp_extract(path, '[^/]*$', 0) file", "body is null part", "element")) == [
        ("cut.json", False, None), ("good.json", True, "5"), ("good.json", True, '{"_id":8,"channel":"text"}'),
    ]
    assert rows.where("created is null").count() == 0


def test_latest_metadata_only(spark):
    pages = spark.createDataFrame([
        (json.dumps({"streams": [stream(viewers=1)]}), datetime(2024, 1, 1, 0, 0)),
        (json.dumps({"streams": [stream(viewers=2)]}), datetime(2024, 1, 1, 0, 10)),
    ], "body string, landed_at timestamp")
    rows, _ = ingest.ingest_metadata(pages, latest_only=True)
    assert rows_of(rows, "channel_id", "viewers") == [(5, 2)]


def test_weather_documents(spark, tmp_path):
    folder = tmp_path / "place=01067"
    folder.mkdir()
    good = {"weather": [{"main": "Rain"}, {"main": "Mist"}], "main": {"temp": 285.444}, "wind": {"speed": 3.6}}
    (folder / "a.json").write_text(json.dumps(good))
    (folder / "b.json").write_text(json.dumps({**good, "weather": []}))
    (folder / "c.json").write_text("{oops")
    pages = documents.read_documents(spark, str(tmp_path))
    bad = documents.weather_quarantine(documents.weather_parts(pages))
    assert sorted(r.body[:5] for r in bad.collect()) == ['{"wea', "{oops"]
    rows = ingest.ingest_weather(pages)
    assert rows_of(rows, "place", "main", "wind", "temp") == [("01067", "Rain", 3.6, 12.44)]
    assert len(rows.first().hour_key) == 10


def test_forecast_documents(spark):
    body = {"list": [
        {"dt_txt": "2024-01-01 06:00:00", "wind": {"speed": 1.5}, "main": {"temp": 273}, "weather": [{"main": "Clear"}]},
        {"dt_txt": "2024-01-01 09:00:00", "wind": {}, "main": {"temp": 274}, "weather": []},
    ]}
    docs = spark.createDataFrame([(json.dumps(body), "p"), ("{", "p")], "body string, place string")
    parts = documents.forecast_parts(docs)
    assert rows_of(documents.forecast_rows(parts), "pos", "dt_txt", "main", "wind", "temp") == [
        (0, "2024-01-01 06:00:00", "Clear", 1.5, 0.0),
        (1, "2024-01-01 09:00:00", None, None, 1.0),
    ]
    assert rows_of(documents.forecast_quarantine(parts)) == [("p", "{")]


def test_each_document_is_parsed_once(spark, tmp_path):
    (tmp_path / "page.json").write_text(json.dumps({"streams": [stream()]}))
    elements = documents.page_elements(documents.read_documents(spark, str(tmp_path)))
    plan = elements._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2  # the page, and each element
    rows, _ = ingest.ingest_metadata(documents.read_documents(spark, str(tmp_path)))
    assert "from_json" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_filters(spark):
    rows = spark.createDataFrame(
        [(500, 1.0), (501, 1.0), (501, None), (None, 1.0)], "viewers long, fps double"
    )
    assert rows_of(quality.rated_samples(rows)) == [(501, 1.0)]
    good, bad = quality.split_valid(rows, F.col("viewers") > 500)
    assert good.count() + bad.count() == 4 and good.count() == 2


def test_allow_list(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "channel string")
    assert rows_of(quality.only_channels(rows, ["a", "z"])) == [("a",)]


def test_replace_partitions_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, p string")
    sinks.replace_partitions(rows, path, "p")
    sinks.replace_partitions(rows.where("p = 'a'").withColumn("id", F.lit(9).cast("long")), path, "p")
    assert rows_of(spark.read.parquet(path), "id", "p") == [(2, "b"), (9, "a")]


def test_prefix_scan_reads_one_day(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.sql("select 'abc' name, date'2024-01-01' + cast(id as int) day, id from range(5)")
    rows.write.partitionBy("day").parquet(path)
    found = tables.prefix_scan(spark.read.parquet(path), "ABC", "2024-01-03")
    assert rows_of(found, "id") == [(2,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "EqualTo(name,abc)" in plan
    literal = tables.key_prefix_scan(spark.read.parquet(path), "name", "ab")
    assert literal.count() == 5


def test_archive_compacts_and_refuses_to_overwrite(spark, tmp_path):
    source = tmp_path / "processing"
    source.mkdir()
    for i in range(6):
        (source / f"f{i}").write_text(f"line {i}\n")
    (source / "empty").write_text("")
    target = str(tmp_path / "completed")
    archive.archive_text(spark, str(source), target, parts=1)
    assert len(list((tmp_path / "completed").glob("*.bz2"))) == 1
    assert rows_of(spark.read.text(target)) == [(f"line {i}",) for i in range(6)]
    with pytest.raises(Exception, match="already exists"):
        archive.archive_text(spark, str(source), target)


def test_scratch_folder_is_shared_and_new(spark):
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))
