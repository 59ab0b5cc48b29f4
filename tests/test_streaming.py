import json
from datetime import datetime, timedelta

import pytest
from rows import rows_of
from pyspark.sql import functions as F

from streamtide import schemas
from streamtide.operators import joins, rollups
from streamtide.plans import ingest, training
from streamtide.session import stored
from streamtide.streaming import chat as chat_jobs
from streamtide.streaming import rollups as stream_rollups
from streamtide.streaming import weather as weather_jobs

START = datetime(2024, 1, 1, 12)


def land(folder, name, rows):
    """One landed file of chat rows: (minutes after start, channel, sentiment)."""
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({
            "ts": (START + timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%SZ"),
            "channel": c, "msg": "m", "sentiment": s,
        })
        for m, c, s in rows
    ]
    (folder / name).write_text("\n".join(lines))


def chat_stream(spark, folder, **options):
    return chat_jobs.file_stream(spark, str(folder), schemas.CHAT_MESSAGE, **options)


def run_windows(spark, folder, root):
    windows = stream_rollups.chat_windows(chat_stream(spark, folder))
    chat_jobs.write_rolled(
        windows, f"{root}/table", f"{root}/check", until_done=True
    ).awaitTermination()
    return spark.read.schema(windows.schema).parquet(f"{root}/table")


def test_windows_equal_batch_once_closed(spark, tmp_path):
    source = tmp_path / "in"
    rows = [(i % 30, f"c{i % 3}", i % 4) for i in range(200)]
    land(source, "1", rows)
    land(source, "2", [(500, "end", 0)])
    table = run_windows(spark, source, tmp_path)
    batch = rollups.chat_per_bucket(
        spark.read.schema(schemas.CHAT_MESSAGE).json(str(source)).where("channel <> 'end'")
    )
    columns = ["name", "minute", "positive", "negative", "neutral"]
    assert rows_of(table, *columns) == rows_of(batch, *columns)


def test_late_rows_are_dropped_by_windows_but_kept_by_partials(spark, tmp_path):
    source = tmp_path / "in"
    land(source, "1", [(0, "a", 1), (100, "a", 1)])
    run_windows(spark, source, tmp_path)
    land(source, "2", [(101, "a", 1)])
    run_windows(spark, source, tmp_path)
    land(source, "3", [(40, "a", 2), (300, "a", 0)])
    table = run_windows(spark, source, tmp_path)
    assert rows_of(table.where("negative > 0"), "name") == []
    assert table.agg(F.sum("positive")).first()[0] == 3

    stream_rollups.write_partials(
        chat_stream(spark, source, max_files=1), rollups.chat_per_bucket,
        str(tmp_path / "partials"), str(tmp_path / "partials_check"),
    ).awaitTermination()
    assert len(list((tmp_path / "partials").glob("query=*/batch=*"))) == 3
    merged = stream_rollups.read_chat_partials(spark, str(tmp_path / "partials"))
    whole = rollups.chat_per_bucket(spark.read.schema(schemas.CHAT_MESSAGE).json(str(source)))
    assert rows_of(merged, *whole.columns) == rows_of(whole)


def test_partials_of_viewers(spark, tmp_path):
    rows = spark.range(300).selectExpr(
        "concat('n', id % 4) name", "id viewers", "timestamp_seconds(1704067200 + id % 60) created"
    )
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = chat_jobs.file_stream(
        spark, str(tmp_path / "in"), rows.schema, fmt="parquet", max_files=1
    )
    stream_rollups.write_partials(
        stream, rollups.viewers_per_bucket, str(tmp_path / "t"), str(tmp_path / "c")
    ).awaitTermination()
    merged = stream_rollups.read_viewer_partials(spark, str(tmp_path / "t"))
    whole = rollups.viewers_per_bucket(rows)
    assert rows_of(merged, *whole.columns) == rows_of(whole)


def test_viewer_windows(spark, tmp_path):
    rows = spark.createDataFrame(
        [("n", 10, START), ("n", 20, START), ("n", 5, START + timedelta(hours=2))],
        "name string, viewers long, created timestamp",
    )
    rows.write.parquet(str(tmp_path / "in"))
    windows = stream_rollups.viewer_windows(
        chat_jobs.file_stream(spark, str(tmp_path / "in"), rows.schema, fmt="parquet")
    )
    chat_jobs.write_rolled(
        windows, str(tmp_path / "t"), str(tmp_path / "c"), until_done=True
    ).awaitTermination()
    table = spark.read.schema(windows.schema).parquet(str(tmp_path / "t"))
    assert rows_of(table, "name", "minute", "viewers_sum", "viewers_cnt", "viewers") == [
        ("n", START, 30, 2, 15.0)
    ]


def test_chat_ingest_in_two_runs(spark, tmp_path):
    """Scored on the way in, each message once, processed files archived."""
    source = tmp_path / "in"
    source.mkdir()
    archive = tmp_path / "archive"

    def land_raw(name, ids):
        lines = [json.dumps({
            "msg_id": i, "ts": "2024-01-01T12:00:00Z", "channel": "#c",
            **({} if i == 3 else {"msg": f"m{i}"}),
        }) for i in ids]
        (source / name).write_text("\n".join(lines))

    scores = spark.createDataFrame(
        [(1, "positive"), (2, None), (4, "negative")], "msg_id long, label string"
    )

    def run():
        stream = chat_jobs.chat_messages(spark, str(source), archive=str(archive), max_files=1)
        chat_jobs.write_rolled(
            ingest.ingest_chat(stream, scores), str(tmp_path / "t"), str(tmp_path / "c"),
            until_done=True,
        ).awaitTermination()

    land_raw("a", [1, 2, 3])
    run()
    land_raw("b", [4, 5])
    run()
    run()
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert rows_of(rows, "channel", "msg", "sentiment") == [
        ("c", "m1", 1), ("c", "m4", 2), ("c", "m5", 0)
    ]


def test_processed_files_move_to_the_archive(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "archive"
    for name in ("1", "2", "3"):
        land(source, name, [(int(name), "a", 1)])
    stream = chat_stream(spark, source, max_files=1, archive=str(archive))
    chat_jobs.write_rolled(
        stream, str(tmp_path / "t"), str(tmp_path / "c"), until_done=True
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    moved = [p for p in archive.rglob("*") if p.is_file() and not p.name.startswith(".")]
    assert moved and len(moved) + len([p for p in source.iterdir()]) == 3


def test_an_empty_folder_is_an_empty_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    query = chat_jobs.write_rolled(
        chat_stream(spark, tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"),
        until_done=True,
    )
    query.awaitTermination()
    assert query.exception() is None


def test_continuous_run_rolls_by_interval(spark, tmp_path):
    land(tmp_path / "in", "1", [(0, "a", 1)])
    query = chat_jobs.write_rolled(
        chat_stream(spark, tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"),
        every="1 second",
    )
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_weather_stream_appends_and_the_latest_wins(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def run(name, temp, minute):
        body = json.dumps({
            "weather": [{"main": "Rain"}], "main": {"temp": temp}, "wind": {"speed": 1}
        })
        (source / name).write_text(json.dumps(
            {"body": body, "place": "p", "landed_at": f"2024-01-01T12:{minute:02}:00Z"}
        ))
        weather_jobs.write_observations(
            weather_jobs.weather_documents(spark, str(source)),
            str(tmp_path / "t"), str(tmp_path / "c"), until_done=True,
        ).awaitTermination()

    run("a", 280.0, 30)
    run("b", 275.0, 5)
    log = spark.read.parquet(str(tmp_path / "t"))
    assert log.count() == 2
    assert rows_of(ingest.latest_weather(log), "hour_key", "place", "temp") == [
        ("2024010112", "p", 7.0)
    ]


def test_requests_are_scored_as_a_stream(spark, tmp_path):
    """The batch scoring job over a stream of requests, against stored slots."""
    training_rows = spark.createDataFrame(
        [(1, f"alpha alpha {i}", 7.0) for i in range(5)]
        + [(1, f"beta beta {i}", 2.0) for i in range(5)], "id long, text string, target double"
    )
    model = training.train(training_rows)
    forecast = spark.createDataFrame(
        [("p", 0, "2024-01-01 06:00:00", "Clear", 1.5, 2.0)],
        "place string, pos int, dt_txt string, main string, wind double, temp double",
    )
    slots = stored(joins.forecast_by_slot(forecast, ["p"]), "slots")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1").write_text("\n".join(json.dumps({
        "id": i, "name": name, "game": name, "duration": 60.0, "daytime": "Morgens", "fps": 60.0,
        "day": "2024-01-01T00:00:00Z",
    }) for i, name in enumerate(["alpha", "beta"])))
    requests = chat_jobs.file_stream(spark, str(tmp_path / "in"), schemas.PREDICTION_REQUEST)
    chat_jobs.write_rolled(
        training.predict(requests, slots, ["p"], model), str(tmp_path / "t"), str(tmp_path / "c"),
        until_done=True,
    ).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert rows_of(rows, "id", "viewer_class", "range_text") == [
        (0, 7.0, "6500 bis 7500"), (1, 2.0, "1500 bis 2500")
    ]


def test_buffered_batches_are_bounded_and_exact_after_a_restart(spark, tmp_path):
    schema = "ts timestamp, channel string, msg string, sentiment int"
    folder, sizes, seen = str(tmp_path / "landing"), [], []

    def land(first, n):
        rows = spark.range(first, first + n).selectExpr(
            "timestamp '2024-01-01' as ts", "'c' as channel", "cast(id as string) as msg", "cast(id % 3 as int) as sentiment")
        rows.coalesce(1).write.mode("append").parquet(folder)

    def write(batch, batch_id):
        own = [r.msg for r in batch.collect()]
        if len(seen) == 2 and not sizes[-1] < 0:
            sizes.append(-1)
            raise RuntimeError("lost")
        sizes.append(len(own))
        seen.append(own)

    def run():
        rows = chat_jobs.buffered(
            spark, chat_jobs.file_stream(spark, folder, schema, "parquet"), str(tmp_path / "buffer"), str(tmp_path / "c1"), max_records=70)
        query = rows.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
        query.awaitTermination()

    land(0, 1000)
    with pytest.raises(Exception, match="lost"):
        run()
    land(1000, 33)
    run()
    run()
    assert max(sizes) <= 70 and len(sizes) > 15
    assert sorted(int(m) for own in seen for m in own) == list(range(1033))


def test_lanes_run_side_by_side_in_bounded_batches_and_are_exact_after_a_restart(spark, tmp_path):
    folder, seen, failed = str(tmp_path / "landing"), [], []

    def land(first, n):
        rows = spark.range(first, first + n).selectExpr(
            "timestamp '2024-01-01' as ts", "'c' as channel", "cast(id as string) as msg", "cast(id % 3 as int) as sentiment")
        rows.coalesce(1).write.mode("append").parquet(folder)

    def writer(lane, rows):
        def write(batch, batch_id):
            own = [r.msg for r in batch.collect()]
            if lane == 1 and len(failed) == 0:
                failed.append(lane)
                raise RuntimeError("lost")
            seen.append((lane, batch_id, own))

        return rows.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / f"lane-{lane}"))

    def run():
        stream = chat_jobs.file_stream(spark, folder, "ts timestamp, channel string, msg string, sentiment int", "parquet")
        rows = chat_jobs.buffered_lanes(
            spark, stream, str(tmp_path / "buffer"), str(tmp_path / "c1"), max_records=70, max_files=2, lanes=3)
        chat_jobs.work_off([writer(lane, r) for lane, r in enumerate(rows)])

    land(0, 1000)
    with pytest.raises(Exception, match="lost"):
        run()
    land(1000, 33)
    run()
    run()
    assert {lane for lane, _, _ in seen} == {0, 1, 2} and len(seen) > 3
    assert max(len(own) for _, _, own in seen) <= 140
    batches = {(lane, batch_id): own for lane, batch_id, own in seen}  # one that is run again replaces its own
    assert sorted(int(m) for own in batches.values() for m in own) == list(range(1033))
