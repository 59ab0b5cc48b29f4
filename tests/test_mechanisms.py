"""Day totals, model versions, corrections and malformed lines on small tables."""

from datetime import datetime, timedelta

import pytest
from rows import rows_of
from pyspark.sql import functions as F

from streamtide.operators import rollups
from streamtide.plans import day_totals, registry, training
from streamtide.sources import files
from streamtide.streaming import chat as chat_jobs
from streamtide.streaming import corrections

CHAT = "ts timestamp, channel string, msg string, sentiment int"
BEGIN = datetime(2024, 1, 1)


def chat_rows(spark, *rows):
    """(minutes after the beginning, channel, sentiment)"""
    return spark.createDataFrame([(BEGIN + timedelta(minutes=m), c, "m", s) for m, c, s in rows], CHAT)


def polls(spark, *rows):
    """(minutes after the beginning, name, viewers)"""
    return spark.createDataFrame([(BEGIN + timedelta(minutes=m), n, v) for m, n, v in rows], "created timestamp, name string, viewers long")


def minutes(spark, seen, said):
    return rollups.viewers_per_bucket(polls(spark, *seen)), rollups.chat_per_bucket(chat_rows(spark, *said))


def test_arrivals_touch_only_their_days(spark, tmp_path):
    root, day = str(tmp_path), 24 * 60
    first = [(0, "a", 10), (1, "a", 30), (day, "a", 5), (2 * day, "b", 7)]
    assert len(day_totals.add(spark, root, "one", *minutes(spark, first, [(0, "a", 1), (day, "a", 2)]))) == 3
    kept = {x: x.stat().st_mtime_ns for x in (tmp_path / "totals").rglob("*.parquet") if "day=2024-01-02" not in str(x)}
    second = [(day, "a", 15), (day + 1, "a", 40), (day, None, 1)]
    days = day_totals.add(spark, root, "two", *minutes(spark, second, [(day, "a", 2), (day, "c", 0)]))
    assert [str(d) for d in days] == ["2024-01-02"]
    assert kept and all(x.stat().st_mtime_ns == at for x, at in kept.items())
    day_totals.add(spark, root, "two", *minutes(spark, second, [(day, "a", 2), (day, "c", 0)]))
    assert rows_of(day_totals.totals(spark, root), "name", F.col("day").cast("string"), "viewers", "positive", "negative", "neutral") == [
        ("a", "2024-01-01", 20.0, 1, 0, 0), ("a", "2024-01-02", 25.0, 0, 2, 0), ("b", "2024-01-03", 7.0, None, None, None),
        ("c", "2024-01-02", None, 0, 0, 1)]
    plan = day_totals.minutes_of(spark, root, days)._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


@pytest.mark.parametrize("keep_ms, reopened", [(3_600_000, False), (1, True)])
def test_late_rows_correct_their_minute(spark, tmp_path, keep_ms, reopened):
    landing, versions = str(tmp_path / "landing"), str(tmp_path / "versions")
    for k in range(4):  # the minute 0 has rows in the first and the last file, the others in one each
        late = [(0, "a", 1), (0, "a", 2)] if k in (0, 3) else []
        chat_rows(spark, *late, (k + 1, "a", 0), (k + 1, "b", 1)).coalesce(1).write.mode("append").parquet(landing)
    stream = chat_jobs.file_stream(spark, landing, CHAT, "parquet", max_files=1)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{versions}/batch={batch_id}")

    writer = corrections.chat_corrections(stream, keep_ms).writeStream.outputMode("update").foreachBatch(write)
    query = writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema(corrections.OUT).parquet(versions)
    got = rows_of(corrections.last_versions(rows), "name", F.minute("minute").alias("m"), "positive", "negative", "neutral")
    assert got == [("a", 0, 2, 2, 0), *[("a", k, 0, 0, 1) for k in range(1, 5)], *[("b", k, 1, 0, 0) for k in range(1, 5)]]
    openings = rows.where("name = 'a' and minute(minute) = 0").select("opening").distinct().count()
    left = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert (openings > 1) == reopened and (left < 9) == reopened


def test_corrections_stay_out_of_python(spark, tmp_path):
    """One call of Python for each minute took more than four minutes over 600,000 events."""
    landing, versions = str(tmp_path / "landing"), str(tmp_path / "versions")
    spark.range(30_000).selectExpr(
        "timestamp_seconds(id * 60) ts", "'a' channel", "'m' msg", "if(id = 7, null, int(id % 3)) sentiment").write.parquet(landing)
    rows = corrections.chat_corrections(chat_jobs.file_stream(spark, landing, CHAT, "parquet"))
    assert "Pandas" not in rows._jdf.queryExecution().logical().toString()

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{versions}/batch={batch_id}")

    writer = rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", str(tmp_path / "c"))
    writer.trigger(availableNow=True).start().awaitTermination()
    last = corrections.last_versions(spark.read.schema(corrections.OUT).parquet(versions))
    sums = last.select(F.count("*"), *[F.sum(c) for c in corrections.SUMS], F.expr("count_if(positive is null or negative is null or neutral is null)")).first()
    assert tuple(sums) == (30_000, 9_999, 10_000, 10_000, 0)


def test_versions_of_the_model(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(LookupError):
        registry.current(spark, root)
    rows = spark.createDataFrame([(1, "a b c", 1.0), (2, "d e f", 2.0)], "id long, text string, target double")
    model = training.train(rows)
    registry.publish(spark, root, model, "2024-01-02T01")
    registry.publish(spark, root, model, "2024-01-01T01")  # older: not current
    stamp, found = registry.current(spark, root)
    assert stamp == "2024-01-02T01" and found.stages[2].labels == model.stages[2].labels


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    lines = ["1;500;g;n;s;2024-01-01 00:00:00;true;u;30.0", "x;500;g;n;s;2024-01-01 00:00:00;true;u;30.0", "2;3;g", "3;1;g;n;s;c;false;u;1.0;more", ""]
    (tmp_path / "1.txt").write_text("\n".join(lines))
    checked = files.checked_samples(spark, str(tmp_path)).cache()
    assert rows_of(files.good_lines(checked), "channel_id", "viewers") == [(1, 500)]
    bad = files.delimited_quarantine(checked).collect()
    assert sorted(r.line for r in bad) == sorted(lines[1:4]) and all(r.file.endswith("1.txt") for r in bad)
    assert files.read_stream_samples(spark, str(tmp_path)).count() == 4
