"""The scheduled runs, from landed files to tables, on one folder layout.

Landed files are read as streams with a checkpoint: each enters exactly one run,
whatever is still in its folder. A micro-batch writes its rows and then a line of
the catalogue that says which run has it; a batch that is done again after a
failure replaces both, so it still belongs to one run only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtide import schemas
from streamtide.functions import times
from streamtide.operators import joins, quality, rollups, wide
from streamtide.plans import discovery, ingest, training
from streamtide.plans.catalogue import Catalogue
from streamtide.session import stored
from streamtide.sinks import tables as sinks
from streamtide.sources import documents, files
from streamtide.sources import tables as sources
from streamtide.streaming.chat import file_stream


@dataclass(frozen=True)
class Layout:
    """Folders below one root on storage all executors share.

    ``archive``: where landed files go once their batch is done (K7, T8);
    without it they stay where they landed.
    """

    root: str
    archive: str | None = None

    def folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def catalogue(self) -> Catalogue:
        return Catalogue(self.folder("manifest"))

    def options(self) -> dict:
        return {"cleanSource": "archive", "sourceArchiveDir": self.archive} if self.archive else {}


def stamp_of(run_ts: str) -> str:
    return run_ts.replace(" ", "T").replace(":", "-")


def take(
    layout: Layout, source: str, stream: DataFrame, stamp: str,
    write: Callable[[DataFrame, str, str], None],
) -> None:
    """Works off what has landed: ``write(rows, folder, batch name)`` per micro-batch."""

    def done(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"{layout.folder(source)}/query={query}/batch={batch_id}"
        write(batch, folder, f"{query}-{batch_id}")
        layout.catalogue().record(batch.sparkSession, source, stamp, folder, f"{query}-{batch_id}")

    writer = stream.writeStream.foreachBatch(done).trigger(availableNow=True)
    writer.option("checkpointLocation", layout.folder(f"checkpoints/{source}")).start().awaitTermination()


def taken(spark: SparkSession, layout: Layout, source: str, stamp: str, schema: str) -> DataFrame:
    """The rows of the batches that belong to the run; none is an empty table."""
    paths = layout.catalogue().paths(spark, source, stamp)
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(p) for p in paths], spark.createDataFrame([], schema))


def _write_rows(clean: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, str, str], None]:
    def write(batch: DataFrame, folder: str, name: str) -> None:
        clean(batch).write.mode("overwrite").parquet(folder)

    return write


def minute_run(
    spark: SparkSession,
    layout: Layout,
    polls: str,
    chat: str,
    run_ts: str,
    pages: str | None = None,
    min_viewers: int = 500,
) -> None:
    """The ten-minute run: polls and chat to sessions and the wide table.

    ``polls`` holds ``;`` text, ``chat`` the typed chat rows, ``pages`` listing
    pages (C1). Only files that no earlier run has taken count. ``run_ts`` names
    the run (``yyyy-MM-dd HH:mm:ss``); repeating a run replaces its own output.
    """
    stamp = stamp_of(run_ts)
    take(layout, "polls", files.stream_sample_files(spark, polls, **layout.options()), stamp,
         _write_rows(quality.clean_samples))
    take(layout, "chat", file_stream(spark, chat, schemas.CHAT_MESSAGE, "parquet", archive=layout.archive), stamp,
         _write_rows(lambda rows: rows))
    landed = taken(spark, layout, "polls", stamp, schemas.CLEAN_SAMPLE)
    if pages is not None:
        take(layout, "pages", documents.stream_documents(spark, pages, **layout.options()), stamp, _write_pages(layout))
        landed = landed.unionByName(taken(spark, layout, "pages", stamp, schemas.CLEAN_SAMPLE))
    sinks.write_run(landed.withColumn("day", F.to_date("created")), layout.folder("samples"), stamp, "day")
    samples = sources.read_run(spark, layout.folder("samples"), stamp, f"{schemas.CLEAN_SAMPLE}, day date").drop("day")
    layout.catalogue().record(spark, "samples", stamp, f"{layout.folder('samples')}/run={stamp}", stamp)
    messages = taken(spark, layout, "chat", stamp, schemas.CHAT_MESSAGE)

    sinks.write_run(
        ingest.sessions_of(samples, min_viewers), layout.folder("sessions"), stamp
    )
    rows = wide.stream_day(
        samples,
        rollups.viewers_per_bucket(samples),
        rollups.chat_per_bucket(messages),
        times.run_time(run_ts),
    )
    sinks.write_stream_day(rows, layout.folder("stream_day"), stamp)


def _write_pages(layout: Layout) -> Callable[[DataFrame, str, str], None]:
    def write(batch: DataFrame, folder: str, name: str) -> None:
        rows, bad = ingest.ingest_metadata(batch)
        rows.drop("updated_at").write.mode("overwrite").parquet(folder)
        bad.write.mode("overwrite").parquet(f"{layout.folder('pages_quarantine')}/batch={name}")

    return write


def weather_run(spark: SparkSession, layout: Layout, pages: str, run_ts: str) -> None:
    """The hourly run: landed weather documents to the log, by day; unreadable ones apart."""

    def write(batch: DataFrame, folder: str, name: str) -> None:
        parts = documents.weather_parts(batch).persist()
        sinks.append_weather(documents.weather_rows(parts), layout.folder("weather"), name)
        bad = documents.weather_quarantine(parts)
        bad.write.mode("overwrite").parquet(f"{layout.folder('weather_quarantine')}/batch={name}")
        parts.unpersist()

    take(layout, "weather_pages", documents.stream_documents(spark, pages, **layout.options()), stamp_of(run_ts), write)


def night_samples(spark: SparkSession, layout: Layout, day: str) -> DataFrame:
    """The polls of one day, whichever runs took them: a run that began before midnight may hold
    polls of the next day. Of each run only the folder of the day is read."""
    samples = sources.read_runs(spark, layout.folder("samples"), f"{schemas.CLEAN_SAMPLE}, day date")
    return samples.where(F.col("day") == F.lit(day).cast("date")).drop("run", "day")


def newest_channels(spark: SparkSession, layout: Layout, active: DataFrame) -> DataFrame:
    """Streams of the newest run that are not tracked yet (C11); the catalogue names the run."""
    samples = sources.read_runs(spark, layout.folder("samples"), schemas.CLEAN_SAMPLE)
    return discovery.new_channels(samples, active, newest=layout.catalogue().newest(spark, "samples"))


def training_run(
    spark: SparkSession,
    layout: Layout,
    places: Sequence[str],
    day: str,
    algorithm: str = "nb",
    strict: bool = True,
    min_viewers: int = 500,
) -> PipelineModel:
    """The nightly run: one row per stream and game of ``day``, then a model of all nights.

    Sessions come from the day's polls, weather from that day of the log and the
    day before and after it. The rows are added to the training table, in place
    of those of an earlier run for the day, and the model is fitted on the table.
    """
    sessions = ingest.sessions_of(night_samples(spark, layout, day), min_viewers)
    at = F.lit(day).cast("date")
    log = sources.read_weather(spark, layout.folder("weather")).where(F.col("day").between(F.date_sub(at, 1), F.date_add(at, 1)))
    obs = ingest.latest_weather(log.drop("day", "batch"))
    rows = training.build_training_set(sessions, obs, places, strict)
    sinks.write_run(rows, layout.folder("training"), day)
    table = spark.read.schema(schemas.TRAINING_ROW).parquet(layout.folder("training"))
    model = training.train(table, algorithm)
    training.save_model(model, layout.folder("model"))
    return model


def prediction_run(
    spark: SparkSession, layout: Layout, requests: DataFrame, forecast: DataFrame,
    places: Sequence[str], digits: int | None = None,
) -> DataFrame:
    """Requests through the model stored last.

    The slots are stored first: with their size known, the requests need no shuffle.
    """
    model = training.load_model(layout.folder("model"))
    slots = stored(joins.forecast_by_slot(forecast, places), "slots")
    return training.predict(requests, slots, places, model, digits=digits)
