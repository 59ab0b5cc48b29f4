"""JSON documents as landed from the web services: stream pages, weather, forecast.

A document is one row of text. A document that cannot be parsed stays a row
with its text in ``_corrupt_record``, so it can be counted and kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtide import schemas
from streamtide.functions import classes, text, times


def read_documents(spark: SparkSession, path, one_per_line: bool = False) -> DataFrame:
    """Landed documents with file path and landing time.

    Files hold one document each, or one per line. A ``place=...`` folder name
    becomes the ``place`` column; it is read as text, postal codes keep zeros.
    """
    return _landed(spark.read.text(path, wholetext=not one_per_line))


def stream_documents(spark: SparkSession, path: str, one_per_line: bool = False, **options) -> DataFrame:
    """The same as a stream: each landed file is read once."""
    reader = spark.readStream.option("wholetext", not one_per_line).option("recursiveFileLookup", True)
    return _landed(reader.options(**options).text(path))


def _landed(lines: DataFrame) -> DataFrame:
    place = F.regexp_extract("_metadata.file_path", "/place=([^/]+)/", 1)
    return lines.select(
        F.col("value").alias("body"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.nullif(place, F.lit("")).alias("place"),
    )


def _parse(body: Column, schema: str) -> Column:
    return F.from_json(
        body, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    )


def _part(body: Column, schema: str, pick: Callable[[Column], Column]) -> Column:
    """A part of each document, null where the document cannot be parsed.

    The document is bound to a lambda variable: named columns would be
    substituted into every later use and each use would parse the text again.
    """
    def readable(doc: Column) -> Column:
        return F.when(doc["_corrupt_record"].isNull(), pick(doc))

    return F.get(F.transform(F.array(_parse(body, schema)), readable), F.lit(0))


def page_elements(documents: DataFrame, *keep: str) -> DataFrame:
    """The elements of each page, parsed once (S1): ``keep``, ``body``, ``element``, ``stream``.

    ``body`` is set only where the whole page cannot be parsed, ``element`` only
    where an element cannot; both then have no stream. Store the result to take
    rows and quarantine from one parse.
    """
    def parsed(element: Column) -> Column:
        one = F.from_json(element, schemas.STREAM_ELEMENT, {
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        return F.struct(element.alias("text"), one.alias("stream"))

    def elements(page: Column) -> Column:
        unread = F.struct(F.lit(None).cast("string").alias("text"), F.from_json(F.lit(None).cast("string"), schemas.STREAM_ELEMENT).alias("stream"))
        return F.when(page["_corrupt_record"].isNull() & page["streams"].isNotNull(), F.transform(page["streams"], parsed)).when(
            page.isNull() | page["_corrupt_record"].isNotNull(), F.array(unread))

    pages = F.transform(F.array(_parse(F.col("body"), schemas.STREAM_PAGE)), elements)
    rows = documents.select(*keep, "body", F.inline(F.flatten(pages)))
    bad = F.col("stream").isNull() | F.col("stream._corrupt_record").isNotNull()
    return rows.select(
        *keep, F.when(F.col("text").isNull(), F.col("body")).alias("body"),
        F.when(bad, F.col("text")).alias("element"), F.when(~bad, F.col("stream")).alias("stream"),
    )


def page_quarantine(elements: DataFrame) -> DataFrame:
    """Pages and elements that cannot be parsed, with their text."""
    return elements.where("stream is null").drop("stream")


def stream_rows(elements: DataFrame, polled_at: str = "landed_at") -> DataFrame:
    """One row per listed stream (S1), separator stripped (X3), typed by try_cast."""
    rows = elements.where("stream is not null").select(F.col(polled_at).alias("created"), "stream.*")
    plain = {
        name: text.strip_separator(F.col(source))
        for name, source in {
            "channel_id": "_id",
            "viewers": "viewers",
            "game": "channel.game",
            "name": "channel.name",
            "status": "channel.status",
            "mature": "channel.mature",
            "updated_at": "channel.updated_at",
            "fps": "average_fps",
        }.items()
    }
    return rows.select(
        plain["channel_id"].try_cast("long").alias("channel_id"),
        plain["viewers"].try_cast("long").alias("viewers"),
        plain["game"].alias("game"),
        plain["name"].alias("name"),
        plain["status"].alias("status"),
        F.col("created"),
        plain["mature"].try_cast("boolean").alias("mature"),
        plain["updated_at"].alias("updated_at"),
        plain["fps"].try_cast("double").alias("fps"),
    )


def weather_parts(documents: DataFrame, obs_ts: str = "landed_at") -> DataFrame:
    """Each weather document parsed once: place, body, time and the observed values."""
    observed = _part(F.col("body"), schemas.WEATHER_RESPONSE, lambda doc: F.struct(
        F.get(doc["weather"], F.lit(0))["main"].alias("main"),
        doc["wind"]["speed"].alias("wind"),
        doc["main"]["temp"].alias("kelvin"),
    ))
    nothing = F.lit(None)
    no_weather = F.struct(
        nothing.cast("string").alias("main"), nothing.cast("double").alias("wind"), nothing.cast("double").alias("kelvin"))
    return documents.select("place", "body", F.col(obs_ts).alias("obs_ts"), F.inline(F.array(F.coalesce(observed, no_weather))))


WEATHER_VALUES = ["place", "main", "wind", "kelvin"]


def weather_quarantine(parts: DataFrame) -> DataFrame:
    """Documents that cannot be parsed or lack a value."""
    complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in WEATHER_VALUES])
    return parts.where(~complete).select("place", "body", "obs_ts")


def weather_rows(parts: DataFrame) -> DataFrame:
    """Current weather per place (S10), celsius (X27), hour key."""
    return parts.dropna(subset=WEATHER_VALUES).select(
        times.hour_key(F.col("obs_ts")).alias("hour_key"),
        "place", "main", "wind",
        classes.kelvin_to_celsius(F.col("kelvin")).alias("temp"),
        "obs_ts",
    )


def forecast_parts(documents: DataFrame) -> DataFrame:
    """Each forecast document parsed once: a row per slot, or one without where there is none."""
    listed = _part(F.col("body"), schemas.FORECAST_RESPONSE, lambda doc: doc["list"])
    slots = documents.select("place", "body", F.posexplode_outer(listed).alias("pos", "slot"))
    return slots.withColumn("body", F.when(F.col("slot").isNull(), F.col("body")))


def forecast_quarantine(parts: DataFrame) -> DataFrame:
    """Documents that cannot be parsed or have no slots."""
    return parts.where("slot is null").select("place", "body")


def forecast_rows(parts: DataFrame) -> DataFrame:
    """Forecast slots per place in document order (S11), celsius."""
    return parts.where("slot is not null").select(
        "place",
        "pos",
        F.col("slot.dt_txt").alias("dt_txt"),
        F.get("slot.weather", F.lit(0))["main"].alias("main"),
        F.col("slot.wind.speed").alias("wind"),
        classes.kelvin_to_celsius(F.col("slot.main.temp")).alias("temp"),
    )
