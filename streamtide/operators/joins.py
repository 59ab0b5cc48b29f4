"""Joins and lookups.

No join here carries a broadcast hint. A side is broadcast when its measured
size is below Spark's threshold; beyond it the join is a shuffled one and AQE
splits partitions that a hot key made too large.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtide.functions import classes
from streamtide.operators.rollups import distinct_names


def attach_sentiment(messages: DataFrame, scores: DataFrame, key: str = "msg_id") -> DataFrame:
    """Messages with the code of their score.

    A message without a score is neutral; one whose score carries no label is
    dropped. Of repeated scores of a key the least label counts, so a message
    never comes twice; labels win over none.
    """
    labels = scores.groupBy(key).agg(F.min("label").alias("label"), F.lit(True).alias("scored"))
    joined = messages.join(labels, key, "left")
    kept = joined.where(F.col("scored").isNull() | F.col("label").isNotNull())
    return kept.withColumn("sentiment", classes.sentiment_code(F.col("label"))).drop(
        "label", "scored"
    )


def score_messages(
    messages: DataFrame, scorer: Callable[[pd.Series], pd.Series], column: str = "msg"
) -> DataFrame:
    """Messages with the code a caller's scorer gives them.

    ``scorer`` maps a batch of texts to labels and runs in Arrow batches.
    """
    label = F.pandas_udf(scorer, T.StringType())
    return messages.withColumn("sentiment", classes.sentiment_code(label(F.col(column))))


def weather_by_hour(obs: DataFrame, places: Sequence[str]) -> DataFrame:
    """Observations as one map per hour: place to ``main,wind,temp``.

    Expects one row per hour and place (``latest_per_key``). Only the listed
    places enter the map, so a map is never larger than that list.
    """
    cell = F.concat_ws(",", "main", F.col("wind").cast("string"), F.col("temp").cast("string"))
    return (
        obs.where(F.col("place").isin(*places))
        .groupBy("hour_key")
        .agg(F.map_from_entries(F.collect_list(F.struct("place", cell))).alias("weather"))
    )


def place_text(cells: Column, places: Sequence[str], strict: bool = True) -> Column:
    """The cells of the places in their order, blank separated.

    ``strict``: null as soon as one place is missing; else missing ones are skipped.
    """
    parts = [F.translate(F.try_element_at(cells, F.lit(p)), ",", " ") for p in places]
    if not strict:
        return F.concat_ws(" ", *parts)
    spaced = [c for p in parts for c in (F.lit(" "), p)][1:]
    return F.concat(*spaced)


def join_weather(
    rows: DataFrame, weather: DataFrame, places: Sequence[str], strict: bool = True
) -> DataFrame:
    """Rows with the weather text of their hour; '' where there is none.

    ``rows`` has a ``weatherkey`` column, ``weather`` comes from ``weather_by_hour``.
    """
    texts = weather.select(
        F.col("hour_key").alias("weatherkey"),
        place_text(F.col("weather"), places, strict).alias("weather"),
    )
    joined = rows.join(texts, "weatherkey", "left")
    return joined.withColumn("weather", F.coalesce("weather", F.lit("")))


def forecast_by_slot(forecast: DataFrame, places: Sequence[str]) -> DataFrame:
    """Forecast as one map per slot; the first entry of a place and slot wins.

    A place whose first entry is incomplete has no text in that slot.
    """
    values = F.struct("main", "wind", "temp")
    listed = forecast.where(F.col("place").isin(*places))
    first = listed.groupBy("place", "dt_txt").agg(F.min_by(values, "pos").alias("slot")).where(
        "slot.main is not null and slot.wind is not null and slot.temp is not null"
    )
    cell = F.concat_ws(
        " ", "slot.main", F.col("slot.wind").cast("string"), F.col("slot.temp").cast("string")
    )
    return first.groupBy("dt_txt").agg(
        F.map_from_entries(F.collect_list(F.struct("place", cell))).alias("weather")
    )


def join_forecast(requests: DataFrame, slots: DataFrame, places: Sequence[str]) -> DataFrame:
    """Requests with the forecast text of their slot.

    ``slots`` comes from ``forecast_by_slot``. One join on the slot covers all
    places; places without a forecast are skipped. Hand in a stored table when
    there are many requests: Spark then knows the size of the slots beforehand
    and need not shuffle the requests.
    """
    texts = slots.select(
        "dt_txt", place_text(F.col("weather"), places, strict=False).alias("weather")
    )
    slot = classes.forecast_time(F.col("day"), F.col("daytime"))
    joined = requests.withColumn("dt_txt", slot).join(texts, "dt_txt", "left")
    return joined.withColumn("weather", F.coalesce("weather", F.lit(""))).drop("dt_txt")


def new_names(rows: DataFrame, active: DataFrame) -> DataFrame:
    """Names in ``rows`` that are not active yet.

    Both sides are made distinct first: a name that fills a third of either
    table then reaches the join as one row.
    """
    return distinct_names(rows).join(distinct_names(active), "name", "left_anti")


def known_names(rows: DataFrame, active: DataFrame) -> DataFrame:
    """Names in ``rows`` that are active already."""
    return distinct_names(rows).join(distinct_names(active), "name", "left_semi")


def minute_lookup(series: DataFrame, metadata: DataFrame) -> DataFrame:
    """The viewer series with the last metadata sample of each minute.

    ``metadata`` has ``name, created, game, status, fps``; minutes without a
    sample keep nulls.
    """
    last = metadata.groupBy("name", F.date_trunc("minute", "created").alias("minute")).agg(
        F.max(F.struct("created", "game", "status", "fps")).alias("info")
    )
    joined = series.join(last, ["name", "minute"], "left")
    return joined.select(series["*"], "info.game", "info.status", "info.fps")
