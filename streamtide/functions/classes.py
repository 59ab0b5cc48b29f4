"""Codes, classes and unit conversions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: sentiment codes by label
SENTIMENT_CODES = {"neutral": 0, "positive": 1, "negative": 2}

# fixed values: daytime classes by upper hour bound (exclusive); from 22 o'clock 1 again
DAYTIME_BOUNDS = [(6, 1), (12, 2), (15, 3), (18, 4), (22, 5)]

# fixed values: daytime labels by class
DAYTIME_LABELS = {1: "Nachts", 2: "Morgens", 3: "Mittags", 4: "Nachmittags", 5: "Abends"}

# fixed values: forecast time of day by daytime label
FORECAST_TIMES = {
    "Morgens": "06:00:00",
    "Mittags": "12:00:00",
    "Nachmittags": "15:00:00",
    "Abends": "18:00:00",
    "Nachts": "21:00:00",
}
DEFAULT_FORECAST_TIME = "12:00:00"

# fixed values: kelvin offset and viewers per class
KELVIN_OFFSET = 273.0
VIEWERS_PER_CLASS = 1000


def sentiment_code(label: Column) -> Column:
    """1 positive, 2 negative, everything else 0."""
    return (
        F.when(label == "positive", SENTIMENT_CODES["positive"])
        .when(label == "negative", SENTIMENT_CODES["negative"])
        .otherwise(SENTIMENT_CODES["neutral"])
    )


def indicator(condition: Column) -> Column:
    """1 or 0; null stays null (X11)."""
    return condition.cast("int")


def daytime_class(ts: Column) -> Column:
    """X12; null stays null."""
    hour = F.hour(ts)
    result = F.when(hour.isNull(), F.lit(None).cast("int"))
    for bound, value in DAYTIME_BOUNDS:
        result = result.when(hour < bound, value)
    return result.otherwise(1)


def daytime_label(cls: Column) -> Column:
    """X13; values outside the table count as evening, null stays null."""
    table = F.create_map(*map(F.lit, chain(*DAYTIME_LABELS.items())))
    return F.when(
        cls.isNotNull(), F.coalesce(F.try_element_at(table, cls), F.lit(DAYTIME_LABELS[5]))
    )


def forecast_time(day: Column, label: Column) -> Column:
    """Forecast slot ``yyyy-MM-dd HH:mm:ss`` for a day and daytime label."""
    table = F.create_map(*map(F.lit, chain(*FORECAST_TIMES.items())))
    hour = F.coalesce(F.try_element_at(table, label), F.lit(DEFAULT_FORECAST_TIME))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), hour)


def viewer_class(viewers: Column, bucket: str = "round") -> Column:
    """Thousands of viewers, rounded half up or floored."""
    thousands = viewers / VIEWERS_PER_CLASS
    if bucket == "round":
        thousands = thousands + 0.5
    elif bucket != "floor":
        raise ValueError(f"bucket must be 'round' or 'floor', not {bucket!r}")
    return F.floor(thousands).cast("int")


def range_text(cls: Column, bucket: str = "round") -> Column:
    """The viewer range a class covers, as text.

    With ``round`` class k covers k*1000 +- 500, with ``floor`` k*1000 up to
    (k+1)*1000.
    """
    k = cls.cast("long") * VIEWERS_PER_CLASS
    if bucket == "round":
        half = VIEWERS_PER_CLASS // 2
        low, high = F.greatest(k - half, F.lit(0)), k + half
    else:
        low, high = k, k + VIEWERS_PER_CLASS
    return F.concat(low.cast("string"), F.lit(" bis "), high.cast("string"))


def round_half_up(c: Column, digits: int) -> Column:
    """Decimal rounding by floor, the same in every engine."""
    scale = float(10 ** digits)
    return F.floor(c * scale + 0.5) / F.lit(scale)


def kelvin_to_celsius(kelvin: Column, offset: float = KELVIN_OFFSET) -> Column:
    """Two decimals, offset 273 by default."""
    return round_half_up(kelvin - F.lit(offset), 2)
