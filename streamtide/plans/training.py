"""Training set, model, scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import HashingTF, IndexToString, StringIndexer, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtide.functions import classes, text, times
from streamtide.operators import joins, quality, rollups

# fixed values: feature dimension, and the forest's size and seed
NUM_FEATURES = 1000
FOREST = {"numTrees": 500, "maxDepth": 4, "maxBins": 16, "seed": 12345}


def feature_text(digits: int | None = None) -> Column:
    """Name, game, duration, daytime, frame rate and weather as one text.

    Shared by training and scoring. ``digits`` rounds the two numbers first.
    Null when a part other than the weather is null.
    """
    numbers = {c: F.col(c) for c in ("dur", "fps")}
    if digits is not None:
        numbers = {c: classes.round_half_up(v, digits) for c, v in numbers.items()}
    parts = [
        F.col("name"), F.col("game"), numbers["dur"].cast("string"),
        F.col("daytime"), numbers["fps"].cast("string"),
        text.empty_if_null(F.col("weather")),
    ]
    return F.concat(*[c for p in parts for c in (F.lit(" "), p)][1:])


def build_training_set(
    sessions: DataFrame,
    obs: DataFrame,
    places: Sequence[str],
    strict: bool = True,
    bucket: str = "round",
    weight: str | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Sessions of many batches to rows ``id, text, target`` (C7: A4 to X34, F3).

    ``obs`` holds one observation per hour and place.
    """
    merged = rollups.reaggregate_sessions(sessions, weight)
    keyed = merged.withColumns({
        "daytime": classes.daytime_label(F.col("daytime")),
        "weatherkey": times.hour_key(F.col("starttime")),
    })
    rows = joins.join_weather(keyed, joins.weather_by_hour(obs, places), places, strict)
    labelled = rows.select(
        F.lit(1).cast("long").alias("id"),
        feature_text(digits).alias("text"),
        classes.viewer_class(F.col("viewers"), bucket).cast("double").alias("target"),
    )
    return quality.not_null(labelled, "text", "target")


def pipeline(algorithm: str = "nb") -> Pipeline:
    """Tokenizer, hashed term counts, indexed target and a classifier (M1-M4, M8)."""
    words = Tokenizer(inputCol="text", outputCol="words")
    counts = HashingTF(numFeatures=NUM_FEATURES, inputCol="words", outputCol="features")
    label = StringIndexer(
        inputCol="target", outputCol="label", stringOrderType="frequencyDesc"
    )
    if algorithm == "nb":
        classifier = NaiveBayes(modelType="multinomial", smoothing=1.0)
    elif algorithm == "rf":
        classifier = RandomForestClassifier(**FOREST)
    else:
        raise ValueError(f"algorithm must be 'nb' or 'rf', not {algorithm!r}")
    return Pipeline(stages=[words, counts, label, classifier])


def train(training: DataFrame, algorithm: str = "nb") -> PipelineModel:
    """C8, M5"""
    return pipeline(algorithm).fit(training)


def save_model(model: PipelineModel, path: str) -> None:
    """K9"""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """M6; a scoring run loads the current path once."""
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with probabilities and the predicted viewer class (M7).

    The prediction is a label index; it is turned back into the class itself.
    """
    restore = IndexToString(
        inputCol="prediction", outputCol="label_text", labels=model.stages[2].labels
    )
    scored = restore.transform(model.transform(rows.drop("target")))
    return scored.drop("words", "features", "rawPrediction", "prediction").withColumn(
        "viewer_class", F.col("label_text").cast("double")
    ).drop("label_text")


def enrich_requests(
    requests: DataFrame, slots: DataFrame, places: Sequence[str], digits: int | None = None
) -> DataFrame:
    """Requests with the feature text, forecast included.

    ``slots`` comes from ``joins.forecast_by_slot``.
    """
    named = requests.withColumns(
        {c: text.clean_name(F.col(c)) for c in ("name", "game")}
    ).withColumnRenamed("duration", "dur")
    return joins.join_forecast(named, slots, places).withColumn("text", feature_text(digits))


def predict(
    requests: DataFrame,
    slots: DataFrame,
    places: Sequence[str],
    model: PipelineModel,
    bucket: str = "round",
    digits: int | None = None,
) -> DataFrame:
    """Requests to viewer classes and range texts.

    ``digits`` must be that of the training set, so that equal numbers are equal text.
    """
    enriched = enrich_requests(requests, slots, places, digits)
    scored = score(model, enriched.select("id", "text"))
    return scored.withColumn("range_text", classes.range_text(F.col("viewer_class"), bucket))
