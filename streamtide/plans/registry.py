"""Versions of the model, and scoring of a request stream with the one that is current.

A version is saved whole before its mark is renamed into place, so the newest mark always names
a complete model. Each micro-batch of requests is answered by the version that is current when
it begins and names it; a batch that is done again after a failure replaces its answers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamtide.plans import training
from streamtide.plans.catalogue import Catalogue

MODELS = "models"


def publish(spark: SparkSession, root: str, model: PipelineModel, stamp: str) -> None:
    """The model as the version of ``stamp`` (``yyyy-MM-dd...``), current from now on if it is the newest."""
    path = f"{root}/versions/{stamp}"
    training.save_model(model, path)
    Catalogue(f"{root}/marks").record(spark, MODELS, stamp, path, stamp)


def current(spark: SparkSession, root: str) -> tuple[str, PipelineModel]:
    """The newest version and its model."""
    marks = Catalogue(f"{root}/marks")
    stamp = marks.newest(spark, MODELS)
    if stamp is None:
        raise LookupError(f"no model has been published below {root}")
    return stamp, training.load_model(marks.paths(spark, MODELS, stamp)[0])


def answer_stream(
    requests: DataFrame, slots: DataFrame, places: Sequence[str], root: str, path: str, checkpoint: str, digits: int | None = None,
) -> StreamingQuery:
    """Answers what has landed of the request stream, below ``path`` by batch, each row with its version."""
    loaded: dict[str, PipelineModel] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stamp = Catalogue(f"{root}/marks").newest(spark, MODELS)
        if stamp not in loaded:
            loaded.clear()
            loaded.update([current(spark, root)])
        [(version, model)] = loaded.items()
        rows = training.predict(batch, slots, places, model, digits=digits)
        columns = "id", "text", "viewer_class", "range_text", F.lit(version).alias("version")
        rows.select(*columns).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


ANSWERS = "id long, text string, viewer_class double, range_text string, version string, batch long"


def answers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANSWERS).parquet(path)
