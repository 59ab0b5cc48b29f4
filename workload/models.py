"""Training and scoring: what a fitted model holds and answers, as far as SQL can say it."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from streamtide import schemas
from streamtide.functions import classes
from streamtide.plans import registry, training
from streamtide.session import scratch_folder, stored
from streamtide.streaming.chat import file_stream
from workload import roles
from workload.features import TRAINING_ROWS, forecast_slots, training_set
from workload.registry import query

#: The label index counts from the most frequent class; the class as text settles ties.
LABELLED = f"""{TRAINING_ROWS.format(text='loose_text')}, rows AS (
  SELECT text, target FROM training WHERE text IS NOT NULL), labels AS (
  SELECT target, count(*) AS n,
         CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(target AS VARCHAR)) - 1 AS DOUBLE) AS label
  FROM rows GROUP BY 1)"""


def stored_training_set(spark, sf_dir):
    """The training set as a table: fitting reads it several times."""
    return stored(training_set(spark, sf_dir, strict=False), "training")


def tokens():
    """The number of words that the hashed counts add up to."""
    return F.aggregate(vector_to_array("features"), F.lit(0.0), lambda total, n: total + n).cast("long")


@query("viewer_class_model", f"""WITH {LABELLED}
SELECT text, label, len(string_split(trim(text), ' ')) AS tokens,
       round(ln((n + 1.0::DOUBLE) / ((SELECT count(*) FROM rows) + (SELECT count(*) FROM labels))), 6) AS prior,
       FALSE AS changed
FROM rows JOIN labels ON rows.target = labels.target""")
def viewer_class_model(spark, sf_dir):
    """Tokens, label order and class priors of the fitted model, and whether the stored model
    answers otherwise (M1-M6, K9, C8)."""
    rows = stored_training_set(spark, sf_dir)
    path = scratch_folder(spark, "model")
    model = training.train(rows)
    training.save_model(model, path)
    again = training.load_model(path).stages[-1]
    again.setPredictionCol("again").setProbabilityCol("p2").setRawPredictionCol("r2")
    prior = F.get(F.array(*[F.lit(float(p)) for p in again.pi]), F.col("label").cast("int"))
    return again.transform(model.transform(rows)).select(
        "text", "label", tokens().alias("tokens"), F.round(prior, 6).alias("prior"),
        (F.col("prediction") != F.col("again")).alias("changed"),
    )


@query("random_forest_model", f"""WITH {LABELLED}
SELECT text, label, CAST(500 AS BIGINT) AS trees, (SELECT count(*) FROM labels) AS classes,
       TRUE AS known_class
FROM rows JOIN labels ON rows.target = labels.target""")
def random_forest_model(spark, sf_dir):
    """The forest with all its trees answers with a class of the training set (M7, M8)."""
    rows = stored_training_set(spark, sf_dir)
    model = training.train(rows, "rf")
    forest = model.stages[-1]
    labels = F.array(*[F.lit(float(x)) for x in model.stages[2].labels])
    scored = training.score(model, rows.withColumn("keep", F.col("target")))
    index = F.array_position(labels, F.col("keep")) - 1
    return scored.select(
        "text", index.cast("double").alias("label"),
        F.lit(forest.getNumTrees).cast("long").alias("trees"),
        F.lit(forest.numClasses).cast("long").alias("classes"),
        F.array_contains(labels, F.col("viewer_class")).alias("known_class"),
    )


@query("predicted_classes", f"""WITH {roles.REQUESTS}, {roles.FORECAST}
SELECT id, name || ' ' || game || ' ' || CAST(dur AS VARCHAR) || ' ' || daytime || ' '
             || CAST(fps AS VARCHAR) || ' ' || coalesce(weather, '') AS text,
       TRUE AS range_of_class
FROM slotted s LEFT JOIN slots ON s.dt_txt = slots.dt_txt""")
def predicted_classes(spark, sf_dir):
    """Every request answered, with the range text of its class."""
    model = training.train(stored_training_set(spark, sf_dir))
    rows = training.predict(
        roles.requests(spark, sf_dir), forecast_slots(spark, sf_dir), roles.PLACES, model, digits=6
    )
    fits = F.col("range_text") == classes.range_text(F.col("viewer_class"), "round")
    return rows.select("id", "text", F.coalesce(fits, F.lit(False)).alias("range_of_class"))


@query("stream_predictions", f"""WITH {roles.REQUESTS}, {roles.FORECAST}
SELECT id, name || ' ' || game || ' ' || CAST(dur AS VARCHAR) || ' ' || daytime || ' '
             || CAST(fps AS VARCHAR) || ' ' || coalesce(weather, '') AS text,
       CASE WHEN id % 2 = 0 THEN '2024-02-01T01' ELSE '2024-02-02T01' END AS version
FROM slotted s LEFT JOIN slots ON s.dt_txt = slots.dt_txt""")
def stream_predictions(spark, sf_dir):
    """A stream of requests, answered by the model that is current: a new version is published
    between two landings (M6, M7, C9)."""
    root = scratch_folder(spark, "registry")
    model = training.train(stored_training_set(spark, sf_dir))
    slots = stored(forecast_slots(spark, sf_dir), "slots")
    asked = roles.requests(spark, sf_dir)
    for rest, stamp in enumerate(("2024-02-01T01", "2024-02-02T01")):
        registry.publish(spark, f"{root}/models", model, stamp)
        asked.where(F.col("id") % 2 == rest).write.mode("append").parquet(f"{root}/requests")
        stream = file_stream(spark, f"{root}/requests", schemas.PREDICTION_REQUEST, fmt="parquet")
        registry.answer_stream(
            stream, slots, roles.PLACES, f"{root}/models", f"{root}/answers", f"{root}/checkpoint", digits=6).awaitTermination()
    return registry.answers(spark, f"{root}/answers").select("id", "text", "version")
