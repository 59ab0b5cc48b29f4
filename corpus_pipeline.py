"""A corpus from raw documents to piece ids, in five stages.

Each stage takes the documents that the one before it kept, as written Parquet, and returns
those that it keeps with the columns of documents; the last returns the encoded texts. A
stage only takes away what its operator finds, so other documents pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtide.llm import decontaminate, language, lines, neardup, pieces
from streamtide.llm.common import scratch, stored
from streamtide.llm.queries import MODEL_FILE, table

#: Ids up to this number (24 bytes each at most) are broadcast, 48 MB; beyond it the join shuffles.
BROADCAST_IDS = 2_000_000
#: Words of a shingle in the near-duplicate stage, as in op9_near_duplicates.
NEAR_WIDTH = 2


def without(docs: DataFrame, gone: DataFrame, on: list[str]) -> DataFrame:
    """The documents whose ids are not among the stored ``gone``."""
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, on, "left_anti")


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the other columns in one, where no operator's column can take their place."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(None).cast("int").alias("end__")).alias("others__"))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that ``packed`` put together, in their order."""
    return rows.select(*(F.col(c) if c in ("doc_id", "text") else F.col("others__")[c].alias(c) for c in columns))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language (null, or no letter) go, also if none is labelled.
    Each row is judged for itself, repeated ones alike; columns named as the operator's stay as they are."""
    model = language.fit(docs)
    if not model.languages:
        return language.lettered(docs)
    known = language.predict(packed(docs), model)
    return unpacked(known.where(F.col("lang_pred") != language.UNKNOWN), docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are cut out; a document of which only blanks are left goes. Null and
    empty texts stay; repeated rows (same id and text) are one document, so all are cut alike."""
    left = lines.dedup(packed(docs))
    left = unpacked(left.where(F.col("removed_runs").isNull() | F.col("text").rlike(r"\S")), docs.columns)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (shingles of ``NEAR_WIDTH`` words, 0.8) the document with
    the least id stays. Texts without words, null texts and rows without an id stay; of repeated
    rows that share the least id all stay. An empty table stays empty."""
    gone = stored(neardup.groups(docs, NEAR_WIDTH).where("not kept").select("doc_id").distinct(), "near-duplicates")
    return without(docs, gone, ["doc_id"]).select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    marked = docs.withColumn("key__", F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie")))
    found = decontaminate.scan(marked, table(spark, sf_dir, "benchmark"), doc_id="key__")
    gone = stored(found.where("n_hit > 0").select(F.col("doc_id").alias("key__")).distinct(), "contaminated")
    return without(marked, gone, ["key__"]).select(*docs.columns)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, checked by decoding them."""
    return pieces.digest(docs, pieces.load(MODEL_FILE))


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("SentencePiece", pieces_stage),
]

#: SQL can express neither the language model nor the pieces; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
