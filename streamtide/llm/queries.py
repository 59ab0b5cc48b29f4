"""The registered queries of the corpus operators: each over its whole tables.

Three have SQL that must give the same rows. SQL cannot express the others in a useful time on
whole tables (scores, fingerprints, components, models, token ids); ``tests/llm`` holds each
against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streamtide.llm import centroids, codes, decontaminate, fingerprints, language, licenses, lines, neardup, packing, pieces, pii, quality, suffixes

#: Read by the driver only; its tables travel with the tasks.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
TOKENIZER_FILE = "/opt/tokenizers/word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(table(spark, sf_dir, "documents"))


def op2_pieces(spark: SparkSession, sf_dir: str, model_file: str | None = None) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), pieces.load(model_file or MODEL_FILE))


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(table(spark, sf_dir, "documents"), passage=suffixes.PASSAGE)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edits(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.digest(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.digest(table(spark, sf_dir, "documents"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str, tokenizer_file: str | None = None) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"), tokenizer_file or TOKENIZER_FILE)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digest(table(spark, sf_dir, "embeddings"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_licenses, op2_pieces, op3_suffixes, op4_decontamination, op5_quality, op6_fingerprints,
    op7_language, op8_personal_data, op9_near_duplicates, op10_lines, op11_packing, op12_centroids, op13_codes)}
ORACLES: dict[str, str] = {"op4_decontamination": decontaminate.oracle_sql(), "op12_centroids": centroids.oracle_sql(), "op13_codes": codes.oracle_sql()}
