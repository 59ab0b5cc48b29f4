import os

import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute as brute_windows
from test_lines import brute as brute_lines
from test_neardup import brute as brute_groups

import corpus_pipeline
from streamtide.llm.language import has_letter

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain(rows, items, encode):
    """rows: (doc_id, text). What each stage leaves, one after the other."""
    rows = sorted((d, t) for d, t in rows if has_letter(t))
    split, gone = brute_lines(rows, 50)
    rows = [(d, "\n".join(x for i, x in enumerate(s) if i not in g), bool(g)) for (d, _), s, g in zip(rows, split, gone)]
    rows = [(d, t) for d, t, cut in rows if not cut or t.strip(" \t\n\x0b\f\r")]
    kept = {d for d, _, _, keep in brute_groups(rows, corpus_pipeline.NEAR_WIDTH, 80) if keep}
    rows = [(d, t) for d, t in rows if d in kept]
    rows = [(d, t) for d, t in rows if not brute_windows(t, items)[1]]
    return {d: encode(t) for d, t in rows}


def test_equals_the_stages_by_brute_force(spark, documents, tmp_path):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=corpus_pipeline.MODEL_FILE)
    docs = documents.select(*COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    os.symlink("/root/testdata/sf0.001/benchmark.parquet", tmp_path / "benchmark.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()]
    expected = plain([(r.doc_id, r.text) for r in docs.collect()], items, sp.encode)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {d: r.ids for d, r in got.items()} == expected
    assert all(r.round_trip for r in got.values()) and 100 < len(got) < docs.count()


def test_stages_keep_columns_and_take_no_rows(spark, documents, empty):
    sf_dir = "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, documents, sf_dir)
        assert left.columns == documents.columns and left.schema["text"].dataType.simpleString() == "string"
        assert stage(spark, empty, sf_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, sf_dir).count() == 0


def test_null_ids_and_repeated_rows(spark):
    body = " ".join(f"word{i}" for i in range(30))
    rows = [(None, body, "en", None, 1), (None, "Short text", None, "s", 1), (7, body, "en", "s", 1), (7, body, "en", "s", 1), (3, None, "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "/root/testdata/sf0.001").collect(), docs.schema)
        assert sorted(str(r.doc_id) for r in docs.collect()) == ["7", "7", "None", "None"]


def test_unlabelled_documents_stay(spark, documents):
    docs = documents.withColumn("lang", F.lit(None).cast("string"))
    left = corpus_pipeline.language_stage(spark, docs, "/root/testdata/sf0.001")
    assert left.columns == docs.columns
    got = sorted(r.doc_id for r in left.collect())
    assert got == sorted(r.doc_id for r in docs.collect() if has_letter(r.text)) and 100 < len(got) < docs.count()


def test_columns_named_as_those_of_the_operators_stay(spark):
    body = "\n".join(" ".join(f"line{i}word{k}" for k in range(20)) for i in range(4))
    rows = [(1, body, "en", "a", 1), (2, f"{body}\nIts own words.", "en", "b", 2), (3, "plain english words", "en", "c", 3)]
    docs = spark.createDataFrame([(*r, f"l{r[0]}", r[0], f"d{r[0]}", True) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, removed_runs int, doc string, `a.b` boolean")
    for name, stage in corpus_pipeline.STAGES[:2]:
        left = stage(spark, docs, "/root/testdata/sf0.001")
        assert left.columns == docs.columns
        got = {r.doc_id: r for r in left.collect()}
        assert {d: (r.lang_pred, r.removed_runs, r.doc, r["a.b"]) for d, r in got.items()} == {d: (f"l{d}", d, f"d{d}", True) for d in (1, 2, 3)}
    assert got[2].text == "Its own words." and got[2].n_chars == 14
