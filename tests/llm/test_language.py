import numpy as np
import pytest
from pyspark.sql import functions as F

from streamtide.llm import language

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return language.fit(docs.where(~language.is_held_out(F.col("doc_id"))))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = language.digest(docs).withColumnRenamed("score", "p").join(docs, "doc_id").where("held_out").collect()
    assert len(got) > 150
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    assert all(0 <= r.p <= 1 for r in got)


def test_mixed_documents_have_both_languages(spark, model):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    de, fr = (docs.where(f"lang = '{x}' and length(text) > 1500").orderBy("doc_id").first().text[:1500] for x in ("de", "fr"))
    rows = [(1, de + "\n" + fr, "x"), (2, de, "y"), (3, de + fr[:60], "z")]
    got = {r.doc_id: r for r in language.predict(spark.createDataFrame(rows, "doc_id long, text string, shares string"), model).collect()}
    assert got[1].languages == ["de", "fr"] and abs(sum(got[1].shares) - 1) < 1e-9 and min(got[1].shares) > 0.3
    assert got[2].languages == ["de"] and got[2].lang_score == 1.0
    assert got[3].lang_pred == "de"


def test_odd_rows(documents, empty, model):
    got = {r.doc_id: r for r in language.predict(documents, model).collect()}
    assert len(got) == documents.count() and set(documents.columns) < set(next(iter(got.values())).asDict())
    for k in (0, 1, 2, 4):
        assert got[10_000 + k].lang_pred == "und" and got[10_000 + k].lang_score == 0 and got[10_000 + k].languages == []
    assert got[10_008].lang_pred == got[10_009].lang_pred != "und"
    assert language.predict(empty, model).count() == 0
    assert {r.lang_pred for r in language.digest(documents.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.digest(empty).count() == 0


def plain_mixture(likely, allowed):
    shares = allowed / allowed.sum()
    for _ in range(language.ROUNDS):
        posts = [row * shares / (row * shares).sum() for row in likely]
        shares = np.sum(posts, axis=0) / len(likely)
    return shares, sum(np.log((row * shares).sum()) for row in likely)


def test_mixtures_equal_a_plain_version():
    rng = np.random.default_rng(3)
    counts = np.array([1, 5, 40, 3])
    likely = np.maximum(rng.random((counts.sum(), 4)) ** 6, 1e-4)
    got = language.mixtures(likely, counts)
    at = 0
    for n, row in zip(counts, got):
        own = likely[at:at + n]
        order = np.argsort(-plain_mixture(own, np.ones(4))[0], kind="stable")
        best, score = np.eye(4)[order[0]], np.log(own[:, order[0]]).sum()
        for size in range(2, 5):
            shares, found = plain_mixture(own, np.isin(np.arange(4), order[:size]).astype(float))
            if found - 2.0 * np.log(n + 1) <= score:
                break
            best, score = shares, found - 2.0 * np.log(n + 1)
        assert np.allclose(best, row)
        at += n
