import pytest

DATA = "/root/testdata/sf0.001"

#: Texts that every operator must survive: null, empty, blank, one word, marks only, long.
ODD = [None, "", "   \n\t", "word", "!!! ... ---", "a" * 5000, "x " * 3000, "\U0001F600 été 你好", "same text here", "same text here"]


@pytest.fixture(scope="session")
def documents(spark):
    """Driver documents and odd rows, with columns that no operator knows."""
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rows += [(10_000 + k, text, None, None, None) for k, text in enumerate(ODD)]
    frame = spark.createDataFrame([(*r, "clash", 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string, kind int")
    return frame.repartition(5, "doc_id").cache()


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)
