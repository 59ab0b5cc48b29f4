import re

import pytest

from streamtide.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


#: Queries over vectors, and the one with several rows for a document.
VECTORS, PIECES = ("op12_centroids", "op13_codes"), "op11_packing"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_row_has_an_answer(spark, name):
    table, key = ("embeddings", "vec_id") if name in VECTORS else ("documents", "doc_id")
    rows = spark.read.parquet(f"{DATA}/{table}.parquet")
    got = QUERIES[name](spark, DATA).select(key)
    ids = [r[0] for r in (got.distinct() if name == PIECES else got).collect()]
    assert sorted(ids) == sorted(r[0] for r in rows.select(key).collect())


def test_names_follow_the_operators():
    assert all(re.fullmatch(r"op\d+_[a-z_]+", name) for name in QUERIES)
