import math

import pytest
from pyspark.sql import functions as F

from streamtide.llm import quality

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))


def test_held_out_accuracy(tables):
    docs, labels = tables
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 0
    got = quality.digest(docs, labels.where(~held)).join(labels.where(held), "doc_id").collect()
    good, bad = ([r.kept for r in got if r.quality == x] for x in (1, 0))
    assert len(good) > 60 and sum(good) / len(good) > 0.97
    assert len(bad) > 8 and sum(bad) / len(bad) < 0.3


def test_groups_equal_a_plain_version(spark, tables):
    docs, labels = tables
    got = quality.score(docs, labels).join(docs.select("doc_id", F.col("source").alias("host"), F.col("lang").alias("path")), "doc_id").collect()
    good = {r.doc_id: float(r.quality) for r in labels.collect()}
    prior = (sum(good.values()) + 1) / (len(good) + 2)
    soft = {r.doc_id: good.get(r.doc_id, 1 / (1 + math.exp(-r.evidence - math.log(prior / (1 - prior))))) for r in got}
    hosts, paths = {}, {}
    for r in got:
        for table, key in ((hosts, r.host), (paths, (r.host, r.path))):
            n, s = table.get(key, (0, 0.0))
            table[key] = n + 1, s + soft[r.doc_id]

    def strength(groups):  # (n, s, parent share)
        n = sum(g[0] for g in groups)
        spread = sum(g[0] * (g[1] / g[0] - g[2]) ** 2 for g in groups) / n
        chance, total = sum(g[2] * (1 - g[2]) for g in groups) / n, sum(g[0] * g[2] * (1 - g[2]) for g in groups) / n
        return 1e6 if spread <= chance else min(max(total / (spread - chance) - 1, 1), 1e6)

    k_host = strength([(n, s, prior) for n, s in hosts.values()])
    whole = {h: (s + k_host * prior) / (n + k_host) for h, (n, s) in hosts.items()}
    k_path = strength([(n, s, whole[h]) for (h, _), (n, s) in paths.items()])
    for r in got:
        (n, s), (m, t), own = hosts[r.host], paths[r.host, r.path], soft[r.doc_id]
        host = (s - own + k_host * prior) / (n - 1 + k_host)
        path = (t - own + k_path * host) / (m - 1 + k_path)
        assert r.host_rate == pytest.approx(host) and r.path_rate == pytest.approx(path)
        assert r.score == pytest.approx(1 / (1 + math.exp(-r.evidence) * (1 - path) / path))


def test_sites_move_equal_texts(spark):
    body = "The same plain text, of middling quality."
    rows = [(k, body, "good" if k % 2 else "bad", "p") for k in range(400)] + [(900, body, "good", "p"), (901, body, "bad", "p"), (902, body, "new", "q")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    assert got[900].score > 0.8 and got[901].score < 0.2 and abs(got[902].score - 0.5) < 0.1


def test_odd_rows(spark, documents, empty, tables):
    docs, labels = documents, tables[1]
    got = quality.digest(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.digest(empty, labels).count() == 0
    unlabelled = quality.digest(docs, labels.limit(0)).collect()
    assert len(unlabelled) == docs.count() and all(r.evidence == 0 and r.kept for r in unlabelled)
    one = spark.createDataFrame([(1, 1), (1, None), (2, 1), (2, 1), (None, 0)], "doc_id long, quality int")
    assert all(r.kept for r in quality.digest(docs, one).collect())
