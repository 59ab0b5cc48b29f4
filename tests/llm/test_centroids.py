import hashlib
import math

import pytest

from streamtide.llm import centroids

ODD = [None, [], [None] * 4, [1.0, 2.0], [1.0, float("nan"), 0.0, 0.0], [1.0, float("inf"), 0.0, 0.0], [1.0, None, 0.0, 0.0], [0.1] * 5]
SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, ints string"


def brute(rows, k, rounds, dims):
    kept = [(d, [math.floor(1024 * x) for x in v]) for d, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    now = [v for _, v in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    place = lambda v: min((far(v, c), n) for n, c in enumerate(now))
    for _ in range(rounds):
        own = [[v for _, v in kept if place(v)[1] == n] for n in range(len(now))]
        now = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(own, now)]
    return sorted(((d, place(v)[1], place(v)[0]) for d, v in kept), key=repr), now


def frame(spark, rows):
    return spark.createDataFrame([(d, v, "clash", "clash", None) for d, v in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows(spark):
    found = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    own = [(r.vec_id, list(r.embedding[:4])) for r in found]
    own += [(1_000 + k, v) for k, v in enumerate(ODD)] + [(None, [0.5, 0.5, 0.5, 0.5]), (None, [-0.5] * 4)]
    return own + own[:5] * 3 + [(own[0][0], [0.25, -0.25, 0.0, 0.0])]


@pytest.mark.parametrize("values", [centroids.VALUES, 10])
def test_equals_brute_force(spark, rows, values, monkeypatch):
    monkeypatch.setattr(centroids, "VALUES", values)
    expected, now = brute(rows, 8, 10, 4)
    got = centroids.cluster(frame(spark, rows), dims=4)
    assert got.centroids == now
    assert sorted(map(tuple, got.assigned.collect()), key=repr) == expected


def test_ties_and_empty_clusters(spark):
    rows = [(k, [float(k % 2)] * 4) for k in range(12)] + [(99, [0.5] * 4)]
    expected, now = brute(rows, 8, 3, 4)
    got = centroids.cluster(frame(spark, rows), rounds=3, dims=4)
    assert got.centroids == now and len({tuple(c) for c in now}) < 8
    assert sorted(map(tuple, got.assigned.collect()), key=repr) == expected


def test_few_and_no_vectors(spark, rows):
    few = rows[:3]
    expected, now = brute(few, 8, 10, 4)
    got = centroids.cluster(frame(spark, few), dims=4)
    assert got.centroids == now and sorted(map(tuple, got.assigned.collect()), key=repr) == expected
    none = frame(spark, [(1, None), (2, [])])
    assert centroids.cluster(none, dims=4).assigned.collect() == []
    assert centroids.digest(none).collect() == []


def test_large_components(spark):
    rows = [(k, [1000.0 * k, -2000.0 * k, 0.5, 90_000.0]) for k in range(20)]
    expected, now = brute(rows, 8, 10, 4)
    got = centroids.cluster(frame(spark, rows), dims=4)
    assert got.centroids == now and sorted(map(tuple, got.assigned.collect()), key=repr) == expected
    with pytest.raises(ValueError):
        centroids.cluster(frame(spark, [(1, [1e30, 0.0, 0.0, 0.0])]), dims=4)


def test_digest_sums(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = centroids.digest(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by[r.cluster] = by.get(r.cluster, 0) + r.distance
    assert all(r.cluster_inertia == by[r.cluster] and r.inertia == sum(by.values()) for r in got)
