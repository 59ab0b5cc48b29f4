"""Clusters of vectors around centroids: distances gathered from scalar lookup tables.

Components are whole numbers, so a dimension holds few different ones. In each round the squared
difference is tabulated for every dimension, every value that occurs in it and every centroid;
the distances of a block of vectors are then sums of table rows, one gather a dimension, and
exact. Tasks send counts and sums of their vectors by centroid, so a round moves a few numbers a
task and the driver sees ``k`` centroids.

The values that occur are counted once. Up to ``VALUES`` of them, all dimensions together, they
travel with the tasks, which tabulate once a round; beyond that each block of vectors is
tabulated by the values that occur in it. Both give the same distances.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtide.llm.common import stored
from streamtide.llm.vectors import SCALE, added, digest_of, finite, largest, matrix, means, rows_of, scaled

#: Pairs of dimension and value in tables that travel: 8 bytes each, and 8 for each centroid.
VALUES = 250_000
#: Vectors whose distances are summed at once.
BLOCK = 2_000


class Values(NamedTuple):
    """Which values occur: all of them dimension by dimension, where each dimension begins, and
    for a value its place, found at ``value - least[d] + base[d]``."""

    flat: np.ndarray
    dim: np.ndarray
    least: np.ndarray
    base: np.ndarray
    place: np.ndarray


class Clusters(NamedTuple):
    assigned: DataFrame
    centroids: list[list[int]]


def whole(vectors: DataFrame, dims: int, vec_id: str, vector: str, scale: int) -> DataFrame:
    kept = vectors.where(finite(vector) & (F.size(F.col(vector)) == dims))
    return kept.select(F.col(vec_id).alias("vec_id"), scaled(vector, scale).alias("ints"))


def first_centroids(rows: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The vectors of the ``k`` smallest hashes of their ids; those of one id by components."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r["ints"]) for r in rows.orderBy(order.asc_nulls_last(), "ints").limit(k).select("ints").collect()]


def occurring(rows: DataFrame, dims: int) -> Values | None:
    """The values of each dimension, or None if they could be more than VALUES."""
    bounds = rows.select(F.posexplode("ints").alias("d", "value")).groupBy("d").agg(F.min("value").alias("least"), F.max("value").alias("most"))
    by_dim = {r["d"]: (r["least"], r["most"]) for r in bounds.collect()}
    if len(by_dim) < dims or sum(most - least + 1 for least, most in by_dim.values()) > VALUES:
        return None
    found = rows.select(F.posexplode("ints").alias("d", "value")).distinct().orderBy("d", "value").toPandas()  # VALUES rows at most
    dim, flat = found["d"].to_numpy(), found["value"].to_numpy()
    least = np.array([by_dim[d][0] for d in range(dims)])
    spans = np.array([by_dim[d][1] - by_dim[d][0] + 1 for d in range(dims)])
    base = np.cumsum(spans) - spans
    place = np.zeros(spans.sum(), np.int64)
    place[flat - least[dim] + base[dim]] = np.arange(len(flat))
    return Values(flat, dim, least, base, place)


def of_block(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values that occur in a block, their dimensions, and the place of each component."""
    flats, dims, places, at = [], [], np.empty(ints.shape, np.int64), 0
    for d in range(ints.shape[1]):
        values, back = np.unique(ints[:, d], return_inverse=True)
        places[:, d] = back + at
        at += len(values)
        flats.append(values)
        dims.append(np.full(len(values), d))
    return np.concatenate(flats), np.concatenate(dims), places


def tabulated(flat: np.ndarray, dim: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """A row for each dimension and value: the squared difference to each centroid."""
    return (flat[:, None] - centroids.T[dim]) ** 2


def gathered(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The squared distance of each vector to each centroid."""
    total = np.zeros((len(places), table.shape[1]), np.int64)
    for d in range(places.shape[1]):
        total += table[places[:, d]]
    return total


def blocks(batches: Iterator[pa.RecordBatch], values: Values | None, centroids: np.ndarray):
    """Of each block its rows, vectors, clusters and distances; ties go to the smaller number."""
    table = tabulated(values.flat, values.dim, centroids) if values else None
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            ints = matrix(part.column("ints"), centroids.shape[1])
            if values:
                own, places = table, values.place[ints - values.least + values.base]
            else:
                flat, dim, places = of_block(ints)
                own = tabulated(flat, dim, centroids)
            distances = gathered(own, places)
            cluster = distances.argmin(axis=1)
            yield part, ints, cluster, distances[np.arange(len(cluster)), cluster]


def moved(rows: DataFrame, values: Values | None, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floors of the means of their vectors; empty ones stay."""
    now = np.array(centroids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(now), np.int64), np.zeros(now.shape, np.int64)
        for _, ints, cluster, _ in blocks(batches, values, now):
            counts += np.bincount(cluster, minlength=len(now))
            for c in np.unique(cluster):
                sums[c] += ints[cluster == c].sum(axis=0)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(counts[some]), rows_of(sums[some])], ["cluster", "n", "sums"])

    totals = added(rows.select("ints").mapInArrow(run, "cluster int, n long, sums array<long>"), ["cluster"])
    return [means(totals[c,], now.shape[1]) if (c,) in totals else centroids[c] for c in range(len(centroids))]


def assigned(rows: DataFrame, values: Values | None, centroids: list[list[int]]) -> DataFrame:
    now = np.array(centroids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, cluster, distance in blocks(batches, values, now):
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3", dims: int = 64, scale: int = SCALE,
            vec_id: str = "vec_id", vector: str = "embedding") -> Clusters:
    """vec_id, cluster, distance for each kept vector, and the centroids in whole numbers.

    Kept are vectors of ``dims`` components, none of them null or non-finite; null and empty
    vectors go. Each row counts, repeated ones too. Rows without an id are kept; they start a
    centroid only if no others are left. With fewer than ``k`` vectors there are as many
    centroids; without any, no rows. Components so large that a distance could pass a long's
    range raise an error. Columns other than the two named are not read.
    """
    rows = stored(whole(vectors, dims, vec_id, vector, scale), "whole-vectors")
    if (2 * largest(rows) + 1) ** 2 * dims >= 1 << 63:
        raise ValueError("components are too large: a squared distance could exceed a long")
    centroids = first_centroids(rows, k, seed)
    if not centroids:
        return Clusters(rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [])
    values = occurring(rows, dims)
    for _ in range(rounds):
        centroids = moved(rows, values, centroids)
    return Clusters(assigned(rows, values, centroids), centroids)


def digest(vectors: DataFrame) -> DataFrame:
    """With each vector the inertia of its cluster and of all, and its centroid's hash."""
    found = cluster(vectors)
    rows = stored(found.assigned, "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["total"]) for r in rows.groupBy("cluster").agg(total.alias("total")).collect()}
    facts = [(c, sums.get(c, 0), sum(sums.values()), digest_of(own)) for c, own in enumerate(found.centroids)]
    named = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int = 8, rounds: int = 10, seed: str = "3", dims: int = 64, scale: int = SCALE) -> str:
    """The rows of ``digest`` in DuckDB SQL, one pair of expressions a round."""
    steps = [
        f"kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings "
        f"WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS cluster, v AS c FROM "
        f"(SELECT v, sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h FROM kept) ORDER BY h NULLS LAST, v LIMIT {k})",
    ]
    numbers = "kept_rows AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, v FROM kept)"
    steps.append(numbers)
    for r in range(rounds + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM "
            f"(SELECT row, vec_id, v, cluster, CAST(list_sum(list_transform(range(1, {dims + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT) AS d "
            f"FROM kept_rows, c{r}) GROUP BY row)")
        if r < rounds:
            steps.append(
                f"c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN "
                f"(SELECT cluster, list(mean ORDER BY i) AS c FROM (SELECT cluster, i, CAST((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS mean "
                f"FROM a{r}, range(1, {dims + 1}) t(i) GROUP BY cluster, i) GROUP BY cluster) m ON m.cluster = c{r}.cluster)")
    return (
        "WITH " + ",\n".join(steps) +
        f"\nSELECT vec_id, a.cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256 "
        f"FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.cluster")
