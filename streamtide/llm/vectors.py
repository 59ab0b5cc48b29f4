"""What the operators on vectors share: kept rows as integers, and sums that tasks add up."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1024


def finite(vector: str) -> Column:
    """Neither null nor with components that are null, infinite or not a number."""
    x = F.col(vector).cast("array<double>")
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf"))), F.lit(False))


def scaled(vector: str, scale: int = SCALE) -> Column:
    """The floor of each component times ``scale``; far above a long's range it saturates."""
    return F.transform(F.col(vector).cast("array<double>"), lambda v: F.floor(v * scale))


def largest(rows: DataFrame, column: str = "ints") -> int:
    """The greatest absolute value in a column of long arrays; 0 without rows."""
    most = F.greatest(F.abs(F.array_max(column).cast("decimal(20,0)")), F.abs(F.array_min(column).cast("decimal(20,0)")))
    return int(rows.agg(F.coalesce(F.max(most), F.lit(0))).first()[0])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` numbers as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def rows_of(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(values).ravel()))


def added(partial: DataFrame, keys: list[str]) -> dict[tuple, tuple[int, dict[int, int]]]:
    """By key, the count and the exact sum at each position of the tasks' partial rows (keys, n,
    sums). The caller bounds the number of keys; tasks send one row a key."""
    wide = partial.select(*keys, "n", F.posexplode("sums").alias("pos", "value"))
    totals = wide.groupBy(*keys, "pos").agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total"))
    out: dict[tuple, tuple[int, dict[int, int]]] = {}
    for r in totals.collect():
        out.setdefault(tuple(r[k] for k in keys), (r["n"], {}))[1][r["pos"]] = int(r["total"])
    return out


def means(found: tuple[int, dict[int, int]], width: int) -> list[int]:
    """The floor of sum by count at each position, in whole numbers."""
    n, sums = found
    return [sums[pos] // n for pos in range(width)]


def digest_of(numbers: Iterable) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in numbers).encode()).hexdigest()
