"""Quality by hierarchical empirical Bayes.

A document's evidence is the log likelihood ratio of a logistic model over the make-up of its
text. Sites give the prior: the good share of a path (a part of a host) is shrunk toward that
of its host, and the host's toward that of all documents, each with a strength estimated from
how much the groups differ beyond chance. A document counts in its groups by its label if it
has one, else by the model's probability; it is left out of its own prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtide.llm.common import as_bytes, in_tasks, slices, stored

#: About so many labelled documents are fitted, picked by a hash of the id; their features
#: (below 50 numbers each) are what reaches the driver.
SAMPLE = 20_000
RIDGE = 1.0
STEPS = 25
#: Bounds of a document's evidence and of a group's prior strength.
MOST_EVIDENCE = 8.0
STRENGTH = (1.0, 1e6)


def byte_kinds() -> np.ndarray:
    """One kind each for upper case, lower case, digits, control bytes, bytes outside ASCII,
    and every other sign."""
    kinds = np.zeros(256, np.int64)
    kinds[65:91], kinds[97:123], kinds[48:58], kinds[:32], kinds[128:] = 0, 1, 2, 3, 4
    signs = [b for b in range(32, 128) if not (65 <= b < 91 or 97 <= b < 123 or 48 <= b < 58)]
    kinds[signs] = 5 + np.arange(len(signs))
    kinds[10] = 5 + len(signs)
    return kinds


KINDS = byte_kinds()
N_KINDS = int(KINDS.max()) + 1


def features(texts: pa.Array) -> np.ndarray:
    """The square roots of the shares of each byte kind, and the length of words and text."""
    data, offsets = as_bytes(texts)
    n = len(texts)
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * N_KINDS + KINDS[data], minlength=n * N_KINDS).reshape(n, N_KINDS)
    total = np.maximum(sizes, 1)[:, None]
    blanks = counts[:, 5] + counts[:, -1] + 1
    return np.hstack([np.sqrt(counts / total), np.log1p(sizes / blanks)[:, None], np.log1p(sizes)[:, None]])


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the constant, without the prior odds

    def evidence(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale @ self.weights[:-1] + self.weights[-1]
        return np.clip(z, -MOST_EVIDENCE, MOST_EVIDENCE)


def logistic(x: np.ndarray, y: np.ndarray) -> Model:
    """Ridge regression by Newton steps; without both classes there is no evidence."""
    width = 2 + N_KINDS
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(width), np.ones(width), np.zeros(width + 1))
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    a = np.hstack([(x - centre) / scale, np.ones((len(x), 1))])
    penalty = np.full(width + 1, RIDGE)
    penalty[-1] = 1e-6
    w = np.zeros(width + 1)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-6)[:, None]).T @ a + np.diag(penalty), a.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    w[-1] -= np.log(y.mean() / (1 - y.mean()))
    return Model(centre, scale, w)


def labels_of(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """doc_id, good: one row for each labelled id; the mean of repeated labels."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col(doc_id).alias("doc_id")).agg(F.avg(label).alias("good"))


def fit(docs: DataFrame, good: DataFrame, sample: int = SAMPLE) -> Model:
    """The evidence model from about ``sample`` of the labelled documents."""
    n = good.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_000)) / 1_000_000
    picked = good.where(draw < min(1.0, sample / max(n, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("good"), pa.array(list(features(part.column("text"))), pa.list_(pa.float64()))], ["good", "x"])

    rows = in_tasks(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("good", "text"), run, "good double, x array<double>")
    found = rows.toArrow()
    y = np.array(found["good"].to_pylist()) >= 0.5
    return logistic(np.array(found["x"].to_pylist()).reshape(len(y), 2 + N_KINDS), y.astype(float))


def evidence(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, host, path, evidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = model.evidence(features(part.column("text")))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "host", "path")), pa.array(found)], ["doc_id", "host", "path", "evidence"])

    return in_tasks(docs, run, "doc_id long, host string, path string, evidence double")


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def strength(groups: DataFrame, rate: Column, parent: Column) -> float:
    """How many documents a parent's share weighs in its groups: the moments' estimate.

    Groups of a beta distribution around their parents' share differ by more than the chance
    of their own documents; the rest gives the strength.
    """
    spread = F.sum(F.col("n") * (rate - parent) * (rate - parent)) / F.sum("n")
    chance = F.sum(parent * (1 - parent)) / F.sum("n")
    total = F.sum(F.col("n") * parent * (1 - parent)) / F.sum("n")
    row = groups.agg(spread.alias("spread"), chance.alias("chance"), total.alias("total")).first()
    if row.spread is None or row.spread <= row.chance:
        return STRENGTH[1]
    return min(max(row.total / (row.spread - row.chance) - 1, STRENGTH[0]), STRENGTH[1])


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          path: str = "lang", label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """doc_id, evidence, host_rate, path_rate, score (probability of good quality): a row for
    each row of ``docs``, judged for itself.

    Null texts are empty; null hosts and paths are groups of their own; repeated labels are
    averaged, null ones ignored. Without labels, or with one class only, texts give no
    evidence and the share of good ones (a half without labels) decides. Other columns are
    not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"))
    good = stored(labels_of(labels, doc_id, label), "labels")
    model = fit(rows, good, sample)
    known = good.agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0.0)).alias("s")).first()
    prior = (known.s + 1) / (known.n + 2)
    judged = stored(
        evidence(rows, model).join(good, "doc_id", "left")
        .withColumn("soft", F.coalesce("good", sigmoid(F.col("evidence") + float(np.log(prior / (1 - prior)))))), "evidence")
    paths = stored(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("soft").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    k_host = strength(hosts, F.col("s") / F.col("n"), F.lit(prior))
    hosts = hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    groups = paths.join(hosts, "host")
    k_path = strength(groups, F.col("s") / F.col("n"), (F.col("host_s") + k_host * prior) / (F.col("host_n") + k_host))
    host_rate = (F.col("host_s") - F.col("soft") + k_host * prior) / (F.col("host_n") - 1 + k_host)
    path_rate = (F.col("s") - F.col("soft") + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path)
    inside = F.least(F.greatest(F.col("path_rate"), F.lit(1e-6)), F.lit(1 - 1e-6))
    return (
        judged.join(groups, ["host", "path"])
        .withColumn("host_rate", host_rate).withColumn("path_rate", path_rate)
        .select("doc_id", "evidence", "host_rate", "path_rate", sigmoid(F.col("evidence") + logit(inside)).alias("score"))
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The scores, and whether the document is kept: good quality is at least as likely as not."""
    return score(docs, labels).withColumn("kept", F.col("score") >= 0.5)
