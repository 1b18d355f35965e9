"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are the presence of words and of their first four and five letters. One weight per
feature serves all thresholds: P(grade <= k) = logistic(theta_k - w x). The result is the
expected severity, the sum of P(grade > k), and the chance that the grade is above 0.

The labels say toxic or not. Grades above 0 rank toxic documents by how many of the features
that mark toxic ones they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import slices, written

#: Bounds of the sample the model is fitted on, and of the model.
SAMPLE_TOXIC = 4_000
SAMPLE_CLEAN = 8_000
MAX_FEATURES = 20_000

#: A feature must be this telling: G-squared of its counts, and its rate in toxic documents
#: against that in clean ones.
LEAST_G2 = 20.0
LEAST_RATIO = 8.0

#: Marks a toxic document holds at least to be of grade 2 and of grade 3.
GRADE_MARKS = (4, 8)
TOXIC_ABOVE = 0.5
#: Of the squared weights, against the mean loss of a document.
PENALTY = 2e-5
OUTER = ".,!?;:\"'()[]{}<>#*$%&|-_"


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]


def features_of(text: str) -> set[str]:
    words = {w.strip(OUTER) for w in set(text.lower().split())}
    words.discard("")
    return words | {"4:" + w[:4] for w in words if len(w) > 4} | {"5:" + w[:5] for w in words if len(w) > 5}


def labelled_sample(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> DataFrame:
    """(doc_id, toxic, features) of at most so many documents of each label, by a hash of the id.
    Ids labelled both ways count as toxic; null ids and labels are left out."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    picked = known.where("toxic = 1").orderBy("order", "doc_id").limit(toxic).unionByName(
        known.where("toxic = 0").orderBy("order", "doc_id").limit(clean)
    )
    # at most toxic + clean rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(written(picked.select("doc_id", "toxic"))), "doc_id"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            found = [sorted(features_of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.string()))],
                names=["doc_id", "toxic", "features"],
            )

    return rows.mapInArrow(run, "doc_id long, toxic int, features array<string>")


def telling_features(sample: DataFrame, most: int = MAX_FEATURES) -> list[str]:
    """Features that mark toxic documents, the most telling first."""
    sizes = dict(sample.groupBy("toxic").count().collect())
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return []
    counts = sample.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("k1"), (F.count("*") - F.sum("toxic")).alias("k0")
    )
    share = F.lit(n1 / (n1 + n0))
    n = F.col("k1") + F.col("k0")
    g2 = 2 * (
        F.col("k1") * F.log(F.col("k1") / (n * share))
        + F.when(F.col("k0") > 0, F.col("k0") * F.log(F.col("k0") / (n * (1 - share)))).otherwise(0.0)
    )
    ratio = (F.col("k1") / n1) / ((F.col("k0") + 0.5) / n0)
    rows = (
        counts.where("k1 > 0")
        .withColumn("g2", g2)
        .where((F.col("g2") >= LEAST_G2) & (ratio >= LEAST_RATIO))
        .orderBy(F.desc("g2"), "feature")
        .limit(most)
    )
    return [r["feature"] for r in rows.select("feature").collect()]


def fit(documents: list[list[int]], grades: list[int], n_features: int, n_grades: int, rounds: int = 600):
    """Weights and ascending thresholds by gradient steps of adaptive size on the mean negative
    log-likelihood, with a small quadratic penalty."""
    import numpy as np

    y = np.array(grades)
    doc = np.repeat(np.arange(len(y)), [len(d) for d in documents])
    feature = np.concatenate([np.array(d, np.int64) for d in documents]) if documents else np.zeros(0, np.int64)
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    # first threshold, then logarithms of the gaps, so that the order holds
    x = np.concatenate([np.zeros(n_features), [1.0], np.zeros(n_grades - 2)])
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, rounds + 1):
        w, free = x[:n_features], x[n_features:]
        theta = np.concatenate([[-np.inf], free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))]), [np.inf]])
        score = np.bincount(doc, w[feature], len(y))
        up, low = logistic(theta[y + 1] - score), logistic(theta[y] - score)
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p, low * (1 - low) / p
        slope = (d_up - d_low) / len(y)  # of the loss by the score
        grad = np.zeros_like(x)
        grad[:n_features] = np.bincount(feature, slope[doc], n_features) + PENALTY * w
        by_theta = np.zeros(n_grades - 1)
        for k in range(n_grades - 1):
            by_theta[k] = (-(d_up * (y == k)).sum() + (d_low * (y == k + 1)).sum()) / len(y)
        tail = by_theta[::-1].cumsum()[::-1]
        grad[n_features] = tail[0]
        grad[n_features + 1 :] = tail[1:] * np.exp(free[1:])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        x = x - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    free = x[n_features:]
    return x[:n_features], free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])


def train(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Model:
    """Fit on the bounded sample. Without documents of both labels nothing is toxic."""
    sample = written(labelled_sample(docs, labels, toxic, clean))
    names = telling_features(sample)
    if not names:
        return Model({}, (10.0, 20.0, 30.0))
    place = {f: i for i, f in enumerate(names)}
    # only the chosen features of a bounded number of documents reach the driver
    chosen = docs.sparkSession.createDataFrame([(f,) for f in names], "feature string")
    kept = (
        sample.select("doc_id", "toxic", F.explode_outer("features").alias("feature"), F.monotonically_increasing_id().alias("row"))
        .join(F.broadcast(chosen.withColumn("hit", F.lit(True))), "feature", "left")
        .groupBy("doc_id", "toxic")
        .agg(F.collect_set(F.when(F.col("hit"), F.col("feature"))).alias("features"))
        .orderBy("doc_id")
        .collect()
    )
    rows = [[place[f] for f in r["features"]] for r in kept]
    marks = [sum(":" not in f for f in r["features"]) + sum(f.startswith("4:") for f in r["features"]) for r in kept]
    grades = [0 if not r["toxic"] else 1 + sum(m >= g for g in GRADE_MARKS) for r, m in zip(kept, marks, strict=True)]
    weights, thresholds = fit(rows, grades, len(names), 2 + len(GRADE_MARKS))
    return Model({f: float(weights[i]) for f, i in place.items()}, tuple(map(float, thresholds)))


def grade_documents(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row: doc_id, severity (expected grade), grade (likeliest), p_toxic, toxic, and
    the columns in `keep`.

    Null and empty texts hold no feature and get the lowest grade. Repeated rows are graded
    alike; an empty table gives no rows. Whole texts are read, in one pass without an exchange;
    the model is bounded by MAX_FEATURES.
    """
    import math

    weights, thresholds = model.weights, model.thresholds
    schema = docs.select("doc_id", *keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weights.keys()
        for batch in slices(batches, 500):
            out: list[tuple] = []
            for text in batch.column("__text").to_pylist():
                score = sum(weights[f] for f in sorted(features_of(text) & known)) if known else 0.0
                above = [1 / (1 + math.exp(min(700.0, max(-700.0, t - score)))) for t in thresholds]
                chances = [a - b for a, b in zip([1.0, *above], [*above, 0.0], strict=True)]
                out.append((sum(above), chances.index(max(chances)), above[0], above[0] > TOXIC_ABOVE))
            made = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in schema.fields]
                + [pa.array(c, k) for c, k in zip(made, (pa.float64(), pa.int32(), pa.float64(), pa.bool_()), strict=True)],
                names=[*schema.names, "severity", "grade", "p_toxic", "toxic"],
            )

    from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructType

    result = StructType(list(schema.fields)).add("severity", DoubleType()).add("grade", IntegerType())
    result = result.add("p_toxic", DoubleType()).add("toxic", BooleanType())
    return docs.select("doc_id", *keep, F.coalesce("text", F.lit("")).alias("__text")).mapInArrow(run, result)
