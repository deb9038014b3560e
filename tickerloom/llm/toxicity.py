"""Toxicity: severity grades by cumulative-link ordinal regression.

P(grade <= k) = logistic(threshold_k - w.x): all thresholds share the weights of the sparse text
features, distinct words and their first four and five letters. The expected severity is the
sum over grades k >= 1 of P(grade >= k). Labels only say toxic or not. A toxic text gets the higher of two
grades if a regression fitted to the other half of the sample, which has not seen it, scores it above the median of the toxic
texts of its half.

The model is fitted on a bounded sample of labelled documents (SAMPLE of each class) and on all features that
LEAST_TEXTS of them have. None is left out for telling little: the ridge on a weight grows as the feature's contrast between
the classes, in standard errors, falls below the largest that so many features reach by chance, sqrt(2 ln n).
Every document is judged by its whole text.

Edge cases: a null or empty text has no feature and is judged by the thresholds alone; a null label or id
is not learned from; of rows that share an id the least text is learned from; without labels of both classes nothing is rejected;
equal rows get equal results; an empty table gives an empty result; other columns pass unchanged.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.text import bounded_batches, kept_table

SAMPLE = 3000  # labelled documents of each class
LEAST_TEXTS = 3  # labelled documents that a feature must occur in
RIDGE = 3e-4  # on the weights of features that tell more than chance
HALF_STEPS = 100  # of the fits to halves, which only part the toxic texts
PREFIXES = (4, 5)
LIMIT = 0.4  # expected severity from which a document is toxic
WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    found = set(WORD.findall(text.lower()))
    return found | {f"{w[:n]}*" for n in PREFIXES for w in found if len(w) > n}


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def __post_init__(self):
        self.known: dict[str, tuple[str, ...]] = {}

    def score(self, text: str) -> float:
        """w.x; what a word contributes to the set of features is remembered."""
        if len(self.known) > 500_000:
            self.known.clear()
        got: set[str] = set()
        for w in set(WORD.findall(text.lower())):
            held = self.known.get(w)
            if held is None:
                names = [w, *[f"{w[:n]}*" for n in PREFIXES if len(w) > n]]
                held = self.known[w] = tuple(n for n in names if n in self.weights)
            if held:
                got.update(held)
        return math.fsum(map(self.weights.__getitem__, got))

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k), a column per k >= 1."""
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds)[None, :] - scores[:, None], -50, 50)))


def prior_scale(rows: list[np.ndarray], toxic: np.ndarray, n: int) -> np.ndarray:
    """How freely each weight may move: 1 where the classes differ by more than chance, falling with the contrast's square below."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    column, each = np.concatenate(rows), np.repeat(toxic, [len(r) for r in rows])
    c1, c = np.bincount(column, each, n), np.bincount(column, minlength=n)
    p = c / (n1 + n0)
    contrast = np.abs(c1 / n1 - (c - c1) / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
    return np.minimum(1, contrast / np.sqrt(2 * np.log(max(n, 2)))) ** 2


def severity_grades(rows: list[np.ndarray], toxic: np.ndarray, half: np.ndarray, n: int) -> np.ndarray:
    """0 for clean texts, 1 or 2 for toxic ones, by scores of a regression that was fitted to the other half."""
    grades = toxic.copy()
    for k in (0, 1):
        own, other = np.flatnonzero(half == k), np.flatnonzero(half != k)
        if len(set(toxic[other])) < 2 or not toxic[own].any():
            return toxic
        learned = [rows[i] for i in other]
        weights, _ = fit_ordinal(learned, toxic[other], n, HALF_STEPS, scale=prior_scale(learned, toxic[other], n))
        marks = np.array([weights[rows[i]].sum() for i in own])
        grades[own[(toxic[own] == 1) & (marks > np.median(marks[toxic[own] == 1]))]] = 2
    return grades


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n: int, steps=300, rate=0.1, ridge=RIDGE, scale=None):
    """Weights and ordered thresholds by gradient steps (Adam) on the mean log-likelihood.

    A weight is its ``scale`` (one unless given) times a parameter, so small scales hold weights to zero.
    """
    k = int(grades.max())
    scale = np.ones(n) if scale is None else scale
    lengths = np.array([len(r) for r in rows])
    column = np.concatenate(rows).astype(np.int64) if lengths.sum() else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), lengths)
    above = np.array([(grades >= j).mean() for j in range(1, k + 1)])
    theta = -np.log(above / (1 - above))
    p = np.concatenate([np.zeros(n), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    logistic = lambda x: 1 / (1 + np.exp(-np.clip(x, -50, 50)))
    for t in range(1, steps + 1):
        w, theta = scale * p[:n], p[n] + np.concatenate([[0], np.cumsum(np.exp(p[n + 1 :]))])
        score = np.bincount(row, w[column], len(rows))
        cdf = np.zeros((len(rows), k + 2))
        cdf[:, 1:-1] = logistic(theta[None, :] - score[:, None])
        cdf[:, -1] = 1
        slope = cdf * (1 - cdf)
        i = np.arange(len(rows))
        chance = np.maximum(cdf[i, grades + 1] - cdf[i, grades], 1e-12)
        up, down = slope[i, grades + 1] / chance, slope[i, grades] / chance
        g_theta = np.zeros(k)
        np.add.at(g_theta, np.minimum(grades, k - 1), np.where(grades < k, -up, 0))
        np.add.at(g_theta, np.maximum(grades - 1, 0), np.where(grades > 0, down, 0))
        g = np.empty_like(p)
        g[:n] = scale * np.bincount(column, (up - down)[row], n) / len(rows) + ridge * p[:n]
        tail = np.cumsum(g_theta[::-1])[::-1] / len(rows)  # each step up moves all later thresholds
        g[n] = tail[0]
        g[n + 1 :] = tail[1:] * np.exp(p[n + 1 :])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return scale * p[:n], p[n] + np.concatenate([[0], np.cumsum(np.exp(p[n + 1 :]))])


def in_order(found: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Features, toxic and half of the sample's texts, sorted by toxic, half and features.

    All features stay in one array of four bytes each, of which the rows are views: as lists of numbers they took the driver
    ten times that.
    """
    held = found.column("held").combine_chunks()
    toxic, half = (found.column(c).to_numpy().astype(np.int64) for c in ("toxic", "half"))
    values, ends = held.values.to_numpy(), held.offsets.to_numpy()
    rows = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
    order = sorted(range(len(rows)), key=lambda i: (toxic[i], half[i], rows[i].astype(">i4").tobytes()))  # as lists compare
    return [rows[i] for i in order], toxic[order], half[order]


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", sample=SAMPLE) -> Model | None:
    spark = docs.sparkSession
    bounded_batches(spark)
    some = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = some.where("toxic = 1").orderBy(*order).limit(sample).union(
        some.where("toxic = 0").orderBy(*order).limit(sample)
    )  # 2 * sample rows at most

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([sorted(features(t)) for t in texts], pa.list_(pa.string()))],
                ["half", "toxic", "features"],
            )

    texts = (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.first("toxic").cast("int").alias("toxic"), F.min("text").alias("text"))
        .select(F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int").alias("half"), "toxic", "text")
    )
    rows = kept_table(texts.mapInArrow(run, "half int, toxic int, features array<string>"), "toxic-sample")
    if len(rows.select("toxic").distinct().collect()) < 2:
        return None
    vocabulary = rows.select(F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("n"))
    names = sorted(vocabulary.where(F.col("n") >= LEAST_TEXTS).select("f").toArrow().column(0).to_pylist())
    place = {f: i for i, f in enumerate(names)}

    def placed(batches):
        for batch in batches:
            held = [[place[f] for f in found if f in place] for found in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(held, pa.list_(pa.int32()))], ["half", "toxic", "held"]
            )

    held, toxic, half = in_order(rows.mapInArrow(placed, "half int, toxic int, held array<int>").toArrow())  # 2 * sample rows
    grades = severity_grades(held, toxic, half, len(names))
    weights, thresholds = fit_ordinal(held, grades, len(names), scale=prior_scale(held, toxic, len(names)))
    return Model({f: float(w) for f, w in zip(names, weights) if w}, tuple(map(float, thresholds)))


def severity(docs: DataFrame, model: Model | None, id_col="doc_id", text_col="text", limit=LIMIT) -> DataFrame:
    """doc_id, severity (expected grade), grade (most likely) and toxic of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reach = _reach(model, batch.column(1))
            expected = reach.sum(axis=1)
            chances = -np.diff(np.concatenate([np.ones((len(reach), 1)), reach, np.zeros((len(reach), 1))], axis=1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.round(expected, 9)),
                    pa.array(chances.argmax(axis=1).astype(np.int32)),
                    pa.array(expected >= limit),
                ],
                ["doc_id", "severity", "grade", "toxic"],
            )

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, severity double, grade int, toxic boolean")


def _reach(model: Model | None, texts) -> np.ndarray:
    if model is None:
        return np.zeros((len(texts), 1))
    return model.at_least(np.array([model.score(t or "") for t in texts.to_pylist()]))


def without_toxic(docs: DataFrame, model: Model | None, text_col="text", limit=LIMIT) -> DataFrame:
    """The rows below the limit, with all their columns."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_reach(model, batch.column(place)).sum(axis=1) < limit))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
