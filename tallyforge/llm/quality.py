"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import each_text, held_out, staged
from .textstats import SHAPE_NAMES, shape

SHRINKAGE = 0.02
FOLDS = 5
THRESHOLD = 0.3


@dataclass(frozen=True)
class QuadraticDiscriminant:
    """Class means, inverse Cholesky factors and log weights in standardised space; None factors: only the prior is known."""

    prior: float
    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray] | None = None
    factors: tuple[np.ndarray, np.ndarray] | None = None
    offsets: tuple[float, float] = (0.0, 0.0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Chance of class 1 for each row: the difference of the classes' Mahalanobis log densities, squashed."""
        if self.factors is None or not len(x):
            return np.full(len(x), self.prior)
        z = (x - self.centre) / self.scale
        logs = [o - 0.5 * ((z - m) @ f.T * ((z - m) @ f.T)).sum(axis=1) for m, f, o in zip(self.means, self.factors, self.offsets)]
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the transformed statistics of each whole text; null counts as empty."""

    def run(batches):
        for batch in batches:
            x = np.array([shape(t) for t in each_text(batch.column(1))]).reshape(batch.num_rows, -1)
            flat = pa.array(x.ravel(), pa.float64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * len(SHAPE_NAMES), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "x"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit(stats: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", shrinkage: float = SHRINKAGE) -> QuadraticDiscriminant:
    """Fit on all labelled rows outside the held-out fold.

    Every task adds up counts, sums and cross products of its rows by class; only those sums meet. Several labels of one id
    count as their largest. Without two rows of each class the model is the smoothed share of class 1 alone.
    """
    d = len(SHAPE_NAMES)
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col, FOLDS))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))

    def run(batches):
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            for k in (0, 1):
                part = x[y == k]
                sums[k] += np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
        cells = sums.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "v"])

    rows = stats.join(known, "id").select("x", "y").mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v")).collect()
    sums = np.zeros(2 * (1 + d + d * d))
    for cell, v in rows:
        sums[cell] = v
    sums = sums.reshape(2, -1)
    n = sums[:, 0]
    prior = float((n[1] + 1) / (n.sum() + 2))
    if n.min() < 2:
        return QuadraticDiscriminant(prior, np.zeros(d), np.ones(d))
    total, cross = sums[:, 1 : d + 1], sums[:, d + 1 :].reshape(2, d, d)
    centre = total.sum(axis=0) / n.sum()
    variance = (np.diag(cross.sum(axis=0)) / n.sum() - centre**2).clip(0)
    scale = np.where(variance > 1e-9, np.sqrt(variance), 1.0)  # a statistic that never varies tells nothing
    means, factors, offsets = [], [], []
    for k in (0, 1):
        mean = total[k] / n[k]
        cov = (cross[k] / n[k] - np.outer(mean, mean)) * n[k] / (n[k] - 1) / np.outer(scale, scale)
        cov = (1 - shrinkage) * cov + (shrinkage * np.trace(cov) / d + 1e-6) * np.eye(d)
        roots, axes = np.linalg.eigh((cov + cov.T) / 2)
        chol = np.linalg.cholesky((axes * roots.clip(1e-6)) @ axes.T + 1e-9 * np.eye(d))
        means.append((mean - centre) / scale)
        factors.append(np.linalg.inv(chol))
        offsets.append(float(np.log(n[k] / n.sum()) - np.log(np.diag(chol)).sum()))
    return QuadraticDiscriminant(prior, centre, scale, tuple(means), tuple(factors), tuple(offsets))


def score(stats: DataFrame, model: QuadraticDiscriminant) -> DataFrame:
    """(id, score) for each row of statistics."""

    def run(batches):
        for batch in batches:
            p = model.probability(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["id", "score"])

    return stats.mapInArrow(run, f"id {dict(stats.dtypes)['id']}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, score) of every row of ``docs``; texts are read once. Empty and null texts are scored like any other, repeated
    rows repeat, an empty table gives an empty result, and without usable labels every score is the smoothed prior 0.5."""
    stats = staged(statistics(docs, id_col, text_col), "quality")
    return score(stats, fit(stats, labels, label_col, id_col))
