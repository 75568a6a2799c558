"""The re-aimed model: one linear layer + softmax cross-entropy.

Parameters are a ``K x d`` weight matrix and ``K`` biases (a final linear
layer, zero start). Scoring runs as built-in array expressions in the JVM,
with the parameters as literal arrays (``K * d`` numbers, independent of
the data size).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Params:
    w: np.ndarray  # (K, d)
    b: np.ndarray  # (K,)

    @classmethod
    def zeros(cls, k: int, d: int) -> "Params":
        return cls(np.zeros((k, d)), np.zeros(k))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w, self.b[:, None]], axis=1).ravel()

    @classmethod
    def from_flat(cls, v: np.ndarray, k: int, d: int) -> "Params":
        m = np.asarray(v, dtype=float).reshape(k, d + 1)
        return cls(m[:, :d].copy(), m[:, d].copy())

    def long_form(self, spark) -> DataFrame:
        """``(k, j, w)`` rows; ``j = d`` holds the bias."""
        k, d = self.w.shape
        m = np.concatenate([self.w, self.b[:, None]], axis=1)
        rows = [(int(i), int(j), float(m[i, j])) for i in range(k) for j in range(d + 1)]
        return spark.createDataFrame(rows, "k int, j int, w double")


def _lit_matrix(m: np.ndarray) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in m])


def scores_expr(x: Column, params: Params) -> Column:
    """``z[k] = b[k] + sum_j w[k][j] * x[j]`` as an array of K doubles."""
    k = params.w.shape[0]
    wm = _lit_matrix(params.w)
    bv = F.array(*[F.lit(float(v)) for v in params.b])
    return F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda i: F.aggregate(
            F.zip_with(x, F.element_at(wm, i + 1), lambda a, w: a.cast("double") * w),
            F.element_at(bv, i + 1), lambda acc, v: acc + v))


def scores(df: DataFrame, params: Params, col: str = "embedding", out: str = "scores") -> DataFrame:
    return df.withColumn(out, scores_expr(F.col(col), params))


def cross_entropy_expr(z: Column, label: Column) -> Column:
    """``-(z[y] - max z - log sum exp(z - max z))``, stable form."""
    mx = F.array_max(z)
    lse = F.log(F.aggregate(z, F.lit(0.0), lambda acc, v: acc + F.exp(v - mx)))
    return lse - (F.element_at(z, (label + 1).cast("int")) - mx)


def with_loss(df: DataFrame, z: str = "scores", label: str = "label", out: str = "loss") -> DataFrame:
    return df.withColumn(out, cross_entropy_expr(F.col(z), F.col(label)))


def argmax_expr(z: Column) -> Column:
    """Index of the largest score; the first maximum wins."""
    return (F.array_position(z, F.array_max(z)) - 1).cast("int")


def with_prediction(df: DataFrame, z: str = "scores", out: str = "pred") -> DataFrame:
    return df.withColumn(out, argmax_expr(F.col(z)))


def label_range(df: DataFrame, label: str, classes: int) -> None:
    """Raises unless all labels are whole numbers from 0 to ``classes - 1``."""
    row = df.agg(F.min(label).alias("lo"), F.max(label).alias("hi"),
                 F.count(F.when(F.col(label).isNull(), 1)).alias("nulls")).first()
    if row.nulls or (row.lo is not None and (row.lo < 0 or row.hi >= classes)):
        raise ValueError(f"labels must lie in 0..{classes - 1}: found {row.lo}..{row.hi}, {row.nulls} nulls")


def fit_centroids(df: DataFrame, col: str = "embedding", label: str = "label",
                  classes: int = 10) -> Params:
    """Nearest-centroid parameters fitted from the table.

    ``w[k]`` = mean vector of class ``k``, ``b[k] = -|w[k]|^2 / 2``, so the
    arg-max of the scores is the nearest class mean. One aggregate keyed by
    (class, element); ``K * d`` numbers reach the driver.
    """
    label_range(df, label, classes)
    rows = df.select(label, F.posexplode(col).alias("j", "x")) \
        .groupBy(label, "j").agg(F.avg(F.col("x").cast("double")).alias("mu")).collect()
    d = max(r.j for r in rows) + 1
    w = np.zeros((classes, d))
    for r in rows:
        w[r[label], r.j] = r.mu
    b = -0.5 * (w * w).sum(axis=1)
    return Params(w, b)
