"""Gaussian mixtures of several sizes fitted in one pass an iteration.

The library fits one mixture at a time, with one small matrix product per row
and component. Here every iteration is one scan for all sizes that have not
converged: a task adds up its rows' shares, first and second moments batch by
batch, and gives one row of sums. Start, steps, tolerance and limit are those of
``GaussianMixture``, so the mixtures are the same but for rounding.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least share of a component, as in the library.
EPSILON = 2.0 ** -52


@dataclass
class Mixture:
    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray
    log_likelihood: float = -math.inf
    iterations: int = 0

    def densities(self) -> list[tuple]:
        """Per component: weight, mean, root of the pseudo-inverse covariance, log of the density at the mean."""
        out = []
        for w, m, c in zip(self.weights, self.means, self.covs):
            values, vectors = np.linalg.eigh(c)
            kept = values > EPSILON * values.max() * len(values)
            if not kept.any():
                raise ValueError("a component's covariance has no non-zero singular values")
            root = vectors[:, kept] / np.sqrt(values[kept])
            out.append((w, m, root, -0.5 * (len(m) * math.log(2 * math.pi) + np.log(values[kept]).sum())))
        return out


def shares(x: np.ndarray, densities: Sequence[tuple]) -> np.ndarray:
    """Weighted densities of the rows, a column per component."""
    out = np.empty((len(x), len(densities)))
    for j, (w, m, root, top) in enumerate(densities):
        z = (x - m) @ root
        out[:, j] = EPSILON + w * np.exp(top - 0.5 * np.einsum("ij,ij->i", z, z))
    return out


def _sums(rows: DataFrame, vector: str, tried: dict[int, list[tuple]], d: int) -> list[np.ndarray]:
    """Per size one flat array: log-likelihood, then weight, first and second moments of each component."""
    upper = np.triu_indices(d)

    def add(batches):
        import pyarrow as pa
        total = [np.zeros(1 + n * (1 + d + len(upper[0]))) for n in tried]
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, d)
            moments = np.column_stack([np.ones(len(x)), x, x[:, upper[0]] * x[:, upper[1]]])
            for at, densities in zip(total, tried.values()):
                p = shares(x, densities)
                whole = p.sum(1)
                at[0] += np.log(whole).sum()
                at[1:] += ((p / whole[:, None]).T @ moments).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(total).tolist()], pa.list_(pa.float64()))], ["s"])

    parts = [np.array(r["s"]) for r in rows.select(vector).mapInArrow(add, "s array<double>").collect()]
    whole = np.sum(parts, axis=0)
    cuts = np.cumsum([1 + n * (1 + d + len(upper[0])) for n in tried])[:-1]
    return np.split(whole, cuts)


def fit_mixtures(rows: DataFrame, features: str, vector: str, sizes: Sequence[int], seed: int = 42, max_iter: int = 100,
                 tol: float = 0.01) -> dict[int, Mixture]:
    """Mixtures of each size. ``rows`` has the features as a vector and as an array of doubles, and should be persisted."""
    from pyspark.ml.clustering import GaussianMixture
    found = {}
    for n in sizes:
        # no iteration: the library's draw of the start
        start = GaussianMixture(k=n, seed=seed, featuresCol=features, maxIter=0).fit(rows)
        found[n] = Mixture(np.array(start.weights), np.array([g.mean.toArray() for g in start.gaussians]),
                           np.array([g.cov.toArray() for g in start.gaussians]))
    d = len(found[sizes[0]].means[0])
    upper = np.triu_indices(d)
    open_ = list(sizes) if max_iter else []
    while open_:
        tried = {n: found[n].densities() for n in open_}
        for n, s in zip(open_, _sums(rows, vector, tried, d)):
            m, per = found[n], s[1:].reshape(n, -1)
            w = per[:, 0]
            m.means = per[:, 1:1 + d] / w[:, None]
            covs = np.zeros((n, d, d))
            covs[:, upper[0], upper[1]] = per[:, 1 + d:] / w[:, None]
            covs[:, upper[1], upper[0]] = covs[:, upper[0], upper[1]]
            m.covs = covs - m.means[:, :, None] * m.means[:, None, :]
            m.weights = w / w.sum()
            before, m.log_likelihood = m.log_likelihood, float(s[0])
            m.iterations += 1
            if m.iterations >= max_iter or abs(m.log_likelihood - before) <= tol:
                open_ = [x for x in open_ if x != n]
    return found


def component(mixture: Mixture, vector: str) -> Column:
    """The most likely component of a row, the first of equals."""
    densities = mixture.densities()

    @F.pandas_udf("int")
    def first(*columns: pd.Series) -> pd.Series:
        return pd.Series(shares(np.column_stack([c.to_numpy() for c in columns]), densities).argmax(1).astype("int32"))

    return first(*[F.get(vector, F.lit(i)) for i in range(len(mixture.means[0]))])
