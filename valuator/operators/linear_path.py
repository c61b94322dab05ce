"""Linear models from sufficient statistics (M8, M16): one aggregate by fold and
sample decile, from which every fold, penalty and training size is fitted.

The sums of products of the features and the target, taken around one centre
for all groups so that they do not cancel, add up over groups: the training
sums of a fold are those of the other folds, a nested sample of 10, 20, ...
percent is so many deciles of the key's hash. Ridge is solved from them, lasso
and elastic net by coordinate descent on them, and the held-out error of any
weights follows from the held-out fold's own sums. What reaches the driver is
folds x 10 rows, however large the table is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuator.operators.train import LCG_MOD, MAX_FOLDS, mix_hash
from valuator.plans.strategy import fit_quantiles, fit_row

DECILES = 10


@dataclass
class Sums:
    """Second moments of (1, features, target) around ``center``; rows with the same centre add up."""
    center: np.ndarray
    s: np.ndarray

    def __add__(self, other: Sums) -> Sums:
        return Sums(self.center, self.s + other.s)

    @property
    def n(self) -> float:
        return float(self.s[0, 0])

    def centered(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gram matrix and target products around the means of these rows, and the means."""
        mean = self.s[0, 1:] / self.n
        g = self.s[1:, 1:] - self.n * np.outer(mean, mean)
        return g[:-1, :-1], g[:-1, -1], mean

    def rmse(self, w: np.ndarray, intercept: float) -> float:
        """Of the prediction ``intercept + (x - center) w`` for the target less its centre."""
        v = np.concatenate([[-intercept], -w, [1.0]])
        return float(np.sqrt(max(v @ self.s @ v, 0.0) / self.n))


def training_sums(df: DataFrame, key: str, features: Sequence[str], target: str, fold: str) -> dict[tuple[int, int], Sums]:
    """(fold, decile of the key's hash) -> sums. Nulls count as the column's median over all rows; rows without a target do not count."""
    rows = df.filter(F.col(target).isNotNull())
    medians = fit_quantiles(rows, list(features), [0.5])
    value = {f: F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), F.lit(float(medians[f][0]) if medians[f] else 0.0)) for f in features}
    cols = [*value.values(), F.col(target).cast("double")]
    named = rows.select(F.col(fold).alias("fold"), F.least(F.floor(mix_hash(key, 7) * F.lit(DECILES / LCG_MOD)), F.lit(DECILES - 1)).cast("int").alias("decile"),
                        *[c.alias(f"x{i}") for i, c in enumerate(cols)])
    center = fit_row(named, *[F.avg(f"x{i}").alias(f"x{i}") for i in range(len(cols))])
    center = np.array([center[f"x{i}"] or 0.0 for i in range(len(cols))])
    c = [F.lit(1.0), *[F.col(f"x{i}") - F.lit(float(m)) for i, m in enumerate(center)]]
    pairs = [(i, j) for i in range(len(c)) for j in range(i, len(c))]
    got = named.groupBy("fold", "decile").agg(*[F.sum(c[i] * c[j]).alias(f"s{i}_{j}") for i, j in pairs]).limit(MAX_FOLDS * DECILES + 1).collect()
    if len(got) > MAX_FOLDS * DECILES:
        raise ValueError(f"{fold} must have at most {MAX_FOLDS} values")
    out = {}
    for r in got:
        s = np.zeros((len(c), len(c)))
        for i, j in pairs:
            s[i, j] = s[j, i] = r[f"s{i}_{j}"]
        out[r["fold"], r["decile"]] = Sums(center, s)
    return out


def ridge_weights(gram: np.ndarray, xy: np.ndarray, alpha: float) -> np.ndarray:
    """Least |y - Xw|^2 + alpha |w|^2; of equally good weights the shortest."""
    return np.linalg.lstsq(gram + alpha * np.eye(len(xy)), xy, rcond=None)[0]


def elastic_net_weights(gram: np.ndarray, xy: np.ndarray, n: float, alpha: float, l1_ratio: float, tol: float = 1e-10,
                        max_sweeps: int = 20_000, start: np.ndarray | None = None) -> np.ndarray:
    """Least |y - Xw|^2 / 2n + alpha (l1_ratio |w|_1 + (1 - l1_ratio) |w|^2 / 2), by coordinate descent on the sums."""
    w = np.zeros(len(xy)) if start is None else start.copy()
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    scale = np.sqrt(np.maximum(np.diag(gram) / n, 1e-300))
    for _ in range(max_sweeps):
        moved = 0.0
        for j in range(len(w)):
            if gram[j, j] <= 0:
                continue
            rho = (xy[j] - gram[j] @ w + gram[j, j] * w[j]) / n
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (gram[j, j] / n + l2)
            moved = max(moved, abs(new - w[j]) * scale[j])
            w[j] = new
        if moved <= tol * max(1.0, float(np.max(np.abs(w) * scale))):
            break
    return w


def _fit(train: Sums, kind: str, alpha: float) -> tuple[np.ndarray, float]:
    gram, xy, mean = train.centered()
    if kind == "ridge":
        w = ridge_weights(gram, xy, alpha)
    else:
        w = elastic_net_weights(gram, xy, train.n, alpha, {"lasso": 1.0, "elastic_net": 0.5}[kind])
    return w, float(mean[-1] - mean[:-1] @ w)


def _total(parts: Sequence[Sums]) -> Sums:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def linear_paths(df: DataFrame, key: str, features: Sequence[str], target: str, fold: str, alphas: Sequence[float],
                 kinds: Sequence[str] = ("ridge", "lasso", "elastic_net")) -> DataFrame:
    """M8 with M12: (model, alpha, cv_rmse over all held-out rows, non-zero weights on all rows) for every model and penalty."""
    sums = training_sums(df, key, features, target, fold)
    folds = sorted({f for f, _ in sums})
    by_fold = {f: _total([s for (g, _), s in sums.items() if g == f]) for f in folds}
    everything = _total(list(by_fold.values()))
    out = []
    for kind in kinds:
        for alpha in alphas:
            square = 0.0
            for f in folds:
                rest = [by_fold[g] for g in folds if g != f]
                held = by_fold[f]
                square += held.n * held.rmse(*_fit(_total(rest) if rest else held, kind, alpha)) ** 2
            w, _ = _fit(everything, kind, alpha)
            out.append((kind, float(alpha), float(np.sqrt(square / everything.n)), int(np.count_nonzero(w))))
    return df.sparkSession.createDataFrame(out, "model string, alpha double, cv_rmse double, n_weights int")


def linear_learning_curve(df: DataFrame, key: str, features: Sequence[str], target: str, fold: str, alpha: float = 0.0) -> DataFrame:
    """M16 for ridge: train and held-out RMSE, means over folds, at 10, 20, ... 100 percent of the training rows; samples are nested."""
    sums = training_sums(df, key, features, target, fold)
    folds = sorted({f for f, _ in sums})
    out = []
    for d in range(1, DECILES + 1):
        scores = []
        for f in folds:
            part = [s for (g, x), s in sums.items() if g != f and x < d]
            if part:
                train = _total(part)
                w = _fit(train, "ridge", alpha)
                scores.append((train.rmse(*w), _total([s for (g, _), s in sums.items() if g == f]).rmse(*w)))
        if scores:
            out.append((d / DECILES, float(np.mean([a for a, _ in scores])), float(np.mean([b for _, b in scores]))))
    return df.sparkSession.createDataFrame(out, "train_fraction double, train_rmse double, cv_rmse double")
