"""Ensembling and routing.

Weight fitting never collects predictions: every least-squares style
objective over k models needs only the k×k Gram matrix PᵀP, Pᵀy, yᵀy and n,
which is ONE aggregate over the prediction table (k(k+1)/2 + k + 2 sums).
The tiny solve runs on the driver; the weights come back as literals.
Per-row blending, clipping and routing are projections or joins on the key.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuator.functions.columns import PRICE_CAP, PRICE_FLOOR, clip
from valuator.plans.strategy import attach_state, fit_row


# ------------------------------------------------------------------ Gram statistics
@dataclass
class Gram:
    models: list[str]
    ptp: np.ndarray
    pty: np.ndarray
    yty: float
    n: int
    sum_y: float

    def sse(self, w: np.ndarray) -> float:
        return float(self.yty - 2 * w @ self.pty + w @ self.ptp @ w)

    def rmse(self, w: np.ndarray) -> float:
        return math.sqrt(max(self.sse(w), 0.0) / self.n)


def gram(df: DataFrame, preds: Sequence[str], y: str, group: str | None = None) -> Gram | dict:
    """One aggregate pass for PᵀP, Pᵀy, yᵀy, Σy and n (optionally per group)."""
    preds = list(preds)
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum(F.col(y) * F.col(y)).alias("_yy"), F.sum(y).alias("_sy")]
    for i, a in enumerate(preds):
        aggs.append(F.sum(F.col(a) * F.col(y)).alias(f"_py{i}"))
        for j in range(i, len(preds)):
            aggs.append(F.sum(F.col(a) * F.col(preds[j])).alias(f"_pp{i}_{j}"))

    def build(r) -> Gram:
        k = len(preds)
        ptp = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                ptp[i, j] = ptp[j, i] = r[f"_pp{i}_{j}"]
        pty = np.array([r[f"_py{i}"] for i in range(k)], dtype=float)
        return Gram(preds, ptp, pty, float(r["_yy"]), int(r["_n"]), float(r["_sy"]))

    if group is None:
        return build(fit_row(df, *aggs))
    return {r[group]: build(r) for r in df.groupBy(group).agg(*aggs).collect()}


# ------------------------------------------------------------------ W1, W2, W15
def mean_ensemble(long: DataFrame, key: str, pred: str = "prediction") -> DataFrame:
    """Mean of the model (and fold) predictions per key."""
    return long.groupBy(key).agg(F.avg(pred).alias("prediction"), F.count(F.lit(1)).alias("n_predictions"))


def fixed_weight_blend(weights: dict[str, float]) -> Column:
    """Σ wᵢ·predᵢ with fixed weights."""
    out = None
    for c, w in weights.items():
        term = F.lit(float(w)) * F.col(c)
        out = term if out is None else out + term
    return out


def median_ensemble(long: DataFrame, key: str, fold: str, pred: str = "prediction") -> DataFrame:
    """Median over folds of the per-fold mean prediction of each key."""
    per_fold = long.groupBy(key, fold).agg(F.avg(pred).alias("_m"))
    return per_fold.groupBy(key).agg(F.percentile("_m", 0.5).alias("prediction"))


# ------------------------------------------------------------------ W3–W6, W14
def l2_weights(g: Gram, lam: float = 0.1) -> np.ndarray:
    """Solve (PᵀP + λI)w = Pᵀy, clip at 0, normalise; equal weights when
    the system is singular or every weight is clipped away."""
    k = len(g.models)
    try:
        w = np.linalg.solve(g.ptp + lam * np.eye(k), g.pty)
    except np.linalg.LinAlgError:
        return np.full(k, 1.0 / k)
    w = np.maximum(w, 0.0)
    s = w.sum()
    return w / s if s > 0 and np.isfinite(s) else np.full(k, 1.0 / k)


def r2_of(g: Gram, i: int) -> float:
    """R² of model i from the Gram statistics alone."""
    e = np.zeros(len(g.models))
    e[i] = 1.0
    sst = g.yty - g.sum_y ** 2 / g.n
    return 1.0 - g.sse(e) / sst if sst > 0 else float("nan")


def robust_weights(g: Gram, lam: float = 0.1, min_r2: float = -0.5) -> np.ndarray:
    """Drop models with R² ≤ min_r2, W3 on the rest, zero weight for dropped."""
    keep = [i for i in range(len(g.models)) if r2_of(g, i) > min_r2]
    if not keep:
        return np.full(len(g.models), 1.0 / len(g.models))
    sub = Gram([g.models[i] for i in keep], g.ptp[np.ix_(keep, keep)], g.pty[keep], g.yty, g.n, g.sum_y)
    w = np.zeros(len(g.models))
    w[keep] = l2_weights(sub, lam)
    return w


def _project_simplex(v: np.ndarray) -> np.ndarray:
    u = np.sort(v)[::-1]
    css = np.cumsum(u)
    rho = np.nonzero(u * np.arange(1, len(v) + 1) > (css - 1))[0][-1]
    theta = (css[rho] - 1) / (rho + 1.0)
    return np.maximum(v - theta, 0.0)


def _simplex_quadratic(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact minimiser of w·q·w − 2c·w over the simplex for small k: best feasible
    solution over all supports."""
    k = len(c)
    best, best_obj = np.full(k, 1.0 / k), float("inf")
    for r in range(1, k + 1):
        for idx in map(list, itertools.combinations(range(k), r)):
            kkt = np.zeros((r + 1, r + 1))
            kkt[:r, :r], kkt[:r, r], kkt[r, :r] = 2 * q[np.ix_(idx, idx)], 1.0, 1.0
            try:
                x = np.linalg.solve(kkt, np.append(2 * c[idx], 1.0))[:r]
            except np.linalg.LinAlgError:
                continue
            if np.any(x < -1e-12):
                continue
            w = np.zeros(k)
            w[idx] = np.maximum(x, 0.0)
            obj = w @ q @ w - 2 * c @ w
            if obj < best_obj:
                best, best_obj = w / w.sum(), obj
    return best


def entropy_objective(g: Gram, w: np.ndarray, alpha: float = 0.1, beta: float = 0.05) -> float:
    """mse(w) + α‖w‖² + β·H(w), H(w) = −Σ w·ln(w)."""
    return g.sse(w) / g.n + alpha * float(w @ w) - beta * float(np.sum(w * np.log(w + 1e-10)))


def entropy_weights(g: Gram, alpha: float = 0.1, beta: float = 0.05, steps: int = 500) -> np.ndarray:
    """Minimise mse(w) + α‖w‖² + β·H(w) over the simplex, mse as it is.

    The first two terms have an exact minimiser; from there, and from each
    corner (the entropy term is concave, and it is 0 there), projected
    gradient steps on the whole objective; the best of them wins."""
    k = len(g.models)
    q, c = g.ptp / g.n + alpha * np.eye(k), g.pty / g.n
    lr = 0.5 / np.linalg.eigvalsh(q).max()
    best = None
    for w in [_simplex_quadratic(q, c), *np.eye(k)]:
        for _ in range(steps):
            new = _project_simplex(w - lr * (2 * (q @ w - c) - beta * (np.log(w + 1e-10) + w / (w + 1e-10))))
            if entropy_objective(g, new, alpha, beta) >= entropy_objective(g, w, alpha, beta):
                break
            w = new
        if best is None or entropy_objective(g, w, alpha, beta) < entropy_objective(g, best, alpha, beta):
            best = w
    return best


def nonneg_ridge(ptp: np.ndarray, pty: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Exact non-negative ridge without intercept for small k: best feasible
    solution over all active sets (KKT), k ≤ 10."""
    k = len(pty)
    best, best_obj = np.zeros(k), 0.0
    for r in range(1, k + 1):
        for s in itertools.combinations(range(k), r):
            idx = list(s)
            try:
                ws = np.linalg.solve(ptp[np.ix_(idx, idx)] + alpha * np.eye(r), pty[idx])
            except np.linalg.LinAlgError:
                continue
            if np.any(ws < 0):
                continue
            w = np.zeros(k)
            w[idx] = ws
            obj = w @ ptp @ w - 2 * w @ pty + alpha * w @ w
            if obj < best_obj:
                best, best_obj = w, obj
    return best


def stacked_nonneg_ridge(oof: DataFrame, preds: Sequence[str], y: str, fold: str, alpha: float = 1.0,
                         test: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """K-fold non-negative ridge (no intercept) on OOF predictions; a
    prediction that is missing counts as the mean of its column.

    Per fold the weights are fitted on the other folds (Gram of all minus Gram
    of the fold, from ONE groupBy(fold)). Returns the fold table (rmse, r2,
    weights), the rows of ``oof`` with the blend of their own fold's weights,
    and the rows of ``test`` with the blend averaged over folds."""
    means = fit_row(oof, *[F.avg(p).alias(p) for p in preds])

    def filled(df: DataFrame) -> DataFrame:
        return df.withColumns({p: F.coalesce(F.col(p).cast("double"), F.lit(means[p])) for p in preds})

    full = filled(oof)
    per = gram(full, preds, y, group=fold)
    total_ptp = sum(g.ptp for g in per.values())
    total_pty = sum(g.pty for g in per.values())
    rows, ws = [], {}
    for f, g in sorted(per.items()):
        w = ws[f] = nonneg_ridge(total_ptp - g.ptp, total_pty - g.pty, alpha)
        sst = g.yty - g.sum_y ** 2 / g.n
        rows.append((int(f), g.rmse(w), 1.0 - g.sse(w) / sst if sst > 0 else None, [float(x) for x in w]))
    table = oof.sparkSession.createDataFrame(rows, "fold int, rmse double, r2 double, weights array<double>")
    blend = None
    for f, w in ws.items():
        own = apply_weights(preds, w)
        blend = F.when(F.col(fold) == f, own) if blend is None else blend.when(F.col(fold) == f, own)
    blended = full.withColumn("blend", blend)
    mean_w = np.mean(list(ws.values()), axis=0)
    return table, blended, None if test is None else filled(test).withColumn("blend", apply_weights(preds, mean_w))


def grid_weights(g: Gram, step: float = 0.05, lo: float | Sequence[float] = 0.0,
                 hi: float | Sequence[float] = 1.0) -> tuple[np.ndarray, float]:
    """Every weight vector on a ``step`` grid with Σw = 1 and each weight
    in [lo, hi], one range for all models or one per model; the RMSE of each
    comes exactly from the Gram statistics, so the whole grid costs one
    aggregate. Lowest RMSE (first in grid order) wins."""
    k = len(g.models)
    m = int(round(1.0 / step))
    low, high = np.broadcast_to(lo, k), np.broadcast_to(hi, k)
    best, best_rmse = None, float("inf")
    for combo in itertools.product(range(m + 1), repeat=k - 1):
        last = m - sum(combo)
        if last < 0:
            continue
        w = np.array([*combo, last], dtype=float) / m
        if np.any(w < low - 1e-12) or np.any(w > high + 1e-12):
            continue
        r = g.rmse(w)
        if r < best_rmse - 1e-12:
            best, best_rmse = w, r
    if best is None:
        raise ValueError("no weight vector on the grid lies in the ranges")
    return best, best_rmse


def grid_weights_by_class(df: DataFrame, preds: Sequence[str], y: str, cls: str, ranges: dict, step: float = 0.05) -> dict:
    """W14 per price class (B7): ``ranges`` maps a class to (lo, hi) per model;
    other classes take [0, 1]. One aggregate for all classes: class -> (weights, rmse)."""
    per = gram(df, preds, y, group=cls)
    return {c: grid_weights(g, step, *ranges.get(c, (0.0, 1.0))) for c, g in per.items()}


def apply_weights(models: Sequence[str], w: Sequence[float]) -> Column:
    return fixed_weight_blend({m: float(x) for m, x in zip(models, w)})


def weights_frame(spark, models: Sequence[str], w: Sequence[float]) -> DataFrame:
    return spark.createDataFrame([(m, float(x)) for m, x in zip(models, w)], "model string, weight double")


# ------------------------------------------------------------------ W7, W8, W13
def stacked_meta_model(oof: DataFrame, preds: Sequence[str], y: str, fold: str, kind: str = "ridge",
                       passthrough: Sequence[str] = (), seed: int = 42):
    """Second-level learner on OOF predictions against log1p(y), trained
    out of fold (fold column); returns (model fitted on all rows, OOF meta predictions)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, LinearRegression
    from valuator.functions.columns import safe_log1p
    from valuator.operators.train import fits_at_a_time, fold_ids, in_parallel, training_rows, union_all
    data = oof.withColumn("_ly", F.log1p(y)).withColumns({f"_lp_{p}": safe_log1p(p) for p in preds})
    inputs = [f"_lp_{p}" for p in preds] + list(passthrough)

    def make():
        est = (LinearRegression(featuresCol="_fv", labelCol="_ly", predictionCol="_meta", regParam=1.0,
                                elasticNetParam=0.0) if kind == "ridge"
               else GBTRegressor(featuresCol="_fv", labelCol="_ly", predictionCol="_meta", maxIter=50, seed=seed))
        return Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="_fv"), est])

    rows, n = training_rows(data, [fold, "_ly", *inputs])
    try:
        folds = fold_ids(rows, fold)
        *models, full = in_parallel(lambda f: make().fit(rows if f is None else rows.filter(F.col(fold) != f)), [*folds, None], fits_at_a_time(n))
    finally:
        rows.unpersist()
    oof_meta = union_all([m.transform(data.filter(F.col(fold) == f)) for f, m in zip(folds, models)])
    res = oof_meta.withColumn("meta_prediction", F.expm1("_meta")).drop("_fv", "_meta", "_ly",
                                                                        *[f"_lp_{p}" for p in preds])
    return full, res


def score_weighted_folds(long: DataFrame, key: str, weight: str, pred: str = "prediction") -> DataFrame:
    """Σ(w·p)/Σw per key (w = validation R² or 1/MSE of the fold)."""
    return long.groupBy(key).agg((F.sum(F.col(weight) * F.col(pred)) / F.sum(weight)).alias("prediction"))


def oof_combine(parts: Sequence[DataFrame], key: str, pred: str = "prediction") -> DataFrame:
    """OOF predictions from several runs: sum per key / times predicted
    (keyed union, so rows of different segments can never be mixed)."""
    u = parts[0].select(key, pred)
    for p in parts[1:]:
        u = u.unionByName(p.select(key, pred))
    return u.groupBy(key).agg((F.sum(pred) / F.greatest(F.count(pred), F.lit(1))).alias(pred),
                              F.count(pred).alias("times_predicted"))


# ------------------------------------------------------------------ W9, W16
def segment_clip(df: DataFrame, segment: str, pred: str, stats: DataFrame, k: float = 3.0,
                 lo: float = PRICE_FLOOR, hi: float = PRICE_CAP) -> DataFrame:
    """Clip to [median − k·std, median + k·std] of the row's segment, inside [lo, hi]."""
    st = stats.select(segment, F.col("median_price").alias("_med"), F.col("std_price").alias("_sd"))
    j = attach_state(df, st, segment, "left")
    a = F.greatest(F.col("_med") - k * F.col("_sd"), F.lit(lo))
    b = F.least(F.col("_med") + k * F.col("_sd"), F.lit(hi))
    return j.withColumn(pred, clip(clip(pred, a, b), lo, hi)).drop("_med", "_sd")


def tail_shrink(df: DataFrame, segment: str, pred: str, stats: DataFrame) -> DataFrame:
    """Below max(700, 0.9·min) or above min(2.9M, 1.1·max) of the segment
    move half-way to that bound; then farther than twice the range from the
    median keep 30 % of the distance; clip to [700, 2.9M]; half-even round."""
    st = stats.select(segment, F.col("min_price").alias("_mn"), F.col("max_price").alias("_mx"),
                      F.col("median_price").alias("_md"))
    j = attach_state(df, st, segment, "left")
    lo = F.greatest(F.lit(PRICE_FLOOR), F.col("_mn") * 0.9)
    hi = F.least(F.lit(PRICE_CAP), F.col("_mx") * 1.1)
    p = F.col(pred)
    s1 = F.when(p < lo, lo + (p - lo) * 0.5).when(p > hi, hi - (hi - p) * 0.5).otherwise(p)
    s2 = F.when(F.abs(s1 - F.col("_md")) > 2 * (hi - lo), F.col("_md") + (s1 - F.col("_md")) * 0.3).otherwise(s1)
    final = F.bround(clip(s2, PRICE_FLOOR, PRICE_CAP), 0)
    return j.withColumn(pred, final).drop("_mn", "_mx", "_md")


# ------------------------------------------------------------------ W10, W11, W12
def route_by_class(df: DataFrame, key: str, cls: str, model_for_class: dict, default_model: str) -> DataFrame:
    """The predicted class picks the prediction column that scores the
    row; rows whose class has no model, or no class, take the default one.
    One projection over one scan."""
    pred, name = None, None
    for c, m in model_for_class.items():
        hit = F.col(cls) == F.lit(c)
        pred = F.when(hit, F.col(m)) if pred is None else pred.when(hit, F.col(m))
        name = F.when(hit, F.lit(m)) if name is None else name.when(hit, F.lit(m))
    default = F.col(default_model), F.lit(default_model)
    return df.select(key, (default[0] if pred is None else pred.otherwise(default[0])).alias("prediction"),
                     (default[1] if name is None else name.otherwise(default[1])).alias("routed_model"))


def soft_route(ref: str | Column, low_pred: str, high_pred: str, ref_mean: float, threshold: float,
               slope: float = 0.1) -> Column:
    """p = 1/(1+exp(−slope·(ref − mean ref))) with the exponent clamped
    to ±700; low segment clipped to [700, threshold], high to [threshold,
    2.9M]; blend (1−p)·low + p·high over the weight sum; final clip."""
    r = F.col(ref) if isinstance(ref, str) else ref
    z = F.lit(-slope) * (r - F.lit(ref_mean))
    z = F.when(z > 700, F.lit(700.0)).when(z < -700, F.lit(-700.0)).otherwise(z)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(z))
    low = clip(low_pred, PRICE_FLOOR, threshold)
    high = clip(high_pred, threshold, PRICE_CAP)
    blended = ((F.lit(1.0) - p) * low + p * high) / ((F.lit(1.0) - p) + p)
    return clip(blended, PRICE_FLOOR, PRICE_CAP)


def ref_price_feature(train: DataFrame, test: DataFrame, key: str, oof: DataFrame, test_pred: DataFrame,
                      pred: str = "prediction", name: str = "ref_price") -> tuple[DataFrame, DataFrame]:
    """Stage-1 OOF predictions become the feature ``ref_price`` of the
    training rows (leak-safe: each row's value comes from a model that did
    not see it); the test rows get the stage-1 test prediction."""
    tr = train.join(oof.select(key, F.col(pred).alias(name)), key, "left")
    te = test.join(test_pred.select(key, F.col(pred).alias(name)), key, "left")
    return tr, te
