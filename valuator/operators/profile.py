"""Scaling, profiling and feature statistics.

Fit = one aggregate pass producing a single row of statistics for all
columns at once (means, standard deviations, quantiles, correlations);
apply = a projection with those statistics as literals. Long-form results
(one row per column) are produced by unpivoting the single wide row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuator.functions.columns import clip, safe_log1p
from valuator.plans.strategy import attach_state, fit_quantiles, fit_row, group_quantiles, ranked


def _d(c: str) -> Column:
    return F.col(c).cast("double")


# ------------------------------------------------------------------ N1–N4
def fit_standard(df: DataFrame, cols: Sequence[str], ddof: int = 0) -> dict[str, tuple[float, float]]:
    """N1 (ddof=0, population std) / N2 (ddof=1, sample std): mean and std per column."""
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    aggs = []
    for c in cols:
        aggs += [F.avg(_d(c)).alias(f"{c}__m"), std(_d(c)).alias(f"{c}__s")]
    r = fit_row(df, *aggs)
    return {c: (r[f"{c}__m"], r[f"{c}__s"]) for c in cols}


def apply_standard(df: DataFrame, state: dict[str, tuple[float, float]]) -> DataFrame:
    """(x − mean)/std; a zero std divides by 1 (as the reference's scaler)."""
    out = {}
    for c, (m, s) in state.items():
        s = 1.0 if (s is None or s == 0 or (isinstance(s, float) and math.isnan(s))) else s
        out[c] = (_d(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(out)


def fit_robust(df: DataFrame, cols: Sequence[str], lo: float = 0.25, hi: float = 0.75) -> dict[str, tuple]:
    """Median and the (lo, hi) quantile range per column, exact."""
    r = fit_quantiles(df, list(cols), [lo, 0.5, hi])
    return {c: (r[c][1], r[c][2] - r[c][0]) for c in cols}


def apply_robust(df: DataFrame, state: dict[str, tuple], clip_at: float | None = None) -> DataFrame:
    out = {}
    for c, (med, rng) in state.items():
        rng = 1.0 if (rng is None or rng == 0) else rng
        v = (_d(c) - F.lit(med)) / F.lit(rng)
        out[c] = clip(v, -clip_at, clip_at) if clip_at is not None else v
    return df.withColumns(out)


# ------------------------------------------------------------------ N5, N6
def skewness_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population skewness per column (Spark's ``skewness`` is the population form)."""
    wide = df.agg(*[F.skewness(_d(c)).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "skewness")


def log_skewed(df: DataFrame, cols: Sequence[str], threshold: float = 0.5) -> tuple[DataFrame, list[str]]:
    """Columns with skewness above ``threshold`` get log1p(max(x, 0))."""
    r = fit_row(df, *[F.skewness(_d(c)).alias(c) for c in cols])
    chosen = [c for c in cols if r[c] is not None and r[c] > threshold]
    return df.withColumns({c: safe_log1p(c) for c in chosen}), chosen


BOXCOX_GRID = [round(-2.0 + 0.1 * i, 1) for i in range(41)]


def boxcox_fit(df: DataFrame, cols: Sequence[str], skew_threshold: float = 0.3,
               grid: Sequence[float] = BOXCOX_GRID) -> DataFrame:
    """λ per column with |skew| > threshold, by maximising the Box-Cox
    log-likelihood of 1+x over a λ grid in ONE aggregate pass:
    llf(λ) = (λ−1)·Σ ln(1+x) − n/2 · ln(var_pop(y_λ)).
    Returns (column, skewness, lambda, llf)."""
    sk = fit_row(df, *[F.skewness(_d(c)).alias(c) for c in cols])
    chosen = [c for c in cols if sk[c] is not None and abs(sk[c]) > skew_threshold]
    if not chosen:
        return df.sparkSession.createDataFrame([], "column string, skewness double, lambda double, llf double")
    aggs = []
    for i, c in enumerate(chosen):
        # each column has its own rows: a null or a value out of range in one does not touch the others
        x1 = F.when(_d(c) > -1, F.lit(1.0) + _d(c))
        aggs += [F.sum(F.log(x1)).alias(f"s{i}"), F.count(x1).alias(f"n{i}")]
        for j, lam in enumerate(grid):
            y = F.log(x1) if lam == 0 else (F.pow(x1, F.lit(lam)) - F.lit(1.0)) / F.lit(lam)
            aggs.append(F.var_pop(y).alias(f"v{i}_{j}"))
    r = fit_row(df, *aggs)
    rows = []
    for i, c in enumerate(chosen):
        best = None
        for j, lam in enumerate(grid):
            v = r[f"v{i}_{j}"]
            if v is None or v <= 0:
                continue
            llf = (lam - 1.0) * r[f"s{i}"] - r[f"n{i}"] / 2.0 * math.log(v)
            if best is None or llf > best[1]:
                best = (lam, llf)
        if best is not None:
            rows.append((c, float(sk[c]), float(best[0]), float(best[1])))
    return df.sparkSession.createDataFrame(rows, "column string, skewness double, lambda double, llf double")


# ------------------------------------------------------------------ N7, N8
def winsorize_tails(df: DataFrame, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99,
                    k: float = 1.5) -> DataFrame:
    """Clamp to [q_lo − k·(q_hi − q_lo), q_hi + k·(q_hi − q_lo)]."""
    r = fit_quantiles(df, list(cols), [lo, hi])
    out = {}
    for c in cols:
        a, b = r[c]
        out[c] = clip(_d(c), a - k * (b - a), b + k * (b - a))
    return df.withColumns(out)


def iqr_filter(df: DataFrame, cols: Sequence[str], k: float = 1.5, mode: str = "sequential") -> DataFrame:
    """Keep rows inside [Q1 − k·IQR, Q3 + k·IQR].

    sequential: column after column, quartiles from the survivors of the
    previous column (k aggregate passes; nulls in the column are dropped as
    the reference's comparison does). all_at_once: every column's quartiles
    from the input, one pass.
    """
    cur = df
    if mode == "all_at_once":
        r = fit_quantiles(df, list(cols), [0.25, 0.75])
        cond = None
        for c in cols:
            q1, q3 = r[c]
            i = q3 - q1
            cnd = (_d(c) >= F.lit(q1 - k * i)) & (_d(c) <= F.lit(q3 + k * i))
            cond = cnd if cond is None else cond & cnd
        return cur.filter(cond)
    for c in cols:
        q1, q3 = fit_quantiles(cur, [c], [0.25, 0.75])[c]
        i = q3 - q1
        cur = cur.filter((_d(c) >= F.lit(q1 - k * i)) & (_d(c) <= F.lit(q3 + k * i)))
    return cur


# ------------------------------------------------------------------ N9–N12
def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std (sample), min, q25, q50, q75, max per column (exact quantiles)."""
    stats = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    qs = fit_quantiles(df, list(cols), [0.25, 0.5, 0.75])
    aggs = []
    for c in cols:
        x = _d(c)
        q = qs[c] or [None, None, None]
        aggs.append(F.struct(F.count(x).cast("double").alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                             F.lit(q[0]).cast("double").alias("q25"), F.lit(q[1]).cast("double").alias("q50"),
                             F.lit(q[2]).cast("double").alias("q75"), F.max(x).alias("max")).alias(c))
    wide = df.agg(*aggs)
    long = wide.unpivot([], list(cols), "column", "s")
    return long.select("column", *[F.col(f"s.{s}").alias(s) for s in stats])


def value_counts_top(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """Frequency per value, the ``n`` most frequent (ties by value) — a top-k report."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(col)).limit(n))


def class_share(df: DataFrame, col: str) -> DataFrame:
    """Normalised frequency (per-value counts are small; total is one more aggregate)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = fit_row(df, F.count(F.lit(1)).alias("n"))["n"]  # literal total: no global window over the values
    return counts.withColumn("share", F.col("n") / F.lit(float(total)))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """Nulls per column in one aggregate, unpivoted; optionally only columns that have any."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "nulls")
    return long.filter(F.col("nulls") > 0) if only_missing else long


# ------------------------------------------------------------------ N13–N16
def f_score_select(df: DataFrame, features: Sequence[str], target: str, k: int | None = None) -> DataFrame:
    """F = r²/(1−r²)·(n−2) per feature on complete rows, ranked (top k)."""
    complete = df.dropna(subset=[*features, target])
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.corr(_d(f), _d(target)).alias(f) for f in features]
    wide = complete.agg(*aggs)
    long = wide.unpivot(["_n"], list(features), "feature", "r")
    long = long.withColumn("r", F.when(F.isnan("r"), None).otherwise(F.col("r")))
    f = F.col("r") * F.col("r") / (F.lit(1.0) - F.col("r") * F.col("r")) * (F.col("_n") - 2)
    long = long.withColumn("f_score", f)
    w = Window.orderBy(F.round("f_score", 6).desc_nulls_last(), F.col("feature"))  # one row per feature
    out = long.withColumn("rank", F.row_number().over(w)).drop("_n")
    return out.filter(F.col("rank") <= k) if k else out


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise Pearson (pairwise-complete rows), long form (a, b, corr), a < b order of input."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(_d(a), _d(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr"))
                     for i, (a, b) in enumerate(pairs)])
    long = wide.select(F.explode(rows).alias("p")).select("p.a", "p.b", "p.corr")
    return long.withColumn("corr", F.when(F.isnan("corr"), None).otherwise(F.col("corr")))


def corr_threshold_select(df: DataFrame, features: Sequence[str], target: str, threshold: float = 0.1,
                          max_k: int = 3) -> DataFrame:
    """Features with |corr(feature, target)| > threshold, strongest first, at most max_k."""
    wide = df.agg(*[F.corr(_d(f), _d(target)).alias(f) for f in features])
    long = wide.unpivot([], list(features), "feature", "corr")
    long = long.filter(F.abs("corr") > threshold)
    w = Window.orderBy(F.round(F.abs("corr"), 9).desc(), F.col("feature"))  # one row per feature
    return long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= max_k)


def mutual_info_select(df: DataFrame, features: Sequence[str], target: str, bins: int = 10, k: int | None = None,
                       min_info: float = 1e-9) -> DataFrame:
    """N14 (re-aimed): the k features (all if None) with the largest MI(feature;
    target), of those above ``min_info`` (rounding noise of 0). MI on
    equal-frequency bins of both:
    Σ p(a,b)·ln(p(a,b)/(p(a)p(b))). Joint counts come from one groupBy per
    feature over the binned columns, unioned into a small table."""
    from valuator.operators.segment import bin_code, quantile_edges_multi
    edges = quantile_edges_multi(df, [target, *features], bins)
    cols = {"_t": bin_code(target, edges[target])}
    for f in features:
        cols[f"_b_{f}"] = bin_code(f, edges[f])
    binned = df.select(*[v.alias(k) for k, v in cols.items()])
    long = binned.unpivot(["_t"], [f"_b_{f}" for f in features], "feature", "b")
    long = long.withColumn("feature", F.regexp_replace("feature", "^_b_", "")).dropna(subset=["_t", "b"])
    joint = long.groupBy("feature", "_t", "b").agg(F.count(F.lit(1)).alias("nab"))
    # joint has features × bins² rows: windows over it are small
    wf = Window.partitionBy("feature")
    j = (joint.withColumn("n", F.sum("nab").over(wf))
         .withColumn("na", F.sum("nab").over(Window.partitionBy("feature", "b")))
         .withColumn("nb", F.sum("nab").over(Window.partitionBy("feature", "_t"))))
    term = (F.col("nab") / F.col("n")) * F.log(F.col("nab") * F.col("n") / (F.col("na") * F.col("nb")))
    out = j.groupBy("feature").agg(F.sum(term).alias("mutual_info")).filter(F.col("mutual_info") > min_info)
    return out.orderBy(F.round("mutual_info", 9).desc(), "feature").limit(k) if k else out


# ------------------------------------------------------------------ N17–N20
# The quantiles of the profile.
QUANTILE_PROFILE_PROBS = [0.001, 0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999]


def quantile_profile(df: DataFrame, col: str, group: str | None = None) -> DataFrame:
    """11 quantiles, lower = max(0, q0.001), upper = 1.2·q0.999, mean/std (pop) of log1p."""
    x = _d(col)
    aggs = [F.avg(F.log1p(x)).alias("log_mean"), F.stddev_pop(F.log1p(x)).alias("log_std")]
    if group:
        g = df.groupBy(group).agg(*aggs).join(group_quantiles(df, [group], col, QUANTILE_PROFILE_PROBS), group, "left")
    else:
        q = fit_quantiles(df, [col], QUANTILE_PROFILE_PROBS)[col]
        g = df.agg(*aggs).withColumn("_q", F.array(*[F.lit(v) for v in q]) if q else F.lit(None).cast("array<double>"))
    qcols = [F.col("_q")[i].alias(f"q{str(p).replace('.', '_')}") for i, p in enumerate(QUANTILE_PROFILE_PROBS)]
    keep = [group] if group else []
    return g.select(*keep, *qcols, F.greatest(F.lit(0.0), F.col("_q")[0]).alias("lower"),
                    (F.lit(1.2) * F.col("_q")[len(QUANTILE_PROFILE_PROBS) - 1]).alias("upper"), "log_mean", "log_std")


def histogram(df: DataFrame, col: str, bins: int = 50, group: str | None = None) -> DataFrame:
    """Equal-width bins between min and max (per group); the max falls in the last bin."""
    keys = [group] if group else []
    if keys:
        mm = df.groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
        j = attach_state(df, mm, keys, "inner")
    else:
        r = fit_row(df, F.min(col).alias("lo"), F.max(col).alias("hi"))
        j = df.withColumns({"_lo": F.lit(r["lo"]), "_hi": F.lit(r["hi"])})
    width = (F.col("_hi") - F.col("_lo"))
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((_d(col) - F.col("_lo")) / width * F.lit(bins)), F.lit(bins - 1))).cast("int")
    h = j.filter(F.col(col).isNotNull()).withColumn("bin", b).groupBy(*keys, "bin", "_lo", "_hi").agg(
        F.count(F.lit(1)).alias("n"))
    return h.select(*keys, "bin", (F.col("_lo") + F.col("bin") * width / bins).alias("bin_start"),
                    (F.col("_lo") + (F.col("bin") + 1) * width / bins).alias("bin_end"), "n")


def distribution_peaks(df: DataFrame, col: str, bins: int = 256, grid: int = 1000,
                       bandwidth: float | None = None) -> DataFrame:
    """N18 (re-aimed): Gaussian KDE evaluated on ``grid`` points from a
    fixed-width histogram of ``bins`` bins (bin centres weighted by counts),
    then local maxima of the density. The histogram (≤ bins rows) is the only
    thing brought to the driver; the grid is a Spark range and each grid
    point sums over the bins with an array aggregate (no cross product of
    tables). Bandwidth: Scott's rule on the data std unless given."""
    st = fit_row(df, F.min(col).alias("lo"), F.max(col).alias("hi"), F.stddev_samp(col).alias("sd"),
                 F.count(col).alias("n"))
    lo, hi, sd, n = float(st["lo"]), float(st["hi"]), float(st["sd"] or 0.0), int(st["n"])
    spark = df.sparkSession
    if hi == lo or n < 2:
        return spark.createDataFrame([(lo, 1.0)], "x double, density double")
    h = sorted(histogram(df, col, bins).select("bin", "n").collect(), key=lambda r: r["bin"])
    centers = [lo + (r["bin"] + 0.5) * (hi - lo) / bins for r in h]
    weights = [float(r["n"]) for r in h]
    bw = bandwidth or (sd * n ** (-1.0 / 5.0)) or (hi - lo) / bins
    cs = F.array(*[F.lit(c) for c in centers])
    ws = F.array(*[F.lit(w) for w in weights])
    g = spark.range(grid).select((F.lit(lo) + F.col("id") * F.lit((hi - lo) / (grid - 1))).alias("x"), "id")
    kern = F.aggregate(F.arrays_zip(cs.alias("c"), ws.alias("w")), F.lit(0.0),
                       lambda acc, e: acc + e["w"] * F.exp(-F.pow((F.col("x") - e["c"]) / F.lit(bw), 2) / 2.0))
    dens = g.withColumn("density", kern / F.lit(n * bw * math.sqrt(2 * math.pi)))
    w = Window.orderBy("id")  # ``grid`` rows (fixed size)
    peaks = dens.withColumns({"_p": F.lag("density").over(w), "_n": F.lead("density").over(w)})
    return peaks.filter((F.col("density") > F.col("_p")) & (F.col("density") > F.col("_n"))).select("x", "density")


def gini_coefficient(df: DataFrame, col: str, group: str | None = None) -> DataFrame:
    """g = (n + 1 − 2·Σ(n − i)·x₍ᵢ₎/Σx)/n with i = 0.. over ascending x,
    clamped to [0, 1]. Σ(n−i)x = n·Σx − Σ i·x; the rank i comes from the
    range-partitioned ``ranked`` helper (no single-task window)."""
    keys = [group] if group else []
    base = df.filter(F.col(col).isNotNull()).select(*keys, _d(col).alias("_x"),
                                                    F.monotonically_increasing_id().alias("_tie"))
    r = ranked(base, keys, ["_x", "_tie"], out="_rn")
    agg = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("_x").alias("sx"),
                               F.sum((F.col("_rn") - 1) * F.col("_x")).alias("six"))
    g = (F.col("n") + 1 - 2 * (F.col("n") * F.col("sx") - F.col("six")) / F.col("sx")) / F.col("n")
    g = F.when(F.col("sx") == 0, F.lit(0.0)).otherwise(F.least(F.greatest(g, F.lit(0.0)), F.lit(1.0)))
    return agg.select(*keys, "n", g.alias("gini"))
