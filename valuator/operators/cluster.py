"""Clustering and segments.

Lloyd iterations run as DataFrame jobs: k centres (k ≤ a few dozen) travel as
literals inside the distance expression, the assignment is an argmin over k
distance columns computed per row, and the update is a groupBy on the cluster
id with map-side partial aggregation (k rows come back). No all-pairs
distances are formed. ``pyspark.ml`` KMeans covers the k-means++ variants,
``mixture`` the Gaussian ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuator.plans.strategy import fit_quantiles, fit_row, group_quantiles, prefix_sums, ranked, spread_once
from valuator.session import cut_lineage

#: Centres that travel as literals, unless the caller asks for more.
MAX_K = 64


def segment_stats(df: DataFrame, segment: str, col: str = "price", full: bool = True) -> DataFrame:
    """Count, min, max, median (mean, std) of ``col`` per segment."""
    aggs = [F.count(F.lit(1)).alias("n"), F.min(col).alias("min_price"), F.max(col).alias("max_price")]
    if full:
        aggs += [F.avg(col).alias("mean_price"), F.stddev_samp(col).alias("std_price")]
    base = df.groupBy(segment).agg(*aggs)
    med = group_quantiles(df, [segment], col, [0.5]).select(segment, F.col("_q")[0].alias("median_price"))
    cols = ["n", "min_price", "max_price", "median_price"] + (["mean_price", "std_price"] if full else [])
    return base.join(med, segment, "left").select(segment, *cols)


# ------------------------------------------------------------------ assignment
def sq_distance(features: Sequence[str | Column], center: Sequence[float]) -> Column:
    cols = [F.col(f) if isinstance(f, str) else f for f in features]
    terms = [(c - F.lit(float(v))) * (c - F.lit(float(v))) for c, v in zip(cols, center)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def nearest_center(features: Sequence[str | Column], centers: Sequence[Sequence[float]], max_k: int = MAX_K) -> Column:
    """Index of the closest centre (squared Euclidean; ties -> lowest index).
    The expression has a term per centre, so their number is held to ``max_k``."""
    if not 1 <= len(centers) <= max_k:
        raise ValueError(f"need 1..{max_k} centres")
    d = [sq_distance(features, c) for c in centers]
    m = F.least(*d) if len(d) > 1 else d[0]
    expr = None
    for j, dj in enumerate(d):
        expr = F.when(dj == m, F.lit(j)) if expr is None else expr.when(dj == m, F.lit(j))
    return expr.cast("int")


@dataclass
class LloydResult:
    centers: list[list[float]]
    iterations: int
    sizes: list[int] = field(default_factory=list)
    cost: float = float("nan")


def lloyd(df: DataFrame, features: Sequence[str | Column], init: Sequence[Sequence[float]], max_iter: int = 300,
          tol: float = 1e-4, fixed_iterations: bool = False) -> LloydResult:
    """Lloyd iterations from explicit centres (``ml`` KMeans takes no explicit
    init). Convergence as in the reference's library: squared centre shift
    below tol · mean feature variance. Empty clusters keep their centre.
    ``df`` should be cached or checkpointed by the caller; each iteration is one aggregate."""
    feats = [F.col(f).cast("double") if isinstance(f, str) else f.cast("double") for f in features]
    names = [f"_f{i}" for i in range(len(feats))]
    data = df.select(*[c.alias(n) for c, n in zip(feats, names)])
    k = len(init)
    centers = [list(map(float, c)) for c in init]
    tol_abs = 0.0
    if not fixed_iterations and tol > 0:
        v = fit_row(data, *[F.var_pop(n).alias(n) for n in names])
        tol_abs = tol * sum(float(v[n] or 0.0) for n in names) / len(names)
    it = 0
    sizes: list[int] = [0] * k
    for it in range(1, max_iter + 1):
        assigned = data.withColumn("_c", nearest_center(names, centers))
        rows = assigned.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"), *[F.avg(n).alias(n) for n in names]).collect()
        new = [list(c) for c in centers]
        sizes = [0] * k
        for r in rows:
            new[r["_c"]] = [float(r[n]) for n in names]
            sizes[r["_c"]] = int(r["_n"])
        shift = sum((a - b) ** 2 for c0, c1 in zip(centers, new) for a, b in zip(c0, c1))
        centers = new
        if not fixed_iterations and shift <= tol_abs:
            break
    return LloydResult(centers, it, sizes)


def percentile_init(df: DataFrame, features: Sequence[str | Column], k: int) -> list[list[float]]:
    """C3 init: centre j = the (100·j/(k−1))-th percentile of every feature."""
    probs = [j / (k - 1) for j in range(k)] if k > 1 else [0.5]
    feats = [F.col(f) if isinstance(f, str) else f for f in features]
    named = df.select(*[c.cast("double").alias(f"_p{i}") for i, c in enumerate(feats)])
    row = fit_quantiles(named, [f"_p{i}" for i in range(len(feats))], probs)
    return [[float(row[f"_p{i}"][j]) for i in range(len(feats))] for j in range(k)]


def band_init(df: DataFrame, features: Sequence[str | Column], price: str | Column, k: int) -> list[list[float]]:
    """C4 init: mean feature vector inside k price-percentile bands; an empty
    band takes the average of its neighbours."""
    from valuator.operators.segment import bin_code
    p = F.col(price) if isinstance(price, str) else price
    probs = [j / k for j in range(k + 1)]
    edges = fit_quantiles(df.select(p.cast("double").alias("_price")), ["_price"], probs)["_price"]
    feats = [F.col(f) if isinstance(f, str) else f for f in features]
    band = bin_code(p, [float(e) for e in edges])
    rows = (df.select(band.alias("_b"), *[c.cast("double").alias(f"_f{i}") for i, c in enumerate(feats)])
            .groupBy("_b").agg(*[F.avg(f"_f{i}").alias(f"_f{i}") for i in range(len(feats))]).collect())
    got = {r["_b"]: [float(r[f"_f{i}"]) for i in range(len(feats))] for r in rows if r["_b"] is not None}
    centers: list[list[float] | None] = [got.get(j) for j in range(k)]
    for j in range(k):
        if centers[j] is None:
            nb = [c for c in (centers[j - 1] if j > 0 else None, got.get(j + 1)) if c is not None]
            centers[j] = [sum(v) / len(nb) for v in zip(*nb)] if nb else [0.0] * len(feats)
    return [list(c) for c in centers]  # type: ignore[arg-type]


# ------------------------------------------------------------------ C1, C2, C7, C8, C11
def _medians(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """The median of every feature that has nulls, 0 where it has nothing else."""
    nulls = fit_row(df, *[F.count(F.when(F.col(f).isNull() | F.isnan(F.col(f).cast("double")), 1)).alias(f) for f in features])
    holes = [f for f in features if nulls[f]]
    medians = fit_quantiles(df, holes, [0.5]) if holes else {}
    return {f: float(medians[f][0]) if medians[f] else 0.0 for f in holes}


def _without_nulls(df: DataFrame, features: Sequence[str], medians: dict[str, float]) -> tuple[DataFrame, list[str]]:
    """The rows with a column of doubles for each feature, and the names of these."""
    value = {f: F.col(f).cast("double") for f in features}
    for f, m in medians.items():
        value[f] = F.coalesce(F.nanvl(value[f], F.lit(None)), F.lit(m))
    names = [f"_a{i}" for i in range(len(features))]
    return df.withColumns(dict(zip(names, value.values()))), names


def _assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector of every row; nulls count as the column's median (0 where there is none)."""
    return _vectors(df, features, _medians(df, features), out)


def _vectors(df: DataFrame, features: Sequence[str], medians: dict[str, float], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    filled, names = _without_nulls(df, features, medians)
    return VectorAssembler(inputCols=names, outputCol=out, handleInvalid="error").transform(filled).drop(*names)


def silhouette_1d(df: DataFrame, value: str, label: str, max_k: int = MAX_K, copies: str | None = None) -> DataFrame:
    """Exact plain (Euclidean) silhouette of one numeric column: per cluster its rows and their mean silhouette. A row
    stands for as many as the whole number ``copies`` says, if that is given.

    A row's distance to all rows of a cluster is its value times the rows below
    it, less their sum, plus the same from above: running counts and sums of
    every cluster over the distinct values in order give it, so no pair of rows is made.
    A row that is alone in its cluster scores 0; with one cluster there is no score (null). Rows without value or label do not count."""
    w = F.col(copies).cast("long") if copies else F.lit(1).cast("long")
    rows = df.select(F.col(value).cast("double").alias("_x"), F.col(label).alias("_c"), w.alias("_w")).filter("_x IS NOT NULL AND NOT isnan(_x) AND _c IS NOT NULL")
    sizes = [(r["_c"], r["n"], r["s"]) for r in rows.groupBy("_c").agg(F.sum("_w").alias("n"), F.sum(F.col("_x") * F.col("_w")).alias("s")).limit(max_k + 1).collect()]
    if len(sizes) > max_k:
        raise ValueError(f"more than {max_k} clusters")
    if not sizes:
        return rows.groupBy(F.col("_c").alias(label)).agg(F.count(F.lit(1)).alias("n"), F.avg(F.lit(None).cast("double")).alias("silhouette"))
    sizes.sort(key=lambda r: str(r[0]))
    of = [F.col("_c") == F.lit(c) for c, _, _ in sizes]
    counts = [F.sum(F.when(is_c, F.col("_w")).otherwise(0)).alias(f"_n{i}") for i, is_c in enumerate(of)]
    # one row a value: equal values, however many, are one row with a count per cluster
    by_value = rows.groupBy("_x").agg(*counts)
    by_value = cut_lineage(by_value.withColumns({f"_s{i}": F.col(f"_n{i}") * F.col("_x") for i in range(len(sizes))}))
    cols = [f"_{kind}{i}" for i in range(len(sizes)) for kind in "ns"]
    cum = prefix_sums(by_value, "_x", cols)
    far = []
    for i, (_, n, total) in enumerate(sizes):
        below_n, below_s = F.col(f"_n{i}_cum"), F.col(f"_s{i}_cum")
        far.append(F.col("_x") * below_n - below_s + (F.lit(total) - below_s) - F.col("_x") * (F.lit(n) - below_n))
    longs = F.array(*[F.lit(n).cast("long") for _, n, _ in sizes])
    each = cum.select(F.array(*far).alias("_far"), F.posexplode(F.array(*[F.col(f"_n{i}") for i in range(len(sizes))])).alias("_i", "n")).filter("n > 0")
    size = F.get(longs, F.col("_i"))
    within = F.greatest(F.get("_far", F.col("_i")), F.lit(0.0)) / (size - 1)
    near = F.array_min(F.filter(F.transform("_far", lambda d, j: F.when(j != F.col("_i"), F.greatest(d, F.lit(0.0)) / F.get(longs, j))),
                                lambda d: d.isNotNull()))
    most = F.greatest(within, near)
    score = F.when(near.isNull(), F.lit(None)).when(size == 1, 0.0).when(most > 0, (near - within) / most).otherwise(0.0)
    found = each.select("_i", "n", score.alias("s")).groupBy("_i").agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("s")) / F.sum(F.when(F.col("s").isNotNull(), F.col("n")))).alias("silhouette"))
    names = F.array(*[F.lit(c) for c, _, _ in sizes])
    return found.select(F.get(names, F.col("_i")).alias(label), "n", "silhouette")


def choose_k_silhouette(df: DataFrame, features: Sequence[str], k_range: Sequence[int] = range(2, 6),
                        seed: int = 42) -> tuple[int, DataFrame]:
    """K-means for each k, mean silhouette (squared Euclidean, linear time),
    first best k. Returns (best_k, table of k -> silhouette, cost)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    data = _assemble(df, features).select("features").persist()
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    res = []
    try:
        for k in k_range:
            m = KMeans(k=k, seed=seed, featuresCol="features").fit(data)
            s = ev.evaluate(m.transform(data))
            res.append((int(k), float(s), float(m.summary.trainingCost)))
    finally:
        data.unpersist()
    best = max(res, key=lambda r: (r[1], -r[0]))[0]
    table = df.sparkSession.createDataFrame(res, "k int, silhouette double, cost double")
    return best, table


def kmeans_segments(df: DataFrame, features: Sequence[str], k: int, restarts: int = 10, seed: int = 42,
                    out: str = "cluster"):
    """K-means|| with ``restarts`` seeds, keep the lowest training cost."""
    data = _assemble(df, features).persist()
    try:
        best = _best_kmeans(data, k, restarts, seed, out)
    finally:
        data.unpersist()
    return best, best.transform(_assemble(df, features)).drop("features")


def _best_kmeans(data: DataFrame, k: int, restarts: int, seed: int, out: str):
    from pyspark.ml.clustering import KMeans
    best = None
    for r in range(restarts):
        m = KMeans(k=k, seed=seed + r, featuresCol="features", predictionCol=out).fit(data)
        if best is None or m.summary.trainingCost < best.summary.trainingCost:
            best = m
    return best


def _uniform(key: str, *salt: Column) -> Column:
    """A number of (0, 1) that the key and the salt decide."""
    bits = F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string"), *salt), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def _near(x: np.ndarray, centers: Sequence[Sequence[float]]) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances to the nearest centre, and which it is (the first of equals); ``x`` has a row a feature."""
    each = []
    for c in centers:
        d = np.zeros(x.shape[1])
        for own, v in zip(x, c):
            d += (own - v) * (own - v)
        each.append(d)
    least = np.fmin.reduce(each)
    return least, np.argmax(np.array(each) == least, axis=0)


def _by_feature(column) -> np.ndarray:
    """A row a feature of an Arrow column of arrays."""
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).T)


def distance_squared_seeds(df: DataFrame, vector: str, key: str, k: int, restarts: int = 10, seed: int = 42) -> list[list[list[float]]]:
    """C2 init: per restart up to k rows, the first uniformly drawn, each further one with weight squared distance to the nearest drawn one.

    A weighted draw is a race: the row with the least -ln(u) / weight wins, u a
    hash of key, restart and step. So a step is one pass, in which a task gives its own
    winner of each restart, and does not depend on the partitioning. Rows at distance
    0 are not drawn; a restart ends early when there are no others. Ties go to the lesser vector. Rows of
    equal key share u: keys should be unique. ``df`` is read k times; nothing of a row is sorted or shuffled."""
    drawn: list[list[list[float]]] = [[] for _ in range(restarts)]
    for step in range(k):
        todo = [r for r in range(restarts) if len(drawn[r]) == step]
        if not todo:
            break
        before = [drawn[r][:] for r in todo]

        def race(batches, before=before):
            import pyarrow as pa
            best: list[tuple | None] = [None] * len(before)
            for b in batches:
                if not b.num_rows:
                    continue
                x = _by_feature(b.column(0))
                for i, centers in enumerate(before):
                    weight = _near(x, centers)[0] if centers else np.ones(b.num_rows)
                    # rows without a weight do not race
                    own = np.flatnonzero(weight > 0)
                    if not len(own):
                        continue
                    time = b.column(i + 1).to_numpy(zero_copy_only=False)[own] / weight[own]
                    tied = x[:, own[time == time.min()]]
                    won = float(time.min()), tied[:, np.lexsort(tied[::-1])[0]].tolist()
                    best[i] = won if best[i] is None else min(best[i], won)
            yield pa.RecordBatch.from_arrays([pa.array([x and x[j]], kind) for x in best for j, kind in ((0, pa.float64()), (1, pa.list_(pa.float64())))],
                                             [f"{c}{i}" for i in range(len(best)) for c in "tv"])

        waits = [(-F.log(_uniform(key, F.lit(seed), F.lit(r), F.lit(step)))).alias(f"e{r}") for r in todo]
        # a row a task
        raced = cut_lineage(df.select(vector, *waits).mapInArrow(race, ", ".join(f"t{i} double, v{i} array<double>" for i in range(len(todo)))))
        least = fit_row(raced, *[F.min(f"t{i}").alias(f"t{i}") for i in range(len(todo))])
        won = F.array(*[F.when(F.col(f"t{i}") == F.lit(least[f"t{i}"]), F.struct(F.lit(r).alias("r"), F.col(f"v{i}").alias("v"))) for i, r in enumerate(todo)])
        winners = raced.select(F.explode(F.filter(won, lambda x: x.isNotNull())).alias("w")).groupBy("w.r").agg(F.min("w.v").alias("v"))
        for row in winners.collect():
            drawn[row["r"]].append([float(x) for x in row["v"]])
    return drawn


def _cluster_sums(rows: DataFrame, vector: str, tried: Sequence[Sequence[Sequence[float]]], dims: int) -> list[np.ndarray]:
    """For each list of centres, a row a cluster: rows, squared distances, and the sum of each feature. One pass, summed batch by batch."""
    cuts = np.cumsum([len(c) * (2 + dims) for c in tried])

    def add(batches):
        import pyarrow as pa
        total = [np.zeros((len(c), 2 + dims)) for c in tried]
        for b in batches:
            if not b.num_rows:
                continue
            x = _by_feature(b.column(0))
            for at, centers in zip(total, tried):
                least, own = _near(x, centers)
                for j, weights in enumerate((None, least, *x)):
                    at[:, j] += np.bincount(own, weights, len(centers))
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([t.ravel() for t in total]).tolist()], pa.list_(pa.float64()))], ["s"])

    parts = [np.array(r["s"]) for r in rows.select(vector).mapInArrow(add, "s array<double>").collect()]
    return [s.reshape(-1, 2 + dims) for s in np.split(np.sum(parts, axis=0), cuts[:-1])]


def kmeans_restarts(df: DataFrame, features: Sequence[str], key: str, k: int, restarts: int = 10, seed: int = 42, max_iter: int = 300,
                    tol: float = 1e-4, out: str = "cluster", max_k: int = MAX_K) -> tuple[DataFrame, DataFrame]:
    """K-means from ``restarts`` draws of ``distance_squared_seeds``, all restarts in one pass an iteration.
    Returns the rows with the cluster of the restart of least cost, and a table (restart, clusters, iterations, cost).

    A restart ends when its squared centre shift is at most tol times the mean
    variance. Nulls count as the column's median. An empty cluster keeps its
    centre; with fewer than k different rows there are fewer clusters, and
    without rows no restart and null clusters."""
    if not 1 <= k <= max_k:
        raise ValueError(f"need 1..{max_k} clusters")
    kept = df.select(F.col(key).alias("_key"), *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    kept = spread_once(kept, kept.columns)
    medians = _medians(kept, kept.columns[1:])
    filled, names = _without_nulls(kept, kept.columns[1:], medians)
    rows = cut_lineage(filled.select("_key", F.array(*names).alias("_vec")))
    centers = {r: c for r, c in enumerate(distance_squared_seeds(rows, "_vec", "_key", k, restarts, seed)) if c}
    schema = "restart int, clusters int, iterations int, cost double"
    if not centers:
        return df.withColumn(out, F.lit(None).cast("int")), df.sparkSession.createDataFrame([], schema)
    dims = len(features)
    v = fit_row(rows, *[F.var_pop(F.col("_vec")[i]).alias(f"v{i}") for i in range(dims)])
    tol_abs = tol * sum(float(v[f"v{i}"] or 0.0) for i in range(dims)) / dims
    iterations = {r: 0 for r in centers}
    open_, cost = set(centers), {}
    while open_:
        tried = sorted(open_)
        for r, sums in zip(tried, _cluster_sums(rows, "_vec", [centers[r] for r in tried], dims)):
            cost[r] = float(sums[:, 1].sum())
            new = [list(map(float, s[2:] / s[0])) if s[0] else list(c) for s, c in zip(sums, centers[r])]
            shift = sum((a - b) ** 2 for x, y in zip(centers[r], new) for a, b in zip(x, y))
            iterations[r] += 1
            if shift <= tol_abs or iterations[r] >= max_iter:
                open_.discard(r)  # the cost is that of the centres it was taken with
            else:
                centers[r] = new
    best = min(centers, key=lambda r: (cost[r], r))
    shown, names = _without_nulls(df, features, {f: medians[f"_x{i}"] for i, f in enumerate(features) if f"_x{i}" in medians})
    labelled = shown.withColumn(out, nearest_center(names, centers[best], max_k)).drop(*names)
    table = [(r, len(centers[r]), iterations[r], float(cost[r])) for r in sorted(centers)]
    return labelled, df.sparkSession.createDataFrame(table, schema)


def gmm_segments_bic(df: DataFrame, features: Sequence[str], n_range: Sequence[int] = range(2, 11),
                     seed: int = 42, min_silhouette: float = 0.2) -> tuple[int, DataFrame]:
    """A Gaussian mixture per n, all n in one pass an iteration, on the given (already log/standardised)
    features; BIC = −2·logLik + p·ln(n_rows); among silhouette > 0.2 pick the
    lowest BIC, else the lowest BIC overall. A mixture that puts all rows in
    one cluster has no silhouette (NaN)."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import vector_to_array

    from valuator.operators.mixture import component, fit_mixtures
    from valuator.operators.train import in_parallel
    data = _assemble(df, features).select("features", vector_to_array("features").alias("_x")).persist()
    d = len(features)
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    try:
        n_rows = data.count()
        fitted = fit_mixtures(data, "features", "_x", list(n_range), seed)

        def score(n: int) -> tuple[int, float, float]:
            p = n * d + n * d * (d + 1) / 2 + (n - 1)
            bic = -2.0 * fitted[n].log_likelihood + p * math.log(n_rows)
            pred = data.select("features", component(fitted[n], "_x").alias("prediction"))
            several = pred.select("prediction").distinct().limit(2).count() > 1
            return int(n), bic, float(ev.evaluate(pred)) if several else float("nan")

        res = in_parallel(score, list(n_range))
    finally:
        data.unpersist()
    ok = [r for r in res if r[2] == r[2] and r[2] > min_silhouette]
    best = min(ok or res, key=lambda r: (r[1], r[0]))[0]
    table = df.sparkSession.createDataFrame(res, "n int, bic double, silhouette double")
    return best, table


def gmm_label(df: DataFrame, features: Sequence[str], n: int, seed: int = 42, out: str = "cluster") -> DataFrame:
    """The mixture of n components fitted on all rows, and each row's most likely one."""
    from pyspark.ml.functions import vector_to_array

    from valuator.operators.mixture import component, fit_mixtures
    rows = _assemble(df, features).withColumn("_x", vector_to_array("features"))
    data = rows.select("features", "_x").persist()
    try:
        m = fit_mixtures(data, "features", "_x", [n], seed)[n]
    finally:
        data.unpersist()
    return rows.withColumn(out, component(m, "_x")).drop("features", "_x")


def gmm_segments_combined(table: DataFrame) -> DataFrame:
    """score = minmax(BIC) − minmax(silhouette) over the candidate table
    (one row per candidate n); zero ranges give 0. Lowest score first."""
    st = fit_row(table, F.min("bic").alias("b0"), F.max("bic").alias("b1"),
                 F.min("silhouette").alias("s0"), F.max("silhouette").alias("s1"))
    j = table.withColumns({k: F.lit(st[k]) for k in ("b0", "b1", "s0", "s1")})
    nb = F.when(F.col("b1") == F.col("b0"), 0.0).otherwise((F.col("bic") - F.col("b0")) / (F.col("b1") - F.col("b0")))
    ns = F.when(F.col("s1") == F.col("s0"), 0.0).otherwise(
        (F.col("silhouette") - F.col("s0")) / (F.col("s1") - F.col("s0")))
    return j.select(*table.columns, (nb - ns).alias("score")).orderBy("score", table.columns[0])


def cluster_errors(df: DataFrame, err: str, k_range: Sequence[int] = range(2, 11), seed: int = 42,
                   out: str = "error_cluster") -> tuple[int, DataFrame]:
    """C11: standardise the error, choose k by the exact plain silhouette in one dimension (first best), label rows.

    The fits read a frame of the errors alone, written once; their scores one of the different errors and how often each is there."""
    from valuator.operators.train import fits_at_a_time, in_parallel
    # equal errors must not meet in one part
    place = F.xxhash64(*[F.col(c) for c, t in df.dtypes if "map<" not in t]).alias("_h")
    errors = spread_once(df.select(F.col(err).alias("_e"), place), ["_h"]).select("_e")
    st = fit_row(errors, F.avg("_e").alias("m"), F.stddev_pop("_e").alias("s"), F.count(F.lit(1)).alias("n"))
    rows = errors.select(((F.col("_e") - F.lit(st["m"])) / F.lit(st["s"] or 1.0)).alias("_z"))
    medians = _medians(rows, ["_z"])
    # not persisted: the fit keeps its own vectors, which it need not read from the frame at each step
    data = _vectors(rows, ["_z"], medians)
    values = cut_lineage(rows.filter("_z IS NOT NULL AND NOT isnan(_z)").groupBy("_z").agg(F.count(F.lit(1)).alias("_n")))
    shown = _vectors(values, ["_z"], {})

    def run(k: int) -> tuple:
        model = _best_kmeans(data, k, 1, seed, out)
        scores = silhouette_1d(model.transform(shown), "_z", out, copies="_n")
        r = fit_row(scores, (F.sum(F.col("n") * F.col("silhouette")) / F.sum("n")).alias("s"))
        return r["s"] if r["s"] is not None else -1.0, -k, model

    scored = in_parallel(run, list(k_range), fits_at_a_time(st["n"]))
    _, k, model = max(scored, key=lambda x: x[:2])
    z = df.withColumn("_z", (F.col(err) - F.lit(st["m"])) / F.lit(st["s"] or 1.0))
    return -k, model.transform(_vectors(z, ["_z"], medians)).drop("_z", "features")


# ------------------------------------------------------------------ C6
def assign_no_price(df: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]],
                    mode: str = "zero", median_log_price: float | None = None, out: str = "cluster") -> DataFrame:
    """Assign unlabelled rows to centres fitted on [log1p(price), features...].

    mode='zero'   : price term 0 (the reference's behaviour, biased to cheap segments)
    mode='median' : log1p(median train price) as the price term
    mode='ignore' : drop the price dimension from the distance
    """
    if mode == "zero":
        return df.withColumn(out, nearest_center([F.lit(0.0), *features], centers))
    if mode == "median":
        if median_log_price is None:
            raise ValueError("median mode needs median_log_price")
        return df.withColumn(out, nearest_center([F.lit(float(median_log_price)), *features], centers))
    if mode == "ignore":
        return df.withColumn(out, nearest_center(list(features), [c[1:] for c in centers]))
    raise ValueError("mode must be zero|median|ignore")


# ------------------------------------------------------------------ C9
def merge_round(centers: dict[int, Sequence[float]], weak: Sequence[int]) -> dict[int, int]:
    """Weak segment -> nearest other centre (lowest id of equals), unless that segment is weak too."""
    out = {}
    for s in weak:
        near = min((sum((a - b) ** 2 for a, b in zip(centers[s], c)), o) for o, c in centers.items() if o != s)[1]
        if near not in weak:
            out[s] = near
    return out


def merge_weak_segments(df: DataFrame, segment: str, centers: dict[int, Sequence[float]],
                        rmse_of: Callable[[DataFrame, str], dict[int, float]], threshold: float, rounds: int = 3,
                        out: str = "merged_segment") -> tuple[DataFrame, dict[int, int]]:
    """Segments whose RMSE is above the threshold merge into their nearest
    centre, unless that one is weak too. ``rmse_of(frame, column)`` scores the
    segments as they are merged so far, again before each round; the last of
    ``rounds`` scorings merges nothing. The centres stay those of the start.
    Returns the rows with the merged segment and the map."""
    mapping = {s: s for s in centers}
    for k in range(rounds):
        cur = df.withColumn(out, apply_mapping(segment, mapping))
        weak = sorted(s for s, r in rmse_of(cur, out).items() if r is not None and r > threshold)
        step = merge_round(centers, weak) if len(centers) > 1 and k < rounds - 1 else {}
        if not step:
            break
        mapping = {s: step.get(t, t) for s, t in mapping.items()}
    return df.withColumn(out, apply_mapping(segment, mapping)), mapping


def apply_mapping(c: str | Column, mapping: dict[int, int]) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for src, dst in sorted(mapping.items()):
        expr = F.when(col == src, F.lit(dst)) if expr is None else expr.when(col == src, F.lit(dst))
    return (expr.otherwise(col) if expr is not None else col).cast("int")


# ------------------------------------------------------------------ C12, C13
def min_size_skip(df: DataFrame, segment: str, min_rows: int = 10) -> DataFrame:
    """The segments that have at least ``min_rows`` rows (the others get no model)."""
    return (df.groupBy(segment).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") >= min_rows).select(segment))


def cap_segment_sample(df: DataFrame, key: str, segment: str, cap: int = 10_000, seed: int = 42) -> DataFrame:
    """At most ``cap`` rows per segment, chosen by key hash (a sampling
    operator: the cap is its purpose). Ranked by range partitioning."""
    from valuator.operators.train import mix_hash
    r = ranked(df.withColumn("_h", mix_hash(key, seed)), [segment], ["_h", key], out="_rn")
    return r.filter(F.col("_rn") <= cap).drop("_h", "_rn")
