"""Registered clustering queries.

Lloyd-based queries iterate to convergence; their oracle does the same in a
recursive CTE.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from valuator.operators import cluster as C
from valuator.plans.common import fx, rnd, round_all
from valuator.plans.registry import register
from valuator.plans.strategy import fit_quantiles
from valuator.session import cut_lineage

K = 3
_FEATS = ["depreciation", "coe", "dereg_value"]
TOL, MAX_ITER = 1e-4, 300


# ------------------------------------------------------------------ SQL generation for fixed Lloyd steps
def _assign_sql(feats: list[str], centers: str, k: int) -> str:
    d = [" + ".join(f"({f} - c{j}_{i}) * ({f} - c{j}_{i})" for i, f in enumerate(feats)) for j in range(k)]
    m = f"least({', '.join(d)})"
    whens = " ".join(f"WHEN {dj} = {m} THEN {j}" for j, dj in enumerate(d))
    return f"CAST(CASE {whens} END AS INTEGER)"


def lloyd_sql(base: str, feats: list[str], k: int, init_cte: str) -> str:
    """CTEs that end with ``cen``: Lloyd steps from ``cen0`` until the centres move by at most the tolerance."""
    names = [f"c{j}_{i}" for j in range(k) for i in range(len(feats))]
    new = ", ".join(f"coalesce(avg(CASE WHEN cl = {j} THEN {f} END), any_value(c{j}_{i})) AS n{j}_{i}"
                    for j in range(k) for i, f in enumerate(feats))
    shift = " + ".join(f"(n{x[1:]} - {x}) * (n{x[1:]} - {x})" for x in names)
    return f"""{init_cte},
tol AS (SELECT {TOL} * ({" + ".join(f"var_pop({f})" for f in feats)}) / {len(feats)} AS t FROM {base}),
steps AS (
  SELECT 0 AS it, CAST('infinity' AS DOUBLE) AS shift, {", ".join(f"CAST({x} AS DOUBLE) AS {x}" for x in names)} FROM cen0
  UNION ALL
  SELECT it + 1, {shift}, {", ".join(f"n{x[1:]}" for x in names)} FROM (
    SELECT any_value(it) AS it, {", ".join(f"any_value({x}) AS {x}" for x in names)}, {new}
    FROM (SELECT b.*, s.*, {_assign_sql(feats, "s", k)} AS cl FROM {base} b CROSS JOIN steps s CROSS JOIN tol
          WHERE s.shift > tol.t AND s.it < {MAX_ITER}) HAVING count(*) > 0)),
cen AS (SELECT * FROM steps ORDER BY it DESC LIMIT 1)"""


def _percentile_init_sql(src: str, feats: list[str], k: int) -> str:
    probs = [j / (k - 1) for j in range(k)]
    sel = [f"quantile_cont({f}, {p}) AS c{j}_{i}" for j, p in enumerate(probs) for i, f in enumerate(feats)]
    return f"cen0 AS (SELECT {', '.join(sel)} FROM {src})"


# ------------------------------------------------------------------ C3
_C3_FEATS = ["lp", *_FEATS]
_C3_SQL = ("WITH RECURSIVE base AS (SELECT listing_id, ln(1 + price) AS lp, " + ", ".join(_FEATS) + " FROM listing),\n"
           + lloyd_sql("base", _C3_FEATS, K, _percentile_init_sql("base", _C3_FEATS, K))
           + f"\nSELECT b.listing_id, {_assign_sql(_C3_FEATS, 'cen', K)} AS cluster FROM base b CROSS JOIN cen")


def _c3_fit(df):
    base = cut_lineage(df.select("listing_id", F.log1p("price").alias("lp"), *_FEATS))
    init = C.percentile_init(base, _C3_FEATS, K)
    res = C.lloyd(base, _C3_FEATS, init)
    return base, res


@register("lloyd_percentile_init", _C3_SQL, ("listing",))
def q_lloyd_percentile(spark, sf_dir):
    base, res = _c3_fit(fx(spark, sf_dir).listing())
    return base.select("listing_id", C.nearest_center(_C3_FEATS, res.centers).alias("cluster"))


# ------------------------------------------------------------------ C4
def _band_init_sql(src: str, feats: list[str], k: int) -> str:
    probs = ", ".join(str(j / k) for j in range(k + 1))
    inner = "list_sort(list_distinct(e))"
    code = (f"CASE WHEN price >= {inner}[1] AND price <= {inner}[len({inner})] THEN "
            f"CAST(len(list_filter({inner}[2:len({inner}) - 1], lambda x: price > x)) AS INTEGER) END")
    sel = [f"(SELECT avg({f}) FROM bb WHERE band = {j}) AS c{j}_{i}" for j in range(k) for i, f in enumerate(feats)]
    return (f"q AS (SELECT quantile_cont(price, [{probs}]) AS e FROM {src}),\n"
            f"bb AS (SELECT s.*, {code} AS band FROM {src} s CROSS JOIN q),\n"
            f"cen0 AS (SELECT {', '.join(sel)})")


_C4_SQL = ("WITH RECURSIVE base AS (SELECT listing_id, price, " + ", ".join(_FEATS) + " FROM listing),\n"
           + lloyd_sql("base", _FEATS, K, _band_init_sql("base", _FEATS, K))
           + f"\nSELECT b.listing_id, {_assign_sql(_FEATS, 'cen', K)} AS cluster FROM base b CROSS JOIN cen")


@register("lloyd_band_init", _C4_SQL, ("listing",))
def q_lloyd_band(spark, sf_dir):
    base = cut_lineage(fx(spark, sf_dir).listing().select("listing_id", "price", *_FEATS))
    init = C.band_init(base, _FEATS, "price", K)
    res = C.lloyd(base, _FEATS, init)
    return base.select("listing_id", C.nearest_center(_FEATS, res.centers).alias("cluster"))


# ------------------------------------------------------------------ C5 / J8
_C5_SQL = ("WITH RECURSIVE base AS (SELECT listing_id, " + ", ".join(_FEATS) + " FROM listing_train),\n"
           + lloyd_sql("base", _FEATS, K, _percentile_init_sql("base", _FEATS, K))
           + f"\nSELECT n.listing_id, {_assign_sql(_FEATS, 'cen', K)} AS cluster FROM listing_new n CROSS JOIN cen")


@register("assign_clusters", _C5_SQL, ("listing_train", "listing_new"))
def q_assign_clusters(spark, sf_dir):
    f = fx(spark, sf_dir)
    base = cut_lineage(f.listing_train().select("listing_id", *_FEATS))
    res = C.lloyd(base, _FEATS, C.percentile_init(base, _FEATS, K))
    return f.listing_new().select("listing_id", C.nearest_center(_FEATS, res.centers).alias("cluster"))


_J8_SQL = ("WITH base AS (SELECT listing_id, " + ", ".join(_FEATS) + " FROM listing),\n"
           + _percentile_init_sql("base", _FEATS, 5)
           + f"\nSELECT b.listing_id, {_assign_sql(_FEATS, 'cen0', 5)} AS cluster FROM base b CROSS JOIN cen0")


@register("nearest_center_join", _J8_SQL, ("listing",))
def q_nearest_center(spark, sf_dir):
    from valuator.operators.joins import nearest_center_join
    base = fx(spark, sf_dir).listing().select("listing_id", *_FEATS)
    centers = C.percentile_init(base, _FEATS, 5)
    return nearest_center_join(base, _FEATS, centers).select("listing_id", "cluster")


# ------------------------------------------------------------------ C6
def _c6_ignore_sql() -> str:
    # distance over the three non-price dimensions (centre coordinates 1..3)
    d = [" + ".join(f"({f} - c{j}_{i + 1}) * ({f} - c{j}_{i + 1})" for i, f in enumerate(_FEATS)) for j in range(K)]
    m = f"least({', '.join(d)})"
    return "CAST(CASE " + " ".join(f"WHEN {dj} = {m} THEN {j}" for j, dj in enumerate(d)) + " END AS INTEGER)"


_C6_SQL = ("WITH RECURSIVE base AS (SELECT listing_id, ln(1 + price) AS lp, " + ", ".join(_FEATS) + " FROM listing_train),\n"
           + lloyd_sql("base", _C3_FEATS, K, _percentile_init_sql("base", _C3_FEATS, K))
           + ",\nmed AS (SELECT ln(1 + quantile_cont(price, 0.5)) AS mlp FROM listing_train)"
           + "\nSELECT n.listing_id, "
           + _assign_sql(_C3_FEATS, "cen", K).replace("(lp -", "(0.0 -") + " AS cluster_zero, "
           + _assign_sql(_C3_FEATS, "cen", K).replace("(lp -", "(med.mlp -") + " AS cluster_median, "
           + _c6_ignore_sql() + " AS cluster_ignore FROM listing_new n CROSS JOIN cen CROSS JOIN med")


@register("assign_clusters_no_price", _C6_SQL, ("listing_train", "listing_new"))
def q_assign_no_price(spark, sf_dir):
    f = fx(spark, sf_dir)
    base, res = _c3_fit(f.listing_train())
    med = math.log1p(fit_quantiles(f.listing_train(), ["price"], [0.5])["price"][0])
    new = f.listing_new().select("listing_id", *_FEATS)
    out = C.assign_no_price(new, _FEATS, res.centers, "zero", out="cluster_zero")
    out = C.assign_no_price(out, _FEATS, res.centers, "median", median_log_price=med, out="cluster_median")
    out = C.assign_no_price(out, _FEATS, res.centers, "ignore", out="cluster_ignore")
    return out.select("listing_id", "cluster_zero", "cluster_median", "cluster_ignore")


# ------------------------------------------------------------------ C10, C12, C13
_STATS_SQL = """
SELECT type_of_vehicle, count(*) AS n, min(price) AS min_price, max(price) AS max_price,
       round(quantile_cont(price, 0.5), 4) AS median_price, round(avg(price), 4) AS mean_price,
       round(stddev_samp(price), 4) AS std_price
FROM listing GROUP BY type_of_vehicle
"""


@register("segment_stats", _STATS_SQL, ("listing",))
def q_segment_stats(spark, sf_dir):
    return round_all(C.segment_stats(fx(spark, sf_dir).listing(), "type_of_vehicle"), 4)


_SEG = ["model", "manufactured", "transmission"]
_MINSIZE_SQL = """
WITH seg AS (SELECT model, manufactured, transmission, avg(price) AS m, count(*) AS n FROM listing_train
             GROUP BY model, manufactured, transmission)
SELECT l.listing_id, round(CASE WHEN seg.n >= 10 THEN seg.m ELSE 700.0 END, 4) AS prediction
FROM listing_new l LEFT JOIN seg ON l.model = seg.model AND l.manufactured = seg.manufactured
  AND l.transmission = seg.transmission
"""


@register("min_size_skip", _MINSIZE_SQL, ("listing_train", "listing_new"))
def q_min_size_skip(spark, sf_dir):
    f = fx(spark, sf_dir)
    tr = f.listing_train().withColumn("seg", F.struct(*_SEG))
    kept = C.min_size_skip(tr, "seg", 10)
    model = tr.join(kept, "seg", "left_semi").groupBy("seg").agg(F.avg("price").alias("m"))
    new = f.listing_new().withColumn("seg", F.struct(*_SEG))
    from valuator.plans.strategy import attach_state
    out = attach_state(new, model, "seg", "left")
    return out.select("listing_id", rnd(F.coalesce(F.col("m"), F.lit(700.0)), 4).alias("prediction"))


_CAP_SQL = """
SELECT listing_id, type_of_vehicle FROM (
  SELECT listing_id, type_of_vehicle, row_number() OVER (PARTITION BY type_of_vehicle
      ORDER BY ((((listing_id % 2147483647 * 48271 + 42) % 2147483647) * 48271) % 2147483647), listing_id) AS rn FROM listing) WHERE rn <= 1000
"""


@register("cap_segment_sample", _CAP_SQL, ("listing",))
def q_cap_segment(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", "type_of_vehicle")
    return C.cap_segment_sample(l, "listing_id", "type_of_vehicle", cap=1000)


# ------------------------------------------------------------------ rows-only (Spark ML)
@register("choose_k_silhouette")
def q_choose_k(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select(*_FEATS)
    best, table = C.choose_k_silhouette(l, _FEATS, range(2, 6))
    return table.withColumn("best_k", F.lit(best))


@register("kmeans_segments")
def q_kmeans_segments(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "price", *_FEATS)
    _, labelled = C.kmeans_segments(l, _FEATS, 3, restarts=10)
    return C.segment_stats(labelled, "cluster")


@register("kmeans_segments_keys", """
SELECT count(*) AS n, count(DISTINCT listing_id) AS keys, CAST(sum(listing_id) AS DOUBLE) AS key_sum, 3 AS clusters FROM listing_nulls
""", ("listing_nulls",))
def q_kmeans_segments_keys(spark, sf_dir):
    """Every row of a table with nulls is labelled, once."""
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", *_FEATS)
    _, labelled = C.kmeans_segments(l, _FEATS, 3, restarts=2)
    return labelled.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("listing_id").alias("keys"),
                        F.sum(F.col("listing_id").cast("double")).alias("key_sum"),
                        F.count_distinct("cluster").cast("int").alias("clusters"))


@register("kmeans_restarts")
def q_kmeans_restarts(spark, sf_dir):
    """Cost of each of ten restarts from distance-squared draws."""
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", *_FEATS)
    return C.kmeans_restarts(l, _FEATS, "listing_id", 3)[1]


@register("kmeans_restarts_keys", """
SELECT count(*) AS n, count(DISTINCT listing_id) AS keys, CAST(sum(listing_id) AS DOUBLE) AS key_sum, 3 AS clusters FROM listing_nulls
""", ("listing_nulls",))
def q_kmeans_restarts_keys(spark, sf_dir):
    """Every row of a table with nulls is labelled, once, by the restart of least cost."""
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", *_FEATS)
    labelled, _ = C.kmeans_restarts(l, _FEATS, "listing_id", 3)
    return labelled.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("listing_id").alias("keys"),
                        F.sum(F.col("listing_id").cast("double")).alias("key_sum"),
                        F.count_distinct("cluster").cast("int").alias("clusters"))


def _log_std(df, cols):
    """The rows with the columns as log1p, standardised; nulls stay."""
    from valuator.operators.profile import apply_standard, fit_standard
    logged = df.withColumns({c: F.log1p(F.col(c).cast("double")) for c in cols})
    return apply_standard(logged, fit_standard(logged, cols))


def _mixture(spark, sf_dir):
    return _log_std(fx(spark, sf_dir).listing_nulls().select("listing_id", "price", *_FEATS), _FEATS)


@register("gmm_segments_bic")
def q_gmm_bic(spark, sf_dir):
    best, table = C.gmm_segments_bic(_mixture(spark, sf_dir), _FEATS, range(2, 7))
    return table.withColumn("best_n", F.lit(best))


@register("gmm_segments_combined")
def q_gmm_combined(spark, sf_dir):
    _, table = C.gmm_segments_bic(_mixture(spark, sf_dir), _FEATS, range(2, 7))
    return C.gmm_segments_combined(table)


@register("gmm_segment_labels")
def q_gmm_labels(spark, sf_dir):
    """C7's product: the chosen mixture fitted on all rows, and price statistics per component."""
    data = _mixture(spark, sf_dir)
    best, _ = C.gmm_segments_bic(data, _FEATS, range(2, 5))
    return C.segment_stats(C.gmm_label(data, _FEATS, best), "cluster").withColumn("best_n", F.lit(best))


@register("gmm_combined_labels")
def q_gmm_combined_labels(spark, sf_dir):
    """C8's product: the same for the lowest combined score."""
    data = _mixture(spark, sf_dir)
    _, table = C.gmm_segments_bic(data, _FEATS, range(2, 5))
    best = C.gmm_segments_combined(table).first()["n"]
    return C.segment_stats(C.gmm_label(data, _FEATS, best), "cluster").withColumn("best_n", F.lit(best))


_SEG_EDGES = "quantile_cont(price, [0, 0.2, 0.4, 0.6, 0.8, 1.0])"


def _merge_sql() -> str:
    inner = "list_sort(list_distinct(e))"
    dist = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in _FEATS)

    def score(k: int) -> str:
        return (f"r{k} AS (SELECT m{k} AS s, sqrt(var_pop(err)) AS rmse FROM (SELECT x.*, m.m{k} FROM x JOIN map{k} m ON x.seg = m.seg) GROUP BY 1),\n"
                f"w{k} AS (SELECT s FROM r{k}, thr WHERE rmse > thr.t)")

    def step(k: int) -> str:
        return (f"map{k + 1} AS (SELECT m.seg, CASE WHEN m.m{k} IN (SELECT s FROM w{k}) AND n.near NOT IN (SELECT s FROM w{k}) "
                f"THEN n.near ELSE m.m{k} END AS m{k + 1} FROM map{k} m JOIN near n ON m.m{k} = n.seg)")

    return f"""
WITH q AS (SELECT {_SEG_EDGES} AS e FROM scored),
x AS (SELECT s.*, price - pred_c AS err,
             CAST(len(list_filter({inner}[2:len({inner}) - 1], lambda v: price > v)) AS INTEGER) AS seg FROM scored s CROSS JOIN q),
cen AS (SELECT seg, {", ".join(f"avg({f}) AS {f}" for f in _FEATS)} FROM x GROUP BY seg),
near AS (SELECT seg, near FROM (SELECT a.seg, b.seg AS near, row_number() OVER (PARTITION BY a.seg ORDER BY {dist}, b.seg) AS r
                                FROM cen a JOIN cen b ON a.seg <> b.seg) WHERE r = 1),
map0 AS (SELECT seg, seg AS m0 FROM cen),
thr AS (SELECT (s[(len(s) + 1) // 2] + s[least((len(s) + 1) // 2 + 1, len(s))]) / 2 AS t
        FROM (SELECT list_sort(list(rmse)) AS s FROM (SELECT sqrt(var_pop(err)) AS rmse FROM x GROUP BY seg))),
{score(0)},
{step(0)},
{score(1)},
{step(1)}
SELECT x.seg, m2 AS merged_seg, count(*) AS n FROM x JOIN map2 ON x.seg = map2.seg GROUP BY 1, 2
"""


@register("merge_weak_segments", _merge_sql(), ("scored",))
def q_merge_weak(spark, sf_dir):
    """Segments scored by the spread of their error, that is after a correction of its mean fitted anew in each merged one.
    The threshold lies half way between the middle score and the next, so that the order of a sum decides nothing."""
    from valuator.operators.segment import quantile_bins
    s = quantile_bins(fx(spark, sf_dir).scored(), "price", 5, out="seg").withColumn("err", F.col("price") - F.col("pred_c"))

    def rmse_of(frame, segment):
        return {r[0]: r[1] for r in frame.groupBy(segment).agg(F.stddev_pop("err")).collect()}

    centers = {r["seg"]: [r[f] for f in _FEATS] for r in s.groupBy("seg").agg(*[F.avg(f).alias(f) for f in _FEATS]).collect()}
    scores = sorted(rmse_of(s, "seg").values())
    middle = (len(scores) - 1) // 2
    threshold = (scores[middle] + scores[min(middle + 1, len(scores) - 1)]) / 2
    out, _ = C.merge_weak_segments(s, "seg", centers, rmse_of, threshold, out="merged_seg")
    return out.groupBy("seg", "merged_seg").agg(F.count(F.lit(1)).alias("n"))


@register("cluster_errors")
def q_cluster_errors(spark, sf_dir):
    s = fx(spark, sf_dir).scored().withColumn("err", F.col("price") - F.col("pred_c"))
    best, labelled = C.cluster_errors(s.select("listing_id", "err"), "err", range(2, 11))
    return labelled.groupBy("error_cluster").agg(F.count(F.lit(1)).alias("n"), F.min("err").alias("min_err"),
                                                 F.max("err").alias("max_err")).withColumn("best_k", F.lit(best))



@register("cap_segment_sample_null_segment", _CAP_SQL.replace("type_of_vehicle", "make").replace("FROM listing)", "FROM listing_nulls)"),
          ("listing", "listing_nulls"))
def q_cap_segment_nulls(spark, sf_dir):
    """C13 where the segment may be missing: rows without one are a segment."""
    return C.cap_segment_sample(fx(spark, sf_dir).listing_nulls().select("listing_id", "make"), "listing_id", "make", cap=1000)


_SIL_SQL = f"""
WITH q AS (SELECT {_SEG_EDGES} AS e FROM scored),
x AS (SELECT listing_id AS id, price - pred_c AS v, CAST(len(list_filter(list_sort(list_distinct(e))[2:len(list_sort(list_distinct(e))) - 1],
             lambda u: price > u)) AS INTEGER) AS seg FROM scored CROSS JOIN q),
c AS (SELECT seg, count(*) AS n FROM x GROUP BY seg),
d AS (SELECT a.id, a.seg AS own, b.seg AS other, sum(abs(a.v - b.v)) AS far FROM x a CROSS JOIN x b GROUP BY ALL),
s AS (SELECT id, own, max(CASE WHEN other = own THEN far / (c.n - 1) END) AS a, min(CASE WHEN other <> own THEN far / c.n END) AS b
      FROM d JOIN c ON c.seg = d.other GROUP BY id, own)
SELECT own AS seg, count(*) AS n, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM s GROUP BY own
"""


@register("silhouette_1d", _SIL_SQL, ("scored",))
def q_silhouette_1d(spark, sf_dir):
    """C11's score: plain silhouette of the price segments in the error, exact for all rows."""
    from valuator.operators.segment import quantile_bins
    s = quantile_bins(fx(spark, sf_dir).scored(), "price", 5, out="seg").withColumn("err", F.col("price") - F.col("pred_c"))
    return round_all(C.silhouette_1d(s, "err", "seg"))
