"""Registered missing-value queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuator.operators import impute as I
from valuator.operators.profile import QUANTILE_PROFILE_PROBS
from valuator.plans.common import fx, rnd, round_all
from valuator.plans.registry import register
from valuator.plans.strategy import fit_quantiles, fit_row

_MED_COLS = ["power", "curb_weight", "engine_cap", "depreciation"]

_MEDIAN_SQL = """
WITH m AS (SELECT {meds} FROM nulls_train)
SELECT n.listing_id, {cols} FROM nulls_new n CROSS JOIN m
""".format(meds=", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _MED_COLS),
           cols=", ".join(f"coalesce(n.{c}, m.m_{c}) AS {c}" for c in _MED_COLS))


@register("impute_median", _MEDIAN_SQL, ("nulls_train", "nulls_new"))
def q_impute_median(spark, sf_dir):
    f = fx(spark, sf_dir)
    tr, new = f.listing_train(f.listing_nulls()), f.listing_new(f.listing_nulls())
    return I.apply_fill(new.select("listing_id", *_MED_COLS), I.fit_medians(tr, _MED_COLS))


_CONST_SQL = "SELECT listing_id, coalesce(make, 'unknown') AS make FROM listing_nulls"


@register("impute_constant", _CONST_SQL, ("listing_nulls",))
def q_impute_constant(spark, sf_dir):
    return I.impute_constant(fx(spark, sf_dir).listing_nulls().select("listing_id", "make"), ["make"])


_MODE_SQL = """
WITH c AS (SELECT make, count(*) AS n FROM nulls_train WHERE make IS NOT NULL GROUP BY make),
m AS (SELECT make AS mode_make FROM c ORDER BY n DESC, make LIMIT 1)
SELECT n.listing_id, coalesce(n.make, m.mode_make) AS make FROM nulls_new n CROSS JOIN m
"""


@register("impute_mode", _MODE_SQL, ("nulls_train", "nulls_new"))
def q_impute_mode(spark, sf_dir):
    f = fx(spark, sf_dir)
    tr, new = f.listing_train(f.listing_nulls()), f.listing_new(f.listing_nulls())
    return I.apply_fill(new.select("listing_id", "make"), I.fit_modes(tr, ["make"]))


_MEAN_SQL = """
SELECT listing_id, round(coalesce(omv, (SELECT avg(omv) FROM listing_nulls)), 4) AS omv FROM listing_nulls
"""


@register("impute_mean", _MEAN_SQL, ("listing_nulls",))
def q_impute_mean(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "omv")
    return round_all(I.apply_fill(l, I.fit_means(l, ["omv"])), 4)


_GMEAN_SQL = """
WITH g AS (SELECT type_of_vehicle, avg(manufactured) AS gm FROM listing_nulls GROUP BY type_of_vehicle),
o AS (SELECT avg(manufactured) AS om FROM listing_nulls)
SELECT l.listing_id,
  CAST(trunc(coalesce(CAST(l.manufactured AS DOUBLE), g.gm, o.om)) AS INTEGER) AS manufactured,
  CAST(round(coalesce(CAST(l.manufactured AS DOUBLE), g.gm, o.om), 0) AS INTEGER) AS manufactured_rounded
FROM listing_nulls l LEFT JOIN g ON l.type_of_vehicle = g.type_of_vehicle CROSS JOIN o
"""


@register("impute_group_mean", _GMEAN_SQL, ("listing_nulls",))
def q_impute_group_mean(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "type_of_vehicle", "manufactured")
    filled = I.impute_group_mean(l, "manufactured", "type_of_vehicle", cast="")
    return filled.select("listing_id", F.col("manufactured").cast("int").alias("manufactured"),
                         F.round("manufactured", 0).cast("int").alias("manufactured_rounded"))


_FIRST_SQL = """
SELECT listing_id, coalesce(power, first_value(power) OVER (PARTITION BY type_of_vehicle ORDER BY listing_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS power FROM listing_nulls
"""


@register("impute_first_in_group", _FIRST_SQL, ("listing_nulls",))
def q_impute_first(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "type_of_vehicle", "power")
    return I.impute_first_in_group(l, "power", "type_of_vehicle", "listing_id").select("listing_id", "power")


# ------------------------------------------------------------------ KNN (brute-force oracle)
_KNN_FEATS = ["curb_weight", "engine_cap", "depreciation"]


def _knn_sql(src: str, target: str, feats: list[str], k: int, p: str = "", also: str = "") -> str:
    rcols = ", ".join(f"{f} AS r_{f}" for f in feats)
    dcols = ", ".join(f"{f} AS d_{f}" for f in feats)
    both = [f"r_{f} IS NOT NULL AND d_{f} IS NOT NULL" for f in feats]
    sq = " + ".join(f"CASE WHEN {b} THEN (d_{f} - r_{f}) * (d_{f} - r_{f}) ELSE 0.0 END" for b, f in zip(both, feats))
    pr = " + ".join(f"CASE WHEN {b} THEN 1 ELSE 0 END" for b in both)
    m_total = float(len(feats) + 1)
    return f"""
{p}rec AS (SELECT listing_id AS rk, {rcols} FROM {src} WHERE {target} IS NULL{also}),
{p}don AS (SELECT listing_id AS dk, CAST({target} AS DOUBLE) AS dv, {dcols} FROM {src} WHERE {target} IS NOT NULL),
{p}pairs AS (SELECT rk, dk, dv, {sq} AS sq, {pr} AS present FROM {p}rec CROSS JOIN {p}don),
{p}dd AS (SELECT rk, dk, dv, CASE WHEN present > 0 THEN sqrt({m_total} / present * sq) END AS dist FROM {p}pairs),
{p}top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rk ORDER BY dist, dk) AS r FROM {p}dd
                       WHERE dist IS NOT NULL) WHERE r <= {k}),
{p}est AS (
  SELECT rk, CASE WHEN max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) = 1
      THEN sum(CASE WHEN dist = 0 THEN dv ELSE 0.0 END) / sum(CASE WHEN dist = 0 THEN 1 ELSE 0 END)
      ELSE sum(CASE WHEN dist > 0 THEN dv / dist ELSE 0.0 END) / sum(CASE WHEN dist > 0 THEN 1.0 / dist ELSE 0.0 END)
    END AS v
  FROM {p}top GROUP BY rk
)"""


_KNN_SQL = "WITH " + _knn_sql("listing_nulls", "power", _KNN_FEATS, 5).strip() + """
SELECT l.listing_id, round(coalesce(l.power, est.v, (SELECT avg(power) FROM listing_nulls)), 4) AS power
FROM listing_nulls l LEFT JOIN est ON l.listing_id = est.rk
"""


@register("impute_knn", _KNN_SQL, ("listing_nulls",))
def q_impute_knn(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "power", *_KNN_FEATS)
    return I.knn_impute(l, "listing_id", "power", _KNN_FEATS, 5).select("listing_id", rnd("power", 4).alias("power"))


_ZCOLS = [*_KNN_FEATS, "power"]
_KNN_SCALED_SQL = ("WITH st AS (SELECT " + ", ".join(f"round(avg({c}), 4) AS m_{c}, round(stddev_pop({c}), 4) AS s_{c}"
                                                   for c in _ZCOLS)
                   + " FROM listing_nulls),\nz AS (SELECT l.listing_id, "
                   + ", ".join(f"(l.{c} - st.m_{c}) / st.s_{c} AS {c}" for c in _ZCOLS)
                   + " FROM listing_nulls l CROSS JOIN st),\n"
                   + _knn_sql("z", "power", _KNN_FEATS, 5).strip() + """
SELECT l.listing_id, round(coalesce(l.power, est.v * st.s_power + st.m_power, st.m_power), 4) AS power
FROM listing_nulls l LEFT JOIN est ON l.listing_id = est.rk CROSS JOIN st
""")


@register("impute_knn_scaled", _KNN_SCALED_SQL, ("listing_nulls",))
def q_impute_knn_scaled(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "power", *_KNN_FEATS)
    return I.knn_impute_scaled(l, "listing_id", "power", _KNN_FEATS, 5, stats_digits=4).select("listing_id", rnd("power", 4).alias("power"))


_KNN_FLOOR_SQL = "WITH " + _knn_sql("listing_nulls", "power", _KNN_FEATS, 5).strip() + """,
fl AS (SELECT greatest(0.5 * min(power), 1.0) AS f FROM listing_nulls),
v AS (SELECT l.listing_id, coalesce(l.power, est.v, (SELECT avg(power) FROM listing_nulls)) AS p
      FROM listing_nulls l LEFT JOIN est ON l.listing_id = est.rk)
SELECT listing_id, round(CASE WHEN p < fl.f THEN fl.f ELSE p END, 4) AS power FROM v CROSS JOIN fl
"""


@register("impute_knn_floor", _KNN_FLOOR_SQL, ("listing_nulls",))
def q_impute_knn_floor(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "power", *_KNN_FEATS)
    return I.knn_impute_floor(l, "listing_id", "power", _KNN_FEATS, 5).select("listing_id", rnd("power", 4).alias("power"))


_BLEND_FEATS = ["price", "omv", "dereg_value"]  # power, the fourth candidate, does not correlate


def _blend_sql() -> str:
    own = ", ".join(_knn_sql("listing_nulls", f, [c for c in [*_BLEND_FEATS, "depreciation"] if c != f], 5, f"{f}_",
                             " AND depreciation IS NULL").strip() for f in _BLEND_FEATS if f != "price")
    lin = " + ".join(f"w.{f} * " + ("l.price" if f == "price" else f"coalesce(l.{f}, {f}_est.v, m.{f})") for f in _BLEND_FEATS)
    return ("WITH " + _knn_sql("listing_nulls", "depreciation", _BLEND_FEATS, 5).strip() + ",\n" + own + f""",
w AS (SELECT {", ".join(f"abs(corr({f}, depreciation)) AS {f}" for f in _BLEND_FEATS)} FROM listing_nulls),
m AS (SELECT {", ".join(f"avg({f}) AS {f}" for f in _BLEND_FEATS)}, avg(depreciation) AS t, greatest(0.5 * min(depreciation), 1.0) AS fl FROM listing_nulls),
v AS (SELECT l.listing_id, coalesce(l.depreciation, (coalesce(est.v, m.t) + ({lin}) / ({" + ".join(f"w.{f}" for f in _BLEND_FEATS)})) / 2) AS v, m.fl
      FROM listing_nulls l LEFT JOIN est ON l.listing_id = est.rk LEFT JOIN omv_est ON l.listing_id = omv_est.rk
      LEFT JOIN dereg_value_est ON l.listing_id = dereg_value_est.rk CROSS JOIN w CROSS JOIN m)
SELECT listing_id, round(CASE WHEN v < fl THEN fl ELSE v END, 4) AS depreciation FROM v
""")


@register("impute_knn_corr_blend", _blend_sql(), ("listing_nulls",))
def q_impute_knn_corr(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "depreciation", "price", "omv", "dereg_value", "power")
    out = I.knn_impute_corr_blend(l, "listing_id", "depreciation", ["price", "omv", "dereg_value", "power"], 5)
    return out.select("listing_id", rnd("depreciation", 4).alias("depreciation"))


@register("impute_outliers_iqr")
def q_impute_outliers(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "power", *_KNN_FEATS)
    out = I.impute_outliers_iqr(l, "listing_id", "power", _KNN_FEATS, 5)
    return out.select("listing_id", rnd("power", 4).alias("power"))


@register("select_features_for_impute")
def q_select_features(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls()
    feats = I.select_features_for_impute(l, "power", ["curb_weight", "engine_cap", "depreciation", "omv", "arf"])
    return spark.createDataFrame([(i, f) for i, f in enumerate(feats)], "rank int, feature string")


@register("impute_model")
def q_impute_model(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "depreciation", "price", "omv", "dereg_value", "coe")
    out = I.impute_model(l, "depreciation", ["price", "omv", "dereg_value", "coe"])
    return out.select("listing_id", "depreciation")


@register("impute_selected_model")
def q_impute_selected(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "depreciation", "price", "omv", "dereg_value", "coe",
                                                 "power")
    out, name = I.impute_selected_model(l, "depreciation", ["price", "omv", "dereg_value", "coe", "power"], ratio=0.4)
    return out.select("listing_id", "depreciation", F.lit(name).alias("model"))


@register("impute_cluster_median")
def q_impute_cluster_median(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "power", "curb_weight", "engine_cap", "coe")
    out = I.impute_cluster_median(l, "power", ["curb_weight", "engine_cap", "coe"])
    return out.select("listing_id", "power")


@register("impute_cluster_median_by_row")
def q_impute_cluster_median_by_row(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "power", "curb_weight", "engine_cap", "coe")
    return I.impute_cluster_median(l, "power", ["curb_weight", "engine_cap", "coe"], per_row=True).select("listing_id", "power")


_FILLED_KEYS_SQL = """
SELECT count(*) AS n, count(DISTINCT listing_id) AS keys, count(*) AS filled, CAST(sum({c}) AS DOUBLE) IS NOT NULL AS known_kept
FROM listing_nulls
"""


def _filled_keys(out, raw, c):
    """Every key once, every value filled, and the known values as they were."""
    j = out.select("listing_id", F.col(c).alias("_f")).join(raw.select("listing_id", F.col(c).alias("_o")), "listing_id")
    return j.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("listing_id").alias("keys"), F.count("_f").alias("filled"),
                 F.coalesce(F.bool_and(F.col("_o").isNull() | (F.abs(F.col("_o") - F.col("_f")) < 1e-6)), F.lit(False)).alias("known_kept"))


@register("impute_model_keys", _FILLED_KEYS_SQL.format(c="depreciation"), ("listing_nulls",))
def q_impute_model_keys(spark, sf_dir):
    return _filled_keys(q_impute_model(spark, sf_dir), fx(spark, sf_dir).listing_nulls(), "depreciation")


@register("impute_cluster_median_keys", _FILLED_KEYS_SQL.format(c="power"), ("listing_nulls",))
def q_impute_cluster_median_keys(spark, sf_dir):
    return _filled_keys(q_impute_cluster_median_by_row(spark, sf_dir), fx(spark, sf_dir).listing_nulls(), "power")


# ------------------------------------------------------------------ I16–I21
_KNOTS = ", ".join(f"quantile_cont(price, {p}) AS q{i}" for i, p in enumerate(QUANTILE_PROFILE_PROBS))


def _snap_sql() -> str:
    n = len(QUANTILE_PROFILE_PROBS)
    parts = ["WHEN x <= q0 THEN q0"]
    for i in range(1, n):
        a = f"(x - q{i-1}) / (q{i} - q{i-1})"
        parts.append(f"WHEN x <= q{i} THEN q{i-1} + 1.0 / (1.0 + exp(-12.0 * ({a} - 0.5))) * (q{i} - q{i-1})")
    parts.append(f"ELSE q{n-1}")
    v = "CASE " + " ".join(parts) + " END"
    return f"""
WITH k AS (SELECT {_KNOTS}, 1.2 * quantile_cont(price, 0.999) AS up FROM listing_train),
s AS (SELECT listing_id, pred_b AS x, k.* FROM scored CROSS JOIN k),
v AS (SELECT listing_id, up, {v} AS y FROM s)
SELECT listing_id, round(CASE WHEN y < 0 THEN 0.0 WHEN y > up THEN up ELSE y END, 4) AS snapped FROM v
"""


@register("quantile_snap", _snap_sql(), ("listing_train", "scored"))
def q_quantile_snap(spark, sf_dir):
    f = fx(spark, sf_dir)
    q = fit_quantiles(f.listing_train(), ["price"], QUANTILE_PROFILE_PROBS)["price"]
    upper = 1.2 * q[-1]
    s = f.scored()
    return s.select("listing_id", rnd(I.quantile_snap("pred_b", q, upper), 4).alias("snapped"))


_STAT_COLS = ["power", "curb_weight", "engine_cap", "depreciation", "omv"]
_STATS_SQL = """
WITH m AS (SELECT {meds} FROM listing_nulls),
f AS (SELECT l.listing_id, {fill} FROM listing_nulls l CROSS JOIN m),
fl AS (SELECT greatest(0.5 * min(power), 1.0) AS f FROM listing_nulls)
SELECT * FROM ({unions})
""".format(
    meds=", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _STAT_COLS),
    fill=", ".join(f"coalesce(l.{c}, m.m_{c}) AS {c}" for c in _STAT_COLS[:4]) + ", l.omv AS omv",
    unions=" UNION ALL ".join(
        f"""SELECT '{c}' AS feature, (SELECT count(*) - count({c}) FROM listing_nulls) AS initial_missing,
              (SELECT count(*) - count({c}) FROM f) AS final_missing,
              (SELECT count(*) FROM listing_nulls, fl WHERE {c} < {'fl.f' if c == 'power' else "'-inf'::DOUBLE"}) AS adjusted,
              (SELECT count(*) - count({c}) FROM listing_nulls) - (SELECT count(*) - count({c}) FROM f) AS filled,
              CAST(0 AS BIGINT) AS errors""" for c in _STAT_COLS))


@register("impute_stats", _STATS_SQL, ("listing_nulls",))
def q_impute_stats(spark, sf_dir):
    raw = fx(spark, sf_dir).listing_nulls().select("listing_id", *_STAT_COLS)
    filled = I.apply_fill(raw, I.fit_medians(raw, _STAT_COLS[:4]))
    floor = {"power": I.knn_floor_value(raw, "power")}
    return I.impute_stats(raw, filled, "listing_id", _STAT_COLS, floor)


_FILLPOS_SQL = """
WITH g AS (SELECT model, avg(power) AS gm FROM listing_nulls GROUP BY model),
f AS (SELECT l.listing_id, coalesce(l.power, g.gm) AS power, l.curb_weight FROM listing_nulls l
      LEFT JOIN g ON l.model = g.model)
SELECT r.listing_id, CAST(r.power IS NULL AND f.power IS NOT NULL AS INTEGER) AS filled_power,
       CAST(r.curb_weight IS NULL AND f.curb_weight IS NOT NULL AS INTEGER) AS filled_curb_weight
FROM listing_nulls r JOIN f ON r.listing_id = f.listing_id
"""


@register("filled_positions", _FILLPOS_SQL, ("listing_nulls",))
def q_filled_positions(spark, sf_dir):
    raw = fx(spark, sf_dir).listing_nulls().select("listing_id", "model", "power", "curb_weight")
    clean = I.impute_group_mean(raw, "power", "model", cast=None)
    return I.filled_positions(raw, clean, "listing_id", ["power", "curb_weight"])


_NPF_SQL = """
WITH j AS (SELECT l.listing_id, l.power, l.curb_weight, l.engine_cap, s.pred_b
           FROM listing_nulls l JOIN scored s ON l.listing_id = s.listing_id),
m AS (SELECT avg(pred_b) AS m FROM j WHERE power IS NOT NULL AND curb_weight IS NOT NULL AND engine_cap IS NOT NULL)
SELECT listing_id, power IS NULL OR curb_weight IS NULL OR engine_cap IS NULL AS was_filled,
       CASE WHEN power IS NULL OR curb_weight IS NULL OR engine_cap IS NULL THEN NULL ELSE pred_b END AS kept_prediction,
       round(CASE WHEN power IS NULL OR curb_weight IS NULL OR engine_cap IS NULL
                  THEN coalesce(m.m, (SELECT avg(price) FROM listing_train)) END, 2) AS filled_prediction
FROM j CROSS JOIN m
"""


@register("null_prediction_fill", _NPF_SQL, ("listing_nulls", "scored", "listing_train"))
def q_null_prediction_fill(spark, sf_dir):
    f = fx(spark, sf_dir)
    j = f.listing_nulls().select("listing_id", "power", "curb_weight", "engine_cap").join(
        f.scored().select("listing_id", "pred_b"), "listing_id")
    tm = fit_row(f.listing_train(), F.avg("price").alias("m"))["m"]
    out = I.null_prediction_fill(j, "pred_b", ["power", "curb_weight", "engine_cap"], tm)
    filled = F.col("power").isNull() | F.col("curb_weight").isNull() | F.col("engine_cap").isNull()
    return out.select("listing_id", filled.alias("was_filled"),
                      F.when(~filled, F.col("pred_b")).alias("kept_prediction"),
                      F.when(filled, rnd("pred_b", 2)).alias("filled_prediction"))


_FQ_SQL = """
WITH g AS (SELECT model, avg(power) AS gm FROM listing_nulls GROUP BY model),
f AS (SELECT l.listing_id, l.power IS NULL AS was_null, coalesce(l.power, g.gm) AS v FROM listing_nulls l
      LEFT JOIN g ON l.model = g.model)
SELECT count(CASE WHEN was_null THEN v END) AS n_filled, round(avg(CASE WHEN was_null THEN v END), 4) AS mean,
  round(stddev_samp(CASE WHEN was_null THEN v END), 4) AS std, round(min(CASE WHEN was_null THEN v END), 4) AS min,
  round(max(CASE WHEN was_null THEN v END), 4) AS max, round(quantile_cont(CASE WHEN was_null THEN v END, 0.5), 4) AS median,
  round(abs(skewness(CASE WHEN NOT was_null THEN v END) - skewness(CASE WHEN was_null THEN v END)), 4) AS skewness_difference,
  round(abs(kurtosis(CASE WHEN NOT was_null THEN v END) - kurtosis(CASE WHEN was_null THEN v END)), 4) AS kurtosis_difference
FROM f
"""


@register("fill_quality", _FQ_SQL, ("listing_nulls",))
def q_fill_quality(spark, sf_dir):
    raw = fx(spark, sf_dir).listing_nulls().select("listing_id", "model", "power")
    filled = I.impute_group_mean(raw, "power", "model", cast=None)
    return round_all(I.fill_quality(raw, filled, "listing_id", "power"), 4)


_FLAG_SQL = """
SELECT listing_id, CAST(power IS NULL AS INTEGER) AS is_impute_power,
       CAST(road_tax IS NULL AS INTEGER) AS is_impute_road_tax FROM listing_nulls
"""


@register("imputed_flag", _FLAG_SQL, ("listing_nulls",))
def q_imputed_flag(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "power", "road_tax")
    return I.imputed_flag(l, ["power", "road_tax"]).select("listing_id", "is_impute_power", "is_impute_road_tax")
