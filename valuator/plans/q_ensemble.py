"""Registered ensembling / routing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuator.operators import ensemble as W
from valuator.operators import evaluate as ev
from valuator.operators.cluster import segment_stats
from valuator.operators.segment import error_band
from valuator.plans.common import PRED_COLS, fx, rnd, round_all
from valuator.plans.registry import register
from valuator.plans.strategy import fit_row
from valuator.session import cut_lineage


def _long(spark, sf_dir):
    return ev.to_long(fx(spark, sf_dir).scored(), "listing_id", "price", PRED_COLS)


_MEAN_SQL = "SELECT listing_id, round((pred_a + pred_b + pred_c) / 3, 2) AS prediction, 3 AS n_predictions FROM scored"


@register("mean_ensemble", _MEAN_SQL, ("scored",))
def q_mean_ensemble(spark, sf_dir):
    m = W.mean_ensemble(_long(spark, sf_dir), "listing_id")
    return m.select("listing_id", rnd("prediction", 2).alias("prediction"), F.col("n_predictions").cast("int"))


_BLEND_SQL = """
SELECT listing_id, 0.7 * pred_a + 0.3 * pred_b AS blend_two, 0.4 * pred_a + 0.3 * pred_b + 0.3 * pred_c AS blend_three
FROM scored
"""


@register("fixed_weight_blend", _BLEND_SQL, ("scored",))
def q_fixed_blend(spark, sf_dir):
    s = fx(spark, sf_dir).scored()
    return s.select("listing_id", W.fixed_weight_blend({"pred_a": 0.7, "pred_b": 0.3}).alias("blend_two"),
                    W.fixed_weight_blend({"pred_a": 0.4, "pred_b": 0.3, "pred_c": 0.3}).alias("blend_three"))


def _gram_sql(src: str, preds: list[str]) -> str:
    parts = ["count(*) AS n", "sum(price * price) AS yy", "sum(price) AS sy"]
    for i, a in enumerate(preds):
        parts.append(f"sum({a} * price) AS py{i}")
        for j in range(len(preds)):
            parts.append(f"sum({a} * {preds[j]}) AS pp{i}_{j}")
    return f"g AS (SELECT {', '.join(parts)} FROM {src})"


def _det3(m: list[list[str]]) -> str:
    return (f"(({m[0][0]}) * (({m[1][1]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][1]}))"
            f" - ({m[0][1]}) * (({m[1][0]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][0]}))"
            f" + ({m[0][2]}) * (({m[1][0]}) * ({m[2][1]}) - ({m[1][1]}) * ({m[2][0]})))")


def _l2_sql() -> str:
    a = [[f"pp{i}_{j}" + (" + 0.1" if i == j else "") for j in range(3)] for i in range(3)]
    b = [f"py{i}" for i in range(3)]
    dets = []
    for c in range(3):
        mc = [[b[i] if j == c else a[i][j] for j in range(3)] for i in range(3)]
        dets.append(_det3(mc))
    raw = ", ".join(f"greatest({d} / {_det3(a)}, 0.0) AS w{c}" for c, d in enumerate(dets))
    return f"""
WITH {_gram_sql('scored', PRED_COLS)},
w AS (SELECT {raw} FROM g)
SELECT * FROM (
  SELECT 'pred_a' AS model, round(w0 / (w0 + w1 + w2), 6) AS weight FROM w
  UNION ALL SELECT 'pred_b', round(w1 / (w0 + w1 + w2), 6) FROM w
  UNION ALL SELECT 'pred_c', round(w2 / (w0 + w1 + w2), 6) FROM w)
"""


@register("l2_ensemble_weights", _l2_sql(), ("scored",))
def q_l2_weights(spark, sf_dir):
    g = W.gram(fx(spark, sf_dir).scored(), PRED_COLS, "price")
    return round_all(W.weights_frame(spark, PRED_COLS, W.l2_weights(g, 0.1)))


_ROBUST_PREDS = [*PRED_COLS, "pred_bad"]


def _with_bad(spark, sf_dir):
    return fx(spark, sf_dir).scored().withColumn("pred_bad", F.col("price") * 3.0)


def _robust_sql() -> str:
    """The three good models have W3's weights; a model with R² <= -0.5 has none."""
    l2 = _l2_sql().strip()
    return f"""
WITH w3 AS ({l2}),
lng AS (SELECT price, model, p FROM (SELECT price, pred_a, pred_b, pred_c, price * 3.0 AS pred_bad FROM scored)
        UNPIVOT (p FOR model IN (pred_a, pred_b, pred_c, pred_bad))),
r AS (SELECT model, 1 - sum((price - p) * (price - p)) / (var_pop(price) * count(*)) AS r2 FROM lng GROUP BY model)
SELECT r.model, CASE WHEN r2 > -0.5 THEN w3.weight ELSE 0.0 END AS weight, round(r2, 6) AS r2
FROM r LEFT JOIN w3 ON r.model = w3.model
"""


@register("robust_ensemble_weights", _robust_sql(), ("scored",))
def q_robust_weights(spark, sf_dir):
    g = W.gram(_with_bad(spark, sf_dir), _ROBUST_PREDS, "price")
    w = W.robust_weights(g)
    rows = [(m, float(x), float(W.r2_of(g, i))) for i, (m, x) in enumerate(zip(_ROBUST_PREDS, w))]
    return round_all(spark.createDataFrame(rows, "model string, weight double, r2 double"))


@register("entropy_ensemble_weights")
def q_entropy_weights(spark, sf_dir):
    g = W.gram(fx(spark, sf_dir).scored(), PRED_COLS, "price")
    return W.weights_frame(spark, PRED_COLS, W.entropy_weights(g))


@register("stacked_nonneg_ridge")
def q_stacked_ridge(spark, sf_dir):
    from valuator.operators.train import kfold_assign
    s = fx(spark, sf_dir).scored().withColumn("fold", kfold_assign("listing_id", 5))
    table, _oof, _test = W.stacked_nonneg_ridge(s, PRED_COLS, "price", "fold", alpha=1.0)
    return table


@register("stacked_ridge_predictions")
def q_stacked_ridge_predictions(spark, sf_dir):
    """W6's product: blended out-of-fold rows and blended test rows; a part of the base predictions is missing."""
    from valuator.operators.train import kfold_assign
    s = fx(spark, sf_dir).scored().withColumn("fold", kfold_assign("listing_id", 6))
    s = s.withColumn("pred_a", F.when(F.col("listing_id") % 11 != 0, F.col("pred_a")))
    _table, oof, test = W.stacked_nonneg_ridge(s.filter("fold < 5"), PRED_COLS, "price", "fold", test=s.filter("fold = 5"))
    return oof.select("listing_id", F.lit("oof").alias("part"), "blend").union(
        test.select("listing_id", F.lit("test").alias("part"), "blend"))


@register("stacked_ridge_keys", """
SELECT CASE WHEN ((listing_id % 2147483647 * 48271 + 42) % 2147483647) % 6 < 5 THEN 'oof' ELSE 'test' END AS part,
       count(*) AS n, CAST(sum(listing_id) AS DOUBLE) AS key_sum, count(*) AS predicted
FROM scored GROUP BY 1
""", ("scored",))
def q_stacked_ridge_keys(spark, sf_dir):
    return q_stacked_ridge_predictions(spark, sf_dir).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("listing_id").cast("double")).alias("key_sum"), F.count("blend").alias("predicted"))


@register("stacked_meta_model")
def q_stacked_meta(spark, sf_dir):
    from valuator.operators.train import kfold_assign
    s = fx(spark, sf_dir).scored().withColumn("fold", kfold_assign("listing_id", 3))
    _m, res = W.stacked_meta_model(s.select("listing_id", "price", "fold", *PRED_COLS), PRED_COLS, "price", "fold")
    return res.select("listing_id", "fold", "price", "meta_prediction")


_SWF_SQL = """
WITH lng AS (
  SELECT 'pred_a' AS model, listing_id, price, pred_a AS p FROM scored
  UNION ALL SELECT 'pred_b', listing_id, price, pred_b FROM scored
  UNION ALL SELECT 'pred_c', listing_id, price, pred_c FROM scored
), r2 AS (SELECT model, 1 - sum((price - p) * (price - p)) / (var_pop(price) * count(*)) AS w FROM lng GROUP BY model)
SELECT listing_id, round(sum(w * p) / sum(w), 2) AS prediction FROM lng JOIN r2 ON lng.model = r2.model GROUP BY listing_id
"""


@register("score_weighted_folds", _SWF_SQL, ("scored",))
def q_score_weighted(spark, sf_dir):
    long = _long(spark, sf_dir)
    r2 = ev.regression_metrics(long, ["model"], "price", "prediction").select("model", F.col("r2").alias("w"))
    from valuator.plans.strategy import attach_state
    j = attach_state(long, r2, "model", "inner")
    return W.score_weighted_folds(j, "listing_id", "w").select("listing_id", rnd("prediction", 2).alias("prediction"))


_SEGCLIP_SQL = """
WITH st AS (SELECT type_of_vehicle, quantile_cont(price, 0.5) AS md, stddev_samp(price) AS sd FROM scored GROUP BY type_of_vehicle),
x AS (SELECT s.listing_id, CASE WHEN s.listing_id % 5 = 0 THEN s.pred_c * 2.0 ELSE s.pred_c END AS p,
             greatest(st.md - 3.0 * st.sd, 700.0) AS lo, least(st.md + 3.0 * st.sd, 2900000.0) AS hi
      FROM scored s JOIN st ON s.type_of_vehicle = st.type_of_vehicle),
c AS (SELECT listing_id, CASE WHEN p < lo THEN lo WHEN p > hi THEN hi ELSE p END AS p FROM x)
SELECT listing_id, round(CASE WHEN p < 700.0 THEN 700.0 WHEN p > 2900000.0 THEN 2900000.0 ELSE p END, 2) AS prediction FROM c
"""


@register("segment_clip", _SEGCLIP_SQL, ("scored",))
def q_segment_clip(spark, sf_dir):
    s = fx(spark, sf_dir).scored()
    x = s.withColumn("prediction", F.when(F.col("listing_id") % 5 == 0, F.col("pred_c") * 2.0).otherwise(F.col("pred_c")))
    out = W.segment_clip(x, "type_of_vehicle", "prediction", segment_stats(s, "type_of_vehicle"))
    return out.select("listing_id", rnd("prediction", 2).alias("prediction"))


_TAIL_SQL = """
WITH st AS (SELECT type_of_vehicle, min(price) AS mn, max(price) AS mx, quantile_cont(price, 0.5) AS md
            FROM scored GROUP BY type_of_vehicle),
x AS (SELECT s.listing_id, CASE WHEN s.listing_id % 7 = 0 THEN s.pred_c * 3.0 WHEN s.listing_id % 7 = 1
             THEN s.pred_c * 0.2 ELSE s.pred_c END AS p, greatest(700.0, st.mn * 0.9) AS lo,
             least(2900000.0, st.mx * 1.1) AS hi, st.md
      FROM scored s JOIN st ON s.type_of_vehicle = st.type_of_vehicle),
s1 AS (SELECT *, CASE WHEN p < lo THEN lo + (p - lo) * 0.5 WHEN p > hi THEN hi - (hi - p) * 0.5 ELSE p END AS q FROM x),
s2 AS (SELECT *, CASE WHEN abs(q - md) > 2 * (hi - lo) THEN md + (q - md) * 0.3 ELSE q END AS r FROM s1)
SELECT listing_id, round_even(CASE WHEN r < 700.0 THEN 700.0 WHEN r > 2900000.0 THEN 2900000.0 ELSE r END, 0) AS prediction
FROM s2
"""


@register("tail_shrink", _TAIL_SQL, ("scored",))
def q_tail_shrink(spark, sf_dir):
    s = fx(spark, sf_dir).scored()
    x = s.withColumn("prediction", F.when(F.col("listing_id") % 7 == 0, F.col("pred_c") * 3.0)
                     .when(F.col("listing_id") % 7 == 1, F.col("pred_c") * 0.2).otherwise(F.col("pred_c")))
    out = W.tail_shrink(x, "type_of_vehicle", "prediction", segment_stats(s, "type_of_vehicle"))
    return out.select("listing_id", "prediction")


_ROUTE_SQL = """
WITH c AS (SELECT *, {band} AS cls FROM scored)
SELECT listing_id, CASE WHEN cls = 0 THEN pred_a WHEN cls = 1 THEN pred_b ELSE pred_a END AS prediction,
       CASE WHEN cls = 0 THEN 'pred_a' WHEN cls = 1 THEN 'pred_b' ELSE 'pred_a' END AS routed_model
FROM c
"""


def _route_sql():
    from valuator.operators.segment import ERROR_BANDS
    from valuator.plans.sqlgen import band_case
    return _ROUTE_SQL.format(band=band_case("price - pred_c", ERROR_BANDS, "closed"))


@register("route_by_class", _route_sql(), ("scored",))
def q_route(spark, sf_dir):
    s = fx(spark, sf_dir).scored().withColumn("cls", error_band(F.col("price") - F.col("pred_c"), gaps="closed"))
    return W.route_by_class(s, "listing_id", "cls", {0: "pred_a", 1: "pred_b"}, "pred_a")


_SOFT_SQL = """
WITH m AS (SELECT avg(pred_a) AS mr FROM scored),
x AS (SELECT listing_id, least(greatest(-0.1 * (pred_a - m.mr), -700.0), 700.0) AS z,
             CASE WHEN pred_b < 700.0 THEN 700.0 WHEN pred_b > 300000.0 THEN 300000.0 ELSE pred_b END AS lo,
             CASE WHEN pred_c < 300000.0 THEN 300000.0 WHEN pred_c > 2900000.0 THEN 2900000.0 ELSE pred_c END AS hi
      FROM scored CROSS JOIN m),
y AS (SELECT listing_id, 1.0 / (1.0 + exp(z)) AS p, lo, hi FROM x),
b AS (SELECT listing_id, ((1.0 - p) * lo + p * hi) / ((1.0 - p) + p) AS v FROM y)
SELECT listing_id, round(CASE WHEN v < 700.0 THEN 700.0 WHEN v > 2900000.0 THEN 2900000.0 ELSE v END, 2) AS prediction FROM b
"""


@register("soft_route", _SOFT_SQL, ("scored",))
def q_soft_route(spark, sf_dir):
    s = fx(spark, sf_dir).scored()
    mr = fit_row(s, F.avg("pred_a").alias("m"))["m"]
    return s.select("listing_id", rnd(W.soft_route("pred_a", "pred_b", "pred_c", mr, 300000.0), 2).alias("prediction"))


@register("ref_price_feature")
def q_ref_price_feature(spark, sf_dir):
    from valuator.operators import train as M
    from valuator.plans.q_train import FEATURES
    f = fx(spark, sf_dir)
    tr = f.listing_labelled().withColumn("fold", M.kfold_assign("listing_id", 5, seed=7))
    te = f.listing_new()
    stage1 = M.oof_run(tr, "listing_id", FEATURES, "price", "fold", "gbt")
    # read by the scores and by every fold of the second stage: each would run the first stage's models again
    oof1 = cut_lineage(stage1.oof)
    test1 = M.predict_folds(stage1.models, te, "listing_id", FEATURES)
    tr2, te2 = W.ref_price_feature(tr, te, "listing_id", oof1, test1)
    tr2 = cut_lineage(tr2)
    stage2 = M.oof_run(tr2, "listing_id", [*FEATURES, "ref_price"], "price", "fold", "gbt")
    rows = [("stage1", oof1), ("stage2", stage2.oof)]
    out = None
    for name, o in rows:
        r = ev.regression_metrics(o, [], "actual", "prediction").withColumn("stage", F.lit(name))
        out = r if out is None else out.unionByName(r)
    n_ref = fit_row(te2, F.count("ref_price").alias("n"))["n"]
    return out.withColumn("test_rows_with_ref", F.lit(n_ref))


@register("two_pass_run")
def q_two_pass(spark, sf_dir):
    """The two passes whole: errors of each pass by segment, and the new rows that each predicts."""
    from valuator.operators import train as M
    from valuator.operators.two_pass import two_pass_run
    from valuator.plans.q_train import _SEGMENT_PARAMS, FEATURES
    f = fx(spark, sf_dir)
    tr = f.listing_labelled().withColumn("fold", M.kfold_assign("listing_id", 5, seed=7))
    passes = two_pass_run(tr, f.listing_new(), "listing_id", ["depreciation", "coe", "dereg_value"], FEATURES, "price", "fold",
                          params_for=_SEGMENT_PARAMS)
    out = []
    for i, p in enumerate(passes, 1):
        per = ev.regression_metrics(p.held_out, ["segment"], "actual", "prediction")
        seen = p.new.groupBy("segment").agg(F.count("prediction").alias("new_rows"), F.avg("prediction").alias("mean_new_prediction"))
        out.append(per.join(seen, "segment", "full").withColumn("pass", F.lit(i)))
    return M.union_all(out)


_OOF_SQL = """
WITH u AS (
  SELECT listing_id, pred_a AS prediction FROM scored WHERE ((listing_id % 2147483647 * 48271 + 42) % 2147483647) % 3 <> 0
  UNION ALL SELECT listing_id, pred_b FROM scored WHERE ((listing_id % 2147483647 * 48271 + 42) % 2147483647) % 3 <> 1
)
SELECT listing_id, round(sum(prediction) / greatest(count(prediction), 1), 2) AS prediction, count(prediction) AS times_predicted
FROM u GROUP BY listing_id
"""


@register("oof_combine", _OOF_SQL, ("scored",))
def q_oof_combine(spark, sf_dir):
    from valuator.operators.train import kfold_assign
    s = fx(spark, sf_dir).scored().withColumn("fold", kfold_assign("listing_id", 3))
    a = s.filter(F.col("fold") != 0).select("listing_id", F.col("pred_a").alias("prediction"))
    b = s.filter(F.col("fold") != 1).select("listing_id", F.col("pred_b").alias("prediction"))
    out = W.oof_combine([a, b], "listing_id")
    return out.select("listing_id", rnd("prediction", 2).alias("prediction"), "times_predicted")


def _grid_sql() -> str:
    rm = ("sqrt(greatest(yy - 2 * (w0 * py0 + w1 * py1 + w2 * py2) + "
          "(w0 * w0 * pp0_0 + w1 * w1 * pp1_1 + w2 * w2 * pp2_2 + 2 * w0 * w1 * pp0_1 + 2 * w0 * w2 * pp0_2 "
          "+ 2 * w1 * w2 * pp1_2), 0.0) / n)")
    return f"""
WITH {_gram_sql('scored', PRED_COLS)},
grid AS (SELECT i, j, i / 20.0 AS w0, j / 20.0 AS w1, (20 - i - j) / 20.0 AS w2
         FROM range(21) a(i) CROSS JOIN range(21) b(j) WHERE i + j <= 20),
r AS (SELECT i, j, w0, w1, w2, {rm} AS rmse FROM grid CROSS JOIN g)
SELECT round(w0, 6) AS w_pred_a, round(w1, 6) AS w_pred_b, round(w2, 6) AS w_pred_c, round(rmse, 2) AS rmse
FROM r ORDER BY rmse, i, j LIMIT 1
"""


@register("grid_ensemble_weights", _grid_sql(), ("scored",))
def q_grid_weights(spark, sf_dir):
    g = W.gram(fx(spark, sf_dir).scored(), PRED_COLS, "price")
    w, r = W.grid_weights(g, 0.05)
    return spark.createDataFrame([(float(w[0]), float(w[1]), float(w[2]), float(r))],
                                 "w_pred_a double, w_pred_b double, w_pred_c double, rmse double").transform(
        lambda d: round_all(d.withColumn("rmse", rnd("rmse", 2))))


_CLASS = "CASE WHEN price < 100000 THEN 'low' WHEN price < 200000 THEN 'medium' ELSE 'high' END"
#: Least and greatest weight of each model, by price class.
_CLASS_RANGES = {"low": ([0.0, 0.0, 0.0], [0.5, 0.5, 1.0]), "medium": ([0.2, 0.1, 0.0], [0.8, 0.6, 0.7])}


def _class_grid_sql() -> str:
    per = " UNION ALL ".join(
        f"SELECT '{c}' AS class, w0, w1, w2, rmse, i, j FROM r WHERE class = '{c}'"
        + "".join(f" AND w{m} >= {lo[m]} - 1e-9 AND w{m} <= {hi[m]} + 1e-9" for m in range(3))
        for c, (lo, hi) in {**_CLASS_RANGES, "high": ([0.0] * 3, [1.0] * 3)}.items())
    return f"""
WITH e AS (SELECT {_CLASS} AS class, price AS y, pred_a AS a, pred_b AS b, pred_c AS c FROM scored),
grid AS (SELECT i, j, i / 20.0 AS w0, j / 20.0 AS w1, (20 - i - j) / 20.0 AS w2 FROM range(21) a(i) CROSS JOIN range(21) b(j) WHERE i + j <= 20),
r AS (SELECT class, i, j, w0, w1, w2, sqrt(avg((y - w0 * a - w1 * b - w2 * c) * (y - w0 * a - w1 * b - w2 * c))) AS rmse
      FROM e CROSS JOIN grid GROUP BY ALL)
SELECT class, round(w0, 6) AS w_pred_a, round(w1, 6) AS w_pred_b, round(w2, 6) AS w_pred_c, round(rmse, 2) AS rmse
FROM ({per}) QUALIFY row_number() OVER (PARTITION BY class ORDER BY rmse, i, j) = 1
"""


@register("grid_weights_by_class", _class_grid_sql(), ("scored",))
def q_grid_by_class(spark, sf_dir):
    """W14 with a range of weights per price class."""
    s = fx(spark, sf_dir).scored().withColumn("class", F.expr(_CLASS))
    best = W.grid_weights_by_class(s, PRED_COLS, "price", "class", _CLASS_RANGES)
    rows = [(c, *(round(float(x), 6) for x in w), round(float(r), 2)) for c, (w, r) in best.items()]
    return spark.createDataFrame(rows, "class string, w_pred_a double, w_pred_b double, w_pred_c double, rmse double")


def _meta(spark, sf_dir, **more):
    from valuator.operators.train import kfold_assign
    s = fx(spark, sf_dir).scored().withColumn("fold", kfold_assign("listing_id", 5))
    passed = list(more.get("passthrough", ()))
    _m, res = W.stacked_meta_model(s.select("listing_id", "price", "fold", *PRED_COLS, *passed), PRED_COLS, "price", "fold", **more)
    return res.select("listing_id", "fold", "price", "meta_prediction")


@register("stacked_meta_boosted")
def q_meta_boosted(spark, sf_dir):
    """W7 with a boosted second level, 50 rounds a fold."""
    return _meta(spark, sf_dir, kind="boosted")


@register("stacked_meta_passthrough")
def q_meta_passthrough(spark, sf_dir):
    """W7 with features passed through beside the predictions."""
    return _meta(spark, sf_dir, passthrough=("power", "engine_cap", "curb_weight", "depreciation"))


_MEDIAN_SQL = """
SELECT listing_id, quantile_cont(p, 0.5) AS prediction FROM (
  SELECT listing_id, pred_a AS p FROM scored UNION ALL SELECT listing_id, pred_b FROM scored
  UNION ALL SELECT listing_id, pred_c FROM scored) GROUP BY listing_id
"""


@register("median_ensemble", _MEDIAN_SQL, ("scored",))
def q_median_ensemble(spark, sf_dir):
    m = W.median_ensemble(_long(spark, sf_dir), "listing_id", "model")
    return m.select("listing_id", "prediction")
