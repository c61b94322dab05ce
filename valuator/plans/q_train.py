"""Registered fold / split / training queries.

Training jobs use Spark ML learners, so their predictions are checked by
row counts and invariants (tests/test_train.py), not by an SQL oracle.
Fold, split and stratification queries are exact and have one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from valuator.operators import ensemble as W
from valuator.operators import evaluate as ev
from valuator.operators import train as M
from valuator.plans.common import NUMERIC_FEATURES, fx, rnd
from valuator.plans.registry import register
from valuator.session import cut_lineage

FEATURES = [*NUMERIC_FEATURES, "manufactured"]
#: Categorical columns of the models; a row's own fold is left out of its mean codes.
CATEGORIES = M.Categories(coded=("make", "model"), flagged=("type_of_vehicle", "transmission"), listed=("category",), fold="fold")
#: Settings of the segment learners; the others are the library's own.
_SEGMENT_PARAMS = {None: {"rf": {"numTrees": 20, "maxDepth": 8}}}


def _train(spark, sf_dir, k: int = 5, nulls: bool = True):
    """All rows, each with its fold."""
    f = fx(spark, sf_dir)
    base = f.listing_features() if nulls else f.listing()
    return base.withColumn("fold", M.kfold_assign("listing_id", k))


# ------------------------------------------------------------------ M1–M3 (exact)
_KFOLD_SQL = """
SELECT listing_id, CAST(((listing_id % 2147483647 * 48271 + 42) % 2147483647) % 5 AS INTEGER) AS fold,
       CAST(((listing_id % 2147483647 * 48271 + 42) % 2147483647) % 10 AS INTEGER) AS fold10 FROM listing
"""


@register("kfold_assign", _KFOLD_SQL, ("listing",))
def q_kfold(spark, sf_dir):
    l = fx(spark, sf_dir).listing()
    return l.select("listing_id", M.kfold_assign("listing_id", 5).alias("fold"),
                    M.kfold_assign("listing_id", 10).alias("fold10"))


_SKFOLD_SQL = """
WITH q AS (SELECT quantile_cont(price, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS e FROM listing),
b AS (SELECT listing_id, CAST(len(list_filter(list_sort(list_distinct(e))[2:len(list_sort(list_distinct(e))) - 1],
             lambda x: price > x)) AS INTEGER) AS bin FROM listing CROSS JOIN q)
SELECT listing_id, CAST((row_number() OVER (PARTITION BY bin ORDER BY ((((listing_id % 2147483647 * 48271 + 42) % 2147483647) * 48271) % 2147483647), listing_id) - 1) % 5
       AS INTEGER) AS fold FROM b
"""


@register("stratified_kfold_assign", _SKFOLD_SQL, ("listing",))
def q_skfold(spark, sf_dir):
    from valuator.operators.segment import quantile_bins
    l = quantile_bins(fx(spark, sf_dir).listing().select("listing_id", "price"), "price", 10, out="bin")
    return M.stratified_kfold_assign(l, "listing_id", "bin", 5).select("listing_id", "fold")


_MAKE_SQL = """
WITH r AS (SELECT listing_id, row_number() OVER (PARTITION BY make ORDER BY ((((listing_id % 2147483647 * 48271 + 42) % 2147483647) * 48271) % 2147483647),
                                                 listing_id) AS rn, count(*) OVER (PARTITION BY make) AS n FROM listing_nulls)
SELECT listing_id, CAST((rn - 1) % 5 AS INTEGER) AS fold, CASE WHEN rn <= round_even(n * 0.2, 0) THEN 'test' ELSE 'train' END AS split FROM r
"""


@register("stratified_splits_null_stratum", _MAKE_SQL, ("listing", "listing_nulls"))
def q_splits_nulls(spark, sf_dir):
    """M2 and stratified M3 where the stratum may be missing: rows without one are a stratum."""
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "make")
    folds = M.stratified_kfold_assign(l, "listing_id", "make", 5).select("listing_id", "fold")
    return folds.join(M.stratified_split(l, "listing_id", "make").select("listing_id", "split"), "listing_id")


_SPLIT_SQL = """
SELECT listing_id,
  CASE WHEN ((((listing_id % 2147483647 * 48271 + 42) % 2147483647) * 48271) % 2147483647) < 429496729 THEN 'test' ELSE 'train' END AS split,
  CASE WHEN ((((listing_id % 2147483647 * 48271 + 7) % 2147483647) * 48271) % 2147483647) < 1546188225 THEN 'train'
       WHEN ((((listing_id % 2147483647 * 48271 + 7) % 2147483647) * 48271) % 2147483647) < 1717986917 THEN 'val' ELSE 'test' END AS split3
FROM listing
"""


@register("train_test_split", _SPLIT_SQL, ("listing",))
def q_split(spark, sf_dir):
    l = fx(spark, sf_dir).listing()
    return l.select("listing_id", M.train_test_split("listing_id", 0.2).alias("split"),
                    M.three_way_split("listing_id", (0.72, 0.08, 0.20), seed=7).alias("split3"))


# ------------------------------------------------------------------ M4–M7
def _oof_metrics(run: M.FoldRun):
    per = ev.regression_metrics(run.oof, ["fold"], "actual", "prediction").withColumn("fold", F.col("fold").cast("string"))
    tot = ev.regression_metrics(run.oof, [], "actual", "prediction").withColumn("fold", F.lit("all"))
    return per.unionByName(tot)


_CODES_SQL = """
WITH l AS (SELECT listing_id, coalesce(make, 'unknown') AS make, coalesce(model, 'unknown') AS model, ln(1 + price) AS y,
                  ((listing_id % 2147483647 * 48271 + 42) % 2147483647) % 5 AS fold FROM listing_nulls),
p AS (SELECT fold, count(*) AS n, sum(y) AS s FROM l GROUP BY fold),
pairs AS (SELECT a.fold AS own, b.fold AS held, (SELECT sum(s) / sum(n) FROM p WHERE fold <> a.fold AND fold <> b.fold) AS prior
          FROM p a CROSS JOIN p b),
sums AS (SELECT 'make' AS col, make AS v, fold, count(*) AS n, sum(y) AS s FROM l GROUP BY make, fold
         UNION ALL SELECT 'model', model, fold, count(*), sum(y) FROM l GROUP BY model, fold),
codes AS (
  SELECT col, own, held, t.v, any_value(prior) AS prior, coalesce(sum(n) FILTER (s.fold <> own AND s.fold <> held), 0) AS n,
         coalesce(sum(s.s) FILTER (s.fold <> own AND s.fold <> held), 0) AS s
  FROM (SELECT DISTINCT col, v FROM sums) t CROSS JOIN pairs JOIN sums s USING (col, v) GROUP BY col, own, held, t.v),
coded AS (SELECT col, own, held, v, CASE WHEN n <= 1 THEN prior ELSE prior * (1 - 1 / (1 + exp(CAST(1 - n AS DOUBLE))))
                                                             + s / n / (1 + exp(CAST(1 - n AS DOUBLE))) END AS code FROM codes)
SELECT l.listing_id, round(a.code, 6) AS make_code, round(b.code, 6) AS model_code, round(c.code, 6) AS make_code_in_0
FROM l JOIN coded a ON a.col = 'make' AND a.v = l.make AND a.own = l.fold AND a.held = l.fold
JOIN coded b ON b.col = 'model' AND b.v = l.model AND b.own = l.fold AND b.held = l.fold
JOIN coded c ON c.col = 'make' AND c.v = l.make AND c.own = l.fold AND c.held = 0
"""


@register("fold_mean_codes", _CODES_SQL, ("listing", "listing_nulls"))
def q_fold_codes(spark, sf_dir):
    """E9 inside the folds: codes of every row where its fold is held out, and in the model that holds out fold 0."""
    from valuator.operators.stages import MeanEncoder
    tr = M._prepare(_train(spark, sf_dir), [], "price", True)
    enc = MeanEncoder(inputCols=["make", "model"], outputCols=["make_code", "model_code"], labelCol="_y", foldCol="fold")
    models = {f: enc.fit(tr.filter(F.col("fold") != f)) for f in M.fold_ids(tr, "fold")}
    held = M.union_all([m.transform(tr.filter(F.col("fold") == f)) for f, m in models.items()])
    in0 = models[0].transform(tr).select("listing_id", rnd("make_code").alias("make_code_in_0"))
    return held.select("listing_id", rnd("make_code").alias("make_code"), rnd("model_code").alias("model_code")).join(in0, "listing_id")


@register("gbt_oof")
def q_gbt_oof(spark, sf_dir):
    run = M.oof_run(_train(spark, sf_dir), "listing_id", FEATURES, "price", "fold", "gbt", categories=CATEGORIES)
    return run.oof


@register("gbt_oof_raw_target")
def q_gbt_raw(spark, sf_dir):
    """Huber loss on the price itself, 10 rounds."""
    run = M.oof_run(_train(spark, sf_dir), "listing_id", FEATURES, "price", "fold", "huber", log_target=False, categories=CATEGORIES,
                    params={"maxIter": 10, "stepSize": 0.3})
    return _oof_metrics(run)


@register("gbt_early_stop")
def q_gbt_early(spark, sf_dir):
    """100 rounds a fold, each model cut to the round that no other beat within 50 rounds."""
    run = M.oof_run(_train(spark, sf_dir), "listing_id", FEATURES, "price", "fold", "gbt", params={"maxIter": 100}, patience=50,
                    categories=CATEGORIES)
    trees = [(str(f), len(m.stages[-1].trees)) for f, m in run.models.items()]
    t = spark.createDataFrame(trees, "fold string, n_trees int")
    return _oof_metrics(run).join(t, "fold", "left")


@register("rf_regression")
def q_rf(spark, sf_dir):
    from pyspark.ml.evaluation import RegressionEvaluator
    l = fx(spark, sf_dir).listing().withColumn("split", M.three_way_split("listing_id"))
    data, _rows = M.training_rows(M._prepare(l, FEATURES, "price", False), [*FEATURES, "_y", "split"])
    m = M.regression_pipeline(FEATURES, "_y", "rf", params={"numTrees": 200, "maxDepth": 12, "maxMemoryInMB": 64}).fit(
        data.filter("split = 'train'"))
    rows = []
    for part in ("train", "val", "test"):
        p = m.transform(data.filter(F.col("split") == part)).select("_y", "_pred").persist()  # every row goes through 200 trees once
        rows.append((part, RegressionEvaluator(labelCol="_y", predictionCol="_pred", metricName="rmse").evaluate(p),
                     RegressionEvaluator(labelCol="_y", predictionCol="_pred", metricName="r2").evaluate(p)))
        p.unpersist()
    data.unpersist()
    return spark.createDataFrame(rows, "split string, rmse double, r2 double")


@register("linear_family")
def q_linear(spark, sf_dir):
    return M.linear_family(_train(spark, sf_dir), FEATURES, "price", "fold")


@register("linear_paths")
def q_linear_paths(spark, sf_dir):
    """Ridge, lasso and elastic net at five penalties, all folds, from one aggregate."""
    from valuator.operators.linear_path import linear_paths
    return linear_paths(_train(spark, sf_dir), "listing_id", FEATURES, "price", "fold", (0.01, 1.0, 100.0, 1_000.0, 10_000.0))


@register("linear_learning_curve")
def q_linear_curve(spark, sf_dir):
    from valuator.operators.linear_path import linear_learning_curve
    return linear_learning_curve(_train(spark, sf_dir), "listing_id", FEATURES, "price", "fold")


_ONE_SQL = """
WITH l AS (SELECT ((listing_id % 2147483647 * 48271 + 42) % 2147483647) % 5 AS fold, dereg_value AS x, price AS y FROM listing),
g AS (SELECT fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy FROM l GROUP BY fold),
t AS (SELECT f.fold AS held, sum(g.n) AS n, sum(g.sx) AS sx, sum(g.sy) AS sy, sum(g.sxx) AS sxx, sum(g.sxy) AS sxy
      FROM g f JOIN g ON g.fold <> f.fold GROUP BY f.fold),
w AS (SELECT held, alpha, (sxy - sx * sy / n) / (sxx - sx * sx / n + alpha) AS w, sx / n AS mx, sy / n AS my
      FROM t CROSS JOIN (VALUES (1e-2), (1e12), (1e13)) a(alpha))
SELECT alpha::DOUBLE AS alpha, round(sqrt(avg((y - my - (x - mx) * w) * (y - my - (x - mx) * w))), 3) AS cv_rmse
FROM l JOIN w ON w.held = l.fold GROUP BY alpha
"""


@register("ridge_path_one_feature", _ONE_SQL, ("listing",))
def q_ridge_one(spark, sf_dir):
    """The ridge path of one feature, where SQL has the closed form."""
    from valuator.operators.linear_path import linear_paths
    out = linear_paths(_train(spark, sf_dir, nulls=False), "listing_id", ["dereg_value"], "price", "fold", (1e-2, 1e12, 1e13), ("ridge",))
    return out.select("alpha", rnd("cv_rmse", 3).alias("cv_rmse"))


# ------------------------------------------------------------------ M9–M18
@register("per_segment_models")
def q_per_segment(spark, sf_dir):
    pred, _scores, _importances = M.per_segment_models(
        _train(spark, sf_dir), "listing_id", "type_of_vehicle", "fold", FEATURES, "price", params_for=_SEGMENT_PARAMS)
    return pred


@register("bagged_seeds")
def q_bagged(spark, sf_dir):
    return M.bagged_seeds(_train(spark, sf_dir), "listing_id", FEATURES, "price", "fold", n_bags=3)


@register("weighted_training")
def q_weighted(spark, sf_dir):
    from valuator.operators.segment import segment_weights
    tr = segment_weights(_train(spark, sf_dir), "type_of_vehicle")
    run = M.oof_run(tr, "listing_id", FEATURES, "price", "fold", "gbt", weight="weight")
    return _oof_metrics(run)


@register("grid_search")
def q_grid(spark, sf_dir):
    return M.grid_search(_train(spark, sf_dir), FEATURES, "price", "fold", {"maxDepth": [3, 5], "maxIter": [5, 10]})


@register("random_search")
def q_random(spark, sf_dir):
    return M.random_search(_train(spark, sf_dir), FEATURES, "price", "fold",
                           {"maxDepth": [2, 3, 4, 5], "maxIter": [5, 10, 15], "stepSize": [0.05, 0.1, 0.2]}, n=4)


@register("guided_search")
def q_guided(spark, sf_dir):
    return M.guided_search(_train(spark, sf_dir), FEATURES, "price", "fold",
                           {"maxDepth": ("int", 2, 6), "maxIter": ("int", 5, 20), "stepSize": ("log", 0.03, 0.5)}, rounds=3, batch=3)


@register("feature_importance")
def q_importance(spark, sf_dir):
    """Three models' importances merged: boosting on squared and on absolute loss, and a forest."""
    tr = _train(spark, sf_dir)
    runs = {"gbt": M.oof_run(tr, "listing_id", FEATURES, "price", "fold", "gbt"),
            "gbt_absolute": M.oof_run(tr, "listing_id", FEATURES, "price", "fold", "gbt", params={"lossType": "absolute"}),
            "rf": M.oof_run(tr, "listing_id", FEATURES, "price", "fold", "rf", params={"numTrees": 100, "maxDepth": 10})}
    return M.feature_importance(runs, spark, top=10)


@register("error_class_model")
def q_error_class(spark, sf_dir):
    from valuator.operators.segment import error_band
    s = fx(spark, sf_dir).scored().withColumn("band", error_band(F.col("price") - F.col("pred_c"), gaps="closed"))
    _m, held_out, _table = M.error_class_model(s, "listing_id", FEATURES, "band", "forest")
    return ev.confusion_matrix(held_out, "band", "predicted_class", sorted({str(i) for i in range(10)}))


@register("learning_curve")
def q_learning_curve(spark, sf_dir):
    return M.learning_curve(_train(spark, sf_dir, nulls=False), "listing_id", FEATURES, "price", "fold",
                            kind="linear")


@register("retrain_on_segments")
def q_retrain(spark, sf_dir):
    f = fx(spark, sf_dir)
    return M.retrain_on_segments(f.listing_labelled(), f.listing_new(), "listing_id", "type_of_vehicle", FEATURES, "price",
                                 params_for=_SEGMENT_PARAMS)


@register("error_weighted_refit")
def q_error_refit(spark, sf_dir):
    from valuator.operators.segment import error_row_weights
    tr = _train(spark, sf_dir)
    a = M.oof_run(tr, "listing_id", FEATURES, "price", "fold", "gbt").oof
    b = M.oof_run(tr, "listing_id", FEATURES, "price", "fold", "linear", log_target=False).oof
    # read by the weights, the refit and every score: each would run the fold models again
    both = cut_lineage(a.select("listing_id", "actual", F.col("prediction").alias("p_gbt")).join(
        b.select("listing_id", F.col("prediction").alias("p_lin")), "listing_id"))
    g = W.gram(both, ["p_gbt", "p_lin"], "actual")
    w = W.l2_weights(g, 0.1)
    blend = both.withColumn("p_blend", W.apply_weights(["p_gbt", "p_lin"], w))
    weighted = error_row_weights(blend, F.col("actual") - F.col("p_blend"), "w_err")
    tr_w = cut_lineage(tr.join(weighted.select("listing_id", "w_err"), "listing_id"))
    c = M.oof_run(tr_w, "listing_id", FEATURES, "price", "fold", "gbt", weight="w_err").oof
    final = cut_lineage(blend.join(c.select("listing_id", F.col("prediction").alias("p_refit")), "listing_id"))
    final = final.withColumn("p_final", (F.col("p_blend") + F.col("p_refit")) / 2.0)
    out = None
    for col in ("p_gbt", "p_lin", "p_blend", "p_refit", "p_final"):
        r = ev.regression_metrics(final, [], "actual", col).withColumn("model", F.lit(col))
        out = r if out is None else out.unionByName(r)
    return out


@register("save_model_bundle")
def q_bundle(spark, sf_dir):
    from valuator.sources.io import scratch_path
    run = M.oof_run(_train(spark, sf_dir), "listing_id", FEATURES, "price", "fold", "gbt", categories=CATEGORIES)
    base = scratch_path(spark, "bundles")
    M.save_model_bundle(run.models, base, "gbt", "log1p(price)", spark)
    return M.verify_bundle(spark, base, "gbt", [0, 1, 2, 3, 4, 5])
