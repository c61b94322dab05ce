"""Registered evaluation / error-analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuator.operators import evaluate as ev
from valuator.operators.segment import ERROR_BANDS
from valuator.plans.common import NUMERIC_FEATURES, PRED_COLS, fx, rnd, round_all
from valuator.plans.registry import register
from valuator.plans.sqlgen import band_case

_LONG = """
long AS (
  SELECT 'pred_a' AS model, listing_id, price, pred_a AS prediction, {f} FROM scored
  UNION ALL SELECT 'pred_b' AS model, listing_id, price, pred_b AS prediction, {f} FROM scored
  UNION ALL SELECT 'pred_c' AS model, listing_id, price, pred_c AS prediction, {f} FROM scored
), banded AS (
  SELECT *, price - prediction AS mistake, abs(price - prediction) AS mistake_abs,
         {band} AS band
  FROM long
)""".format(f=", ".join(NUMERIC_FEATURES), band=band_case("price - prediction", ERROR_BANDS))


def scored_long(spark, sf_dir):
    s = fx(spark, sf_dir).scored()
    long = ev.to_long(s, "listing_id", "price", PRED_COLS, keep=NUMERIC_FEATURES)
    return ev.add_mistakes(long)


# ------------------------------------------------------------------ flagship: V5 metrics
_BAND_REPORT_SQL = "WITH " + _LONG.strip() + """
SELECT model, band,
       round(sqrt(avg(mistake * mistake)), 4) AS rmse,
       count(*) AS count,
       round(avg(mistake_abs), 4) AS mean_absolute_mistake,
       round(max(mistake_abs), 4) AS max_mistake,
       round(min(mistake_abs), 4) AS min_mistake,
       round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY model), 6) AS proportion
FROM banded GROUP BY model, band
"""


@register("band_report", _BAND_REPORT_SQL, ("scored",))
def q_band_report(spark, sf_dir):
    rep = ev.band_report(scored_long(spark, sf_dir))
    return rep.select("model", "band", rnd("rmse", 4).alias("rmse"), "count",
                      rnd("mean_absolute_mistake", 4).alias("mean_absolute_mistake"),
                      rnd("max_mistake", 4).alias("max_mistake"), rnd("min_mistake", 4).alias("min_mistake"),
                      rnd("proportion", 6).alias("proportion"))


# ------------------------------------------------------------------ P27 (error columns)
_PRED_ERR_SQL = """
SELECT listing_id, price - pred_a AS mistake, abs(price - pred_a) AS mistake_abs
FROM scored
"""


@register("prediction_error", _PRED_ERR_SQL, ("scored",))
def q_prediction_error(spark, sf_dir):
    from valuator.functions.columns import prediction_error
    s = fx(spark, sf_dir).scored()
    e = prediction_error("price", "pred_a")
    return s.select("listing_id", e["mistake"].alias("mistake"), e["mistake_abs"].alias("mistake_abs"))


# ------------------------------------------------------------------ V5 features
_TOP_FEAT_SQL = "WITH " + _LONG.strip() + """,
wide AS (
  SELECT model, band, {corrs} FROM banded GROUP BY model, band
), lng AS (
  UNPIVOT wide ON {feats} INTO NAME feature VALUE corr
), ranked AS (
  SELECT model, band, feature, CASE WHEN isnan(corr) THEN NULL ELSE corr END AS corr FROM lng
), full_list AS (
  SELECT w.model, w.band, f.feature, r.corr
  FROM (SELECT DISTINCT model, band FROM banded) w
  CROSS JOIN (SELECT unnest([{names}]) AS feature) f
  LEFT JOIN ranked r ON r.model = w.model AND r.band = w.band AND r.feature = f.feature
)
SELECT model, band, feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY model, band ORDER BY round(abs(corr), 9) DESC NULLS LAST, feature) AS INTEGER) AS rank
  FROM full_list) WHERE rank <= 5
""".format(corrs=", ".join(f"corr(CAST({f} AS DOUBLE), mistake) AS {f}" for f in NUMERIC_FEATURES),
           feats=", ".join(NUMERIC_FEATURES), names=", ".join(f"'{f}'" for f in NUMERIC_FEATURES))


@register("band_top_features", _TOP_FEAT_SQL, ("scored",))
def q_band_top_features(spark, sf_dir):
    t = ev.band_top_features(scored_long(spark, sf_dir), NUMERIC_FEATURES)
    return t.select("model", "band", "feature", rnd("corr").alias("corr"), rnd("abs_corr").alias("abs_corr"),
                    "rank")


# ------------------------------------------------------------------ V1
_RMSE_SQL = """
SELECT count(p.pred_a) AS n_pred, count(t.price) AS n_truth,
       count(CASE WHEN p.pred_a IS NOT NULL AND t.price IS NOT NULL THEN 1 END) AS n_matched,
       round(sqrt(avg((t.price - p.pred_a) * (t.price - p.pred_a))), 4) AS rmse
FROM (SELECT listing_id, pred_a FROM scored) p
FULL OUTER JOIN (SELECT listing_id, price FROM listing) t ON p.listing_id = t.listing_id
"""


@register("rmse", _RMSE_SQL, ("scored",))
def q_rmse(spark, sf_dir):
    f = fx(spark, sf_dir)
    r = ev.rmse(f.scored(), f.listing(), "listing_id", "pred_a", "price")
    return r.select("n_pred", "n_truth", "n_matched", rnd("rmse", 4).alias("rmse"))


# ------------------------------------------------------------------ V2 / V4
_R2_SQL = "WITH " + _LONG.strip() + """
SELECT model, count(*) AS n, round(sqrt(avg(mistake * mistake)), 4) AS rmse,
       round(1 - sum(mistake * mistake) / (var_pop(price) * count(*)), 6) AS r2
FROM banded GROUP BY model
"""


@register("r2_score", _R2_SQL, ("scored",))
def q_r2(spark, sf_dir):
    m = ev.regression_metrics(scored_long(spark, sf_dir), ["model"], "price", "prediction")
    return m.select("model", "n", rnd("rmse", 4).alias("rmse"), rnd("r2", 6).alias("r2"))


_SEG_RMSE_SQL = "WITH " + _LONG.strip() + """
SELECT model, seg, count(*) AS n, round(sqrt(avg(mistake * mistake)), 4) AS rmse
FROM (SELECT *, CASE WHEN price < 100000 THEN 'low' WHEN price < 250000 THEN 'mid' ELSE 'high' END AS seg FROM banded)
GROUP BY model, seg
"""


@register("segment_rmse", _SEG_RMSE_SQL, ("scored",))
def q_segment_rmse(spark, sf_dir):
    s = scored_long(spark, sf_dir).withColumn(
        "seg", F.when(F.col("price") < 100000, "low").when(F.col("price") < 250000, "mid").otherwise("high"))
    m = ev.regression_metrics(s, ["model", "seg"], "price", "prediction")
    return m.select("model", "seg", "n", rnd("rmse", 4).alias("rmse"))


# ------------------------------------------------------------------ V3
_FOLD_SQL = "WITH " + _LONG.strip() + """,
per AS (
  SELECT model, ((listing_id % 2147483647 * 48271 + 42) % 2147483647) % 5 AS fold,
         sqrt(avg(mistake * mistake)) AS rmse,
         1 - sum(mistake * mistake) / (var_pop(price) * count(*)) AS r2
  FROM banded GROUP BY model, fold
)
SELECT model, round(avg(rmse), 4) AS mean_rmse, round(stddev_pop(rmse), 4) AS std_rmse,
       round(avg(r2), 6) AS mean_r2, round(stddev_pop(r2), 6) AS std_r2, count(*) AS n_folds
FROM per GROUP BY model
"""


@register("fold_scores", _FOLD_SQL, ("scored",))
def q_fold_scores(spark, sf_dir):
    from valuator.operators.train import kfold_assign
    s = scored_long(spark, sf_dir).withColumn("fold", kfold_assign("listing_id", 5))
    r = ev.fold_scores(s, ["model"], "fold", "price", "prediction")
    return r.select("model", rnd("mean_rmse", 4).alias("mean_rmse"), rnd("std_rmse", 4).alias("std_rmse"),
                    rnd("mean_r2").alias("mean_r2"), rnd("std_r2").alias("std_r2"), "n_folds")


# ------------------------------------------------------------------ V6
_CORR_TOP_SQL = """
WITH wide AS (SELECT {corrs} FROM scored),
lng AS (UNPIVOT wide ON {feats} INTO NAME feature VALUE corr)
SELECT feature, round(corr, 6) AS corr, rank FROM (
  SELECT feature, CASE WHEN isnan(corr) THEN NULL ELSE corr END AS corr,
         CAST(row_number() OVER (ORDER BY round(abs(CASE WHEN isnan(corr) THEN NULL ELSE corr END), 9) DESC NULLS LAST, feature) AS INTEGER) AS rank
  FROM lng) WHERE rank <= 10
""".format(corrs=", ".join(f"corr(CAST({f} AS DOUBLE), price - pred_c) AS {f}" for f in NUMERIC_FEATURES),
           feats=", ".join(NUMERIC_FEATURES))


@register("corr_with_error_top", _CORR_TOP_SQL, ("scored",))
def q_corr_top(spark, sf_dir):
    s = fx(spark, sf_dir).scored().withColumn("mistake", F.col("price") - F.col("pred_c"))
    t = ev.corr_with_error_top(s, NUMERIC_FEATURES, "mistake", 10)
    return t.select("feature", rnd("corr").alias("corr"), "rank")


# ------------------------------------------------------------------ V7 / V8
_PIVOT_SQL = "WITH " + _LONG.strip() + """,
rep AS (SELECT model, band, sqrt(avg(mistake * mistake)) AS rmse FROM banded GROUP BY model, band)
SELECT band,
  round(max(CASE WHEN model = 'pred_a' THEN rmse END), 4) AS pred_a,
  round(max(CASE WHEN model = 'pred_b' THEN rmse END), 4) AS pred_b,
  round(max(CASE WHEN model = 'pred_c' THEN rmse END), 4) AS pred_c,
  arg_min(model, (rmse, model)) AS best_model
FROM rep GROUP BY band
"""


@register("model_band_pivot", _PIVOT_SQL, ("scored",))
def q_model_band_pivot(spark, sf_dir):
    rep = ev.band_report(scored_long(spark, sf_dir))
    p = ev.model_band_pivot(rep, PRED_COLS)
    return p.select("band", *[rnd(c, 4).alias(c) for c in PRED_COLS], "best_model")


_CUM_SQL = "WITH " + _LONG.strip() + """,
rep AS (SELECT model, band, count(*) AS count FROM banded GROUP BY model, band)
SELECT model, band, count,
  round(count * 100.0 / sum(count) OVER (PARTITION BY model), 6) AS pct,
  round(sum(count) OVER (PARTITION BY model ORDER BY band ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0
        / sum(count) OVER (PARTITION BY model), 6) AS cumulative_pct
FROM rep
"""


@register("band_cumulative", _CUM_SQL, ("scored",))
def q_band_cumulative(spark, sf_dir):
    rep = ev.band_report(scored_long(spark, sf_dir)).select("model", "band", "count")
    c = ev.band_cumulative(rep)
    return c.select("model", "band", "count", rnd("pct").alias("pct"), rnd("cumulative_pct").alias("cumulative_pct"))


# ------------------------------------------------------------------ V9–V13 (class scores)
_CM_SQL = """
SELECT CAST(label AS INTEGER) AS true_class,
       count(CASE WHEN pred = 0 THEN 1 END) AS "0",
       count(CASE WHEN pred = 1 THEN 1 END) AS "1"
FROM (SELECT label, CAST(score > 0.5 AS INTEGER) AS pred FROM class_scores) GROUP BY label
"""


@register("confusion_matrix", _CM_SQL, ("class_scores",))
def q_confusion(spark, sf_dir):
    c = fx(spark, sf_dir).class_scores().withColumn("pred", (F.col("score") > 0.5).cast("int"))
    m = ev.confusion_matrix(c, "label", "pred", [0, 1])
    return m.select(F.col("true_class").cast("int").alias("true_class"), F.col("0").cast("long").alias("0"),
                    F.col("1").cast("long").alias("1"))


_CR_SQL = """
WITH c AS (SELECT label AS yt, CAST(score > 0.5 AS INTEGER) AS yp FROM class_scores),
classes AS (SELECT yt AS c FROM c UNION SELECT yp FROM c),
per AS (
  SELECT cl.c,
    (SELECT count(*) FROM c WHERE yt = cl.c AND yp = cl.c) AS tp,
    (SELECT count(*) FROM c WHERE yt = cl.c) AS support,
    (SELECT count(*) FROM c WHERE yp = cl.c) AS pred_n
  FROM classes cl
), m AS (
  SELECT c, tp, support,
    CASE WHEN pred_n = 0 THEN 0.0 ELSE tp / pred_n END AS precision,
    CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall
  FROM per
), f AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM m
), tot AS (
  SELECT sum(support) AS s, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
         sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM f
)
SELECT CAST(c AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', round(tp / s, 6), round(tp / s, 6), round(tp / s, 6), CAST(s AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(s AS BIGINT) FROM tot
UNION ALL SELECT 'weighted avg', round(wp / s, 6), round(wr / s, 6), round(wf / s, 6), CAST(s AS BIGINT) FROM tot
"""


@register("classification_report", _CR_SQL, ("class_scores",))
def q_classification_report(spark, sf_dir):
    c = fx(spark, sf_dir).class_scores().withColumn("pred", (F.col("score") > 0.5).cast("int"))
    return round_all(ev.classification_report(c, "label", "pred"))


_ROC_SQL = """
WITH g AS (
  SELECT score AS threshold, sum(CAST(label AS BIGINT)) AS tp_n, sum(CAST(1 - label AS BIGINT)) AS fp_n
  FROM class_scores GROUP BY score
), tot AS (SELECT sum(CAST(label AS BIGINT)) AS P, sum(CAST(1 - label AS BIGINT)) AS N FROM class_scores),
cum AS (
  SELECT threshold,
    CAST(sum(tp_n) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tps,
    CAST(sum(fp_n) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fps
  FROM g
)
SELECT round(threshold, 6) AS threshold, tps, fps, round(fps / N, 6) AS fpr, round(tps / P, 6) AS tpr
FROM cum, tot
"""


@register("roc_curve", _ROC_SQL, ("class_scores",))
def q_roc_curve(spark, sf_dir):
    r = ev.roc_points(fx(spark, sf_dir).class_scores(), "label", "score")
    return round_all(r.select("threshold", F.col("tps").cast("long").alias("tps"),
                              F.col("fps").cast("long").alias("fps"), "fpr", "tpr"))


_AUC_SQL = _ROC_SQL.replace(
    "SELECT round(threshold, 6) AS threshold, tps, fps, round(fps / N, 6) AS fpr, round(tps / P, 6) AS tpr\nFROM cum, tot",
    """, pts AS (SELECT threshold, tps, fps, fps / N AS fpr, tps / P AS tpr FROM cum, tot),
seg AS (SELECT *, coalesce(lag(fpr) OVER (ORDER BY threshold DESC), 0.0) AS pf,
               coalesce(lag(tpr) OVER (ORDER BY threshold DESC), 0.0) AS pt,
               tps / (tps + fps) AS prec FROM pts)
SELECT round(sum((fpr - pf) * (tpr + pt) / 2.0), 6) AS auc FROM seg""")
_AP_SQL = _AUC_SQL.replace("SELECT round(sum((fpr - pf) * (tpr + pt) / 2.0), 6) AS auc FROM seg",
                           "SELECT round(sum((tpr - pt) * prec), 6) AS average_precision FROM seg")


@register("roc_auc", _AUC_SQL, ("class_scores",))
def q_roc_auc(spark, sf_dir):
    return ev.roc_auc(fx(spark, sf_dir).class_scores(), "label", "score").select(rnd("auc").alias("auc"))


@register("average_precision", _AP_SQL, ("class_scores",))
def q_average_precision(spark, sf_dir):
    ap = ev.average_precision(fx(spark, sf_dir).class_scores(), "label", "score")
    return ap.select(rnd("average_precision").alias("average_precision"))


_CVACC_SQL = """
WITH per AS (
  SELECT ((doc_id % 2147483647 * 48271 + 42) % 2147483647) % 5 AS fold,
         avg(CASE WHEN label = CAST(score > 0.5 AS INTEGER) THEN 1.0 ELSE 0.0 END) AS accuracy
  FROM class_scores GROUP BY fold
)
SELECT round(avg(accuracy), 6) AS mean_accuracy, round(stddev_pop(accuracy), 6) AS std_accuracy,
       count(*) AS n_folds, round(avg(accuracy) - 2 * stddev_pop(accuracy), 6) AS low,
       round(avg(accuracy) + 2 * stddev_pop(accuracy), 6) AS high
FROM per
"""


@register("cv_accuracy", _CVACC_SQL, ("class_scores",))
def q_cv_accuracy(spark, sf_dir):
    from valuator.operators.train import kfold_assign
    c = (fx(spark, sf_dir).class_scores().withColumn("pred", (F.col("score") > 0.5).cast("int"))
         .withColumn("fold", kfold_assign("doc_id", 5)))
    return round_all(ev.cv_accuracy(c, "fold", "label", "pred"))


# ------------------------------------------------------------------ V14 / V15 / V17
_SANITY_SQL = """
WITH q AS (SELECT quantile_cont(pred_c, 0.25) AS q1, quantile_cont(pred_c, 0.75) AS q3 FROM scored),
seg AS (SELECT type_of_vehicle, min(price) AS min_price, max(price) AS max_price FROM scored GROUP BY type_of_vehicle),
j AS (SELECT s.pred_c AS p, q.q1, q.q3, seg.min_price, seg.max_price
      FROM scored s CROSS JOIN q LEFT JOIN seg ON s.type_of_vehicle = seg.type_of_vehicle)
SELECT count(*) AS n, CAST(sum(CAST(p < 0 AS INTEGER)) AS BIGINT) AS n_negative,
  round(avg(CASE WHEN p < q1 - 3 * (q3 - q1) OR p > q3 + 3 * (q3 - q1) THEN 1.0 ELSE 0.0 END), 6) AS outlier_share,
  round(avg(CASE WHEN p < 0.5 * min_price OR p > 1.5 * max_price THEN 1.0 ELSE 0.0 END), 6) AS segment_out_share,
  sum(CAST(p < 0 AS INTEGER)) > 0 AS fail_negative,
  avg(CASE WHEN p < q1 - 3 * (q3 - q1) OR p > q3 + 3 * (q3 - q1) THEN 1.0 ELSE 0.0 END) > 0.01 AS warn_outliers,
  avg(CASE WHEN p < 0.5 * min_price OR p > 1.5 * max_price THEN 1.0 ELSE 0.0 END) > 0 AS warn_segment
FROM j
"""


@register("prediction_sanity", _SANITY_SQL, ("scored",))
def q_prediction_sanity(spark, sf_dir):
    from valuator.operators.cluster import segment_stats
    s = fx(spark, sf_dir).scored()
    stats = segment_stats(s, "type_of_vehicle", "price")
    r = ev.prediction_sanity(s, "pred_c", "type_of_vehicle", stats)
    return round_all(r.withColumn("n_negative", F.col("n_negative").cast("long")))


_PSTATS_SQL = """
SELECT type_of_vehicle, round(min(pred_b), 4) AS min_pred, round(max(pred_b), 4) AS max_pred,
       round(avg(pred_b), 4) AS mean_pred, round(quantile_cont(pred_b, 0.5), 4) AS median_pred, count(*) AS n
FROM scored GROUP BY type_of_vehicle
"""


@register("prediction_stats", _PSTATS_SQL, ("scored",))
def q_prediction_stats(spark, sf_dir):
    r = ev.prediction_stats(fx(spark, sf_dir).scored(), "pred_b", ["type_of_vehicle"])
    return round_all(r, 4)


_RESID_SQL = """
SELECT listing_id, price AS actual, pred_b AS predicted, price - pred_b AS residual FROM scored
"""


@register("residual_pairs", _RESID_SQL, ("scored",))
def q_residual_pairs(spark, sf_dir):
    r = ev.residual_pairs(fx(spark, sf_dir).scored(), "listing_id", "price", "pred_b")
    return r
