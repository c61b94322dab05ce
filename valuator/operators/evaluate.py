"""Evaluation and error analysis.

Everything is a grouped aggregate over the long scored table
``(model, key, price, prediction, ...)``: no per-model process, no collect of
rows. Correlations of many features with the error are generated as one
``corr`` aggregate per feature inside a single groupBy, and only the tiny
result is unpivoted and ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuator.operators.segment import error_band
from valuator.plans.strategy import attach_state, fit_quantiles, fit_row, group_quantiles, prefix_sums
from valuator.session import cut_lineage


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ long form
def to_long(df: DataFrame, key: str, price: str, preds: Sequence[str], model_col: str = "model",
            pred_col: str = "prediction", keep: Sequence[str] = ()) -> DataFrame:
    """Stack prediction columns into (model, key, price, prediction)."""
    return df.unpivot([key, price, *keep], list(preds), model_col, pred_col)


def add_mistakes(df: DataFrame, price: str = "price", pred: str = "prediction",
                 bands=None, gaps: str = "reference") -> DataFrame:
    m = F.col(price) - F.col(pred)
    out = df.withColumns({"mistake": m, "mistake_abs": F.abs(m)})
    kw = {} if bands is None else {"bands": bands}
    return out.withColumn("band", error_band("mistake", gaps=gaps, **kw))


# ------------------------------------------------------------------ V1, V2
def rmse(pred: DataFrame, truth: DataFrame, key: str, pred_col: str, truth_col: str) -> DataFrame:
    """V1: RMSE on key-matched rows with completeness counts.

    Returns one row (n_pred, n_truth, n_matched, rmse); a caller checks
    n_pred == n_truth == n_matched instead of trusting row positions.
    """
    p = pred.select(F.col(key).alias("_k"), F.col(pred_col).alias("_p"))
    t = truth.select(F.col(key).alias("_k"), F.col(truth_col).alias("_t"))
    j = p.join(t, "_k", "full_outer")
    return j.agg(
        F.count("_p").alias("n_pred"), F.count("_t").alias("n_truth"),
        F.count(F.when(F.col("_p").isNotNull() & F.col("_t").isNotNull(), 1)).alias("n_matched"),
        F.sqrt(F.avg(F.pow(F.col("_t") - F.col("_p"), 2))).alias("rmse"))


def regression_metrics(df: DataFrame, group: Sequence[str], y: str, p: str) -> DataFrame:
    """V2/V3/V4: RMSE and R² (1 − SSE/SST) per group; SST via stable var_pop."""
    e2 = F.pow(F.col(y) - F.col(p), 2)
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e2)).alias("rmse"),
        (F.lit(1.0) - F.sum(e2) / (F.var_pop(F.col(y)) * F.count(F.lit(1)))).alias("r2"))


def fold_scores(df: DataFrame, group: Sequence[str], fold: str, y: str, p: str) -> DataFrame:
    """V3: per (group, fold) RMSE/R², then mean and population std over folds."""
    per = regression_metrics(df, [*group, fold], y, p)
    return per.groupBy(*group).agg(
        F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("std_rmse"),
        F.avg("r2").alias("mean_r2"), F.stddev_pop("r2").alias("std_r2"),
        F.count(F.lit(1)).alias("n_folds"))


# ------------------------------------------------------------------ V5–V8
def band_report(scored: DataFrame, group: Sequence[str] = ("model",), band: str = "band",
                price: str = "price", pred: str = "prediction") -> DataFrame:
    """V5 (metrics part): per (group, band) RMSE, count, share, mean/max/min |mistake|."""
    err = F.col(price) - F.col(pred)
    agg = scored.groupBy(*group, band).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.count(F.lit(1)).alias("count"),
        F.avg(F.abs(err)).alias("mean_absolute_mistake"),
        F.max(F.abs(err)).alias("max_mistake"),
        F.min(F.abs(err)).alias("min_mistake"))
    # the aggregated table has (#groups × #bands) rows: a window over it is tiny
    w = Window.partitionBy(*group) if group else Window.partitionBy()
    return agg.withColumn("proportion", F.col("count") / F.sum("count").over(w))


def band_top_features(scored: DataFrame, features: Sequence[str], group: Sequence[str] = ("model",),
                      band: str = "band", target: str = "mistake", top: int = 5) -> DataFrame:
    """V5 (feature part): top-``top`` features by |corr(feature, mistake)| per band.

    One corr aggregate per feature in a single groupBy; constant features have
    null correlation and sort last; ties break on the feature name.
    """
    aggs = [F.corr(F.col(f).cast("double"), F.col(target)).alias(f) for f in features]
    wide = scored.groupBy(*group, band).agg(*aggs)
    long = wide.unpivot([*group, band], list(features), "feature", "corr")
    long = long.withColumn("corr", F.when(F.isnan("corr"), None).otherwise(F.col("corr")))
    long = long.withColumn("abs_corr", F.abs("corr"))
    # correlations equal to 9 decimals are ties (broken by name), so float noise cannot reorder them
    w = Window.partitionBy(*group, band).orderBy(F.round("abs_corr", 9).desc_nulls_last(), F.col("feature"))
    return long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def corr_with_error_top(scored: DataFrame, features: Sequence[str], target: str = "mistake",
                        top: int = 10) -> DataFrame:
    """V6: top features by |corr| with the error over all rows."""
    aggs = [F.corr(F.col(f).cast("double"), F.col(target)).alias(f) for f in features]
    wide = scored.agg(*aggs)
    long = wide.unpivot([], list(features), "feature", "corr")
    long = long.withColumn("corr", F.when(F.isnan("corr"), None).otherwise(F.col("corr")))
    w = Window.orderBy(F.round(F.abs("corr"), 9).desc_nulls_last(), F.col("feature"))
    # ``long`` has one row per feature: a global window over it is tiny
    return long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def model_band_pivot(report: DataFrame, models: Sequence[str], band: str = "band",
                     model: str = "model") -> DataFrame:
    """V7: band × model RMSE with the best (lowest RMSE) model per band, in one aggregate."""
    cells = [F.max(F.when(F.col(model) == m, F.col("rmse"))).alias(m) for m in models]
    return report.groupBy(band).agg(*cells, F.min_by(model, F.struct(F.col("rmse"), F.col(model))).alias("best_model"))


def band_cumulative(report: DataFrame, model: str = "model", band: str = "band") -> DataFrame:
    """V8: share per band and running share by model (report table is tiny)."""
    w = Window.partitionBy(model).orderBy(band).rowsBetween(Window.unboundedPreceding, 0)
    tot = Window.partitionBy(model)
    pct = F.col("count") * 100.0 / F.sum("count").over(tot)
    return (report.withColumn("pct", pct)
            .withColumn("cumulative_pct", F.sum(F.col("count")).over(w) * 100.0 / F.sum("count").over(tot)))


# ------------------------------------------------------------------ V9–V13
def confusion_matrix(df: DataFrame, y: str, p: str, classes: Sequence) -> DataFrame:
    """V9: true × predicted counts, zero filled."""
    return (df.groupBy(F.col(y).alias("true_class")).pivot(p, list(classes))
            .agg(F.count(F.lit(1))).fillna(0))


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Precision / recall / F1 / support per class + accuracy, macro and weighted avg.

    Classes are those present in y or p. Division by zero gives 0.
    """
    classes = df.select(F.col(y).alias("c")).union(df.select(F.col(p).alias("c"))).distinct()
    counts = df.groupBy(F.col(y).alias("yt"), F.col(p).alias("yp")).agg(F.count(F.lit(1)).alias("n"))
    tp = counts.filter("yt = yp").select(F.col("yt").alias("c"), F.col("n").alias("tp"))
    sup = counts.groupBy(F.col("yt").alias("c")).agg(F.sum("n").alias("support"))
    pred_n = counts.groupBy(F.col("yp").alias("c")).agg(F.sum("n").alias("pred_n"))
    per = (classes.join(tp, "c", "left").join(sup, "c", "left").join(pred_n, "c", "left")
           .fillna(0, ["tp", "support", "pred_n"]))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred_n")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    per = per.withColumns({"precision": prec, "recall": rec})
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                        F.col("precision") + F.col("recall")), F.lit(0.0)))
    per = per.select(F.col("c").cast("string").alias("class"), "precision", "recall", "f1",
                     F.col("support").cast("long").alias("support"), F.col("tp"))
    tot = per.agg(F.sum("support").alias("s"), F.sum("tp").alias("tp"), F.count(F.lit(1)).alias("k"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("class"), (F.col("tp") / F.col("s")).alias("precision"),
                     (F.col("tp") / F.col("s")).alias("recall"), (F.col("tp") / F.col("s")).alias("f1"),
                     F.col("s").cast("long").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("s").cast("long").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("class"), (F.col("wp") / F.col("s")).alias("precision"),
                          (F.col("wr") / F.col("s")).alias("recall"), (F.col("wf") / F.col("s")).alias("f1"),
                          F.col("s").cast("long").alias("support"))
    return per.drop("tp").unionByName(acc).unionByName(macro).unionByName(weighted)


def roc_points(df: DataFrame, y: str, score: str) -> DataFrame:
    """ROC points (fpr, tpr) per distinct score threshold, descending.

    Ties are grouped into one threshold first; running sums over the
    distinct thresholds use ``prefix_sums`` (ranges + offsets), so
    no global window gathers the table into one task.
    """
    g = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(y).cast("long")).alias("tp_n"),
        F.sum((F.lit(1) - F.col(y)).cast("long")).alias("fp_n"))
    g = cut_lineage(g)
    tot = fit_row(g, F.sum("tp_n").alias("P"), F.sum("fp_n").alias("N"))
    cum = prefix_sums(g, "threshold", ["tp_n", "fp_n"], descending=True)
    cum = cum.withColumnsRenamed({"tp_n_cum": "tps", "fp_n_cum": "fps"})
    cum = cum.withColumns({"P": F.lit(tot["P"]), "N": F.lit(tot["N"])})  # totals as literals
    return cum.select(
        "threshold", "tp_n", "fp_n", "tps", "fps",
        (F.col("fps") / F.col("N")).alias("fpr"), (F.col("tps") / F.col("P")).alias("tpr"),
        ((F.col("fps") - F.col("fp_n")) / F.col("N")).alias("prev_fpr"),
        ((F.col("tps") - F.col("tp_n")) / F.col("P")).alias("prev_tpr"))


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Trapezoid area under the ROC curve (from (0,0)); previous point
    from the running sums, so it is one aggregate."""
    pts = roc_points(df, y, score)
    return pts.agg(F.sum((F.col("fpr") - F.col("prev_fpr")) * (F.col("tpr") + F.col("prev_tpr")) / 2.0).alias("auc"))


def average_precision(df: DataFrame, y: str, score: str) -> DataFrame:
    """AP = Σ (R_n − R_{n−1}) · P_n over distinct thresholds."""
    pts = roc_points(df, y, score)
    prec = F.col("tps") / (F.col("tps") + F.col("fps"))
    return pts.agg(F.sum((F.col("tpr") - F.col("prev_tpr")) * prec).alias("average_precision"))


def cv_accuracy(df: DataFrame, fold: str, y: str, p: str) -> DataFrame:
    """Accuracy per fold, mean, population std and mean ± 2·std."""
    per = df.groupBy(fold).agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))
    return per.agg(F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("std_accuracy"),
                   F.count(F.lit(1)).alias("n_folds")).withColumns({
        "low": F.col("mean_accuracy") - 2 * F.col("std_accuracy"),
        "high": F.col("mean_accuracy") + 2 * F.col("std_accuracy")})


# ------------------------------------------------------------------ V14, V15, V17
def prediction_sanity(pred: DataFrame, p: str, segment: str | None = None,
                      seg_stats: DataFrame | None = None) -> DataFrame:
    """One-row flag table: negatives (fail), share outside Q1/Q3 ± 3·IQR
    above 1 % (warn), and (optional) share outside [0.5·min, 1.5·max] of the
    row's segment (warn)."""
    q1, q3 = fit_quantiles(pred, [p], [0.25, 0.75])[p]
    j = pred.withColumns({"q1": F.lit(q1), "q3": F.lit(q3)})
    iqr = F.col("q3") - F.col("q1")
    outlier = (F.col(p) < F.col("q1") - 3 * iqr) | (F.col(p) > F.col("q3") + 3 * iqr)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum((F.col(p) < 0).cast("int")).alias("n_negative"),
            F.avg(outlier.cast("double")).alias("outlier_share")]
    if segment is not None and seg_stats is not None:
        j = attach_state(j, seg_stats.select(segment, "min_price", "max_price"), segment, "left")
        out_seg = (F.col(p) < 0.5 * F.col("min_price")) | (F.col(p) > 1.5 * F.col("max_price"))
        aggs.append(F.avg(F.coalesce(out_seg, F.lit(False)).cast("double")).alias("segment_out_share"))
    res = j.agg(*aggs)
    res = res.withColumns({"fail_negative": F.col("n_negative") > 0,
                           "warn_outliers": F.col("outlier_share") > 0.01})
    if "segment_out_share" in res.columns:
        res = res.withColumn("warn_segment", F.col("segment_out_share") > 0)
    return res


def prediction_stats(pred: DataFrame, p: str, group: Sequence[str] = ()) -> DataFrame:
    """Min, max, mean, median overall or per group."""
    aggs = [F.min(p).alias("min_pred"), F.max(p).alias("max_pred"), F.avg(p).alias("mean_pred"),
            F.count(F.lit(1)).alias("n")]
    if not group:
        med = fit_quantiles(pred, [p], [0.5])[p]
        return pred.agg(*aggs).withColumn("median_pred", F.lit(med[0] if med else None).cast("double"))
    med = group_quantiles(pred, list(group), p, [0.5]).select(*group, F.col("_q")[0].alias("median_pred"))
    return pred.groupBy(*group).agg(*aggs).join(med, list(group), "left")


def residual_pairs(df: DataFrame, key: str, y: str, p: str) -> DataFrame:
    """True vs predicted and residual per row."""
    return df.select(key, F.col(y).alias("actual"), F.col(p).alias("predicted"),
                     (F.col(y) - F.col(p)).alias("residual"))
