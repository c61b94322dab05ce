"""Fold assignment, splits and Spark ML training jobs.

Folds and splits are pure functions of the key (integer LCG), so they are
stable under any repartitioning and identical in the SQL oracle. Training
uses ``pyspark.ml`` estimators; each fold fit is a distributed job.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuator.plans.strategy import attach_groups, fit_row, ranked, spread
from valuator.session import cut_lineage

LCG_MULT = 48271
LCG_MOD = 2147483647


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lcg_hash(key: str | Column, seed: int = 42) -> Column:
    """(key·48271 + seed) mod (2³¹−1): deterministic per key, same in SQL. The key
    is reduced first, so that no key overflows."""
    low = F.pmod(_col(key).cast("long"), F.lit(LCG_MOD))
    return F.pmod(low * F.lit(LCG_MULT) + F.lit(seed), F.lit(LCG_MOD))


def mix_hash(key: str | Column, seed: int = 42) -> Column:
    """Two rounds of the multiplicative generator: consecutive keys land far
    apart, so thresholds and orderings on it behave like a random draw
    (one round is monotone in the key for small keys)."""
    return F.pmod(lcg_hash(key, seed) * F.lit(LCG_MULT), F.lit(LCG_MOD))


def kfold_assign(key: str | Column, k: int, seed: int = 42) -> Column:
    """M1: fold id in [0, k) from the key (k = 2 when the caller has < 5 rows)."""
    return (lcg_hash(key, seed) % F.lit(k)).cast("int")


def stratified_kfold_assign(df: DataFrame, key: str, strata: str, k: int, seed: int = 42,
                            out: str = "fold") -> DataFrame:
    """M2: (row_number within stratum ordered by hash(key)) − 1 mod k.

    The row number is computed by range partitioning (``ranked``), so a
    stratum with a third of all rows is still spread over many tasks.
    """
    h = mix_hash(key, seed).alias("_h")
    r = ranked(df.withColumn("_h", h), [strata], ["_h", key], out="_rn")
    return r.withColumn(out, ((F.col("_rn") - 1) % k).cast("int")).drop("_h", "_rn")


def train_test_split(key: str | Column, test_fraction: float = 0.2, seed: int = 42) -> Column:
    """M3: 'test' when hash(key) falls below the fraction of the hash range."""
    cut = int(LCG_MOD * test_fraction)
    return F.when(mix_hash(key, seed) < F.lit(cut), F.lit("test")).otherwise(F.lit("train"))


def three_way_split(key: str | Column, fractions: Sequence[float] = (0.72, 0.08, 0.20), seed: int = 42) -> Column:
    """M3 variant: train / val / test by cumulative hash thresholds."""
    h = mix_hash(key, seed)
    a = int(LCG_MOD * fractions[0])
    b = int(LCG_MOD * (fractions[0] + fractions[1]))
    return F.when(h < a, "train").when(h < b, "val").otherwise("test")


def stratified_split(df: DataFrame, key: str, strata: str, test_fraction: float = 0.2, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """M3 stratified: per stratum the first round(share·n) rows by hash are test."""
    from valuator.sources.holdout import stratified_rank
    r, counts = stratified_rank(df, key, strata, seed)
    cut = F.expr(f"bround(_cls_n * {float(test_fraction)}, 0)")
    return (attach_groups(r, counts, [strata], "inner")
            .withColumn(out, F.when(F.col("_rn") <= cut, "test").otherwise("train"))
            .drop("_rn", "_cls_n"))


# ====================================================================== Spark ML jobs
#: Folds, and segments with a model of their own: one fit each, so their number is bounded.
MAX_FOLDS, MAX_SEGMENTS = 100, 1_000
#: Fits that are submitted at a time, and rows that they hold in memory together.
PARALLEL_FITS, FIT_ROWS = 5, 30_000_000


def fold_ids(df: DataFrame, fold: str) -> list:
    """The fold ids; an error beyond MAX_FOLDS."""
    got = [r[0] for r in df.select(fold).distinct().limit(MAX_FOLDS + 1).collect()]
    if len(got) > MAX_FOLDS or None in got:
        raise ValueError(f"{fold} must have at most {MAX_FOLDS} values and no null")
    return sorted(got)


def in_parallel(fn: Callable, items: Sequence, parallelism: int = PARALLEL_FITS) -> list:
    """Results in order; fits are Spark jobs of their own, so a few run side by side."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(fn, items))


def fits_at_a_time(rows: int, parallelism: int = PARALLEL_FITS) -> int:
    """Fits side by side: a fit keeps its rows in memory for all its passes, and rows that do not fit are read from disk at each."""
    return max(1, min(parallelism, FIT_ROWS // max(rows, 1)))


def training_rows(prepared: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, int]:
    """The columns that fits read, spread over the cores and kept (the caller lets go of them), and their rows."""
    cols = list(dict.fromkeys(cols))
    rows = prepared.count()
    return spread(prepared.select(*cols), rows, cols).persist(), rows


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@dataclass
class FoldRun:
    """Result of an out-of-fold run: OOF predictions keyed by id, the fitted
    fold models, and per-fold feature importances (when the learner has them)."""
    oof: DataFrame
    models: dict = field(default_factory=dict)
    importances: list = field(default_factory=list)
    #: per fold the held-out score of every prefix of the trees (with ``patience``)
    rounds: dict = field(default_factory=dict)


def _learner(kind: str, label: str, seed: int, params: dict | None = None, weight: str | None = None):
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
    p = dict(params or {})
    common = {"featuresCol": "_fv", "labelCol": label, "predictionCol": "_pred"}
    if weight:
        common["weightCol"] = weight
    if kind == "gbt":
        return GBTRegressor(seed=seed, **{"maxIter": 20, "maxDepth": 5, **p}, **common)
    if kind == "rf":
        return RandomForestRegressor(seed=seed, **{"numTrees": 200, "maxDepth": 30, **p}, **common)
    if kind == "linear":
        return LinearRegression(**{"regParam": 0.0, "elasticNetParam": 0.0, **p}, **common)
    if kind == "huber":
        from valuator.operators.huber import HuberBoostedTrees
        if weight:
            raise ValueError("Huber boosting takes no weights")
        return HuberBoostedTrees(seed=seed, **{"maxIter": 20, "maxDepth": 5, **p}, **common)
    raise ValueError(f"unknown learner {kind}")


@dataclass(frozen=True)
class Categories:
    """Categorical columns of a model: ``coded`` by the mean of the label (E9), ``flagged`` by value (E4-E7) and ``listed``, comma lists
    flagged by token (E5). With ``fold`` a row's own fold is left out of its mean codes."""
    coded: tuple[str, ...] = ()
    flagged: tuple[str, ...] = ()
    listed: tuple[str, ...] = ()
    fold: str = ""
    smoothing: float = 1.0

    def stages(self, label: str) -> tuple[list, list[str]]:
        """Encoder stages, and the columns that they give."""
        from valuator.operators.stages import FlagEncoder, MeanEncoder
        out, cols = [], [f"_te_{c}" for c in self.coded]
        if self.coded:
            out.append(MeanEncoder(inputCols=list(self.coded), outputCols=cols[:], labelCol=label, foldCol=self.fold, smoothing=self.smoothing))
        if self.flagged or self.listed:
            out.append(FlagEncoder(inputCols=[*self.flagged, *self.listed], listCols=list(self.listed), outputCol="_flags"))
            cols.append("_flags")
        return out, cols


def regression_pipeline(features: Sequence[str], label: str, kind: str = "gbt", seed: int = 42,
                        params: dict | None = None, weight: str | None = None, categories: Categories | None = None):
    """Median imputer and encoders (fitted inside each fit, i.e. per fold) + assembler + learner."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, VectorAssembler
    imp = [f"_imp_{f}" for f in features]
    encoders, coded = (categories or Categories()).stages(label)
    return Pipeline(stages=[
        Imputer(inputCols=list(features), outputCols=imp, strategy="median"), *encoders,
        VectorAssembler(inputCols=[*imp, *coded], outputCol="_fv", handleInvalid="keep"),
        _learner(kind, label, seed, params, weight)])


def feature_names(model, features: Sequence[str]) -> list[str]:
    """Names of the entries of a fitted pipeline's feature vector."""
    return [*features, *[n for stage in model.stages if hasattr(stage, "names") for n in stage.names()]]


def _prepare(df: DataFrame, features: Sequence[str], target: str, log_target: bool) -> DataFrame:
    out = df.withColumns({f: F.col(f).cast("double") for f in features})
    y = F.log1p(F.col(target)) if log_target else F.col(target).cast("double")
    return out.withColumn("_y", y)


def oof_run(df: DataFrame, key: str, features: Sequence[str], target: str, fold: str, kind: str = "gbt",
            log_target: bool = True, seed: int = 42, params: dict | None = None, weight: str | None = None,
            early_stop_tol: float | None = None, parallelism: int = PARALLEL_FITS, categories: Categories | None = None,
            patience: int | None = None) -> FoldRun:
    """M4/M5/M6: per fold fit on the other folds, predict the held-out fold,
    undo the log transform, union the OOF rows keyed by id. Folds are fitted
    side by side.

    ``early_stop_tol`` (GBT only): boosting stops when the error on the
    held-out fold improves by less than the tolerance; ``patience`` (GBT only,
    M6): all rounds are fitted, and the model is cut to the best one on the
    held-out fold, as found by ``best_round``. Imputer and encoders are fitted on the training
    folds alone."""
    c = categories or Categories()
    data, n = training_rows(_prepare(df, features, target, log_target), [
        fold, "_y", *features, *([weight] if weight else []), *c.coded, *c.flagged, *c.listed, *([c.fold] if c.fold else [])])
    run = FoldRun(oof=None)
    try:
        folds = fold_ids(data, fold)

        def fit(f):
            train_part = data.filter(F.col(fold) != f)
            if early_stop_tol is None or kind != "gbt":
                m = regression_pipeline(features, "_y", kind, seed, params, weight, categories).fit(train_part)
                if patience is None or kind != "gbt":
                    return m, None
                scores = prefix_scores(m, data.filter(F.col(fold) == f), "_y")
                best = best_round(scores, patience)
                return cut_boosting(m, best), scores
            from pyspark.ml import PipelineModel
            p = {**(params or {}), "validationIndicatorCol": "_is_val", "validationTol": early_stop_tol}
            *before, learner = regression_pipeline(features, "_y", kind, seed, p, weight, categories).getStages()
            fitted, shown = [], data.withColumn("_is_val", F.col(fold) == f)
            for stage in before:
                m = stage.fit(train_part) if hasattr(stage, "fit") else stage
                fitted.append(m)
                train_part, shown = m.transform(train_part), m.transform(shown)
            return PipelineModel([*fitted, learner.fit(shown)]), None

        fitted = in_parallel(fit, folds, fits_at_a_time(n, parallelism))
    finally:
        data.unpersist()
    outs = []
    for f, (m, scores) in zip(folds, fitted):
        run.models[f] = m
        if scores is not None:
            run.rounds[f] = scores
        learner = m.stages[-1]
        if hasattr(learner, "featureImportances"):
            imp = learner.featureImportances.toArray()
            run.importances.extend((int(f), feat, float(v)) for feat, v in zip(feature_names(m, features), imp))
        pred = m.transform(_prepare(df, features, target, log_target).filter(F.col(fold) == f))
        back = F.expm1("_pred") if log_target else F.col("_pred")
        outs.append(pred.select(key, F.col(fold).alias("fold"), F.col(target).alias("actual"),
                                back.alias("prediction")))
    run.oof = union_all(outs)
    return run


# ------------------------------------------------------------------ M6
def prefix_scores(model, rows: DataFrame, label: str) -> list[float]:
    """RMSE on ``rows`` of the first 1, 2, ... trees of a boosted pipeline: one scan and one aggregate for all of them.

    Each row's tree outputs are one array; their running sums are taken per
    Arrow batch, and a batch gives one row of sums of squares."""
    boosted = model.stages[-1]
    shown = rows
    for stage in model.stages[:-1]:
        shown = stage.transform(shown)
    trees, weights = boosted.trees, boosted.treeWeights
    shown = shown.select("_fv", F.col(label).cast("double").alias("_label")).filter("_label IS NOT NULL")
    each = shown
    for i, t in enumerate(trees):
        each = t.setFeaturesCol("_fv").setPredictionCol(f"_t{i}").transform(each)
    weight = np.array(weights)

    def sums(batches):
        import pyarrow as pa
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            out = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(weight))
            sq = ((np.cumsum(out * weight, axis=1) - y[:, None]) ** 2).sum(0) if b.num_rows else np.zeros(len(weight))
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([sq.tolist()], pa.list_(pa.float64()))], ["n", "sq"])

    per_batch = each.select("_label", F.array(*[F.col(f"_t{i}") for i in range(len(trees))]).alias("out")).mapInArrow(sums, "n long, sq array<double>")
    total = fit_row(per_batch, F.sum("n").alias("n"), *[F.sum(F.get("sq", F.lit(i))).alias(f"s{i}") for i in range(len(trees))])
    return [float(np.sqrt(total[f"s{i}"] / total["n"])) for i in range(len(trees))] if total["n"] else [0.0] * len(trees)


def best_round(scores: Sequence[float], patience: int) -> int:
    """Number of rounds (from 1) of the lowest score seen before ``patience`` rounds in a row brought none lower."""
    best = 0
    for i, s in enumerate(scores):
        if s < scores[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def cut_boosting(model, rounds: int):
    """A boosted pipeline with its first ``rounds`` trees only; saved and loaded like the whole."""
    from pyspark import SparkContext
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import GBTRegressionModel
    last = model.stages[-1]
    sc = SparkContext._active_spark_context
    j, jvm = last._java_obj, sc._jvm
    trees = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(jvm.double, rounds)
    for i, (t, w) in enumerate(zip(j.trees()[:rounds], list(j.treeWeights())[:rounds])):
        trees[i], weights[i] = t, w
    cut = jvm.org.apache.spark.ml.regression.GBTRegressionModel(j.uid(), trees, weights, j.numFeatures())
    out = GBTRegressionModel(cut)
    out._resetUid(last.uid)
    return PipelineModel([*model.stages[:-1], out.setFeaturesCol("_fv").setPredictionCol("_pred")])


def predict_folds(models: dict, df: DataFrame, key: str, features: Sequence[str], log_target: bool = True,
                  agg: str = "mean") -> DataFrame:
    """Score new rows with every fold model and average (W1) or take the median."""
    data = df.withColumns({f: F.col(f).cast("double") for f in features})
    outs = []
    for f, m in models.items():
        back = F.expm1("_pred") if log_target else F.col("_pred")
        outs.append(m.transform(data).select(key, F.lit(f).alias("fold"), back.alias("prediction")))
    u = outs[0]
    for o in outs[1:]:
        u = u.unionByName(o)
    a = F.avg("prediction") if agg == "mean" else F.percentile("prediction", 0.5)
    return u.groupBy(key).agg(a.alias("prediction"))


def feature_importance(runs: dict[str, FoldRun], spark, top: int | None = None) -> DataFrame:
    """Importances averaged over folds per model, then the models'
    tables merged (inner) on the feature, sorted by the mean over models."""
    merged = None
    for name, run in runs.items():
        t = (spark.createDataFrame(run.importances, "fold int, feature string, importance double")
             .groupBy("feature").agg(F.avg("importance").alias(f"importance_{name}")))
        merged = t if merged is None else merged.join(t, "feature", "inner")
    cols = [c for c in merged.columns if c.startswith("importance_")]
    merged = merged.withColumn("importance_mean", sum(F.col(c) for c in cols) / len(cols))
    merged = merged.orderBy(F.col("importance_mean").desc(), "feature")
    return merged.limit(top) if top else merged


def linear_family(df: DataFrame, features: Sequence[str], target: str, fold: str, alpha: float = 1.0,
                  key: str = "listing_id") -> DataFrame:
    """M8: ridge / lasso / elastic-net baselines, out of fold. The penalty is on
    the features as they are; alpha is per row sum for ridge (regParam =
    alpha / n) and per row mean for the other two (regParam = alpha)."""
    from valuator.operators.evaluate import regression_metrics
    folds = fold_ids(df, fold)
    n = df.count() * (len(folds) - 1) / len(folds)
    out = []
    for name, enet, reg in (("ridge", 0.0, alpha / n), ("lasso", 1.0, alpha), ("elastic_net", 0.5, alpha)):
        run = oof_run(df, key, features, target, fold, "linear", log_target=False,
                      params={"regParam": reg, "elasticNetParam": enet, "standardization": False})
        out.append(regression_metrics(run.oof, [], "actual", "prediction").withColumn("model", F.lit(name)))
    return union_all(out)


# ------------------------------------------------------------------ M9, M17
REST = "(rest)"
SEGMENT_LEARNERS = ("gbt", "rf", "linear")


def segment_label(df: DataFrame, segment: str, min_rows: int) -> tuple[Column, list[str], int]:
    """Label of a row's segment, the labels with a model of their own, and the rows of the rest: segments
    with fewer than ``min_rows`` rows and the null segment are one group."""
    kept = (df.filter(F.col(segment).isNotNull()).groupBy(F.col(segment).cast("string").alias("s")).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_rows).limit(MAX_SEGMENTS + 1).collect())
    if len(kept) > MAX_SEGMENTS:
        raise ValueError(f"more than {MAX_SEGMENTS} segments of {min_rows} rows")
    names = sorted(r["s"] for r in kept)
    s = F.col(segment).cast("string")
    label = F.when(s.isin(names), s).otherwise(F.lit(REST)) if names else F.lit(REST)
    return label, names, df.count() - sum(r["n"] for r in kept)


def _segment_params(params_for: dict | None, name: str, kind: str) -> dict | None:
    """``params_for`` maps a segment to parameters per learner; the entry None holds for all segments."""
    p = params_for or {}
    return (p.get(name) or p.get(None) or {}).get(kind)


def training_layout(df: DataFrame, path: str, segment: Column, fold: str | None = None) -> DataFrame:
    """``df`` written once under ``path``, a folder per segment (and fold), and read back: a filter on ``_seg`` (and ``_fold``) reads those
    folders only. Rows are spread over the folders by a hash besides, so that a large segment is written by many tasks."""
    parts = ["_seg", "_fold"] if fold else ["_seg"]
    rows = df.withColumn("_seg", segment)
    if fold:
        rows = rows.withColumn("_fold", F.col(fold))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns[:1]]), F.lit(16))
    rows.repartition(*parts, spread).write.mode("overwrite").partitionBy(*parts).option("compression", "zstd").parquet(path)
    schema = rows.schema
    return df.sparkSession.read.schema(schema).parquet(path)


@dataclass
class SegmentFits:
    """Fold models per segment: the prepared rows by folder, the label, segments and folds, and a model per (segment, fold, learner).
    A cell without a row has no models."""
    data: DataFrame
    label: Column
    groups: list
    cells: list
    fitted: dict


def fit_segments(df: DataFrame, segment: str, fold: str, features: Sequence[str], target: str, learners: Sequence[str] = SEGMENT_LEARNERS,
                 params_for: dict | None = None, seed: int = 42, parallelism: int = PARALLEL_FITS, min_rows: int = 30,
                 path: str | None = None, categories: Categories | None = None) -> SegmentFits:
    """Every segment's learners for every fold, each fitted on the segment's other folds.

    The prepared rows are written once, in a folder per segment and fold under
    ``path`` (a scratch folder of the session by default): a fit reads its
    segment's other folds, a prediction its own folder, so that the predictions
    together read the table once, however many segments and folds there are."""
    from valuator.sources.io import scratch_path
    label, names, rest = segment_label(df, segment, min_rows)
    prepared = _prepare(df, features, target, True)
    data = training_layout(prepared, path or scratch_path(df.sparkSession, "segments"), label, fold)
    folds = fold_ids(data, fold)
    groups = names + ([REST] if rest else [])
    # cells without a row: a segment with all rows in one fold learns from all segments, and an empty cell needs no model
    counts = {(r["_seg"], r["_fold"]): r["n"] for r in data.groupBy("_seg", "_fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = [(g, f) for g in groups for f in folds if counts.get((g, f))]
    jobs = [(g, f, kind) for g, f in cells for kind in learners]

    def fit(job):
        g, f, kind = job
        rows = data.filter(F.col("_fold") != f)
        others = sum(n for (s, x), n in counts.items() if s == g and x != f)
        own = rows.filter(F.col("_seg") == g) if others and (g != REST or rest >= min_rows) else rows
        return regression_pipeline(features, "_y", kind, seed, _segment_params(params_for, g, kind), categories=categories).fit(own)

    largest = max([sum(n for (s, _), n in counts.items() if s == g) for g in names] or [0])
    if rest and len(groups) > len(names):
        largest = max(largest, rest if rest >= min_rows else sum(counts.values()))
    return SegmentFits(data, label, groups, cells, dict(zip(jobs, in_parallel(fit, jobs, fits_at_a_time(largest, parallelism)))))


def predict_held_out(fits: SegmentFits, key: str, segment: str, fold: str, features: Sequence[str], target: str,
                     learners: Sequence[str] = SEGMENT_LEARNERS, categories: Categories | None = None) -> DataFrame:
    """key, segment, fold, actual, prediction: the mean of the learners that did not see the row's fold."""
    parts = []
    for g, f in fits.cells:
        rows = fits.data.filter((F.col("_seg") == g) & (F.col("_fold") == f))
        for kind in learners:
            rows = _scored(fits.fitted[g, f, kind], rows, kind, features, categories)
        mean = sum((F.col(f"_p_{kind}") for kind in learners), F.lit(0.0)) / len(learners)
        parts.append(rows.select(key, F.col("_seg").alias(segment), F.col(fold).alias("fold"),
                                 F.col(target).alias("actual"), mean.alias("prediction")))
    return union_all(parts)


def per_segment_models(df: DataFrame, key: str, segment: str, fold: str, features: Sequence[str], target: str,
                       learners: Sequence[str] = SEGMENT_LEARNERS, params_for: dict | None = None, seed: int = 42,
                       parallelism: int = PARALLEL_FITS, min_rows: int = 30, path: str | None = None,
                       categories: Categories | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M9: per segment, out-of-fold predictions of every learner, averaged.

    Returns (predictions: key, segment, fold, actual, prediction; scores per
    segment; importances per segment and feature, averaged over folds and the
    learners that have them). Every input row is predicted: segments with
    fewer than ``min_rows`` rows, and rows without a segment, form one group,
    which learns from all rows if it is smaller than that itself. Rows are
    laid out as in ``fit_segments``."""
    from valuator.operators.evaluate import regression_metrics
    fits = fit_segments(df, segment, fold, features, target, learners, params_for, seed, parallelism, min_rows, path, categories)
    imps = [(g, x, float(v)) for (g, _, _), m in fits.fitted.items() if hasattr(m.stages[-1], "featureImportances")
            for x, v in zip(feature_names(m, features), m.stages[-1].featureImportances.toArray())]
    pred = predict_held_out(fits, key, segment, fold, features, target, learners, categories)
    scores = regression_metrics(pred, [segment], "actual", "prediction")
    importances = (df.sparkSession.createDataFrame(imps, f"{segment} string, feature string, importance double")
                   .groupBy(segment, "feature").agg(F.avg("importance").alias("importance")))
    return pred, scores, importances


def _scored(model, rows: DataFrame, kind: str, features: Sequence[str], categories: Categories | None) -> DataFrame:
    """``rows`` with the price that a pipeline on the log of the price predicts, ``_p_<kind>``, and none of its other columns."""
    coded = (categories or Categories()).stages("_y")[1]
    return model.transform(rows).withColumn(f"_p_{kind}", F.expm1("_pred")).drop("_pred", "_fv", *coded, *[f"_imp_{x}" for x in features])


def retrain_on_segments(train: DataFrame, new: DataFrame, key: str, segment: str, features: Sequence[str], target: str,
                        learners: Sequence[str] = SEGMENT_LEARNERS, params_for: dict | None = None, seed: int = 42,
                        parallelism: int = PARALLEL_FITS, min_rows: int = 30, path: str | None = None) -> DataFrame:
    """Every segment's learners refitted on all its rows, and the new rows
    predicted by the mean of their segment's learners. New rows of other
    segments, or without one, are predicted by learners of all rows. Training
    and new rows are written in a folder per segment under ``path``, and read by segment."""
    from valuator.sources.io import scratch_path
    label, names, _ = segment_label(train, segment, min_rows)
    base = path or scratch_path(train.sparkSession, "segments")
    data = training_layout(_prepare(train, features, target, True), f"{base}/train", label)
    jobs = [(g, kind) for g in [*names, REST] for kind in learners]

    def fit(job):
        g, kind = job
        rows = data if g == REST else data.filter(F.col("_seg") == g)
        return regression_pipeline(features, "_y", kind, seed, _segment_params(params_for, g, kind)).fit(rows)

    fitted = dict(zip(jobs, in_parallel(fit, jobs, parallelism)))
    shown = training_layout(new.withColumns({f: F.col(f).cast("double") for f in features}), f"{base}/new", label)
    parts = []
    for g in [*names, REST]:
        rows = shown.filter(F.col("_seg") == g)
        for kind in learners:
            rows = _scored(fitted[g, kind], rows, kind, features, None)
        mean = sum((F.col(f"_p_{kind}") for kind in learners), F.lit(0.0)) / len(learners)
        parts.append(rows.select(key, segment, F.col("_seg").alias("model"), mean.alias("prediction")))
    return union_all(parts)


def bagged_seeds(df: DataFrame, key: str, features: Sequence[str], target: str, fold: str, n_bags: int = 3,
                 kind: str = "gbt", params: dict | None = None) -> DataFrame:
    """n_bags OOF runs with different seeds, averaged per key."""
    outs = []
    for b in range(n_bags):
        p = dict(params or {})
        if kind == "gbt":
            p.setdefault("subsamplingRate", 0.8)
        outs.append(oof_run(df, key, features, target, fold, kind, seed=42 + b, params=p).oof.withColumn("bag", F.lit(b)))
    return union_all(outs).groupBy(key).agg(F.avg("prediction").alias("prediction"), F.first("actual").alias("actual"))


def _fold_count(df: DataFrame, fold: str) -> int:
    """Folds of a fold column that holds 0 to n - 1."""
    r = fit_row(df, F.min(fold).alias("low"), F.max(fold).alias("high"))
    if r["low"] is None or r["low"] < 0 or r["high"] < 1:
        raise ValueError("folds are numbered from 0, and there are two at least")
    return int(r["high"]) + 1


def grid_search(df: DataFrame, features: Sequence[str], target: str, fold: str, grid: dict,
                kind: str = "gbt", parallelism: int = 4, top: int = 5) -> DataFrame:
    """Exhaustive grid with k-fold CV on a fold column; table of settings
    and mean RMSE, best first."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    data, n_rows = training_rows(_prepare(df, features, target, True).withColumn(fold, F.col(fold).cast("int")), [*features, fold, "_y"])
    pipe = regression_pipeline(features, "_y", kind)
    learner = pipe.getStages()[-1]
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(learner.getParam(name), list(values))
    maps = b.build()
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, foldCol=fold, numFolds=_fold_count(data, fold), parallelism=fits_at_a_time(n_rows, parallelism),
                        evaluator=RegressionEvaluator(labelCol="_y", predictionCol="_pred", metricName="rmse"))
    try:
        m = cv.fit(data)
    finally:
        data.unpersist()
    rows = [(str({p.name: v for p, v in pm.items()}), float(s)) for pm, s in zip(maps, m.avgMetrics)]
    t = df.sparkSession.createDataFrame(rows, "params string, cv_rmse double").orderBy("cv_rmse", "params")
    return t.limit(top) if top else t


def random_search(df: DataFrame, features: Sequence[str], target: str, fold: str, space: dict, n: int = 6,
                  kind: str = "gbt", seed: int = 42, parallelism: int = 4) -> DataFrame:
    """``n`` settings sampled from ``space`` (lists), each scored by
    k-fold CV on the fold column; all results, best first."""
    import random
    rnd = random.Random(seed)
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator
    data, n_rows = training_rows(_prepare(df, features, target, True).withColumn(fold, F.col(fold).cast("int")), [*features, fold, "_y"])
    pipe = regression_pipeline(features, "_y", kind)
    learner = pipe.getStages()[-1]
    maps = []
    for _ in range(n):
        maps.append({learner.getParam(k): rnd.choice(list(v)) for k, v in space.items()})
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, foldCol=fold, numFolds=_fold_count(data, fold), parallelism=fits_at_a_time(n_rows, parallelism),
                        evaluator=RegressionEvaluator(labelCol="_y", predictionCol="_pred", metricName="rmse"))
    try:
        m = cv.fit(data)
    finally:
        data.unpersist()
    rows = [(str({p.name: v for p, v in pm.items()}), float(s)) for pm, s in zip(maps, m.avgMetrics)]
    return df.sparkSession.createDataFrame(rows, "params string, cv_rmse double").orderBy("cv_rmse", "params")


class _Range:
    """One searched setting: ("log" | "float" | "int", low, high), or a list of choices.

    ``propose`` draws near the settings that did well, ``density`` is the Parzen
    estimate on the range taken to 0..1: a normal kernel at each setting and an
    even share of the whole range, which keeps every value within reach."""

    def __init__(self, spec):
        self.choices = None if isinstance(spec, tuple) else list(spec)
        if self.choices is None:
            self.kind, self.low, self.high = spec
            if self.kind not in ("log", "float", "int") or not self.low < self.high or (self.kind == "log" and self.low <= 0):
                raise ValueError(f"bad range {spec}")

    def _unit(self, v) -> float:
        if self.kind == "log":
            return math.log(v / self.low) / math.log(self.high / self.low)
        return (v - self.low) / (self.high - self.low)

    def _value(self, u: float):
        u = min(max(u, 0.0), 1.0)
        if self.kind == "log":
            return self.low * (self.high / self.low) ** u
        v = self.low + u * (self.high - self.low)
        return int(round(v)) if self.kind == "int" else v

    def draw(self, rnd):
        return rnd.choice(self.choices) if self.choices else self._value(rnd.random())

    @staticmethod
    def _width(seen: Sequence) -> float:
        return max(0.05, 0.5 / (1 + len(seen)) ** 0.5)

    def propose(self, rnd, seen: Sequence):
        if not seen or rnd.random() < 1.0 / (1 + len(seen)):
            return self.draw(rnd)
        near = rnd.choice(list(seen))
        return near if self.choices else self._value(rnd.gauss(self._unit(near), self._width(seen)))

    def density(self, v, seen: Sequence) -> float:
        if self.choices:
            return (seen.count(v) + 1.0) / (len(seen) + len(self.choices))
        u, h = self._unit(v), self._width(seen)
        kernels = sum(math.exp(-0.5 * ((u - self._unit(s)) / h) ** 2) / (h * math.sqrt(2 * math.pi)) for s in seen)
        return (1.0 + kernels) / (1 + len(seen))


def guided_search(df: DataFrame, features: Sequence[str], target: str, fold: str, space: dict, rounds: int = 4, batch: int = 4,
                  kind: str = "gbt", seed: int = 42, keep: float = 0.5, good: float = 0.25, draws: int = 24,
                  parallelism: int = PARALLEL_FITS) -> DataFrame:
    """Settings from a Parzen sampler, scored by successive halving over the folds.

    Each round tries ``batch`` settings: drawn at random in the first one, later
    those of ``draws`` proposals for which the density near the best ``good``
    share of earlier settings is largest against that near the others. All of a
    round are scored on the first fold, the better ``keep`` share of them (at
    least one) on the next, and so on, so only the last survivors take a fit on
    every fold. Fits of a fold run side by side, as jobs of their own.

    ``space``: name of a learner's parameter -> ("log" | "float" | "int", low,
    high) or a list of choices. Returns (params, fits, cv_rmse of the folds it
    was scored on, finished), finished settings first, best first. Settings of a
    round that come out equal are tried once. Null targets do not count."""
    import random

    from pyspark.ml.evaluation import RegressionEvaluator
    spark, rnd = df.sparkSession, random.Random(seed)
    ranges = {name: _Range(spec) for name, spec in sorted(space.items())}
    data = _prepare(df, features, target, True).select(*features, fold, "_y").filter(F.col("_y").isNotNull())
    n_rows = data.count()
    data = cut_lineage(spread(data, n_rows, [*features, fold]))
    folds = sorted(fold_ids(data, fold))
    metric = RegressionEvaluator(labelCol="_y", predictionCol="_pred", metricName="rmse")
    scores: dict[tuple, list[float]] = {}

    def score(task) -> float:
        setting, f = task
        model = regression_pipeline(features, "_y", kind, seed, dict(zip(ranges, setting))).fit(data.filter(F.col(fold) != f))
        return float(metric.evaluate(model.transform(data.filter(F.col(fold) == f))))

    def pick() -> tuple:
        # all settings have a score on the first fold
        order = sorted(scores, key=lambda s: (scores[s][0], str(s)))
        split = max(1, math.ceil(good * len(order)))
        best, rest = order[:split], order[split:]
        offers = [tuple(r.propose(rnd, [s[i] for s in best]) for i, r in enumerate(ranges.values())) for _ in range(draws)]
        offers = [o for o in offers if o not in scores] or offers

        def gain(offer: tuple) -> float:
            return sum(math.log(r.density(v, [s[i] for s in best]) / r.density(v, [s[i] for s in rest]))
                       for i, (r, v) in enumerate(zip(ranges.values(), offer)))
        return max(offers, key=gain)

    for n in range(rounds):
        drawn = [pick() if scores else tuple(r.draw(rnd) for r in ranges.values()) for _ in range(batch)]
        running = [s for s in dict.fromkeys(drawn) if s not in scores]
        for f in folds:
            for s, v in zip(running, in_parallel(score, [(s, f) for s in running], fits_at_a_time(n_rows, parallelism))):
                scores.setdefault(s, []).append(v)
            running = sorted(running, key=lambda s: (sum(scores[s]) / len(scores[s]), str(s)))[:max(1, math.ceil(keep * len(running)))]
    rows = [(str(dict(zip(ranges, s))), len(v), sum(v) / len(v), len(v) == len(folds)) for s, v in scores.items()]
    return (spark.createDataFrame(rows, "params string, fits int, cv_rmse double, finished boolean")
            .orderBy(F.col("finished").desc(), "cv_rmse", "params"))


CLASS_GRIDS = {"forest": {"maxDepth": [5, 10]}, "logistic": {"regParam": [0.0, 0.1]}, "boosted": {}}


def error_class_model(df: DataFrame, key: str, features: Sequence[str], label: str, kind: str = "forest", seed: int = 42,
                      test_fraction: float = 0.2, grid: dict | None = None, folds: int = 3, trees: int = 50):
    """Predict a class (e.g. error band) from features. A stratified share
    of the rows is held out; the settings are chosen on the others by k-fold
    accuracy. Returns (model, held-out rows with predicted_class, table of
    settings and scores). At least two classes are required."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import Imputer, IndexToString, StringIndexer, VectorAssembler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    data = df.withColumns({f: F.col(f).cast("double") for f in features}).withColumn(label, F.col(label).cast("string"))
    split = stratified_split(data, key, label, test_fraction, seed, out="_part")
    train, test = split.filter("_part = 'train'").drop("_part"), split.filter("_part = 'test'").drop("_part")
    train, n_rows = training_rows(train, [key, label, *features])
    if train.select(label).distinct().limit(2).count() < 2:
        raise ValueError("error_class_model needs at least two classes")
    idx = StringIndexer(inputCol=label, outputCol="_li", handleInvalid="keep").fit(train)
    cols = {"featuresCol": "_fv", "labelCol": "_li", "predictionCol": "_pi"}
    if kind == "forest":
        clf = RandomForestClassifier(numTrees=trees, seed=seed, **cols)
    elif kind == "logistic":
        clf = LogisticRegression(family="multinomial", maxIter=100, **cols)
    elif kind == "boosted":
        clf = OneVsRest(classifier=GBTClassifier(maxIter=20, seed=seed), **cols)
    else:
        raise ValueError("kind must be forest|logistic|boosted")
    imp = [f"_imp_{f}" for f in features]
    pipe = Pipeline(stages=[idx, Imputer(inputCols=list(features), outputCols=imp, strategy="median"),
                            VectorAssembler(inputCols=imp, outputCol="_fv"), clf,
                            IndexToString(inputCol="_pi", outputCol="predicted_class", labels=idx.labels)])
    b = ParamGridBuilder()
    for name, values in (CLASS_GRIDS[kind] if grid is None else grid).items():
        b = b.addGrid(clf.getParam(name), list(values))
    maps = b.build()
    score = MulticlassClassificationEvaluator(labelCol="_li", predictionCol="_pi", metricName="accuracy")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=score, numFolds=folds, seed=seed,
                        parallelism=fits_at_a_time(n_rows)).fit(train)
    train.unpersist()
    rows = [(str({p.name: v for p, v in pm.items()}), float(x)) for pm, x in zip(maps, cv.avgMetrics)]
    table = df.sparkSession.createDataFrame(rows, "params string, accuracy double").orderBy(F.desc("accuracy"), "params")
    return cv.bestModel, cv.bestModel.transform(test), table


def learning_curve(df: DataFrame, key: str, features: Sequence[str], target: str, fold: str,
                   sizes: Sequence[float] = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0),
                   kind: str = "gbt", params: dict | None = None) -> DataFrame:
    """Train and CV RMSE at growing training sizes; samples are nested
    (a row is in every sample whose fraction exceeds its key hash). Plain linear models (``kind`` linear without
    ``params``) come from one aggregate, see ``_linear_scores``."""
    from pyspark.ml.evaluation import RegressionEvaluator
    ev = RegressionEvaluator(labelCol="_y", predictionCol="_pred", metricName="rmse")
    data, n_rows = training_rows(_prepare(df, features, target, True).withColumn("_h", mix_hash(key, 7) / F.lit(float(LCG_MOD))), [*features, fold, "_y", "_h"])
    folds = fold_ids(data, fold)

    def score(task) -> tuple[float, float]:
        s, f = task
        train_part = data.filter((F.col(fold) != f) & (F.col("_h") < s))
        m = regression_pipeline(features, "_y", kind, params=params).fit(train_part)
        return ev.evaluate(m.transform(train_part)), ev.evaluate(m.transform(data.filter(F.col(fold) == f)))

    try:
        tasks = [(s, f) for s in sizes for f in folds]
        scores = _linear_scores(data, features, fold, folds, sizes, n_rows) if kind == "linear" and not params else dict(zip(tasks, in_parallel(score, tasks, fits_at_a_time(n_rows))))
    finally:
        data.unpersist()
    rows = [(float(s), *(float(np.mean([scores[s, f][i] for f in folds])) for i in (0, 1))) for s in sizes]
    return df.sparkSession.createDataFrame(rows, "train_fraction double, train_rmse double, cv_rmse double")


def _linear_scores(data: DataFrame, features: Sequence[str], fold: str, folds: Sequence, sizes: Sequence[float], n_rows: int) -> dict[tuple, tuple[float, float]]:
    """(size, fold) -> RMSE on the training sample and on the held-out fold of the linear pipeline fitted on the sample.

    The pipeline's learner solves the normal equations, so it needs of its rows only their sums of products, and so do the two
    errors. One pass gives these by fold and by the least size whose sample has the row; all fits add them up. A missing
    value adds to the sums of its column's gaps, which are multiplied by the median that the fit's own imputer finds. A row
    without a target is an error, as it is to the learner."""
    from pyspark.ml.feature import Imputer
    given = [F.nanvl(F.col(f), F.lit(None)) for f in features]
    st = fit_row(data, F.avg("_y").alias("y"), F.count(F.when(F.col("_y").isNull() | F.isnan("_y"), 1)).alias("none"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(given)], *[F.count(F.when(c.isNull(), 1)).alias(f"h{i}") for i, c in enumerate(given)])
    if st["none"]:
        raise ValueError("targets must not be null or NaN")
    center = np.array([st[f"m{i}"] or 0.0 for i in range(len(features))])
    holes = [i for i in range(len(features)) if st[f"h{i}"]]
    steps, p = sorted(set(sizes)), 2 + len(features) + len(holes)
    step = sum((F.when(F.col("_h") < s, 0).otherwise(1) for s in steps), F.lit(0))
    group = (F.array_position(F.array(*[F.lit(f) for f in folds]), F.col(fold)) - 1) * (len(steps) + 1) + step
    columns = [F.lit(1.0), *[F.coalesce(c - F.lit(float(m)), F.lit(0.0)) for c, m in zip(given, center)],
               *[F.when(given[i].isNull(), 1.0).otherwise(0.0) for i in holes], F.col("_y") - F.lit(float(st["y"] or 0.0))]

    def add(batches):
        import pyarrow as pa
        total: dict[int, np.ndarray] = {}
        for b in batches:
            g = b.column(0).to_numpy(zero_copy_only=False)
            z = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]])
            order = np.argsort(g, kind="stable")
            names, starts = np.unique(g[order], return_index=True)
            for name, own in zip(names, np.split(order, starts[1:])):
                total[int(name)] = total.get(int(name), 0.0) + z[own].T @ z[own]
        for name, s in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, name), pa.int32()), pa.array(np.arange(s.size), pa.int32()), pa.array(s.ravel())], ["g", "i", "v"])

    each = data.select(group.cast("int").alias("g"), *[c.alias(f"z{i}") for i, c in enumerate(columns)]).mapInArrow(add, "g int, i int, v double")
    sums = np.zeros((len(folds), len(steps) + 1, p * p))
    for r in each.groupBy("g", "i").agg(F.sum("v").alias("v")).collect():
        sums[r["g"] // (len(steps) + 1), r["g"] % (len(steps) + 1), r["i"]] = r["v"]
    sums = sums.reshape(len(folds), len(steps) + 1, p, p)

    def fit(task) -> tuple[float, float]:
        s, f = task
        own, below = folds.index(f), steps.index(s) + 1
        train, held = sum(sums[i, :below].sum(0) for i in range(len(folds)) if i != own), sums[own].sum(0)
        if not train[0, 0]:
            raise ValueError(f"no training rows at {s} without fold {f}")
        # (1, features, target) from what was added up: a gap has the median's distance from the centre
        to = np.zeros((2 + len(features), p))
        to[:-1, :1 + len(features)], to[-1, -1] = np.eye(1 + len(features)), 1.0
        if holes:
            names = [features[i] for i in holes]
            found = Imputer(inputCols=names, outputCols=[f"_imp_{x}" for x in names], strategy="median").fit(data.filter((F.col(fold) != f) & (F.col("_h") < s))).surrogateDF.first()
            for j, i in enumerate(holes):
                to[1 + i, 1 + len(features) + j] = found[features[i]] - center[i]
        train, held = to @ train @ to.T, to @ held @ to.T
        mean = train[0, 1:] / train[0, 0]
        gram = train[1:, 1:] - train[0, 0] * np.outer(mean, mean)
        width = np.sqrt(np.maximum(np.diag(gram)[:-1], 0.0))
        # a column that does not vary, but for rounding, has no weight
        varies = width > 1e-12 * np.sqrt(np.maximum(np.diag(train)[1:-1], 0.0))
        weights = np.zeros(len(features))
        scale = width[varies]
        weights[varies] = np.linalg.lstsq(gram[:-1, :-1][np.ix_(varies, varies)] / np.outer(scale, scale), gram[:-1, -1][varies] / scale, rcond=None)[0] / scale
        v = np.concatenate([[-(mean[-1] - mean[:-1] @ weights)], -weights, [1.0]])
        return tuple(float(np.sqrt(max(v @ x @ v, 0.0) / x[0, 0])) if x[0, 0] else float("nan") for x in (train, held))

    tasks = [(s, f) for s in sizes for f in folds]
    return dict(zip(tasks, in_parallel(fit, tasks, fits_at_a_time(n_rows))))


# ====================================================================== S6 bundles
def save_model_bundle(models: dict, base_path: str, model_name: str, target: str, spark) -> DataFrame:
    """Save every fold model (PipelineModel writer) and a manifest table
    (model, fold, path, target) next to them."""
    rows = []
    for f, m in models.items():
        p = f"{base_path}/{model_name}/fold={f}"
        m.write().overwrite().save(p)
        rows.append((model_name, str(f), p, target))
    manifest = spark.createDataFrame(rows, "model string, fold string, path string, target string")
    manifest.write.mode("overwrite").parquet(f"{base_path}/{model_name}/_manifest")
    return manifest


def verify_bundle(spark, base_path: str, model_name: str, required_folds: Sequence) -> DataFrame:
    """Reload the manifest, try to load each model, and report required
    folds that are missing (anti join) or fail to load."""
    from pyspark.ml import PipelineModel
    manifest = spark.read.parquet(f"{base_path}/{model_name}/_manifest")
    req = spark.createDataFrame([(str(f),) for f in required_folds], "fold string")
    missing = req.join(manifest, "fold", "left_anti").select("fold", F.lit("missing").alias("status"))
    rows = []
    for r in manifest.collect():
        try:
            PipelineModel.load(r["path"])
            rows.append((r["fold"], "ok"))
        except Exception:  # noqa: BLE001 - reported as a status row
            rows.append((r["fold"], "unloadable"))
    loaded = spark.createDataFrame(rows, "fold string, status string")
    return loaded.unionByName(missing)
