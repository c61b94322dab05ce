"""W12, the whole two-pass run: segments, three learners a segment and fold, and once more with the first pass's price as a feature.

A pass finds k-means segments of the listing's own columns (never the price),
with k by silhouette, fits every segment's learners per fold, predicts each
training row by the models that did not see its fold, and each new row by all
fold models of its segment. The first pass's predictions, held to the range of
prices, become ``ref_price`` of the training and the new rows, and the second
pass is the same run with that column added.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuator.functions.columns import clip_prices
from valuator.operators import train as M
from valuator.operators.cluster import choose_k_silhouette, kmeans_segments, nearest_center
from valuator.operators.ensemble import ref_price_feature
from valuator.plans.strategy import fit_quantiles, spread_once
from valuator.session import cut_lineage


@dataclass
class PassResult:
    """held_out: key, segment, fold, actual, prediction; new: key, segment, prediction; the centres; the silhouettes by k."""
    held_out: DataFrame
    new: DataFrame
    centers: list
    silhouettes: DataFrame


def segment_columns(train: DataFrame, columns: Sequence[str], max_k: int = 5, restarts: int = 10, seed: int = 42) -> tuple[Column, list, DataFrame]:
    """An expression that gives a row its segment, the centres, and the silhouettes of 2 to ``max_k`` segments.

    A missing value counts as the training rows' median, in new rows too, and
    a column without any value as 0."""
    best, table = choose_k_silhouette(train, columns, range(2, max_k + 1), seed)
    model, _ = kmeans_segments(train, columns, best, restarts, seed)
    medians = fit_quantiles(train, list(columns), [0.5])
    value = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(float(medians[c][0]) if medians[c] else 0.0)) for c in columns]
    centers = [[float(x) for x in c] for c in model.clusterCenters()]
    return nearest_center(value, centers), centers, table


def predict_new_rows(fits: M.SegmentFits, new: DataFrame, key: str, segment: str, features: Sequence[str],
                     learners: Sequence[str], path: str) -> DataFrame:
    """key, segment, prediction: the mean over all fold models of the row's segment.

    Rows of a segment that has no models get the mean over the models of the
    segment with most folds, the first by name of equals. New rows are written
    once, by segment, so that each segment's models read their own folder."""
    rows = M.training_layout(new.withColumns({f: F.col(f).cast("double") for f in features}), path, fits.label)
    folds_of: dict[str, list] = {}
    for g, f in fits.cells:
        folds_of.setdefault(g, []).append(f)
    spare = max(sorted(folds_of), key=lambda g: len(folds_of[g]))
    parts = []
    for g in sorted({*folds_of, M.REST}):
        own = g if g in folds_of else spare
        part = rows.filter(F.col("_seg") == g)
        names = []
        for f in folds_of[own]:
            for kind in learners:
                part = M._scored(fits.fitted[own, f, kind], part, kind, features, None).withColumnRenamed(f"_p_{kind}", f"_f{len(names)}")
                names.append(f"_f{len(names)}")
        mean = sum((F.col(c) for c in names), F.lit(0.0)) / len(names)
        parts.append(part.select(key, F.col("_seg").alias(segment), mean.alias("prediction")))
    return M.union_all(parts)


def segment_pass(train: DataFrame, new: DataFrame, key: str, columns: Sequence[str], features: Sequence[str], target: str, fold: str,
                 learners: Sequence[str] = M.SEGMENT_LEARNERS, params_for: dict | None = None, max_k: int = 5, restarts: int = 10,
                 seed: int = 42, min_rows: int = 30) -> PassResult:
    """One pass; every training row and every new row is predicted once, within the range of prices."""
    from valuator.sources.io import scratch_path
    label, centers, table = segment_columns(train, columns, max_k, restarts, seed)
    train, new = train.withColumn("segment", label), new.withColumn("segment", label)
    base = scratch_path(train.sparkSession, "passes")
    fits = M.fit_segments(train, "segment", fold, features, target, learners, params_for, seed, min_rows=min_rows, path=f"{base}/train")
    held_out = M.predict_held_out(fits, key, "segment", fold, features, target, learners)
    shown = predict_new_rows(fits, new, key, "segment", features, learners, f"{base}/new")
    held_out, shown = (cut_lineage(x.withColumn("prediction", clip_prices("prediction"))) for x in (held_out, shown))
    return PassResult(held_out, shown, centers, table)


def two_pass_run(train: DataFrame, new: DataFrame, key: str, columns: Sequence[str], features: Sequence[str], target: str, fold: str,
                 name: str = "ref_price", **settings) -> tuple[PassResult, PassResult]:
    """Both passes; ``settings`` as in ``segment_pass``. A training row's ``ref_price`` is of models that did not see its fold."""
    # each pass reads its rows for every size of the segments
    train = spread_once(train, [key])
    first = segment_pass(train, new, key, columns, features, target, fold, **settings)
    train, new = ref_price_feature(train, new, key, first.held_out, first.new, name=name)
    train = spread_once(train, [key])
    return first, segment_pass(train, new, key, columns, [*features, name], target, fold, **settings)
