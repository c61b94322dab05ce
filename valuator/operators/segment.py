"""Binning and rule-based segments.

Fitted pieces (quantile edges, per-segment counts) are one aggregate each;
applying them is a projection (global state as literals) or a size-checked
broadcast join (per-group state). Per-group statistics use groupBy with
map-side partial aggregation rather than a window over the raw rows, so a hot
segment never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuator.functions.columns import clip
from valuator.plans.strategy import attach_groups, fit_quantiles, fit_row, group_quantiles

# The reference's nine absolute-error bands (inclusive integer
# bounds; values above the last band, or inside the integer gaps, get id 9).
ERROR_BANDS = [
    (0, 2000), (2001, 3000), (3001, 5000), (5001, 8000), (8001, 10000),
    (10001, 12000), (12001, 14000), (14001, 16000), (16001, 20000),
]
# Default two-band split of the error-routing experiments.
DEFAULT_CUSTOM_BANDS = [(0, 8000), (8001, 9999999)]
# Quantile bin labels.
LABELS_5 = ["very_low", "low", "medium", "high", "very_high"]
LABELS_3 = ["low", "medium", "high"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ B1, B2
def quantile_edges(df: DataFrame, col: str, q: int) -> list[float]:
    """Fit: q+1 exact (linearly interpolated) quantile edges, duplicates dropped."""
    probs = [i / q for i in range(q + 1)]
    edges = fit_quantiles(df, [col], probs)[col] or []
    out: list[float] = []
    for e in edges:
        if not out or e != out[-1]:
            out.append(float(e))
    return out


def quantile_edges_multi(df: DataFrame, cols: Sequence[str], q: int) -> dict[str, list[float]]:
    """Edges of several columns in one aggregate pass (nulls ignored per column)."""
    probs = [i / q for i in range(q + 1)]
    row = fit_quantiles(df, list(cols), probs)
    out: dict[str, list[float]] = {}
    for c in cols:
        es: list[float] = []
        for e in row[c] or []:
            if not es or e != es[-1]:
                es.append(float(e))
        out[c] = es
    return out


def bin_code(c: str | Column, edges: Sequence[float]) -> Column:
    """Apply: right-closed bins, lowest edge included; code = #inner edges < x.

    Values outside [first, last] edge get null, as with pandas qcut.
    """
    x = _col(c)
    if len(edges) < 2:
        return F.when(x.isNotNull(), F.lit(0)).cast("int")
    code = F.lit(0)
    for e in edges[1:-1]:
        code = code + (x > F.lit(e)).cast("int")
    inside = (x >= F.lit(edges[0])) & (x <= F.lit(edges[-1]))
    return F.when(inside, code).cast("int")


def quantile_bins(df: DataFrame, col: str, q: int, out: str = "bin") -> DataFrame:
    """B1: equal-frequency bins (pandas qcut semantics, duplicates='drop')."""
    return df.withColumn(out, bin_code(col, quantile_edges(df, col, q)))


def quantile_labels(df: DataFrame, col: str, q: int, labels: Sequence[str] | None = None,
                    out: str = "bin_label") -> DataFrame:
    """B2: B1 with text labels."""
    labels = list(labels or (LABELS_5 if q == 5 else LABELS_3 if q == 3 else [str(i) for i in range(q)]))
    edges = quantile_edges(df, col, q)
    code = bin_code(col, edges)
    arr = F.array(*[F.lit(s) for s in labels])
    return df.withColumn(out, F.when(code.isNotNull(), F.element_at(arr, code + 1)))


# ------------------------------------------------------------------ B3, B4, B5
def error_band(err: str | Column, bands: Sequence[tuple[float, float]] = ERROR_BANDS,
               gaps: str = "reference") -> Column:
    """Band id of |err|.

    gaps='reference': first band with lower <= e <= upper, else len(bands)
    (2000.5 falls in the 2000–2001 gap and gets the overflow id).
    gaps='closed': contiguous bands, e <= upper of band i.
    """
    e = F.abs(_col(err))
    expr = None
    for i, (lo, hi) in enumerate(bands):
        cond = (e >= F.lit(lo)) & (e <= F.lit(hi)) if gaps == "reference" else (e <= F.lit(hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(bands))).cast("int")


def binary_error_label(err: str | Column, threshold: float) -> Column:
    """|err| > threshold -> 1."""
    return (F.abs(_col(err)) > F.lit(threshold)).cast("int")


# ------------------------------------------------------------------ B6, B7
def threshold_segments(df: DataFrame, col: str = "price", pct: float = 0.75,
                       out: str = "segment") -> tuple[DataFrame, DataFrame]:
    """Col > percentile(pct) -> 1 else 0, plus per-segment statistics."""
    cut = fit_quantiles(df, [col], [pct])[col][0]
    seg = df.withColumn(out, (F.col(col) > F.lit(cut)).cast("int"))
    stats = seg.groupBy(out).agg(
        F.min(col).alias("min_price"), F.max(col).alias("max_price"), F.count(F.lit(1)).alias("n"),
        F.avg(col).alias("mean_price"), F.stddev_samp(col).alias("std_price"))
    med = group_quantiles(seg, [out], col, [0.5]).select(out, F.col("_q")[0].alias("median_price"))
    stats = stats.join(med, out, "left").select(out, "min_price", "max_price", "median_price", "n", "mean_price",
                                                  "std_price")
    return seg, stats


def price_range_class(df: DataFrame, group: str, col: str = "price", mode: str = "absolute",
                      low: float = 50_000.0, high: float = 150_000.0) -> DataFrame:
    """Class of each group from its median price.

    absolute: median < low -> 'low', < high -> 'medium', else 'high'.
    relative: below the median of the group medians -> 'low', above their
    q75 -> 'high', else 'medium'.
    """
    med = group_quantiles(df, [group], col, [0.5]).select(group, F.col("_q")[0].alias("median_price"))
    if mode == "absolute":
        cls = (F.when(F.col("median_price") < low, "low")
               .when(F.col("median_price") < high, "medium").otherwise("high"))
        return med.withColumn("price_class", cls)
    if mode == "relative":
        # the group-median table has one row per group: a cross-group
        # statistic over it is a second tiny aggregate
        r = fit_row(med, F.percentile("median_price", 0.5).alias("m"), F.percentile("median_price", 0.75).alias("q"))
        cls = (F.when(F.col("median_price") < F.lit(r["m"]), "low")
               .when(F.col("median_price") > F.lit(r["q"]), "high").otherwise("medium"))
        return med.withColumn("price_class", cls)
    raise ValueError("mode must be absolute|relative")


# ------------------------------------------------------------------ B8–B11
def segment_weights(df: DataFrame, segment: str, out: str = "weight") -> DataFrame:
    """weight = sqrt(N / count(segment)); rows without a segment are one. Counts by partial aggregation."""
    counts = df.groupBy(segment).agg(F.count(F.lit(1)).alias("_seg_n"))
    total = df.count()
    joined = attach_groups(df, counts, [segment], "left")
    return joined.withColumn(out, F.sqrt(F.lit(float(total)) / F.col("_seg_n"))).drop("_seg_n")


def segment_bounds(df: DataFrame, segment: str, col: str = "price",
                   probs: Sequence[float] = (0.01, 0.33, 0.67, 0.99)) -> DataFrame:
    """q01/q33/q67/q99 per segment."""
    g = group_quantiles(df, [segment], col, list(probs))
    return g.select(segment, *[F.col("_q")[i].alias(f"q{int(round(pr * 100)):02d}") for i, pr in enumerate(probs)])


def class_imbalance(df: DataFrame, label: str = "label") -> DataFrame:
    """B10 as a one-row aggregate: negatives / positives (null without positives)."""
    neg = F.sum(F.when(F.col(label) == 0, 1).otherwise(0))
    pos = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    return df.agg(F.try_divide(neg.cast("double"), pos).alias("weight"))


def class_imbalance_weight(df: DataFrame, label: str = "label") -> float:
    """Negatives / positives."""
    r = fit_row(df, F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("neg"),
                F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"))
    return float(r["neg"]) / float(r["pos"]) if r["pos"] else float("nan")


def error_row_weights(df: DataFrame, err: str | Column, out: str = "weight") -> DataFrame:
    """w = 1/(1+|err|), normalised by its mean (one global aggregate)."""
    w = F.lit(1.0) / (F.lit(1.0) + F.abs(_col(err)))
    mean_w = fit_row(df, F.avg(w).alias("m"))["m"]
    return df.withColumn(out, w / F.lit(mean_w))


def clip_by_segment_stats(pred: Column, lo: Column, hi: Column) -> Column:
    return clip(pred, lo, hi)
