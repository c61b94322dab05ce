"""Missing-value operators.

Fit on a training frame, apply to any frame. Statistics travel as literals
(one aggregate row); per-group statistics are joined back with a
size-checked broadcast, never a window over the raw rows (a hot group would
sit in one task).

Nearest-neighbour imputation (I7–I11) follows the reference's definition
(NaN-aware Euclidean distance rescaled by total/present coordinates, k
donors, weights 1/d, zero-distance donors take all the weight, receivers
without any comparable donor get the column mean). See ``knn_impute`` for the
join that finds the donors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuator.plans.strategy import _partitions, attach_state, fit_quantiles, fit_row, group_quantiles
from valuator.session import cut_lineage


def _d(c: str) -> Column:
    return F.col(c).cast("double")


# ------------------------------------------------------------------ I1–I6
def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """I1 fit: exact medians of all columns in one aggregate."""
    r = fit_quantiles(df, list(cols), [0.5])
    return {c: (r[c][0] if r[c] else None) for c in cols}


def fit_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """I4 fit: column means."""
    r = fit_row(df, *[F.avg(_d(c)).alias(c) for c in cols])
    return {c: r[c] for c in cols}


def apply_fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Apply fitted fill values (null -> value); numeric columns keep their type
    when the value is integral, else become double."""
    out = {}
    types = dict(df.dtypes)
    for c, v in values.items():
        if v is None:
            continue
        if types[c] in ("double", "float") or isinstance(v, str):
            out[c] = F.coalesce(F.col(c), F.lit(v))
        else:
            out[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
    return df.withColumns(out)


def impute_constant(df: DataFrame, cols: Sequence[str], value: str = "unknown") -> DataFrame:
    """String null -> constant."""
    return df.fillna({c: value for c in cols})


def fit_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """I3 fit: most frequent non-null value per column, ties -> smallest value
    (value counts by partial aggregation, then one min_by over them)."""
    out = {}
    for c in cols:
        counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        r = counts.agg(F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c))).alias("m")).collect()
        out[c] = r[0]["m"] if r else None
    return out


def impute_group_mean(df: DataFrame, col: str, group: str, train: DataFrame | None = None,
                      cast: str = "int", rounding: str = "truncate") -> DataFrame:
    """Null -> mean of its group (fitted on ``train``), then the global
    mean; cast to integer by truncation (default) or half-up rounding."""
    train = df if train is None else train
    g = train.groupBy(group).agg(F.avg(_d(col)).alias("_gmean"))
    overall = fit_row(train, F.avg(_d(col)).alias("m"))["m"]
    j = attach_state(df, g, group, "left")
    filled = F.coalesce(_d(col), F.col("_gmean"), F.lit(overall))
    if cast:
        filled = (F.round(filled, 0) if rounding == "round" else filled).cast(cast)
    return j.withColumn(col, filled).drop("_gmean")


def impute_first_in_group(df: DataFrame, col: str, group: str, order: str) -> DataFrame:
    """Null -> value of the first row (by ``order``) of the same group; that
    value may itself be null. One aggregate (min_by on a struct keeps a null
    value) joined back, instead of a window over a possibly hot group."""
    first = df.groupBy(group).agg(F.min_by(F.struct(F.col(col).alias("v")), F.col(order)).alias("_first"))
    j = attach_state(df, first, group, "left")
    return j.withColumn(col, F.coalesce(F.col(col), F.col("_first.v"))).drop("_first")


# ------------------------------------------------------------------ I7–I11 nearest neighbours
def _knn_distance(feats: Sequence[str], m_total: int, rp: str = "_r_", dp: str = "_d_") -> Column:
    """NaN-aware distance: sqrt(m_total / present · Σ_present (a − b)²), null when nothing is comparable."""
    sq = None
    present = None
    for f in feats:
        both = F.col(f"{dp}{f}").isNotNull() & F.col(f"{rp}{f}").isNotNull()
        diff = F.col(f"{dp}{f}") - F.col(f"{rp}{f}")
        term = F.when(both, diff * diff).otherwise(F.lit(0.0))
        cnt = F.when(both, F.lit(1)).otherwise(F.lit(0))
        sq = term if sq is None else sq + term
        present = cnt if present is None else present + cnt
    return F.when(present > 0, F.sqrt(F.lit(float(m_total)) / present * sq))


def _weighted_estimate(top: DataFrame) -> DataFrame:
    """Distance-weighted mean of the k chosen donors; zero-distance donors take all the weight."""
    agg = top.groupBy("_rk").agg(
        F.max(F.when(F.col("_dist") == 0, 1).otherwise(0)).alias("_z"),
        F.sum(F.when(F.col("_dist") == 0, F.col("_dv")).otherwise(0.0)).alias("_zs"),
        F.sum(F.when(F.col("_dist") == 0, 1).otherwise(0)).alias("_zn"),
        F.sum(F.when(F.col("_dist") > 0, F.col("_dv") / F.col("_dist")).otherwise(0.0)).alias("_ws"),
        F.sum(F.when(F.col("_dist") > 0, F.lit(1.0) / F.col("_dist")).otherwise(0.0)).alias("_wn"))
    val = F.when(F.col("_z") == 1, F.col("_zs") / F.col("_zn")).otherwise(F.col("_ws") / F.col("_wn"))
    return agg.select("_rk", val.alias("_knn"))


def _top_k(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("_rk").orderBy("_dist", "_dk")
    return pairs.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def _pattern(feats: Sequence[str], prefix: str) -> Column:
    out = F.lit(0)
    for i, f in enumerate(feats):
        out = out + F.when(F.col(f"{prefix}{f}").isNotNull(), F.lit(1 << i)).otherwise(F.lit(0))
    return out


#: Donors that the splits are fitted on, most leaves, and donors of a leaf in units of k.
TREE_SAMPLE, MAX_LEAVES, LEAF_K = 100_000, 20_000, 4
#: A leaf with over so many times its intended donors is split again, into so many parts a level, for so many levels.
SPLIT_OVER, SPLIT_BITS, SPLIT_LEVELS = 4, 4, 11
#: Times that a point must be in the sample before many donors are taken to share it.
TIED_SEEN = 3
#: Added to the tree's leaf numbers: a child's number is its parent's, shifted, and the part, so this first bit tells the levels apart.
TOP_NODE = 1 << 18


class DonorTree:
    """k-d trees over donors, one per view and null pattern: splits at sample medians, boxes from all donors.

    A view is the set of columns that its receivers have (a bit mask), its donors are what such a receiver
    can tell apart, and a receiver looks in the trees of its own view only. ``patterns`` are views times 2^m
    plus the donors' null pattern.

    Nodes are arrays: split column and value, children, leaf number, number of
    donors, and the box of their coordinates (NaN in columns that the pattern
    does not have). A pattern's tree spans all its columns; a receiver that
    lacks some of them is compared in the common ones, in which a box is still
    a bound.
    """

    def __init__(self, sample: np.ndarray, patterns: np.ndarray, counts: dict[int, int], leaf_donors: int):
        self.m = sample.shape[1]
        self.dim, self.cut, self.left, self.right, self.leaf = [], [], [], [], []
        self.roots: dict[int, int] = {}
        self.leaves = 0
        total = sum(counts.values())
        for q, n in sorted(counts.items()):
            own = sample[patterns == q]
            most = min(-(-n // leaf_donors), max(1, MAX_LEAVES * n // total), max(1, len(own)))
            self.roots[q] = self._build(own, [i for i in range(self.m) if q >> i & 1], max(1, most))
        self.codes = np.array(list(self.roots), dtype=np.int64)  # ascending
        self.root = np.array(list(self.roots.values()), dtype=np.int64)
        self.dim, self.left, self.right, self.leaf = (np.array(x, dtype=np.int64) for x in (self.dim, self.left, self.right, self.leaf))
        self.cut = np.array(self.cut)

    def _build(self, rows: np.ndarray, dims: list[int], leaves: int) -> int:
        at = len(self.dim)
        for x, v in ((self.dim, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.leaf, -1)):
            x.append(v)
        spread = sorted(((rows[:, i].max() - rows[:, i].min(), -i) for i in dims), reverse=True) if len(rows) > 1 and leaves > 1 else []
        for width, i in spread:
            if width <= 0:
                break
            x = rows[:, -i]
            cut = np.median(x)
            if cut >= x.max():
                cut = x[x < x.max()].max()
            low = x <= cut
            self.dim[at], self.cut[at] = -i, cut
            self.left[at] = self._build(rows[low], dims, -(-leaves // 2))
            self.right[at] = self._build(rows[~low], dims, leaves // 2)
            return at
        self.leaf[at] = self.leaves
        self.leaves += 1
        return at

    def leaf_of(self, x: np.ndarray, patterns: np.ndarray) -> np.ndarray:
        node = self.root[np.searchsorted(self.codes, patterns)]
        while True:
            inner = np.flatnonzero(self.dim[node] >= 0)
            if not len(inner):
                return self.leaf[node]
            n = node[inner]
            node[inner] = np.where(x[inner, self.dim[n]] <= self.cut[n], self.left[n], self.right[n])

    def set_boxes(self, leaf: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        size = len(self.dim)
        self.n, self.low, self.high = np.zeros(size, np.int64), np.full((size, self.m), np.nan), np.full((size, self.m), np.nan)
        node_of = {v: i for i, v in enumerate(self.leaf.tolist()) if v >= 0}
        at = [node_of[v] for v in leaf.tolist()]
        self.n[at], self.low[at], self.high[at] = n, low, high
        for i in range(size - 1, -1, -1):  # children come after their parent
            if self.dim[i] >= 0:
                kids = [self.left[i], self.right[i]]
                self.n[i] = self.n[kids].sum()
                self.low[i], self.high[i] = np.fmin(*self.low[kids]), np.fmax(*self.high[kids])

    def bound(self, x: np.ndarray, node: np.ndarray, m_total: int) -> np.ndarray:
        """Least distance of each row of x to any donor of its node; infinite if nothing is comparable."""
        gap = np.fmax(np.fmax(self.low[node] - x, x - self.high[node]), 0.0)
        common = ~np.isnan(x) & ~np.isnan(self.low[node])
        present = common.sum(axis=1)
        sq = np.where(common, gap, 0.0) ** 2
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where((present > 0) & (self.n[node] > 0), np.sqrt(m_total / present * sq.sum(axis=1)), np.inf)

    def _views(self, x: np.ndarray, views: np.ndarray | None) -> np.ndarray:
        return np.full(len(x), (1 << self.m) - 1) if views is None else views

    def near_leaves(self, x: np.ndarray, k: int, m_total: int, views: np.ndarray | None = None) -> list[np.ndarray]:
        """Leaves that hold at least k comparable donors near each row (all comparable ones if there are fewer)."""
        count, roots = len(x), self.root
        views = self._views(x, views)
        lb = np.stack([np.where(views == q >> self.m, self.bound(x, np.full(count, r), m_total), np.inf) for q, r in zip(self.codes, roots)], axis=1)
        enough = np.where(self.n[roots][None, :] >= k, lb, np.inf)
        node = np.where(np.isfinite(enough).any(axis=1), roots[enough.argmin(axis=1)], -1)
        alone = np.flatnonzero(node < 0)
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * count
        for i in alone:
            out[i] = self._below(roots[np.isfinite(lb[i])])
        todo = np.flatnonzero(node >= 0)
        while len(todo):
            n = node[todo]
            inner = self.dim[n] >= 0
            todo, n = todo[inner], n[inner]
            kids = np.stack([self.left[n], self.right[n]], axis=1)
            d = np.stack([np.where(self.n[kids[:, j]] >= k, self.bound(x[todo], kids[:, j], m_total), np.inf) for j in (0, 1)], axis=1)
            pick = d.argmin(axis=1)
            go = np.isfinite(d[np.arange(len(d)), pick])
            todo, pick, kids = todo[go], pick[go], kids[go]
            node[todo] = kids[np.arange(len(kids)), pick]
        for i in np.flatnonzero(node >= 0):
            out[i] = self._below(node[i:i + 1])
        return out

    def _below(self, nodes: np.ndarray) -> np.ndarray:
        found, todo = [], np.asarray(nodes)
        while len(todo):
            found.append(self.leaf[todo[self.dim[todo] < 0]])
            inner = todo[self.dim[todo] >= 0]
            todo = np.concatenate([self.left[inner], self.right[inner]])
        got = np.concatenate(found) if found else np.zeros(0, np.int64)
        return got

    def leaves_within(self, x: np.ndarray, distance: np.ndarray, m_total: int, views: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that may hold a donor at most so far from the row."""
        row, at = np.nonzero(self._views(x, views)[:, None] == self.codes[None, :] >> self.m)
        node = self.root[at]
        rows, leaves = [], []
        while len(node):
            # a hair more than the distance, for the rounding of the last digits
            ok = self.bound(x[row], node, m_total) <= distance[row] * (1 + 1e-9)
            row, node = row[ok], node[ok]
            end = self.dim[node] < 0
            rows.append(row[end]), leaves.append(self.leaf[node[end]])
            row, node = np.repeat(row[~end], 2), np.stack([self.left[node[~end]], self.right[node[~end]]], axis=1).ravel()
        return np.concatenate(rows) if rows else row, np.concatenate(leaves) if leaves else node


def _first_k(don: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    """Of donors with the same coordinates the first k by key: no other can be among the k nearest of any row."""
    same = Window.partitionBy(*cols).orderBy("_dk")
    return don.withColumn("_nth", F.row_number().over(same)).filter(F.col("_nth") <= k).drop("_nth")


def _hash_sample(don: DataFrame, share: Column, cols: Sequence[str]) -> pd.DataFrame:
    place = F.shiftrightunsigned(F.xxhash64("_dk", F.lit("sample")), 11).cast("double") / float(1 << 53)
    return don.filter(place < share).select(*cols).limit(4 * TREE_SAMPLE).toPandas()


def _tied_views(don: DataFrame, cols: Sequence[str], k: int, patterns: Sequence[int]) -> list[int]:
    """Receivers' null patterns in whose columns many donors, more than a leaf should hold, have the same coordinates.

    Judged from a sample; a wrong guess costs time, not results."""
    total = don.count()
    x = _hash_sample(don, F.lit(TREE_SAMPLE / max(total, 1)), cols)
    tied = []
    for p in patterns:
        own = [c for i, c in enumerate(cols) if p >> i & 1]
        most = int(x.groupby(own, dropna=False).size().max()) if len(x) and len(own) < len(cols) else 0
        if most >= TIED_SEEN and most * total > SPLIT_OVER * LEAF_K * k * len(x):
            tied.append(p)
    return tied


def _seen_donors(don: DataFrame, feats: Sequence[str], k: int, tied: Sequence[int]) -> DataFrame:
    """Donors by view (``_q``, see ``DonorTree``): all of them in the view of all columns, and for each tied pattern
    those that a receiver with only its columns can tell apart."""
    m, cols, q = len(feats), [f"_d_{f}" for f in feats], _pattern(feats, "_d_")
    parts = [don.withColumn("_q", q + F.lit(((1 << m) - 1) << m).cast("long")).filter(q > 0)]
    for p in tied:
        own = don.select("_dk", "_dv", *[F.col(c) if p >> i & 1 else F.lit(None).cast("double").alias(c) for i, c in enumerate(cols)]).filter(q > 0)
        parts.append(_first_k(own, [c for i, c in enumerate(cols) if p >> i & 1], k).withColumn("_q", q + F.lit(p << m).cast("long")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return cut_lineage(out) if tied else out


def _donor_tree(don: DataFrame, feats: Sequence[str], k: int, tied: Sequence[int] = ()) -> tuple[DonorTree, DataFrame]:
    """The tree, with a view for each tied null pattern, and its donors with their leaf (``_leaf``)."""
    cols = [f"_d_{f}" for f in feats]
    don = _seen_donors(don, feats, k, tied)
    counts = {int(r["_q"]): int(r["n"]) for r in don.groupBy("_q").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    # a sample by hash of about TREE_SAMPLE rows, and at least a few hundred of each pattern
    need = {q: max(TREE_SAMPLE * n // max(total, 1), 300) / n for q, n in counts.items()}
    share = F.lit(0.0)
    for q, x in need.items():
        share = F.when(F.col("_q") == q, F.lit(float(x))).otherwise(share)
    rows = _hash_sample(don, share, ["_q", *cols])
    tree = DonorTree(rows[cols].to_numpy(np.float64).reshape(-1, len(cols)), rows["_q"].to_numpy(np.int64), counts, LEAF_K * k)

    shared = don.sparkSession.sparkContext.broadcast(tree)  # at most 2 * MAX_LEAVES nodes

    @F.pandas_udf("long")
    def leaf(q: pd.Series, *xs: pd.Series) -> pd.Series:
        x = np.column_stack([v.to_numpy(np.float64) for v in xs])
        return pd.Series(shared.value.leaf_of(x, q.to_numpy(np.int64)))

    placed = don.withColumn("_leaf", leaf("_q", *cols)).drop("_q")
    boxes = placed.groupBy("_leaf").agg(*_box(cols)).toPandas()
    m = len(cols)
    tree.set_boxes(boxes["_leaf"].to_numpy(np.int64), boxes["n"].to_numpy(np.int64),
                   boxes[[f"lo{i}" for i in range(m)]].to_numpy(np.float64).reshape(-1, m),
                   boxes[[f"hi{i}" for i in range(m)]].to_numpy(np.float64).reshape(-1, m))
    return tree, placed


def _box(cols: Sequence[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
            *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]]


def _split_leaves(placed: DataFrame, cols: Sequence[str], leaf_donors: int, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """Leaves of over SPLIT_OVER * leaf_donors donors cut again, level by level, until none is left.

    The tree on the driver has at most MAX_LEAVES leaves, so its leaves grow
    with the donors; these levels do not. Each cuts a large leaf at quantiles
    of its widest column (one aggregate over all large leaves) and is a table
    of parent, child, donors and box, joined to the receivers on the parent.
    ``_leaf`` of a donor is then the number of its last node: the parent's, shifted,
    and the part. ``most``: donors of the largest leaf. A leaf that is still
    large after SPLIT_LEVELS stays as it is, which costs time, not results.
    """
    levels: list[DataFrame] = []
    parts = 1 << SPLIT_BITS
    wide = F.greatest(*[F.coalesce(F.col(f"hi{i}") - F.col(f"lo{i}"), F.lit(-1.0)) for i in range(len(cols))], F.lit(-1.0))
    while most > SPLIT_OVER * leaf_donors and len(levels) < SPLIT_LEVELS:
        box = placed.groupBy("_leaf").agg(*_box(cols)).filter(F.col("n") > SPLIT_OVER * leaf_donors).withColumn("_wide", wide)
        dim, low, high = F.lit(-1), F.lit(None).cast("double"), F.lit(None).cast("double")
        for i in range(len(cols)):
            is_wide = (F.col(f"hi{i}") - F.col(f"lo{i}")) == F.col("_wide")
            dim = F.when(is_wide, i).otherwise(dim)
            low, high = F.when(is_wide, F.col(f"lo{i}")).otherwise(low), F.when(is_wide, F.col(f"hi{i}")).otherwise(high)
        large = box.filter("_wide > 0").select("_leaf", dim.alias("_dim"), low.alias("_low"), high.alias("_high"))
        x = F.lit(None).cast("double")
        for i, c in enumerate(cols):
            x = F.when(F.col("_dim") == i, F.col(c)).otherwise(x)
        inside = placed.join(large, "_leaf").withColumn("_x", x)
        cuts = inside.groupBy("_leaf").agg(
            F.first("_dim").alias("_dim"), F.first("_low").alias("_low"), F.first("_high").alias("_high"),
            F.percentile_approx("_x", [i / parts for i in range(1, parts)], 1000).alias("_cuts"))
        # the least value and the middle, so that a leaf of which most lies in one value is divided as well
        some = F.array_distinct(F.filter("_cuts", lambda c: c < F.col("_high")))
        spare = F.filter(F.array("_low", (F.col("_low") + F.col("_high")) / 2.0), lambda c: c < F.col("_high"))
        cuts = cuts.select("_leaf", "_dim", F.when(F.size(some) > 0, some).otherwise(F.array_distinct(spare)).alias("_cuts"))
        part = F.size(F.filter("_cuts", lambda c: c < F.col("_x"))).cast("long")
        child = F.when(F.col("_cuts").isNull(), F.col("_leaf")).otherwise(F.shiftleft("_leaf", SPLIT_BITS) + part)
        placed = cut_lineage(placed.join(cuts, "_leaf", "left").withColumn("_x", x)
                             .withColumn("_up", F.when(F.col("_cuts").isNotNull(), F.col("_leaf")))
                             .withColumn("_leaf", child).drop("_dim", "_cuts", "_x"))
        kids = placed.filter("_up IS NOT NULL").groupBy("_up", "_leaf").agg(*_box(cols))
        entry = F.struct("_leaf", "n", *[f"{e}{i}" for i in range(len(cols)) for e in ("lo", "hi")])
        level = cut_lineage(kids.groupBy("_up").agg(F.collect_list(entry).alias("_kids"), F.max("n").alias("n")))
        placed = placed.drop("_up")
        top = fit_row(level, F.max("n").alias("n"))["n"]
        if top is None:  # nothing was left to cut
            break
        levels.append(level.drop("n"))
        most = top
    return placed, levels


def _descend(met: DataFrame, levels: list[DataFrame], pick: Callable[[Column], Column]) -> DataFrame:
    """Receivers' leaves of the tree (``_leaf``) taken down the levels; ``pick`` names the children to go on with."""
    for level in levels:
        on = F.when(F.col("_kids").isNull(), F.array("_leaf")).otherwise(pick(F.col("_kids")))
        both = met.join(level, F.col("_leaf") == F.col("_up"), "left")
        met = both.select(*[c for c in met.columns if c != "_leaf"], F.explode(on).alias("_leaf"))
    return met


def _box_bound(feats: Sequence[str], m_total: int, box: Column) -> Column:
    """Least distance of a receiver to any donor of a box."""
    sq, present = F.lit(0.0), F.lit(0)
    for i, f in enumerate(feats):
        x, low, high = F.col(f"_r_{f}"), box[f"lo{i}"], box[f"hi{i}"]
        both = x.isNotNull() & low.isNotNull()
        gap = F.greatest(low - x, x - high, F.lit(0.0))
        sq = sq + F.when(both, gap * gap).otherwise(0.0)
        present = present + F.when(both, 1).otherwise(0)
    return F.sqrt(F.lit(float(m_total)) / present * sq)


def _receiver_leaves(rec: DataFrame, feats: Sequence[str], tree: DonorTree, k: int, m_total: int) -> tuple[DataFrame, Callable]:
    """Receivers with the tree's leaves of the first look, and a function that gives those of the second, up to a distance."""
    cols = [f"_r_{f}" for f in feats]
    shared = rec.sparkSession.sparkContext.broadcast(tree)

    @F.pandas_udf("array<long>")
    def near(view: pd.Series, *xs: pd.Series) -> pd.Series:
        x = np.column_stack([v.to_numpy(np.float64) for v in xs])
        return pd.Series([v + TOP_NODE for v in shared.value.near_leaves(x, k, m_total, view.to_numpy(np.int64))], dtype=object)

    @F.pandas_udf("array<long>")
    def within(distance: pd.Series, view: pd.Series, *xs: pd.Series) -> pd.Series:
        x = np.column_stack([v.to_numpy(np.float64) for v in xs])
        row, leaf = shared.value.leaves_within(x, distance.to_numpy(np.float64), m_total, view.to_numpy(np.int64))
        order = np.argsort(row, kind="stable")
        ends = np.searchsorted(row[order], np.arange(len(x) + 1))
        leaf = leaf[order] + TOP_NODE
        return pd.Series([leaf[ends[i]:ends[i + 1]] for i in range(len(x))], dtype=object)

    return rec.withColumn("_first", near("_view", *cols)), lambda frame, distance: frame.withColumn("_all", within(distance, "_view", *cols))


def knn_impute(df: DataFrame, key: str, target: str, features: Sequence[str], k: int = 5,
               donors: DataFrame | None = None, out: str | None = None) -> DataFrame:
    """Fill ``target`` nulls from the k nearest donors (rows with target present).

    Distance over the columns [features..., target]: sqrt(m_total / m_present
    · Σ_present (a − b)²) where present = coordinates non-null in both rows
    (the receiver's target is null, so m_total = len(features) + 1).
    Ties in distance break on the donor key. Receivers without any comparable
    donor get the donor mean.

    Exact, by two joins on the leaves of ``DonorTree``: each receiver first
    meets the donors of the leaves around it, at least k of them, whose k-th
    distance bounds the answer; then those of every leaf whose box is not
    farther. Splits are medians, and leaves that are still large are split
    again by ``_split_leaves``, so leaves hold a few times k donors however
    many there are and however the values spread; of donors with the same coordinates only the
    first k by key can count and only they are kept, so a point that many
    share is no large leaf. A receiver without some column cannot tell donors
    apart that differ only there, and all of these are equally far: where many
    are, receivers of that null pattern look among the first k of each such
    point (``_tied_views``), not among all of them, whose number grows with the table.
    """
    out = out or target
    donors = df if donors is None else donors
    feats = list(features)
    m_total = len(feats) + 1
    all_donors = donors.filter(F.col(target).isNotNull()).select(
        F.col(key).alias("_dk"), _d(target).alias("_dv"), *[_d(f).alias(f"_d_{f}") for f in feats])
    rec = (df.filter(F.col(target).isNull()).select(F.col(key).alias("_rk"), *[_d(f).alias(f"_r_{f}") for f in feats])
           .withColumn("_view", _pattern(feats, "_r_")).filter("_view > 0"))
    col_mean = fit_row(all_donors, F.avg("_dv").alias("m"))["m"]
    cols = [f"_d_{f}" for f in feats]
    don = cut_lineage(_first_k(all_donors, cols, k))
    tied = _tied_views(don, cols, k, [r["_view"] for r in rec.select("_view").distinct().collect()])
    rec = rec.withColumn("_view", F.when(F.col("_view").isin(tied), F.col("_view")).otherwise(F.lit((1 << len(feats)) - 1)))
    tree, placed = _donor_tree(don, feats, k, tied)
    if not tree.roots:
        return df.withColumn(out, F.coalesce(_d(target), F.lit(col_mean).cast("double")))
    rcols = [f"_r_{f}" for f in feats]
    most = int(tree.n[tree.leaf >= 0].max())
    placed, levels = _split_leaves(cut_lineage(placed.withColumn("_leaf", F.col("_leaf") + TOP_NODE)), cols, LEAF_K * k, most)
    dist = _knn_distance(feats, m_total)

    def nearest(kids: Column) -> Column:
        enough = F.filter(kids, lambda e: e["n"] >= k)
        best = F.array_min(F.transform(enough, lambda e: F.struct(_box_bound(feats, m_total, e).alias("b"), e["_leaf"].alias("v"))))
        return F.when(F.size(enough) > 0, F.array(best["v"])).otherwise(F.transform(kids, lambda e: e["_leaf"]))

    def not_farther(kids: Column) -> Column:
        reached = F.filter(kids, lambda e: _box_bound(feats, m_total, e) <= F.col("_far") * (1 + 1e-9))
        return F.transform(reached, lambda e: e["_leaf"])

    first, add_within = _receiver_leaves(rec, feats, tree, k, m_total)
    first = cut_lineage(first)
    near = _descend(first.select("_rk", *rcols, F.explode("_first").alias("_leaf")), levels, nearest)
    pairs = near.join(placed, "_leaf").select("_rk", "_dk", "_dv", dist.alias("_dist")).filter("_dist IS NOT NULL")
    top = cut_lineage(_top_k(pairs, k))
    reach = top.groupBy("_rk").agg(F.max("_dist").alias("_far"), F.count(F.lit(1)).alias("_n"))
    full = reach.filter(F.col("_n") >= k).drop("_n")
    # few bytes that become many rows: spread before they do
    second = add_within(first.drop("_first").join(full, "_rk").repartition(_partitions(df, None), "_rk"), F.col("_far"))
    second = _descend(second.select("_rk", "_far", *rcols, F.explode("_all").alias("_leaf")), levels, not_farther)
    # the second look meets the donors of the first again; only those that are no farther go into the sort
    closer = second.join(placed, "_leaf").withColumn("_dist", dist).filter(F.col("_dist") <= F.col("_far")).select("_rk", "_dk", "_dv", "_dist")
    few = top.join(reach.filter(F.col("_n") < k).select("_rk"), "_rk", "left_semi")
    est = _weighted_estimate(few.unionByName(_top_k(closer, k)))
    j = df.join(est, F.col(key) == F.col("_rk"), "left").drop("_rk")
    filled = F.coalesce(_d(target), F.col("_knn"), F.when(F.col(target).isNull(), F.lit(col_mean)))
    return j.withColumn(out, filled).drop("_knn")


def knn_impute_scaled(df: DataFrame, key: str, target: str, features: Sequence[str], k: int = 5,
                      train: DataFrame | None = None, stats_digits: int | None = None) -> DataFrame:
    """I8: I7 on features and target standardised with train statistics
    (population std), then the estimate is scaled back."""
    from valuator.operators.profile import fit_standard
    train = df if train is None else train
    cols = [*features, target]
    st = fit_standard(train, cols, ddof=0)
    if stats_digits is not None:  # fixed-precision state: identical arithmetic in any engine
        st = {c: (round(m, stats_digits), round(sd, stats_digits)) for c, (m, sd) in st.items()}
    z = df.withColumns({f"_z_{c}": (_d(c) - F.lit(st[c][0])) / F.lit(st[c][1] or 1.0) for c in cols})
    filled = knn_impute(z, key, f"_z_{target}", [f"_z_{f}" for f in features], k)
    m, s = st[target]
    back = F.col(f"_z_{target}") * F.lit(s or 1.0) + F.lit(m)
    return filled.withColumn(target, F.coalesce(_d(target), back)).drop(*[f"_z_{c}" for c in cols])


def knn_floor_value(df: DataFrame, target: str) -> float:
    """I9 floor: max(0.5 · min(observed), 1)."""
    mn = fit_row(df, F.min(_d(target)).alias("m"))["m"]
    return max(0.5 * mn, 1.0) if mn is not None else 1.0


def knn_impute_floor(df: DataFrame, key: str, target: str, features: Sequence[str], k: int = 5) -> DataFrame:
    """I7, then every value (new and existing) below max(0.5·min, 1) is
    raised to it; with ≤ k donors the median (at least the floor) fills, and
    without any donor the floor, which is then 1."""
    floor = knn_floor_value(df, target)
    n_donors = df.filter(F.col(target).isNotNull()).count()
    if n_donors <= k:
        # the reference's own switch: too few donors to choose from
        med = fit_quantiles(df, [target], [0.5])[target]
        filled = df.withColumn(target, F.coalesce(_d(target), F.lit(max(med[0], floor) if med else floor)))
    else:
        filled = knn_impute(df, key, target, features, k)
    return filled.withColumn(target, F.when(F.col(target) < F.lit(floor), F.lit(floor)).otherwise(F.col(target)))


def knn_impute_corr_blend(df: DataFrame, key: str, target: str, candidates: Sequence[str], k: int = 5,
                          threshold: float = 0.3, max_features: int = 3) -> DataFrame:
    """Features with |corr(feature, target)| > threshold (strongest
    first, at most 3); estimate = mean of the KNN estimate and the
    |corr|-weighted average of the row's own feature values, missing ones being
    filled from their own nearest donors; then the floor."""
    r = fit_row(df, *[F.corr(_d(c), _d(target)).alias(c) for c in candidates])
    ranked_feats = sorted([(abs(r[c]), c) for c in candidates if r[c] is not None and not math.isnan(r[c])
                           and abs(r[c]) > threshold], key=lambda t: (-t[0], t[1]))[:max_features]
    feats = [c for _, c in ranked_feats] or list(candidates)
    weights = {c: a for a, c in ranked_feats} or {c: 1.0 for c in feats}
    floor = knn_floor_value(df, target)
    # only rows to fill need their own missing features, and any row that has one can give it
    rows = df.filter(F.col(target).isNull()).select(key, target, *feats)
    own = rows
    for f in feats:
        others = [c for c in feats if c != f] + [target]
        est = knn_impute(rows, key, f, others, k, donors=df, out="_own").select(F.col(key).alias("_k"), F.col("_own").alias(f"_own_{f}"))
        own = own.join(est, F.col(key) == F.col("_k"), "left").drop("_k")
    wsum = sum(weights.values())
    lin = sum((F.col(f"_own_{c}") * F.lit(w) for c, w in weights.items()), F.lit(0.0)) / F.lit(wsum)
    own = own.select(F.col(key).alias("_k"), lin.alias("_lin"))
    knn = knn_impute(df, key, target, feats, k, out="_knn_est").join(own, F.col(key) == F.col("_k"), "left").drop("_k")
    v = F.coalesce(_d(target), (F.col("_knn_est") + F.col("_lin")) / 2.0)
    return knn.withColumn(target, F.when(v < F.lit(floor), F.lit(floor)).otherwise(v)).drop("_knn_est", "_lin")


def impute_outliers_iqr(df: DataFrame, key: str, target: str, features: Sequence[str], k: int = 5) -> DataFrame:
    """I11 (intent of the reference): after I9, values outside
    [max(Q1 − 1.5·IQR, floor), Q3 + 1.5·IQR] are nulled and re-imputed from
    donors inside the range (the reference's second pass refits on the
    pre-fill copy, returning originals; we implement the stated intent)."""
    first = knn_impute_floor(df, key, target, features, k)
    floor = knn_floor_value(df, target)
    first = cut_lineage(first)  # read again by the second pass
    q1, q3 = fit_quantiles(first, [target], [0.25, 0.75])[target] or (floor, floor)
    lo, hi = max(q1 - 1.5 * (q3 - q1), floor), q3 + 1.5 * (q3 - q1)
    nulled = first.withColumn(target, F.when((F.col(target) < lo) | (F.col(target) > hi), F.lit(None))
                              .otherwise(F.col(target)))
    return knn_impute_floor(nulled, key, target, features, k)


# ------------------------------------------------------------------ I12, I13, I15 (Spark ML)
def select_features_for_impute(df: DataFrame, target: str, candidates: Sequence[str], top: int = 3,
                               seed: int = 42, trees: int = 100) -> list[str]:
    """Top features by random-forest importance on complete rows; without
    two complete rows there is no forest, and the F-score orders them;
    topped up from the rest."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    complete = df.dropna(subset=[*candidates, target]).withColumns({c: _d(c) for c in [*candidates, target]})
    if complete.limit(2).count() == 2:
        va = VectorAssembler(inputCols=list(candidates), outputCol="_fv")
        m = RandomForestRegressor(featuresCol="_fv", labelCol=target, numTrees=trees, maxDepth=6, seed=seed).fit(
            va.transform(complete))
        imp = m.featureImportances.toArray()
        order = [c for _, c in sorted(zip(-imp, candidates))]
    else:
        from valuator.operators.profile import f_score_select
        order = [r["feature"] for r in f_score_select(df, candidates, target).orderBy("rank").collect()]
    return order[:top] + [c for c in candidates if c not in order[:top]]


def impute_model(df: DataFrame, target: str, features: Sequence[str], seed: int = 42,
                 min_rows: int = 10, num_trees: int = 50) -> DataFrame:
    """Random forest trained on rows where target and features are
    known, predicting rows where the target is null (features null -> their
    training median first); skipped when fewer than ``min_rows`` rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    known = df.filter(F.col(target).isNotNull())
    if known.limit(min_rows).count() < min_rows:
        return df
    feats = list(features)
    imp_cols = [f"_i_{f}" for f in feats]
    pipe = Pipeline(stages=[
        Imputer(inputCols=feats, outputCols=imp_cols, strategy="median"),
        VectorAssembler(inputCols=imp_cols, outputCol="_fv"),
        RandomForestRegressor(featuresCol="_fv", labelCol=target, predictionCol="_pred", numTrees=num_trees,
                              maxDepth=8, seed=seed)])
    cast = df.withColumns({f: _d(f) for f in feats}).withColumn(target, _d(target))
    model = pipe.fit(cast.filter(F.col(target).isNotNull()))
    scored = model.transform(cast)
    return scored.withColumn(target, F.coalesce(F.col(target), F.col("_pred"))).drop("_fv", "_pred", *imp_cols)


def impute_selected_model(df: DataFrame, target: str, candidates: Sequence[str], ratio: float = 0.2,
                          seed: int = 42, folds: int = 3, select: str = "f_score") -> tuple[DataFrame, str]:
    """I15 (re-aimed): keep the top ``ratio`` of candidates (at least one) by
    ``select``: f_score, mutual_info or forest (importance); pick the best of {linear, forest, boosted trees} by k-fold
    RMSE with ``CrossValidator``, predict the nulls."""
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import Imputer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from valuator.operators.profile import f_score_select, mutual_info_select
    from valuator.operators.train import training_rows
    n_keep = max(1, int(len(candidates) * ratio))
    if select == "f_score":
        feats = [r["feature"] for r in f_score_select(df, candidates, target, n_keep).orderBy("rank").collect()]
    elif select == "mutual_info":
        feats = [r["feature"] for r in mutual_info_select(df, candidates, target, k=n_keep).collect()] or list(candidates)[:n_keep]
    elif select == "forest":
        feats = select_features_for_impute(df, target, candidates, n_keep, seed)[:n_keep]
    else:
        raise ValueError("select must be f_score|mutual_info|forest")
    cast = df.withColumns({f: _d(f) for f in feats}).withColumn(target, _d(target))
    known, _n = training_rows(cast.filter(F.col(target).isNotNull()), [*feats, target])
    best_name, best_rmse, best_model = None, float("inf"), None
    for name, est in (("linear", LinearRegression(featuresCol="_fv", labelCol=target, predictionCol="_pred")),
                      ("forest", RandomForestRegressor(featuresCol="_fv", labelCol=target, predictionCol="_pred",
                                                       numTrees=30, seed=seed)),
                      ("boosted", GBTRegressor(featuresCol="_fv", labelCol=target, predictionCol="_pred",
                                               maxIter=30, seed=seed))):
        pipe = Pipeline(stages=[Imputer(inputCols=feats, outputCols=[f"_i_{f}" for f in feats], strategy="median"),
                                VectorAssembler(inputCols=[f"_i_{f}" for f in feats], outputCol="_fv"), est])
        ev = RegressionEvaluator(labelCol=target, predictionCol="_pred", metricName="rmse")
        cv = CrossValidator(estimator=pipe, estimatorParamMaps=ParamGridBuilder().build(), evaluator=ev,
                            numFolds=folds, seed=seed)
        m = cv.fit(known)
        if m.avgMetrics[0] < best_rmse:
            best_name, best_rmse, best_model = name, m.avgMetrics[0], m.bestModel
    known.unpersist()
    scored = best_model.transform(cast)
    out = scored.withColumn(target, F.coalesce(F.col(target), F.col("_pred")))
    return out.drop("_fv", "_pred", *[f"_i_{f}" for f in feats]), best_name


# ------------------------------------------------------------------ I14
def impute_cluster_median(df: DataFrame, target: str, features: Sequence[str], k: int = 3,
                          seed: int = 42, per_row: bool = False) -> DataFrame:
    """Z-score features (sample std), k-means on rows with the target,
    assign the null rows, fill every null with the median target of the most
    frequent assigned cluster (ties: lowest id); with ``per_row``, each null
    with the median of its own cluster."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    st = fit_row(df, *[F.avg(_d(f)).alias(f"m_{f}") for f in features],
                 *[F.stddev_samp(_d(f)).alias(f"s_{f}") for f in features])
    z = df.withColumns({f"_z_{f}": (_d(f) - F.lit(st[f"m_{f}"])) / F.lit(st[f"s_{f}"] or 1.0) for f in features})
    z = z.fillna({f"_z_{f}": 0.0 for f in features})
    va = VectorAssembler(inputCols=[f"_z_{f}" for f in features], outputCol="_fv")
    zv = va.transform(z)
    model = KMeans(k=k, seed=seed, featuresCol="_fv", predictionCol="_cl").fit(zv.filter(F.col(target).isNotNull()))
    lab = model.transform(zv)
    med = group_quantiles(lab.filter(F.col(target).isNotNull()), ["_cl"], _d(target), [0.5]).select(
        "_cl", F.col("_q")[0].alias("_med"))
    top = (lab.filter(F.col(target).isNull()).groupBy("_cl").agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.col("_n").desc(), "_cl").limit(1))
    fill = top.join(med, "_cl").select("_med")
    fallback = fit_quantiles(df, [target], [0.5])[target]
    if per_row:
        labelled = attach_state(lab, med, "_cl", "left").withColumn(
            target, F.coalesce(_d(target), F.col("_med"), F.lit(fallback[0] if fallback else None)))
        return labelled.select(*df.columns)
    rows = fill.collect()
    value = rows[0]["_med"] if rows else (fallback[0] if fallback else None)
    return df.withColumn(target, F.coalesce(_d(target), F.lit(value)))


# ------------------------------------------------------------------ I16–I21
def quantile_snap(x: str | Column, knots: Sequence[float], upper: float, steep: float = 12.0) -> Column:
    """I16: map an estimate onto the training quantile profile: below the
    first knot -> first knot, above the last -> last; between knots a logistic
    blend 1/(1+exp(−steep·(α − 0.5))); clamp to [0, upper]."""
    v = F.col(x) if isinstance(x, str) else x
    q = [float(t) for t in knots]
    expr = F.when(v <= F.lit(q[0]), F.lit(q[0]))
    for i in range(1, len(q)):
        a = (v - F.lit(q[i - 1])) / F.lit(q[i] - q[i - 1]) if q[i] != q[i - 1] else F.lit(0.0)
        s = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-steep) * (a - F.lit(0.5))))
        expr = expr.when(v <= F.lit(q[i]), F.lit(q[i - 1]) + s * F.lit(q[i] - q[i - 1]))
    expr = expr.otherwise(F.lit(q[-1]))
    clipped = F.when(expr < 0, F.lit(0.0)).otherwise(expr)
    return F.when(v.isNull(), F.lit(None)).otherwise(F.when(clipped > F.lit(upper), F.lit(upper)).otherwise(clipped))


def impute_stats(raw: DataFrame, filled: DataFrame, key: str, cols: Sequence[str],
                 floor: dict[str, float] | None = None) -> DataFrame:
    """Per column initial nulls, filled, final nulls and values raised to
    the floor (one aggregate on each side, unpivoted); errors = 0 here since
    failures raise instead of being logged."""
    floor = floor or {}
    a = raw.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols]).unpivot([], list(cols), "feature", "initial_missing")
    b = filled.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols]).unpivot([], list(cols), "feature", "final_missing")
    adj = raw.agg(*[F.count(F.when(_d(c) < F.lit(floor.get(c, float("-inf"))), 1)).alias(c) for c in cols]
                  ).unpivot([], list(cols), "feature", "adjusted")
    return (a.join(b, "feature").join(adj, "feature")
            .withColumn("filled", F.col("initial_missing") - F.col("final_missing"))
            .withColumn("errors", F.lit(0).cast("long")))


def filled_positions(raw: DataFrame, clean: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Per row and column, 1 where raw is null and clean is not."""
    r = raw.select(key, *[F.col(c).alias(f"_raw_{c}") for c in cols])
    c_ = clean.select(key, *[F.col(c).alias(f"_cl_{c}") for c in cols])
    j = r.join(c_, key, "inner")
    return j.select(key, *[(F.col(f"_raw_{c}").isNull() & F.col(f"_cl_{c}").isNotNull()).cast("int").alias(f"filled_{c}")
                           for c in cols])


def null_prediction_fill(df: DataFrame, pred: str, features: Sequence[str], train_mean: float) -> DataFrame:
    """Rows with any null feature get the mean prediction of complete
    rows; NaN/null predictions get the training mean."""
    any_null = F.lit(False)
    for f in features:
        any_null = any_null | F.col(f).isNull()
    m = fit_row(df.filter(~any_null), F.avg(pred).alias("m"))["m"]
    p = F.when(F.isnan(pred), F.lit(None)).otherwise(F.col(pred))
    v = F.when(any_null, F.lit(m)).otherwise(p)
    return df.withColumn(pred, F.coalesce(v, F.lit(train_mean)))


def fill_quality(raw: DataFrame, filled: DataFrame, key: str, col: str) -> DataFrame:
    """mean/std/min/max/median of the filled values and the absolute
    difference of (bias-corrected) skewness and excess kurtosis between the
    observed and the filled values."""
    mask = raw.select(key, F.col(col).isNull().alias("_was_null"))
    j = filled.select(key, _d(col).alias("_v")).join(mask, key)

    def moments(flag: bool, p: str):
        x = F.when(F.col("_was_null") == F.lit(flag), F.col("_v"))
        n = F.count(x)
        g1 = F.skewness(x)
        g2 = F.kurtosis(x)
        big_g1 = g1 * F.sqrt(n * (n - 1)) / (n - 2)
        big_g2 = ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))
        return [big_g1.alias(f"{p}_skew"), big_g2.alias(f"{p}_kurt")]

    fv = F.when(F.col("_was_null"), F.col("_v"))
    median = fit_quantiles(j.select(fv.alias("_v")), ["_v"], [0.5])["_v"]
    return j.agg(
        F.count(fv).alias("n_filled"), F.avg(fv).alias("mean"), F.stddev_samp(fv).alias("std"),
        F.min(fv).alias("min"), F.max(fv).alias("max"),
        *moments(False, "obs"), *moments(True, "fill"),
    ).select("n_filled", "mean", "std", "min", "max", F.lit(median[0] if median else None).cast("double").alias("median"),
             F.abs(F.col("obs_skew") - F.col("fill_skew")).alias("skewness_difference"),
             F.abs(F.col("obs_kurt") - F.col("fill_kurt")).alias("kurtosis_difference"))


def imputed_flag(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """is_impute_<col> = 1 where the cell is null (taken before filling)."""
    return df.withColumns({f"is_impute_{c}": F.col(c).isNull().cast("int") for c in cols})
