"""Rank-based statistics: Box-Cox by normal scores (N6) and mutual information from nearest neighbours."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuator.plans.strategy import _cuts_below, attach_state, fit_row, prefix_sums, ranked
from valuator.session import cut_lineage

# Wichura's rational approximation of the normal quantile (AS 241), numerators and
# denominators by rising power, for the centre, the shoulders and the far tails.
CENTRE = ([3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
           4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3],
          [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
           2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3])
SHOULDER = ([1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
             1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4],
            [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
             1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9])
TAIL = ([6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
         2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7],
        [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
         7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15])


def _ratio(z: Column, fraction: tuple[list[float], list[float]]) -> Column:
    def poly(coefficients: list[float]) -> Column:
        out = F.lit(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            out = out * z + F.lit(c)
        return out
    return poly(fraction[0]) / poly(fraction[1])


def normal_quantile(p: Column) -> Column:
    """Quantile of the standard normal law, to about 1e-15; infinite at 0 and 1, null outside."""
    q = p - 0.5
    centre = q * _ratio(F.lit(0.180625) - q * q, CENTRE)
    r = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    outside = F.when(r <= 5.0, _ratio(r - 1.6, SHOULDER)).otherwise(_ratio(r - 5.0, TAIL)) * F.signum(q)
    end = F.when(p == 0.0, F.lit(float("-inf"))).when(p == 1.0, F.lit(float("inf")))
    return F.when(F.abs(q) <= 0.425, centre).when((p > 0.0) & (p < 1.0), outside).otherwise(end)


def order_median(rank: Column, n: Column) -> Column:
    """Filliben's estimate of the median of the rank-th of n uniform order statistics."""
    top = F.pow(F.lit(0.5), F.lit(1.0) / n)
    return (F.when(rank == n, top).when(rank == 1, F.lit(1.0) - top)
            .otherwise((rank - 0.3175) / (n + 0.365)))


def _power(x1: Column, lam: Column) -> Column:
    return F.when(lam == 0.0, F.log(x1)).otherwise((F.pow(x1, lam) - 1.0) / lam)


#: Exponents tried a pass on each side of the best one so far, passes, and half the width of the first.
SIDE, PASSES, HALF_WIDTH = 20, 3, 2.0


def boxcox_normal_scores(df: DataFrame, cols: Sequence[str], skew_threshold: float = 0.3) -> DataFrame:
    """(column, skewness, lambda, corr) for columns with |skewness| over the
    threshold; lambda makes the Box-Cox transform of 1 + x correlate best with
    the normal scores of its ranks.

    The transform keeps the order, so ranks and scores are computed once, for
    all columns in one range partitioning. A pass evaluates 41 exponents of all
    columns in one aggregate; the next pass looks between the neighbours of the
    best (2, then 0.1, then 0.005 to each side), moving on while the best
    is at an end of its range. lambda is a multiple of 0.00025.
    Nulls and NaN do not count, nor do values of -1 and less; equal values take
    the scores of their ranks in any order, which does not change the result. A
    column with fewer than two different values is not returned.
    """
    def number(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(~F.isnan(v), v)

    spark, cols = df.sparkSession, list(cols)
    schema = "column string, skewness double, lambda double, corr double"
    sk = fit_row(df, *[F.skewness(number(c)).alias(c) for c in cols])
    chosen = [c for c in cols if sk[c] is not None and abs(sk[c]) > skew_threshold]
    if not chosen:
        return spark.createDataFrame([], schema)
    long = (df.select(*[number(c).alias(f"_c{i}") for i, c in enumerate(chosen)])
            .select(F.posexplode(F.array(*[f"_c{i}" for i in range(len(chosen))])).alias("_i", "_x"))
            .filter("_x > -1").select("_i", (F.lit(1.0) + F.col("_x")).alias("_x")))
    order = ranked(long, ["_i"], ["_x"], out="_r")
    counts = {r["_i"]: r["n"] for r in order.groupBy("_i").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = F.get(F.array(*[F.lit(float(counts.get(i, 0))) for i in range(len(chosen))]), F.col("_i"))
    scored = cut_lineage(order.select("_i", "_x", normal_quantile(order_median(F.col("_r").cast("double"), n)).alias("_m")))
    best: dict[int, tuple[float, float]] = {}
    half = HALF_WIDTH
    for _ in range(PASSES):
        step = half / SIDE
        todo = {i: best.get(i, (0.0, 0.0))[0] for i in counts}
        while todo:
            # whole multiples of the step, so that a value is one double wherever it comes from
            tried = {(i, j): round((round(mid / step) + j) * step, 6) for i, mid in todo.items() for j in range(-SIDE, SIDE + 1)}
            trials = spark.createDataFrame([(i, j, lam) for (i, j), lam in tried.items()], "_i int, _j int, _lam double")
            r = (scored.join(F.broadcast(trials), "_i").groupBy("_i", "_j")
                 .agg(F.corr("_m", _power(F.col("_x"), F.col("_lam"))).alias("r")).collect())
            moved = {}
            for i in todo:
                values = sorted((row["_j"], row["r"]) for row in r if row["_i"] == i and row["r"] is not None and not math.isnan(row["r"]))
                if not values:
                    best.pop(i, None)
                    continue
                j, corr = max(values, key=lambda v: (v[1], -v[0]))
                if abs(j) == SIDE and (i not in best or best[i][1] < corr):
                    moved[i] = tried[i, j]
                if i not in best or best[i][1] <= corr:
                    best[i] = (tried[i, j], corr)
            todo = moved
        half = step
    rows = [(chosen[i], float(sk[chosen[i]]), float(lam), float(c)) for i, (lam, c) in sorted(best.items())]
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------------- N14
#: Steps of the lattice a standard deviation, bits of a group in the order of all values, points of a cell and of a leaf in it,
#: cuts that a strip can be divided by, and points that are counted in one go.
LATTICE, GROUP_BITS, CELL_POINTS, LEAF, MOST_CUTS, COUNTED_POINTS = 1 << 20, 44, 1 << 15, 32, 1024, 1 << 18
#: More than any distance, and the farthest look.
FAR, REACH = 1 << 60, 1 << 45


def digamma(m: Column) -> Column:
    """Digamma of a whole number of 1 or more, to about 1e-10."""
    z = m + 10.0
    out = F.log(z) - F.lit(0.5) / z - F.lit(1.0) / (z * z * 12.0) + F.lit(1.0) / (z * z * z * z * 120.0)
    for i in range(10):
        out = out - F.lit(1.0) / (m + float(i))
    return out


class _Leaves:
    """Points in strips by x, each cut by y into leaves of as many points, so that a search meets few of them."""

    def __init__(self, x: np.ndarray, y: np.ndarray, k: int):
        n, self.size = len(x), max(LEAF, 2 * k)
        m = -(-n // self.size)
        wide, high = (float(np.subtract(*np.quantile(v, [0.95, 0.05]))) + 1.0 for v in (x, y))
        strips = int(min(max(round(math.sqrt(m * wide / high)), 1), m, 1 << 14))
        rows = self.size * -(-m // strips)
        order = np.lexsort((y, x))
        strip = np.arange(n) // rows
        self.order = order[np.lexsort((y[order], strip))]
        x, y = x[self.order], y[self.order]
        self.x, self.y = (np.concatenate([v, np.full(m * self.size - n, FAR)]).reshape(m, self.size) for v in (x, y))
        starts = np.arange(0, n, rows)
        self.x0, self.x1 = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
        # leaves follow each other by strip and y
        base = (np.arange(m) * self.size // rows) * (REACH << 2)
        self.y0, self.y1 = base + self.y[:, 0], base + y[np.minimum(np.arange(1, m + 1) * self.size, n) - 1]

    def nearest(self, k: int) -> np.ndarray:
        """The k least distances of each point to others of its leaf, in leaf order; FAR where there are fewer."""
        out = np.empty((*self.x.shape, k), dtype=np.int64)
        own = np.arange(self.size)
        for i in range(0, len(self.x), 256):
            x, y = self.x[i:i + 256], self.y[i:i + 256]
            d = np.maximum(np.abs(x[:, :, None] - x[:, None, :]), np.abs(y[:, :, None] - y[:, None, :]))
            d[:, own, own] = FAR
            out[i:i + 256] = np.sort(np.partition(d, k - 1, axis=2)[:, :, :k], axis=2)
        return np.where(out < FAR >> 1, out, FAR).reshape(-1, k)

    def closer(self, near: np.ndarray, x: np.ndarray, y: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """``near`` with what is closer than its last column in any leaf but the ``own`` one of each point."""
        near, k = near.copy(), near.shape[1]
        asked = np.flatnonzero(near[:, -1] > 0)
        for begin in range(0, len(asked), 8192):
            q = asked[begin:begin + 8192]
            r = np.minimum(near[q, -1] - 1, REACH)
            first = np.searchsorted(self.x1, x[q] - r)
            at, strip = _ranges(first, np.searchsorted(self.x0, x[q] + r, "right"))
            base = strip * (REACH << 2) + y[q][at]
            which, leaf = _ranges(np.searchsorted(self.y1, base - r[at]), np.searchsorted(self.y0, base + r[at], "right"))
            at = at[which]
            if own is not None:
                other = leaf != own[q][at]
                at, leaf = at[other], leaf[other]
            who, far = [], []
            for i in range(0, len(at), 8192):
                a, c = at[i:i + 8192], leaf[i:i + 8192]
                d = np.maximum(np.abs(self.x[c] - x[q][a][:, None]), np.abs(self.y[c] - y[q][a][:, None]))
                row, col = np.nonzero(d <= r[a][:, None])
                who.append(a[row])
                far.append(d[row, col])
            met = np.unique(np.concatenate(who)) if who else np.empty(0, dtype=np.int64)
            if len(met):
                who = np.concatenate([*who, np.repeat(met, k)])
                far = np.concatenate([*far, near[q[met]].ravel()])
                order = np.lexsort((far, who))
                who, far = who[order], far[order]
                nth = np.arange(len(who)) - np.searchsorted(who, who)
                near[q[who[nth < k]], nth[nth < k]] = far[nth < k]
        return near


def _ranges(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, value) of all whole numbers from ``first`` to under ``end``."""
    n = np.maximum(end - first, 0)
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + first[which]


def _cells(points: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Points with their cell, a number: strips by quantiles of x, each cut by quantiles of y. Any cuts give the same
    distances; a strip of more points has more of them. The cuts, one a cell, are the driver's."""
    strips = {i: math.ceil(math.sqrt(n / CELL_POINTS)) for i, n in sizes.items()}
    most, half = max(strips.values()), 1 << (GROUP_BITS - 1)
    # a feature, and a strip, begins half a group before its zero
    cuts = [(i << GROUP_BITS) - half for i in sorted(sizes)]
    if most > 1:
        for r in points.groupBy("_f").agg(F.percentile_approx("x", [j / 64 / most for j in range(1, 64 * most)], 10_000).alias("q")).collect():
            cuts += [(r["_f"] << GROUP_BITS) + r["q"][64 * most * j // strips[r["_f"]] - 1] for j in range(1, strips[r["_f"]])]

    def place(rows: DataFrame, group: str, v: str, cuts: list[int], out: str, schema: str) -> DataFrame:
        table = np.array(sorted(set(cuts)), dtype=np.int64)

        def below(batches):
            for b in batches:
                b[out] = np.searchsorted(table, (b[group].to_numpy().astype(np.int64) << GROUP_BITS) + b[v].to_numpy())
                yield b

        return rows.mapInPandas(below, schema)

    schema = "_f int, x long, y long, w long"
    placed = place(points.select("_f", "x", "y", "w"), "_f", "x", cuts, "_strip", f"{schema}, _strip int")
    if sum(sizes.values()) > CELL_POINTS:
        of = placed.groupBy("_strip").agg(F.percentile_approx("y", [j / MOST_CUTS for j in range(1, MOST_CUTS)], 10_000).alias("q"),
                                          F.count(F.lit(1)).alias("n"))
        step = F.ceil(F.lit(MOST_CUTS * CELL_POINTS) / F.col("n"))
        inner = of.select("_strip", F.filter("q", lambda v, j: (j + 1) % step == 0).alias("q")).collect()
    else:
        inner = [{"_strip": i, "q": []} for i in range(len(cuts) + 1)]
    cuts = [(r["_strip"] << GROUP_BITS) + v for r in inner for v in [-half, *r["q"]]]
    return place(placed, "_strip", "y", cuts, "_cell", f"{schema}, _strip int, _cell int").drop("_strip")


def _kth_distance(points: DataFrame, sizes: dict[int, int], k: int) -> DataFrame:
    """Points with the Chebyshev distance ``d`` to the k-th nearest other row; null if there are fewer.

    A point first meets its own cell, whose k-th distance bounds the answer,
    then every other cell that reaches into the square of that bound. A cell
    is one task's call; a point that looks beyond it goes there with its bound,
    and only what is closer comes back."""
    placed = cut_lineage(_cells(points, sizes))
    found = placed.groupBy("_cell", "_f").agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).collect()
    cells = {i: np.array([[r["_cell"], *r[2:]] for r in found if r["_f"] == i], dtype=np.int64) for i in sizes}

    def own(group: pd.DataFrame) -> pd.DataFrame:
        x, y, w = (group[c].to_numpy() for c in "xyw")
        copies = np.minimum(w, k + 1)  # more would not change the k nearest
        leaves = _Leaves(np.repeat(x, copies), np.repeat(y, copies), k)
        at = np.empty(len(leaves.order), dtype=np.int64)
        at[leaves.order] = np.arange(len(leaves.order))
        at = at[np.cumsum(copies) - copies]
        near = leaves.closer(leaves.nearest(k)[at], x, y, at // leaves.size)
        others = cells[int(group["_f"].iloc[0])]
        others = others[others[:, 0] != int(group["_cell"].iloc[0])]
        r = np.minimum(near[:, -1] - 1, REACH)
        looking = np.flatnonzero((r >= 0) & ((x - r < x.min()) | (x + r > x.max()) | (y - r < y.min()) | (y + r > y.max())))
        lists, beyond = np.full(len(x), None, dtype=object), np.full(len(x), None, dtype=object)
        for i in range(0, len(looking) if len(others) else 0, 2048):
            q = looking[i:i + 2048]
            reach = r[q][:, None]
            meets = ((others[:, 1] <= x[q][:, None] + reach) & (others[:, 2] >= x[q][:, None] - reach)
                     & (others[:, 3] <= y[q][:, None] + reach) & (others[:, 4] >= y[q][:, None] - reach))
            for j in np.flatnonzero(meets.any(axis=1)):
                lists[q[j]], beyond[q[j]] = near[q[j]], others[meets[j], 0]
        return pd.DataFrame({"_f": group["_f"], "x": x, "y": y, "w": w, "d": near[:, -1], "_near": lists, "_beyond": beyond})

    first = cut_lineage(placed.groupBy("_cell").applyInPandas(own, "_f int, x long, y long, w long, d long, _near array<long>, _beyond array<int>"))
    d = F.when(F.col("d") < FAR, F.col("d")).alias("d")
    alone = first.filter("_beyond IS NULL").select("_f", "x", "y", "w", d)
    if len(found) == len(cells):
        return alone  # one cell a feature
    looking = first.filter("_beyond IS NOT NULL").select("_f", "x", "y", "w", "_near", "_beyond")

    def visit(guests: pd.DataFrame, hosts: pd.DataFrame) -> pd.DataFrame:
        x, y = guests["x"].to_numpy(), guests["y"].to_numpy()
        near = np.full((len(x), k), FAR)
        if len(guests) and len(hosts):
            copies = np.minimum(hosts["w"].to_numpy(), k)
            bound = guests["d"].to_numpy()
            leaves = _Leaves(np.repeat(hosts["x"].to_numpy(), copies), np.repeat(hosts["y"].to_numpy(), copies), k)
            near = leaves.closer(np.repeat(bound[:, None], k, axis=1), x, y)
            near[near >= bound[:, None]] = FAR
        some = np.flatnonzero(near.min(axis=1) < FAR) if len(x) else []
        return pd.DataFrame({"_f": guests["_f"].iloc[some], "x": x[some], "y": y[some], "w": guests["w"].iloc[some],
                             "_near": pd.Series([v[v < FAR] for v in near[some]], dtype=object, index=guests.index[some])})

    guests = looking.select("_f", "x", "y", "w", F.get("_near", F.lit(k - 1)).alias("d"), F.explode("_beyond").alias("_cell"))
    more = (guests.groupBy("_cell").cogroup(placed.select("x", "y", "w", "_cell").groupBy("_cell"))
            .applyInPandas(visit, "_f int, x long, y long, w long, _near array<long>"))
    merged = looking.drop("_beyond").unionByName(more).groupBy("_f", "x", "y", "w").agg(
        F.sort_array(F.flatten(F.collect_list("_near"))).alias("_near"))
    return alone.unionByName(merged.select("_f", "x", "y", "w", F.get("_near", F.lit(k - 1)).alias("d")).select("_f", "x", "y", "w", d))


def _digamma(m: np.ndarray) -> np.ndarray:
    z = m + 10.0
    out = np.log(z) - 0.5 / z - 1.0 / (z * z * 12.0) + 1.0 / (z * z * z * z * 120.0)
    for i in range(10):
        out = out - 1.0 / (m + i)
    return out


def _mean_digamma(points: DataFrame, near: DataFrame) -> DataFrame:
    """(_f, _psi): both sides' means over rows of the digamma of how many rows are within ``_reach`` of a coordinate.

    Both coordinates of all features are in one order, a group of values each, far apart. The order is cut into
    chunks; rows look up both ends in their chunk's running sums, rows whose ends are in two chunks look up one at a time."""
    def sides(rows: DataFrame, *cols: str) -> DataFrame:
        each = F.array(*[F.struct((F.col("_f") * 2 + j).cast("long").alias("g"), F.col(c).alias("v")) for j, c in enumerate("xy")])
        return rows.select(F.explode(each).alias("s"), "w", *cols).select(
            "s.g", (F.col("s.g") * F.lit(1 << GROUP_BITS) + F.col("s.v")).alias("_at"), "w", *cols)

    values = cut_lineage(sides(points).groupBy("_at").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")))
    rows = values.agg(F.sum("n")).first()[0]
    n = min(-(-rows // COUNTED_POINTS), 4096)
    cuts = sorted({*values.agg(F.percentile_approx("_at", [i / n for i in range(1, n)], 10_000)).first()[0]}) if n > 1 else []
    table = cut_lineage(values.select("_at", "w", "n", _cuts_below(F.col("_at").cast("double"), [float(c) for c in cuts]).alias("_chunk")))
    totals = {r["_chunk"]: (r["w"], r["n"]) for r in table.groupBy("_chunk").agg(F.sum("w").alias("w"), F.sum("n").alias("n")).collect()}
    parts = [-(-totals.get(i, (0, 1))[1] // COUNTED_POINTS) for i in range(len(cuts) + 1)]
    before, upto = [], 0
    for i in range(len(cuts) + 1):
        before.append(upto)
        upto += totals.get(i, (0, 0))[0]

    # a chunk with more rows than go together, such as one of a value that many rows share, is given to several calls
    def part_of(chunk: str) -> Column:
        return F.get(F.expr("array(" + ", ".join(map(str, parts)) + ")"), F.col(chunk))
    spread = table.select("_at", "w", "_chunk", F.explode(F.sequence(F.lit(0), part_of("_chunk") - 1)).alias("_part"))
    ends_of, parts_of = np.array(cuts, dtype=np.int64), np.array(parts, dtype=np.int64)

    def ask(batches):
        for b in batches:
            f, w, reach = (b[c].to_numpy() for c in ("_f", "w", "_reach"))
            mixed = ((b["x"].to_numpy() * 0x9E3779B1 + b["y"].to_numpy()) * 0x85EBCA77 >> 16) & 0x7FFFFFFF
            for j, c in enumerate("xy"):
                g = f.astype(np.int64) * 2 + j
                at = (g << GROUP_BITS) + b[c].to_numpy()
                chunk, last = np.searchsorted(ends_of, at - reach), np.searchsorted(ends_of, at + reach)
                yield pd.DataFrame({"g": g, "w": w, "_lo": at - reach, "_hi": at + reach, "_chunk": chunk, "_last": last, "_part": mixed % parts_of[chunk]})

    asked = near.mapInPandas(ask, "g long, w long, _lo long, _hi long, _chunk int, _last int, _part int")

    def sums(table: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        table = table.sort_values("_at")
        return table["_at"].to_numpy(), np.concatenate([[0], np.cumsum(table["w"].to_numpy())])

    def count(rows: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        at, cum = sums(table)
        n = cum[np.searchsorted(at, rows["_hi"].to_numpy(), "right")] - cum[np.searchsorted(at, rows["_lo"].to_numpy())]
        w = rows["w"].to_numpy()
        out = pd.DataFrame({"g": rows["g"], "_psi": w * _digamma(n.astype(float)), "w": w})
        return out.groupby("g", as_index=False).sum()

    within = (asked.filter("_chunk = _last").select("g", "w", "_lo", "_hi", "_chunk", "_part").groupBy("_chunk", "_part")
              .cogroup(spread.groupBy("_chunk", "_part")).applyInPandas(count, "g long, _psi double, w long"))
    if not cuts:
        across = None
    else:
        def one_end(rows: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
            at, cum = sums(table)
            end, high = rows["_end"].to_numpy(), rows["_high"].to_numpy()
            n = np.where(high, cum[np.searchsorted(at, end, "right")], -cum[np.searchsorted(at, end)])
            base = np.array(before, dtype=np.int64)[rows["_chunk"].to_numpy()]
            return rows[["g", "w", "_lo", "_hi"]].assign(n=n + np.where(high, base, -base))

        ends = F.array(F.struct(F.col("_lo").alias("_end"), "_chunk", F.lit(False).alias("_high")),
                       F.struct(F.col("_hi").alias("_end"), F.col("_last").alias("_chunk"), F.lit(True).alias("_high")))
        two = (asked.filter("_chunk <> _last").groupBy("g", "_lo", "_hi", "_chunk", "_last").agg(F.sum("w").alias("w"))
               .select("g", "w", "_lo", "_hi", F.explode(ends).alias("e")).select("g", "w", "_lo", "_hi", "e.*"))
        two = (two.withColumn("_part", F.pmod(F.xxhash64("_lo", "_hi"), part_of("_chunk")).cast("int")).groupBy("_chunk", "_part")
               .cogroup(spread.groupBy("_chunk", "_part")).applyInPandas(one_end, "g long, w long, _lo long, _hi long, n long"))
        across = (two.groupBy("g", "w", "_lo", "_hi").agg(F.sum("n").cast("double").alias("n"))
                  .groupBy("g").agg(F.sum(F.col("w") * digamma(F.col("n"))).alias("_psi"), F.sum("w").alias("w")))
    means = (within if across is None else within.unionByName(across)).groupBy("g").agg((F.sum("_psi") / F.sum("w")).alias("_psi"))
    return means.groupBy(F.expr("cast(g div 2 as int)").alias("_f")).agg(F.sum("_psi").alias("_psi"))


def neighbour_mutual_info(df: DataFrame, features: Sequence[str], target: str, neighbours: int = 3,
                          stats_digits: int | None = None) -> DataFrame:
    """(feature, n, mutual_info) by the k-nearest-neighbour estimate:
    psi(n) + psi(k) - mean psi(rows nearer than the k-th neighbour in x) - the same in y, at least 0.

    The distance is the larger one of both standardised coordinates. These are
    rounded to a lattice of 2^-20 standard deviations, so that distances are
    whole numbers and ties are exact: at distance 0 the rows of equal value
    count. Equal points are one row with a weight, so a value that a third of
    the rows share costs no more than another. Neighbours come from cells of
    some 32,768 points, cut into leaves of 32, counts of both sides from running
    sums over the values in order; no pairs of rows beyond neighbouring leaves are made.
    Rows without the feature or the target (null, NaN, infinite) do not count
    for that feature; with ``neighbours`` rows or fewer the result is null.
    ``stats_digits`` rounds means and deviations, for equal results in another engine.
    """
    spark, features, k = df.sparkSession, list(features), int(neighbours)

    def finite(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(F.abs(v) < float("inf"), v)

    cols = [*features, target]
    data = df.select(*[finite(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    st = fit_row(data, *[F.avg(f"_v{i}").alias(f"m{i}") for i in range(len(cols))],
                 *[F.stddev_pop(f"_v{i}").alias(f"s{i}") for i in range(len(cols))])

    def step(i: int) -> Column:
        m, s = float(st[f"m{i}"] or 0.0), float(st[f"s{i}"] or 0.0)
        if stats_digits is not None:
            m, s = round(m, stats_digits), round(s, stats_digits)
        return F.floor((F.col(f"_v{i}") - F.lit(m)) / F.lit(s or 1.0) * float(LATTICE) + 0.5).cast("long")

    at = data.select(*[step(i).alias(f"_q{i}") for i in range(len(cols))])
    y = f"_q{len(features)}"
    pairs = F.array(*[F.struct(F.lit(i).alias("_f"), F.col(f"_q{i}").alias("x"), F.col(y).alias("y")) for i in range(len(features))])
    points = (at.filter(F.col(y).isNotNull()).select(F.explode(pairs).alias("p")).select("p.*").filter("x IS NOT NULL")
              .groupBy("_f", "x", "y").agg(F.count(F.lit(1)).alias("w")))
    points = cut_lineage(points)
    total = {r["_f"]: (r["p"], r["n"]) for r in points.groupBy("_f").agg(F.count(F.lit(1)).alias("p"), F.sum("w").alias("n")).collect()}
    enough = {i: p for i, (p, n) in total.items() if n > k}
    names = spark.createDataFrame([(i, c, int(total.get(i, (0, 0))[1])) for i, c in enumerate(features)], "_f int, feature string, n long")
    if not enough:
        return names.select("feature", "n", F.lit(None).cast("double").alias("mutual_info"))
    points = points.filter(F.col("_f").isin(list(enough)))
    near = _kth_distance(points, enough, k)
    near = cut_lineage(near.select("_f", "x", "y", "w", F.greatest(F.col("d") - 1, F.lit(0)).alias("_reach")))
    sums = _mean_digamma(points, near)
    n = F.col("n").cast("double")
    info = F.greatest(digamma(n) + digamma(F.lit(float(k))) - F.col("_psi"), F.lit(0.0))
    return names.join(F.broadcast(sums), "_f", "left").select("feature", "n", F.when(F.col("n") > k, info).alias("mutual_info"))
