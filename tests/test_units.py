"""Hand-built edge cases per operator family, and invariants of the
distributed helpers (ranked / prefix sums / grid KNN) against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from valuator.functions import columns as C
from valuator.functions import text as T
from valuator.operators import cluster as CL
from valuator.operators import encode as E
from valuator.operators import ensemble as W
from valuator.operators import evaluate as EV
from valuator.operators import impute as I
from valuator.operators import profile as N
from valuator.operators import segment as B
from valuator.operators import train as M
from valuator.plans.strategy import prefix_sums, ranked


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


# ------------------------------------------------------------------ scalar / text
def test_clean_title_and_expiry(spark):
    df = spark.createDataFrame([("BMW 320i 2.0L Auto (COE till 05/2029) 2015 12000 km",), ("Honda Jazz Manual",)],
                               "t string")
    out = df.select(T.clean_title("t").alias("c"), T.extract_expiry("t").alias("e")).collect()
    assert out[0]["c"] == "BMW 320i" and out[0]["e"] == "05/2029"
    assert out[1]["c"] == "Honda Jazz" and out[1]["e"] is None


def test_clean_token(spark):
    df = spark.createDataFrame([("Luxury Sedan/SUV!",), (None,)], "t string")
    assert [r[0] for r in df.select(T.clean_token("t")).collect()] == ["luxury_sedan_suv", ""]


def test_clip_keeps_null_and_safe_divide(spark):
    df = spark.createDataFrame([(None, 0.0), (5.0, 0.0), (3000000.0, 2.0)], "x double, d double")
    out = df.select(C.clip_prices("x").alias("c"), C.safe_divide("x", "d").alias("z"),
                    C.safe_divide("x", "d", "plus1").alias("p")).collect()
    assert out[0]["c"] is None and out[1]["c"] == 700.0 and out[2]["c"] == 2900000.0
    assert out[1]["z"] == 0.0 and out[2]["z"] == 1500000.0 and out[1]["p"] == 5.0


def test_vehicle_age_modes(spark):
    df = spark.createDataFrame([("2020-06-15",)], "d string").select(F.to_date("d").alias("d"))
    r = df.select(*[C.vehicle_age("d", "2024-06-14", m).alias(m) for m in C.AGE_MODES]).collect()[0]
    assert r["calendar"] == 3 and r["days365"] == 4 and r["mean_year"] == 3


# ------------------------------------------------------------------ bins and bands
def test_error_band_gap_goes_to_overflow(spark):
    df = spark.createDataFrame([(2000.5,), (2000.0,), (-2500.0,), (30000.0,)], "e double")
    out = df.select(B.error_band("e").alias("b"), B.error_band("e", gaps="closed").alias("c")).collect()
    assert [r["b"] for r in out] == [9, 0, 1, 9]
    assert [r["c"] for r in out] == [1, 0, 1, 9]


def test_quantile_bins_right_closed_with_ties(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 1, 1, 1, 2, 3, 4, 5]], "x double")
    edges = B.quantile_edges(df, "x", 4)
    assert edges == sorted(set(edges))  # duplicates dropped
    codes = [r[0] for r in df.select(B.bin_code("x", edges)).collect()]
    assert codes[0] == 0 and max(codes) == len(edges) - 2


# ------------------------------------------------------------------ encoders
def test_one_hot_unknown_is_all_zero(spark):
    tr = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    st = E.fit_one_hot(tr, "c", "c_")
    new = spark.createDataFrame([("b",), ("z",), (None,)], "c string")
    out = E.apply_one_hot(new, st).collect()
    assert [tuple(r) for r in out] == [(0, 1), (0, 0), (0, 0)]


def test_label_codes_unseen(spark):
    tr = spark.createDataFrame([("b",), ("a",), ("c",)], "c string")
    codes = E.fit_label_codes(tr, "c")
    new = spark.createDataFrame([(1, "c"), (2, "zz")], "id int, c string")
    assert sorted(rows(E.apply_label_codes(new, "c", codes), "id", "c_code")) == [(1, 2), (2, -1)]
    assert sorted(rows(E.apply_label_codes(new, "c", codes, "new"), "id", "c_code")) == [(1, 2), (2, 3)]


def test_fuzzy_fill_blocking_is_exact(spark):
    makes = ["toyota", "honda", "mercedes-benz", "bmw", "mazda"]
    data = [(i, m, f"{m} x") for i, m in enumerate(makes * 3)]
    words = ["toyot", "hondaa", "mercedes", "bnw", "mazdaz", "xyz", "b", "hond"]
    data += [(100 + i, None, f"{w} y") for i, w in enumerate(words)]
    df = spark.createDataFrame(data, "id int, make string, title string")
    got = dict(rows(E.fuzzy_fill_make(df), "id", "make"))

    def lev(a, b):
        d = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            p, d[0] = d[0], i
            for j, cb in enumerate(b, 1):
                p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (ca != cb))
        return d[-1]

    for i, w in enumerate(words):
        best = None
        for m in sorted(makes):
            s = 1 - lev(w, m) / max(len(w), len(m)) if max(len(w), len(m)) else 1.0
            if s >= 0.8 and (best is None or s > best[0]):
                best = (s, m)
        assert got[100 + i] == (best[1] if best else w)


# ------------------------------------------------------------------ distributed helpers
def test_ranked_equals_window(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice("aab"), rnd.randint(0, 20)) for i in range(400)]
    df = spark.createDataFrame(data, "k int, g string, v int").repartition(5)
    r = ranked(df, ["g"], ["v", "k"], out="rn", num_partitions=6)
    ref = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("v", "k")))
    j = r.join(ref, ["k", "g", "v"])
    assert j.filter("rn != rn2").count() == 0 and j.count() == 400


def test_prefix_sums_equals_window(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(float(rnd.randint(0, 50)), rnd.randint(0, 3)) for _ in range(300)], "t double, n int")
    g = df.groupBy("t").agg(F.sum("n").alias("n"))
    ps = prefix_sums(g, "t", ["n"], descending=True, num_partitions=4)
    ref = g.withColumn("c2", F.sum("n").over(Window.orderBy(F.col("t").desc())))
    assert ps.join(ref, "t").filter("n_cum != c2").count() == 0


def _brute_knn(data, m, k):
    """data: (key, features..., target); target of every row, filled from its k nearest donors."""
    donors = [r for r in data if r[m + 1] is not None]
    mean = sum(r[m + 1] for r in donors) / len(donors)
    out = {}
    for r in data:
        if r[m + 1] is not None:
            out[r[0]] = r[m + 1]
            continue
        near = []
        for d in donors:
            both = [(d[i] - r[i]) ** 2 for i in range(1, m + 1) if d[i] is not None and r[i] is not None]
            if both:
                near.append((math.sqrt((m + 1) / len(both) * sum(both)), d[0], d[m + 1]))
        near = sorted(near)[:k]
        zero = [v for x, _, v in near if x == 0]
        out[r[0]] = (mean if not near else sum(zero) / len(zero) if zero
                     else sum(v / x for x, _, v in near) / sum(1 / x for x, _, v in near))
    return out


def _knn_case(kind, rnd):
    feats = 8 if kind == "eight features" else 2 if kind == "starved" else 3
    out = []
    for i in range(400):
        if kind == "log spread":
            xs = [math.exp(rnd.gauss(0, 4)) for _ in range(3)]
        elif kind == "one value":
            xs = [rnd.choice([0.0, 0.0, 0.0, 1.0]), 5.0, float(rnd.randint(0, 1))]
        elif kind == "eight features":
            base = rnd.gauss(0, 3)
            xs = [base * (j + 1) + rnd.gauss(0, 0.3) for j in range(8)]
        else:
            xs = [rnd.random() * 10 for _ in range(feats)]
        if kind in ("nulls", "eight features"):
            xs = [None if rnd.random() < 0.2 else x for x in xs]
        out.append((i, *xs, None if rnd.random() < 0.2 else rnd.random()))
    if kind == "log spread":
        out.append((1000, 1e12, 1e12, -1e12, 3.0))
    if kind == "starved":
        out = [(r[0], r[1], None, r[3]) for r in out] + [(1001, None, 5.0, 1000.0), (1002, None, 900.0, 2000.0), (1003, None, 7.0, None),
                                                          (1004, None, None, None)]
    return feats, out


@pytest.mark.parametrize("kind", ["plain", "nulls", "log spread", "one value", "eight features", "starved"])
def test_knn_matches_brute_force(spark, kind):
    feats, data = _knn_case(kind, random.Random(kind))
    names = [f"f{i}" for i in range(feats)]
    df = spark.createDataFrame(data, "k int, " + ", ".join(f"{f} double" for f in names) + ", t double")
    got = {r["k"]: r["t"] for r in I.knn_impute(df, "k", "t", names, 5).collect()}
    want = _brute_knn(data, feats, 5)
    assert set(got) == set(want) and all(abs(got[i] - want[i]) <= 1e-9 * max(1, abs(want[i])) for i in want)


@pytest.mark.parametrize("kind", ["plain", "nulls", "log spread", "one value", "eight features", "starved"])
def test_knn_split_leaves_match_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(I, "MAX_LEAVES", 2)
    monkeypatch.setattr(I, "LEAF_K", 1)
    monkeypatch.setattr(I, "SPLIT_OVER", 1)
    monkeypatch.setattr(I, "SPLIT_BITS", 2)
    feats, data = _knn_case(kind, random.Random(kind))
    names = [f"f{i}" for i in range(feats)]
    df = spark.createDataFrame(data, "k int, " + ", ".join(f"{f} double" for f in names) + ", t double")
    got = {r["k"]: r["t"] for r in I.knn_impute(df, "k", "t", names, 5).collect()}
    want = _brute_knn(data, feats, 5)
    assert set(got) == set(want) and all(abs(got[i] - want[i]) <= 1e-9 * max(1, abs(want[i])) for i in want)


@pytest.mark.parametrize("kind", ["even", "log spread", "mostly one value"])
def test_knn_leaves_are_split_until_small(spark, monkeypatch, kind):
    monkeypatch.setattr(I, "MAX_LEAVES", 4)
    rnd, k = random.Random(kind), 3
    draw = {"even": lambda: [rnd.random(), rnd.random() * 5], "log spread": lambda: [math.exp(rnd.gauss(0, 6)), rnd.gauss(0, 1)],
            "mostly one value": lambda: [7.0 if rnd.random() < 0.97 else rnd.random() * 9, rnd.random() * 1e-3]}[kind]
    don = spark.createDataFrame([(i, *draw()) for i in range(6000)], "_dk int, _d_a double, _d_b double")
    tree, placed = I._donor_tree(don, ["a", "b"], k)
    most = int(tree.n[tree.leaf >= 0].max())
    assert tree.leaves <= 4 and most >= 1500
    cut, levels = I._split_leaves(placed.withColumn("_leaf", F.col("_leaf") + I.TOP_NODE), ["_d_a", "_d_b"], I.LEAF_K * k, most)
    size = {r["_leaf"]: r["count"] for r in cut.groupBy("_leaf").count().collect()}
    assert sum(size.values()) == 6000 and max(size.values()) <= I.SPLIT_OVER * I.LEAF_K * k and levels
    parents = [r["_up"] for level in levels for r in level.select("_up").collect()]
    assert len(parents) == len(set(parents)) and not set(parents) & set(size)


@pytest.mark.parametrize("kind", ["log spread", "eight features"])
def test_knn_candidates_stay_near_k(spark, kind):
    rnd = random.Random(kind)
    m, k = (8, 5) if kind == "eight features" else (3, 5)

    def point():
        if m == 3:
            return [math.exp(rnd.gauss(0, 4)) for _ in range(3)]
        base = rnd.gauss(0, 3)
        return [base * (j + 1) + rnd.gauss(0, 0.3) for j in range(8)]

    don = np.array([point() for _ in range(3600)] + [[1e12] * m])
    rec = np.array([point() for _ in range(400)])
    names = [f"f{i}" for i in range(m)]
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(don)], "_dk int, " + ", ".join(f"_d_{f} double" for f in names))
    tree, placed = I._donor_tree(df, names, k)
    size = {r["_leaf"]: r["count"] for r in placed.groupBy("_leaf").count().collect()}
    far = np.sort(np.sqrt((m + 1) / m * ((rec[:, None, :] - don[None]) ** 2).sum(axis=2)), axis=1)[:, k - 1]
    first = sum(size[v] for x in tree.near_leaves(rec, k, m + 1) for v in x.tolist())
    _, leaves = tree.leaves_within(rec, far, m + 1)
    pairs = first + sum(size[v] for v in leaves.tolist())
    assert pairs < 40 * k * len(rec), pairs / (k * len(rec))


def test_knn_receivers_with_tied_donors(spark, monkeypatch):
    """Rows without b cannot tell the 600 donors of a value of a apart: they meet few of them, and their result stays."""
    rnd, k = random.Random(3), 5
    data = [(i, float(i % 4), rnd.random() * 100, rnd.random()) for i in range(2400)]
    data += [(5000 + i, float(i % 4), None, rnd.random()) for i in range(40)]  # donors without b
    data += [(9000 + i, float(rnd.choice([0, 1, 2, 3, 9])), None, None) for i in range(60)] + [(9900 + i, None, rnd.random() * 100, None) for i in range(9)]
    df = spark.createDataFrame(data, "k int, a double, b double, t double")
    met = []
    sort = I._top_k
    monkeypatch.setattr(I, "_top_k", lambda pairs, n: met.append(pairs.count()) or sort(pairs, n))
    got = {r["k"]: r["t"] for r in I.knn_impute(df, "k", "t", ["a", "b"], k).collect()}
    want = _brute_knn(data, 2, k)
    assert set(got) == set(want) and all(abs(got[i] - want[i]) <= 1e-9 * max(1, abs(want[i])) for i in want)
    assert len(met) == 2 and max(met) < 69 * 100, met


def test_knn_floor_without_donors(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, None)], "k int, a double, t double")
    assert [r["t"] for r in I.knn_impute_floor(df, "k", "t", ["a"], 2).collect()] == [1.0, 1.0]
    assert [r["t"] for r in I.knn_impute(df, "k", "t", ["a"], 2).collect()] == [None, None]


def test_knn_zero_distance_takes_all_weight(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 1.0, 10.0), (3, 2.0, 1000.0), (4, 3.0, 50.0)],
                               "k int, a double, t double")
    out = dict(rows(I.knn_impute(df, "k", "t", ["a"], 2), "k", "t"))
    assert out[1] == 10.0


# ------------------------------------------------------------------ folds, splits, holdout
def test_folds_stable_under_repartition(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = df.repartition(1).select("k", M.kfold_assign("k", 5).alias("f"))
    b = df.repartition(7).select("k", M.kfold_assign("k", 5).alias("f2"))
    assert a.join(b, "k").filter("f != f2").count() == 0
    sizes = [r[1] for r in a.groupBy("f").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_stratified_holdout_exact_sizes(spark):
    from valuator.sources.holdout import stratified_holdout
    df = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(1000)], "k int, c string")
    train, test, _ = stratified_holdout(df, "k", "c", 200)
    counts = dict(rows(test.groupBy("c").count(), "c", "count"))
    assert counts == {"a": 150, "b": 50} and train.count() == 800
    assert train.join(test, "k").count() == 0


# ------------------------------------------------------------------ ensembles and evaluation
def test_gram_rmse_and_l2_weights(spark):
    rnd = np.random.default_rng(0)
    y = rnd.normal(100, 10, 500)
    p = np.stack([y + rnd.normal(0, 1, 500), y + rnd.normal(0, 5, 500), y * 0 + 100], axis=1)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(p, y)],
                               "p0 double, p1 double, p2 double, y double")
    g = W.gram(df, ["p0", "p1", "p2"], "y")
    w = W.l2_weights(g)
    assert abs(w.sum() - 1) < 1e-9 and (w >= 0).all() and w[0] > w[1]
    direct = math.sqrt(np.mean((p @ w - y) ** 2))
    assert abs(g.rmse(w) - direct) < 1e-6
    gw, grmse = W.grid_weights(g, 0.05)
    assert abs(gw.sum() - 1) < 1e-9 and grmse <= g.rmse(np.array([1 / 3] * 3)) + 1e-9


def test_rmse_counts_unmatched(spark):
    pred = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, p double")
    truth = spark.createDataFrame([(1, 12.0), (3, 5.0)], "k int, y double")
    r = EV.rmse(pred, truth, "k", "p", "y").collect()[0]
    assert (r["n_pred"], r["n_truth"], r["n_matched"]) == (2, 2, 1) and r["rmse"] == 2.0


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    rep = {r["class"]: r for r in EV.classification_report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["recall"] == 0.0
    assert abs(rep["accuracy"]["f1"] - 2 / 3) < 1e-12


# ------------------------------------------------------------------ clustering
def test_lloyd_matches_numpy(spark):
    rnd = np.random.default_rng(1)
    pts = np.concatenate([rnd.normal(0, 1, (100, 2)), rnd.normal(8, 1, (100, 2))])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pts], "a double, b double")
    init = [[0.0, 0.0], [1.0, 1.0]]
    res = CL.lloyd(df, ["a", "b"], init, max_iter=2, fixed_iterations=True)
    c = np.array(init)
    for _ in range(2):
        lab = np.argmin(((pts[:, None, :] - c[None]) ** 2).sum(-1), axis=1)
        c = np.array([pts[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(2)])
    assert np.allclose(np.array(res.centers), c)


def test_merge_weak_segments(spark):
    """Rescored after each merge; a weak segment whose nearest centre is weak too stays."""
    df = spark.createDataFrame([(0, 5.0), (1, 1.0), (2, 1.0), (3, 9.0), (4, 9.0), (None, 1.0)], "seg int, e double")
    centers = {0: [0.0], 1: [1.0], 2: [10.0], 3: [50.0], 4: [51.0]}

    def rmse_of(frame, c):
        return {r[0]: r[1] for r in frame.filter(f"{c} IS NOT NULL").groupBy(c).agg(F.avg("e")).collect()}

    out, mapping = CL.merge_weak_segments(df, "seg", centers, rmse_of, threshold=4.0)
    assert mapping == {0: 1, 1: 1, 2: 2, 3: 3, 4: 4}
    assert {(r["seg"], r["merged_segment"]) for r in out.collect()} == {(0, 1), (1, 1), (2, 2), (3, 3), (4, 4), (None, None)}


def test_null_groups_keep_their_rows(spark):
    """Rows of the null group are there and are treated as one group."""
    from valuator.sources import holdout as H
    rows = [(i, None if i % 3 == 0 else "a" if i % 3 == 1 else "b", float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g string, x double").repartition(4)

    def per_group(frame, *by):
        return {tuple(r[c] for c in ("g", *by)): r["count"] for r in frame.groupBy("g", *by).count().collect()}

    train, test, _ = H.stratified_holdout(df, "id", "g", 60)
    assert per_group(test) == {(g,): 20 for g in (None, "a", "b")} and per_group(train) == {(g,): 80 for g in (None, "a", "b")}
    share = {r["g"]: (r["original_share"], r["test_share"]) for r in H.holdout_share_report(df, test, "g").collect()}
    assert len(share) == 3 and all(abs(a - 1 / 3) < 1e-12 and abs(b - 1 / 3) < 1e-12 for a, b in share.values())
    assert per_group(CL.cap_segment_sample(df, "id", "g", cap=30)) == {(g,): 30 for g in (None, "a", "b")}
    assert per_group(M.stratified_kfold_assign(df, "id", "g", 5), "fold") == {(g, f): 20 for g in (None, "a", "b") for f in range(5)}
    assert per_group(M.stratified_split(df, "id", "g", 0.2), "split") == {
        (g, s): n for g in (None, "a", "b") for s, n in (("test", 20), ("train", 80))}
    assert {r["g"]: r["n"] for r in N.gini_coefficient(df, "x", "g").collect()} == {None: 100, "a": 100, "b": 100}
    from valuator.operators.segment import segment_weights
    assert {round(r[0], 9) for r in segment_weights(df, "g").select("weight").collect()} == {round(3 ** 0.5, 9)}


@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sums_for_any_number_of_partitions(spark, descending):
    from valuator.plans.strategy import prefix_sums
    rnd = np.random.default_rng(3)
    vals = [float(v) for v in rnd.integers(0, 500, 3000)] + [float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in vals], "v double").groupBy("v").agg(F.count(F.lit(1)).alias("n")).cache()
    order = sorted({v for v in vals if v is not None}, reverse=descending) + [None]
    want, run = {}, 0
    for v in order:
        run += vals.count(v)
        want[v] = run
    for n in (1, 8, 400, 10_000):
        got = prefix_sums(df, "v", ["n"], descending, num_partitions=n).collect()
        assert {r["v"]: r["n_cum"] for r in got} == want


@pytest.mark.parametrize("mode", ["zero", "median", "ignore"])
def test_assign_no_price_modes(spark, mode):
    df = spark.createDataFrame([(1.0, 1.0)], "a double, b double")
    out = CL.assign_no_price(df, ["a", "b"], [[0.0, 1.0, 1.0], [12.0, 1.0, 1.0]], mode, median_log_price=11.0)
    assert out.collect()[0]["cluster"] == {"zero": 0, "median": 1, "ignore": 0}[mode]


def _plain_quantiles(values, probs):
    x = sorted(v for v in values if v is not None and v == v)
    out = []
    for p in probs:
        pos = (len(x) - 1) * p
        lo, hi = math.floor(pos), math.ceil(pos)
        out.append(x[lo] if x[lo] == x[hi] else (hi - pos) * x[lo] + (pos - lo) * x[hi])
    return out


@pytest.mark.parametrize("few", [4, 2048])
def test_quantiles_of_heavy_tails_hot_values_nan_and_infinity(spark, monkeypatch, few):
    from valuator.plans import strategy
    monkeypatch.setattr(strategy, "FEW_VALUES", few)
    monkeypatch.setattr(strategy, "FEW_OF_GROUP", few)
    rnd = random.Random(9)
    nan, inf = float("nan"), float("inf")
    data = [(rnd.choice("abbbc"), rnd.choice([0.0, 0.0, math.exp(rnd.gauss(0, 9)), -rnd.random()]), rnd.choice([1.0, 2.0, nan, None]),
             rnd.choice([inf, -inf, 3.0, 1.5e308, -1.5e308])) for _ in range(900)] + [(None, 5.0, 1.0, 0.0), ("c", 1e300, nan, nan)]
    df = spark.createDataFrame(data, "g string, x double, y double, z double").withColumn("none", F.lit(None).cast("double"))
    probs = [0.0, 0.01, 0.25, 0.5, 0.731, 0.99, 1.0]
    got = strategy.fit_quantiles(df, ["x", "y", "z", "none"], probs)
    assert got == {**{c: _plain_quantiles([r[i] for r in data], probs) for i, c in ((1, "x"), (2, "y"), (3, "z"))}, "none": None}
    for i, c in ((1, "x"), (3, "z")):
        by = {r["g"]: r["_q"] for r in strategy.group_quantiles(df, ["g"], c, probs).collect()}
        assert by == {g: _plain_quantiles([r[i] for r in data if r[0] == g], probs) for g in ("a", "b", "c", None)}


def test_attach_state_falls_back_to_shuffle_join(spark):
    from valuator.plans.strategy import attach_state, localize
    big = spark.range(200).withColumn("g", F.col("id") % 50)
    state = big.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    _, small = localize(state, max_rows=10)
    assert not small  # 50 groups > 10: not pulled to the driver
    a = attach_state(big, state, "g", "left", max_rows=10)
    b = attach_state(big, state, "g", "left", max_rows=1000)
    assert a.filter("n = 4").count() == 200 and b.filter("n = 4").count() == 200


def test_keys_beyond_a_long_product_do_not_overflow(spark):
    df = spark.createDataFrame([(9 * 10**17,), (5,), (5 + 2147483647,)], "k long")
    got = [r[0] for r in df.select(M.kfold_assign("k", 1000)).collect()]
    assert got[1] == got[2] == (5 * 48271 + 42) % 2147483647 % 1000 and 0 <= got[0] < 1000


def test_entropy_weights_minimise_the_reference_objective(spark):
    rnd = random.Random(3)
    data = []
    for _ in range(300):
        y = rnd.random() * 1e5
        data.append((y, y * 0.9 + rnd.gauss(0, 500), y * 1.3 + rnd.gauss(0, 900), rnd.random() * 1e5))
    df = spark.createDataFrame(data, "y double, a double, b double, c double")
    g = W.gram(df, ["a", "b", "c"], "y")
    w = W.entropy_weights(g)
    assert abs(w.sum() - 1) < 1e-9 and w.min() >= 0
    best = min(W.entropy_objective(g, np.array([i, j, 200 - i - j]) / 200) for i in range(201) for j in range(201 - i))
    assert W.entropy_objective(g, w) <= best + 1e-6 * abs(best)


def test_clusters_keep_rows_with_nulls(spark):
    df = spark.createDataFrame([(i, float(i % 7) if i % 5 else None, float(i)) for i in range(60)], "k int, a double, b double")
    _, labelled = CL.kmeans_segments(df, ["a", "b"], 2, restarts=1)
    assert sorted(r["k"] for r in labelled.filter("cluster IS NOT NULL").collect()) == list(range(60))
    assert CL.gmm_label(df, ["a", "b"], 2).count() == 60
    _, labelled = CL.cluster_errors(df, "a", range(2, 4))
    assert labelled.count() == 60


def test_merging_scores_the_segments_again(spark):
    df = spark.createDataFrame([(s, float(e)) for s, es in {0: (1, -1), 1: (9, -9), 2: (2, -2), 3: (8, 8)}.items() for e in es], "seg int, err double")
    centers = {0: [0.0], 1: [1.0], 2: [5.0], 3: [6.0]}
    seen = []

    def rmse_of(frame, col):
        seen.append({r[0]: r[1] for r in frame.groupBy(col).agg(F.sqrt(F.avg(F.col("err") * F.col("err")))).collect()})
        return seen[-1]

    out, mapping = CL.merge_weak_segments(df, "seg", centers, rmse_of, 6.0)
    # 1 goes to 0 and 3 to 2; then the merged 0 (rmse 6.4) is weak and goes back to 1's centre, the last scoring merges nothing
    assert set(seen[0]) == {0, 1, 2, 3} and set(seen[1]) == {0, 2} and mapping == {0: 1, 1: 1, 2: 2, 3: 2} and out.count() == 8
    assert CL.merge_round({0: [0.0], 1: [1.0], 2: [1.5]}, [1, 2]) == {}


def test_segments_small_or_null_are_predicted_too(spark):
    rnd = random.Random(1)
    data = [(i, "ab"[i % 2] if i < 150 else "tiny" if i < 155 else None, rnd.random(), 100 + 50 * rnd.random(), i % 2) for i in range(160)]
    df = spark.createDataFrame(data, "k int, seg string, x double, price double, fold int")
    small, learners = {None: {"rf": {"numTrees": 2, "maxDepth": 2}}}, ("rf", "linear")
    pred, scores, imp = M.per_segment_models(df, "k", "seg", "fold", ["x"], "price", learners, params_for=small)
    assert sorted(r["k"] for r in pred.filter("prediction IS NOT NULL").collect()) == list(range(160))
    assert {r["seg"] for r in scores.collect()} == {"a", "b", M.REST} and imp.count() == 3
    new = spark.createDataFrame([(1, "a", 0.5), (2, "unseen", 0.5), (3, None, 0.1), (4, "b", None)], "k int, seg string, x double")
    got = M.retrain_on_segments(df, new, "k", "seg", ["x"], "price", ("linear",)).collect()
    assert {r["k"]: r["model"] for r in got} == {1: "a", 2: M.REST, 3: M.REST, 4: "b"} and all(r["prediction"] for r in got)


def test_searches_take_any_number_of_folds(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(i, rnd.random(), 10 + rnd.random(), i % 5) for i in range(60)], "k int, x double, price double, fold int")
    assert M.grid_search(df, ["x"], "price", "fold", {"regParam": [0.0, 0.1]}, kind="linear").count() == 2
    assert M.random_search(df, ["x"], "price", "fold", {"regParam": [0.0, 0.1, 1.0]}, n=3, kind="linear").count() == 3


def test_boxcox_columns_do_not_share_rows(spark):
    rnd = random.Random(4)
    data = [(math.exp(rnd.gauss(0, 1)), None if i % 2 else math.exp(rnd.gauss(0, 1))) for i in range(200)]
    df = spark.createDataFrame(data, "a double, b double")
    one = N.boxcox_fit(df, ["a"]).collect()
    assert one[0] in N.boxcox_fit(df, ["a", "b"]).collect()


def test_token_keeps_letters_of_any_script(spark):
    df = spark.createDataFrame([("Citroën C3 / Été № 5",)], "s string")
    assert df.select(T.clean_token("s")).first()[0] == "citroën_c3___été_5"


def test_stacked_ridge_fills_missing_base_predictions(spark):
    rnd = random.Random(6)
    data = [(i, i % 4, float(y), None if i % 9 == 0 else y * 0.9, y * 1.1) for i, y in enumerate(rnd.random() * 100 for _ in range(80))]
    df = spark.createDataFrame(data, "k int, fold int, y double, a double, b double")
    table, oof, test = W.stacked_nonneg_ridge(df, ["a", "b"], "y", "fold", test=df)
    assert table.count() == 4 and oof.filter("blend IS NOT NULL").count() == test.filter("blend IS NOT NULL").count() == 80


@pytest.mark.parametrize("name, scans, exchanges", [("route_by_class", 2, 2), ("model_band_pivot", 2, 4)])
def test_plans_scan_once(spark, name, scans, exchanges):
    """The listing view is a join of two tables: two scans, and two exchanges unless a side is broadcast."""
    import __spark_entry__ as entry
    plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    executed = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == scans and executed.count("Exchange") <= exchanges + 1


def test_normal_scores_of_box_cox(spark):
    import statistics

    import numpy as np

    from valuator.operators import normality as R
    rnd, nd = random.Random(8), statistics.NormalDist()
    data = [(math.exp(rnd.gauss(1, 0.7)), None if i % 3 == 0 else float(int(rnd.expovariate(0.2))), 1.0) for i in range(400)]
    data += [(float("nan"), -5.0, 1.0), (None, None, None)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {r["column"]: r for r in R.boxcox_normal_scores(df, ["a", "b", "c"], skew_threshold=0.0).collect()}
    assert set(got) == {"a", "b"}  # one value only: nothing to transform

    def corr(x, lam):
        n = len(x)
        p = [(i - 0.3175) / (n + 0.365) for i in range(1, n + 1)]
        p[-1] = 0.5 ** (1 / n)
        p[0] = 1 - p[-1]
        y = np.log(x) if lam == 0 else (x ** lam - 1) / lam
        return np.corrcoef([nd.inv_cdf(v) for v in p], y)[0, 1]

    for i, c in enumerate("ab"):
        x = np.sort([1 + r[i] for r in data if r[i] is not None and r[i] > -1])
        lams = [round(got[c]["lambda"] + d * 0.0005, 6) for d in range(-400, 401)]
        best = max(lams, key=lambda lam: corr(x, lam))
        assert abs(best - got[c]["lambda"]) <= 1e-3 and abs(corr(x, got[c]["lambda"]) - got[c]["corr"]) < 1e-9
    far = spark.createDataFrame([((1 + i / 50) ** 0.25 - 1,) for i in range(300)], "a double")
    assert R.boxcox_normal_scores(far, ["a"], 0.0).first()["lambda"] > 2  # outside of the first range
    assert R.boxcox_normal_scores(df.limit(0), ["a", "b"]).count() == 0


def test_mutual_information_of_neighbours(spark):
    import numpy as np

    from valuator.operators import normality as R
    rnd = random.Random(9)
    data = []
    for i in range(700):
        x = rnd.gauss(0, 1)
        # a continuous one, a heavy tail with ties, few values of which one is hot, one with holes
        data.append((x, round(math.exp(rnd.gauss(0, 3)), 1), float(rnd.choice([0, 0, 0, 1, 2])), None if i % 4 == 0 else -x,
                     x + rnd.gauss(0, 0.3)))
    data += data[:30] + [(float("nan"), float("inf"), 1.0, None, 0.5), (1.0, 1.0, None, 1.0, None)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, y double")

    def brute(i, k):
        ok = [[v if v is not None and math.isfinite(v) else math.nan for v in (r[i], r[4])] for r in data]
        ys = np.array([v[1] for v in ok])
        xs = np.array([v[0] for v in ok])
        q = np.stack([np.floor((v - np.nanmean(v)) / np.nanstd(v) * (1 << 20) + 0.5) for v in (xs, ys)], 1)
        q = q[~np.isnan(q).any(axis=1)].astype(np.int64)
        n = len(q)
        dx, dy = (abs(q[:, None, j] - q[None, :, j]) for j in (0, 1))
        d = np.maximum(dx, dy)
        np.fill_diagonal(d, 1 << 60)
        reach = np.maximum(np.sort(d, axis=1)[:, k - 1] - 1, 0)[:, None]
        psi = np.concatenate([[np.nan, 0], np.cumsum(1 / np.arange(1, n + 1))]) - 0.5772156649015329
        return n, max(0.0, psi[n] + psi[k] - psi[(dx <= reach).sum(1)].mean() - psi[(dy <= reach).sum(1)].mean())

    for k in (1, 3):
        for r in R.neighbour_mutual_info(df, ["a", "b", "c", "d"], "y", k).collect():
            n, info = brute("abcd".index(r["feature"]), k)
            assert r["n"] == n and abs(r["mutual_info"] - info) < 1e-7, r
    assert [r["mutual_info"] for r in R.neighbour_mutual_info(df.limit(3), ["a"], "y", 3).collect()] == [None]
    assert [r["n"] for r in R.neighbour_mutual_info(df.limit(0), ["a", "b"], "y").collect()] == [0, 0]


def test_distance_squared_draws_have_their_law(spark):
    pts = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [3.0, 0.0]), (4, [3.0, 0.0])]
    df = spark.createDataFrame(pts, "k int, v array<double>").repartition(3).cache()
    runs = [s for seed in range(8) for s in CL.distance_squared_seeds(df, "v", "k", 2, restarts=50, seed=seed)]
    expected = {}
    for _, a in pts:
        w = [sum((x - y) ** 2 for x, y in zip(a, b)) for _, b in pts]
        for (_, b), x in zip(pts, w):
            pair = (tuple(a), tuple(b))
            expected[pair] = expected.get(pair, 0.0) + 0.2 * x / sum(w)
    got = {}
    for a, b in runs:
        got[tuple(a), tuple(b)] = got.get((tuple(a), tuple(b)), 0) + 1
    assert set(got) <= {p for p, x in expected.items() if x > 0}
    for pair, x in expected.items():  # within four standard deviations of 400 draws
        assert abs(got.get(pair, 0) / 400 - x) <= 4 * math.sqrt(x * (1 - x) / 400) + 1e-12, pair
    assert [len(s) for s in CL.distance_squared_seeds(df, "v", "k", 9, restarts=2)] == [4, 4]  # four different points
    assert runs[:50] == CL.distance_squared_seeds(df.coalesce(1), "v", "k", 2, restarts=50, seed=0)
    df.unpersist()


def test_kmeans_restarts(spark):
    rnd = random.Random(12)
    data = [(i, 10.0 * (i % 3) + rnd.gauss(0, 0.3), None if i % 40 == 7 else rnd.gauss(0, 0.3)) for i in range(300)]
    df = spark.createDataFrame(data, "k int, x double, y double")
    rows, table = CL.kmeans_restarts(df, ["x", "y"], "k", 3, restarts=4)
    got = {r["k"]: r["cluster"] for r in rows.collect()}
    assert len(got) == 300 and len({(k % 3, c) for k, c in got.items()}) == 3
    costs = [r["cost"] for r in table.collect()]
    assert len(costs) == 4 and min(costs) < 100
    none, empty = CL.kmeans_restarts(df.limit(0), ["x", "y"], "k", 3)
    assert none.count() == empty.count() == 0


def test_colocated_join_has_no_exchange(spark):
    from valuator.operators import joins as J
    big = spark.createDataFrame([(i, None if i % 3 == 0 else ("hot" if i % 3 == 1 else f"m{i % 7}"), i % 2) for i in range(200)], "k int, make string, model int")
    ref = spark.createDataFrame([(m, j, float(j)) for m in ("hot", "m1", "m2", None) for j in (0, 1)], "make string, model int, price double")
    names = J.colocate(big, ref, ["make", "model"], "k", 4, spread=3)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = J.colocated_join(spark, *names, ["make", "model"])
        rows = out.collect()
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = {r["k"]: r["price"] for r in big.join(ref, ["make", "model"], "left").collect()}
    assert len(rows) == 200 and {r["k"]: r["price"] for r in rows} == want
    assert sum(p is not None for p in want.values()) > 60


def test_guided_search_needs_fewer_fits_than_random_search(spark):
    rnd = random.Random(5)
    data = []
    for i in range(90):
        x = [rnd.gauss(0, 1) for _ in range(3)]
        data.append((i, *x, math.expm1(2 + x[0] + 0.5 * x[1] + rnd.gauss(0, 0.3)), i % 3))
    df = spark.createDataFrame(data, "k int, a double, b double, c double, price double, fold int")
    space = {"regParam": ("log", 1e-4, 1e2), "elasticNetParam": [0.0, 1.0]}
    got = M.guided_search(df, ["a", "b", "c"], "price", "fold", space, rounds=3, batch=4, kind="linear", seed=1).collect()
    lists = {"regParam": [10 ** (-4 + 6 * i / 40) for i in range(41)], "elasticNetParam": [0.0, 1.0]}
    other = M.random_search(df, ["a", "b", "c"], "price", "fold", lists, n=10, kind="linear", seed=1).collect()
    fits = sum(r["fits"] for r in got)
    assert fits < 3 * 10 and got[0]["finished"] and got[0]["cv_rmse"] <= other[0]["cv_rmse"] + 0.01
    assert all(r["fits"] == 3 for r in got if r["finished"]) and any(not r["finished"] for r in got)
    done = [r["cv_rmse"] for r in got if r["finished"]]
    assert done == sorted(done)


def test_ranges_of_the_guided_search():
    rnd = random.Random(3)
    for spec, ok in ((("log", 0.01, 10.0), lambda v: 0.01 <= v <= 10.0 + 1e-9), (("int", 2, 6), lambda v: v in (2, 3, 4, 5, 6)),
                     (("float", -1.0, 1.0), lambda v: -1 <= v <= 1), (["a", "b"], lambda v: v in ("a", "b"))):
        r = M._Range(spec)
        seen = [r.draw(rnd) for _ in range(3)]
        assert all(ok(r.propose(rnd, seen)) and r.density(r.draw(rnd), seen) > 0 for _ in range(200))
    near = M._Range(("float", 0.0, 1.0))
    assert near.density(0.5, [0.5, 0.52]) > near.density(0.95, [0.5, 0.52])
    # the estimate is a density: it adds up to 1 but for what the kernels lose at the ends
    assert 0.9 < sum(near.density(i / 1000, [0.5, 0.45]) for i in range(1000)) / 1000 <= 1.001
    with pytest.raises(ValueError):
        M._Range(("log", 0.0, 1.0))


def test_restart_draws_do_not_sort_the_rows(spark):
    """A least struct of a vector is found by sorting, so every step sorted each row once a restart; ties for a least time go to the lesser vector."""
    df = spark.createDataFrame([(None, [float(9 - i % 10), 1.0]) for i in range(200)], "k int, v array<double>").repartition(3)
    seen = []
    real = CL.fit_row
    try:
        CL.fit_row = lambda frame, *aggs: seen.append(frame.agg(*aggs)._jdf.queryExecution().executedPlan().toString()) or real(frame, *aggs)
        drawn = CL.distance_squared_seeds(df, "v", "k", 2, restarts=2)
    finally:
        CL.fit_row = real
    assert len(seen) == 2 and not any("Sort" in p for p in seen)
    # all keys are equal: the first draw is a tie of all rows, the second one takes the farthest
    assert drawn == [[[0.0, 1.0], [9.0, 1.0]]] * 2


def test_mixtures_of_all_sizes_share_each_pass(spark):
    """Equal to the library's mixtures fitted one by one, with one scan an iteration for all sizes that are open."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import vector_to_array

    from valuator.operators import mixture as MX
    rnd = random.Random(5)
    data = [(rnd.gauss(8.0 * (i % 3), 1.0), rnd.gauss(4.0 * (i % 2), 0.7)) for i in range(400)]
    rows = CL._assemble(spark.createDataFrame(data, "x double, y double"), ["x", "y"]).withColumn("_x", vector_to_array("features")).cache()
    scans = []
    real = MX._sums
    try:
        MX._sums = lambda r, v, tried, d: scans.append(len(tried)) or real(r, v, tried, d)
        found = MX.fit_mixtures(rows, "features", "_x", [2, 3, 4])
    finally:
        MX._sums = real
    assert scans[0] == 3 and len(scans) == max(m.iterations for m in found.values()) < sum(m.iterations for m in found.values())
    for n, m in found.items():
        own = GaussianMixture(k=n, seed=42, featuresCol="features").fit(rows)
        assert abs(own.summary.logLikelihood - m.log_likelihood) < 1e-6 and own.summary.numIter == m.iterations
        assert max(abs(own.weights - m.weights)) < 1e-8
        both = own.transform(rows).withColumn("_c", MX.component(m, "_x")).select("prediction", "_c").collect()
        assert all(r["prediction"] == r["_c"] for r in both)
    rows.unpersist()


def test_mutual_information_of_neighbours_in_many_cells(spark, monkeypatch):
    """Points look into other cells, rows have their ends in two chunks, a value that many rows share is several calls' work."""
    import numpy as np

    from valuator.operators import normality as R
    rnd, n, k = random.Random(5), 900, 3
    hot = [rnd.choice([0.0, 0.0, 1.0, rnd.gauss(0, 1)]) for _ in range(n)]
    data = [(rnd.gauss(0, 1), h, math.exp(rnd.gauss(0, 2)), 7.0, round(rnd.gauss(0, 1), 1 + i % 2)) for i, h in enumerate(hot)]
    data += data[:200] + data[:50] * 3
    df = spark.createDataFrame(data, "a double, b double, c double, d double, y double")
    visited = []
    cells = R._cells
    monkeypatch.setattr(R, "_cells", lambda *a: visited.append(cells(*a).select("_cell").distinct().count()) or cells(*a))
    for cell, counted in ((40, 30), (300, 1 << 18)):
        monkeypatch.setattr(R, "CELL_POINTS", cell)
        monkeypatch.setattr(R, "COUNTED_POINTS", counted)
        got = {r["feature"]: r["mutual_info"] for r in R.neighbour_mutual_info(df, ["a", "b", "c", "d"], "y", k).collect()}
        assert visited.pop() > 4 * 700 // cell
        for i, c in enumerate("abcd"):
            q = np.array([(r[i], r[4]) for r in data])
            q = np.floor((q - q.mean(axis=0)) / np.where(q.std(axis=0) > 0, q.std(axis=0), 1) * (1 << 20) + 0.5).astype(np.int64)
            dx, dy = (abs(q[:, None, j] - q[None, :, j]) for j in (0, 1))
            d = np.maximum(dx, dy)
            np.fill_diagonal(d, 1 << 60)
            reach = np.maximum(np.sort(d, axis=1)[:, k - 1] - 1, 0)[:, None]
            psi = np.concatenate([[np.nan, 0], np.cumsum(1 / np.arange(1, len(q) + 1))]) - 0.5772156649015329
            info = max(0.0, psi[len(q)] + psi[k] - psi[(dx <= reach).sum(1)].mean() - psi[(dy <= reach).sum(1)].mean())
            assert abs(got[c] - info) < 1e-7, (c, got[c], info)


def test_restarts_use_all_cores_and_equal_plain_lloyd(spark, monkeypatch):
    """A large frame of one part is spread, and every pass gives a row a task; centres, iterations and costs are those of plain steps."""
    import numpy as np
    from valuator.plans import strategy as S
    monkeypatch.setattr(S, "SPREAD_ROWS", 100)
    parts, draws, sums, seen = [], CL.distance_squared_seeds, CL._cluster_sums, []

    def seeds(rows, *more):
        parts.append(rows.rdd.getNumPartitions())
        seen.append(draws(rows, *more))
        return seen[-1]

    passes = []
    monkeypatch.setattr(CL, "distance_squared_seeds", seeds)
    monkeypatch.setattr(CL, "_cluster_sums", lambda rows, *more: passes.append(more[1]) or sums(rows, *more))
    rnd = random.Random(4)
    data = [(None if i % 50 == 0 else i // 2, rnd.choice([0.0, 5.0, 9.0]) + rnd.random(), rnd.random()) for i in range(400)]
    df = spark.createDataFrame(data, "k int, x double, y double").coalesce(1)
    labelled, table = CL.kmeans_restarts(df, ["x", "y"], "k", 3, restarts=3)
    assert parts == [spark.sparkContext.defaultParallelism]
    got = {r["restart"]: r for r in table.collect()}
    x = np.array([r[1:] for r in data])
    tol, best = 1e-4 * x.var(axis=0).sum() / 2, {}
    for r, centers in enumerate(np.array(c) for c in seen[0]):
        for n in range(1, 301):
            d = ((x[:, None] - centers) ** 2).sum(2)
            new = np.array([x[d.argmin(1) == j].mean(0) if (d.argmin(1) == j).any() else c for j, c in enumerate(centers)])
            if ((new - centers) ** 2).sum() <= tol:
                break
            centers = new
        best[r] = (d.min(1).sum(), d.argmin(1))
        assert got[r]["iterations"] == n and abs(got[r]["cost"] - best[r][0]) < 1e-6
    assert len(passes) == max(r["iterations"] for r in got.values())
    want = dict(zip(map(tuple, x), min(best.values(), key=lambda b: b[0])[1]))
    assert all(r["cluster"] == want[r["x"], r["y"]] for r in labelled.collect()) and labelled.count() == 400


def test_error_clusters_read_a_spread_frame_of_errors(spark, monkeypatch):
    """The fits of a large frame of one part use all cores; a row's label depends on its error alone, and a missing one counts as the median."""
    from valuator.plans import strategy as S
    monkeypatch.setattr(S, "SPREAD_ROWS", 100)
    seen, best = [], CL._best_kmeans
    monkeypatch.setattr(CL, "_best_kmeans", lambda data, *more: seen.append((data.columns, data.rdd.getNumPartitions())) or best(data, *more))
    rnd = random.Random(2)
    data = [(i, None if i % 20 == 0 else rnd.choice([-50.0, 0.0, 70.0]) + rnd.choice([0.0, 0.5])) for i in range(300)]
    df = spark.createDataFrame(data, "k int, e double").coalesce(1)
    k, labelled = CL.cluster_errors(df, "e", range(2, 4))
    assert seen == [(["_z", "features"], spark.sparkContext.defaultParallelism)] * 2
    got = {r["k"]: (r["e"], r["error_cluster"]) for r in labelled.collect()}
    assert k == 3 and len(got) == 300 and len({c for _, c in got.values()}) == 3
    assert len({(e // 10, c) for e, c in got.values() if e is not None}) == 3
    whole = CL.silhouette_1d(spark.createDataFrame([(v, c) for v, c, n in ((1.0, 0, 2), (2.0, 0, 3), (9.0, 1, 1)) for _ in range(n)], "v double, c int"), "v", "c")
    brief = CL.silhouette_1d(spark.createDataFrame([(1.0, 0, 2), (2.0, 0, 3), (9.0, 1, 1)], "v double, c int, n int"), "v", "c", copies="n")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, brief.collect()))
