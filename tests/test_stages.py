"""Encoders, Huber boosting and patience as pipeline stages; training layout; exact silhouette."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from valuator.operators import cluster as C
from valuator.operators import train as M
from valuator.operators.huber import HuberBoostedTrees
from valuator.operators.stages import FlagEncoder, MeanEncoder

SCHEMA = "id long, make string, kind string, cats string, x double, price double, fold int"
MAKES = ["a", "b", "c", None, "rare"]


def listings(n=400, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        make = MAKES[4] if i == 7 else rng.choice(MAKES[:4])
        x = rng.random()
        rows.append((i, make, rng.choice(["s", "t", None]), rng.choice(["p, q", "p", "-", "", None, "q,r"]), None if i % 17 == 0 else x,
                     1000.0 * (2 + "abc".find(make or "a") + 3 * x), i % 4))
    return rows


def plain_code(rows, i, held, smoothing=1.0):
    """Code of row i in the model that holds out a fold; the row's own fold is left out too."""
    name = lambda r: r[1] or "unknown"
    seen = [r for r in rows if r[6] != held and r[6] != rows[i][6]]
    prior = sum(r[5] for r in seen) / len(seen)
    own = [r[5] for r in seen if name(r) == name(rows[i])]
    if len(own) <= 1:
        return prior
    w = 1 / (1 + math.exp((1 - len(own)) / smoothing))
    return prior * (1 - w) + sum(own) / len(own) * w


def test_mean_codes_equal_plain_python_and_hold_no_own_price(spark):
    rows = listings()
    enc = MeanEncoder(inputCols=["make"], outputCols=["code"], labelCol="price", foldCol="fold")

    def codes(data, held):
        df = spark.createDataFrame(data, SCHEMA)
        return {r["id"]: r["code"] for r in enc.fit(df.filter(F.col("fold") != held)).transform(df).collect()}

    got = codes(rows, 1)
    assert len(got) == len(rows)
    for i in range(len(rows)):
        assert got[i] == pytest.approx(plain_code(rows, i, 1), rel=1e-9)
    for i in (10, 13):  # a training row, and one that is held out
        changed = [(*r[:5], 1e9, r[6]) if r[0] == i else r for r in rows]
        assert codes(changed, 1)[i] == pytest.approx(got[i], rel=1e-9)


def test_mean_codes_without_folds_and_for_new_rows(spark):
    rows = listings()
    df = spark.createDataFrame(rows, SCHEMA)
    model = MeanEncoder(inputCols=["make"], outputCols=["code"], labelCol="price").fit(df)
    prior = sum(r[5] for r in rows) / len(rows)
    new = spark.createDataFrame([(1, "never"), (2, "a"), (3, "rare"), (4, None)], "id long, make string")
    got = {r["id"]: r["code"] for r in model.transform(new).collect()}
    assert got[1] == pytest.approx(prior) and got[3] == pytest.approx(prior)
    for i, make in ((2, "a"), (4, None)):
        own = [r[5] for r in rows if r[1] == make]
        w = 1 / (1 + math.exp(1 - len(own)))
        assert got[i] == pytest.approx(prior * (1 - w) + sum(own) / len(own) * w)


def test_flags_and_bundle_round_trip(spark, tmp_path):
    rows = listings()
    df = spark.createDataFrame(rows, SCHEMA)
    flags = FlagEncoder(inputCols=["kind", "cats"], listCols=["cats"], outputCol="flags").fit(df)
    assert flags.names() == ["kind=s", "kind=t", "cats=p", "cats=q", "cats=r"]
    for r in flags.transform(df).collect():
        tokens = {t.strip() for t in (r["cats"] or "").split(",")}
        assert list(r["flags"]) == [float(r["kind"] == "s"), float(r["kind"] == "t"), *(float(t in tokens) for t in "pqr")]
    cats = M.Categories(coded=("make",), flagged=("kind",), listed=("cats",), fold="fold")
    run = M.oof_run(df, "id", ["x"], "price", "fold", "gbt", params={"maxIter": 3, "maxDepth": 3}, categories=cats)
    assert run.oof.count() == run.oof.select("id").distinct().count() == len(rows)
    assert {n for _, n, _ in run.importances} == {"x", "_te_make", "kind=s", "kind=t", "cats=p", "cats=q", "cats=r"}
    M.save_model_bundle(run.models, str(tmp_path), "g", "price", spark)
    again = PipelineModel.load(f"{tmp_path}/g/fold=2")
    data = M._prepare(df, ["x"], "price", True).filter("fold = 2")
    cols = ["id", "_te_make", "_flags", "_pred"]
    assert sorted(map(str, again.transform(data).select(*cols).collect())) == sorted(map(str, run.models[2].transform(data).select(*cols).collect()))


def test_patience_cuts_at_the_best_round(spark):
    assert M.best_round([5.0, 4.0, 4.5, 4.4, 3.0], 2) == 2 and M.best_round([5.0, 4.0, 4.5, 4.4, 3.0], 3) == 5
    assert M.best_round([3.0, 3.0, 3.0], 5) == 1
    df = spark.createDataFrame(listings(300, 3), SCHEMA)
    df = df.withColumn("price", F.col("price") * (1 + F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0))
    run = M.oof_run(df, "id", ["x"], "price", "fold", "gbt", params={"maxIter": 12, "maxDepth": 4, "stepSize": 0.5}, patience=4)
    ev = RegressionEvaluator(labelCol="_y", predictionCol="_pred")
    for f, scores in run.rounds.items():
        held = M._prepare(df, ["x"], "price", True).filter(F.col("fold") == f)
        model = run.models[f]
        kept = len(model.stages[-1].trees)
        assert len(scores) == 12 and kept == M.best_round(scores, 4)
        # brute force over the prefixes that are left
        for k in range(1, kept + 1):
            assert ev.evaluate(M.cut_boosting(model, k).transform(held)) == pytest.approx(scores[k - 1], rel=1e-9)


def test_huber_beats_absolute_loss_on_outliers(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 6, 600)
    clean = 10 * np.sin(x)
    y = clean + rng.normal(0, 0.5, 600) + np.where(rng.random(600) < 0.08, 200.0, 0.0)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x, y, clean)], "x double, y double, clean double")
    settings = {"maxIter": 12, "maxDepth": 3, "stepSize": 0.4}
    pipe = lambda kind, more: M.regression_pipeline(["x"], "y", kind, params={**settings, **more}).fit(df)
    huber, absolute = pipe("huber", {"quantile": 0.85}), pipe("gbt", {"lossType": "absolute"})
    ev = RegressionEvaluator(labelCol="clean", predictionCol="_pred")
    assert ev.evaluate(huber.transform(df)) < ev.evaluate(absolute.transform(df))
    losses = huber.stages[-1].losses
    assert len(losses) == 12 and all(b < a for a, b in zip(losses, losses[1:]))
    huber.write().overwrite().save(f"{tmp_path}/h")
    again = PipelineModel.load(f"{tmp_path}/h").transform(df).select("x", "_pred").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, huber.transform(df).select("x", "_pred").collect()))


def test_huber_of_constant_labels_has_no_trees(spark):
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None)], "x double, label double"))
    model = HuberBoostedTrees(maxIter=3).fit(df)
    assert not hasattr(model, "featureImportances")
    assert model.trees == [] and {r["prediction"] for r in model.transform(df).collect()} == {5.0}


def test_importances_of_three_models_are_merged(spark):
    rng = random.Random(5)
    rows = [(i, rng.random(), rng.random(), None, i % 2) for i in range(160)]
    rows = [(i, a, b, 1000.0 * (2 + 5 * a + b), f) for i, a, b, _, f in rows]
    df = spark.createDataFrame(rows, "id long, a double, b double, price double, fold int")
    small = {"maxIter": 2, "maxDepth": 3}
    runs = {"gbt": M.oof_run(df, "id", ["a", "b"], "price", "fold", "gbt", params=small),
            "huber": M.oof_run(df, "id", ["a", "b"], "price", "fold", "huber", params=small),
            "rf": M.oof_run(df, "id", ["a", "b"], "price", "fold", "rf", params={"numTrees": 5, "maxDepth": 3})}
    got = M.feature_importance(runs, spark).collect()
    assert [r["feature"] for r in got] == ["a", "b"]
    for name, run in runs.items():
        assert sum(r[f"importance_{name}"] for r in got) == pytest.approx(1.0)
        for r in got:
            assert r[f"importance_{name}"] == pytest.approx(np.mean([v for _, x, v in run.importances if x == r["feature"]]))
    assert all(r["importance_mean"] == pytest.approx(np.mean([r[f"importance_{n}"] for n in runs])) for r in got)


def test_segment_training_reads_its_own_folders(spark, tmp_path):
    rows = [(*r[:2], None if r[0] % 9 == 0 else r[2], *r[3:]) for r in listings(240)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.coalesce("x", F.lit(0.5)))
    pred, scores, _ = M.per_segment_models(df, "id", "kind", "fold", ["x"], "price", learners=("linear",), path=f"{tmp_path}/p")
    got = pred.collect()
    assert sorted(r["id"] for r in got) == list(range(240)) and all(r["prediction"] > 0 for r in got)
    plan = pred._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters: [isnotnull(_seg" in line and "_fold" in line.split("PartitionFilters")[1] for line in scans)
    # each folder belongs to one scan: together the scans read every row once
    layout = spark.read.parquet(f"{tmp_path}/p")
    assert layout.count() == 240 and len(scans) == layout.select("_seg", "_fold").distinct().count()
    new = df.withColumn("kind", F.when(F.col("id") < 5, "unseen").otherwise(F.col("kind")))
    out = M.retrain_on_segments(df, new, "id", "kind", ["x"], "price", learners=("linear",), path=f"{tmp_path}/q").collect()
    assert sorted(r["id"] for r in out) == list(range(240))
    assert all(r["model"] == M.REST for r in out if r["id"] < 5 or rows[r["id"]][2] is None)


def brute_silhouette(points):
    out = {}
    for i, (x, c) in enumerate(points):
        far = {d: [abs(x - y) for j, (y, e) in enumerate(points) if e == d and j != i] for d in {e for _, e in points}}
        others = [sum(v) / len(v) for d, v in far.items() if d != c]
        if not others:
            out.setdefault(c, []).append(None)
            continue
        a, b = (sum(far[c]) / len(far[c]) if far[c] else None), min(others)
        out.setdefault(c, []).append(0.0 if a is None or max(a, b) == 0 else (b - a) / max(a, b))
    return out


def test_silhouette_equals_brute_force(spark):
    rng = random.Random(1)
    points = [(round(rng.gauss(3 * c, 1.5), 1), c) for c in range(4) for _ in range(60)] + [(100.0, 9)]
    df = spark.createDataFrame([*points, (None, 1), (float("nan"), 1), (1.0, None)], "v double, c int").repartition(3)
    want = brute_silhouette(points)
    for r in C.silhouette_1d(df, "v", "c").collect():
        assert r["n"] == len(want[r["c"]]) and r["silhouette"] == pytest.approx(sum(want[r["c"]]) / r["n"], abs=1e-9)
    one = C.silhouette_1d(spark.createDataFrame([(1.0, 0), (2.0, 0)], "v double, c int"), "v", "c").collect()
    assert [tuple(r) for r in one] == [(0, 2, None)]
    assert C.silhouette_1d(spark.createDataFrame([], "v double, c int"), "v", "c").collect() == []


def test_linear_paths_equal_plain_fits(spark):
    """Ridge equals the normal equations of the rows themselves, lasso meets its optimality conditions, errors are those of the rows."""
    from valuator.operators import linear_path as L
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (400, 4)) * [1, 5, 0.1, 1] + [0, 100, 0, 3]
    y = x @ [2.0, -1.0, 0.0, 0.0] + 50 + rng.normal(0, 1, 400)
    df = spark.createDataFrame([(i, *map(float, r), float(t), i % 3) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, y double, fold int")
    feats, fold = ["a", "b", "c", "d"], np.arange(400) % 3
    got = {(r["model"], r["alpha"]): r for r in L.linear_paths(df, "id", feats, "y", "fold", (0.5, 20.0)).collect()}
    for alpha in (0.5, 20.0):
        sq = 0.0
        for f in range(3):
            tx, ty = x[fold != f], y[fold != f]
            cx, cy = tx - tx.mean(0), ty - ty.mean()
            w = np.linalg.solve(cx.T @ cx + alpha * np.eye(4), cx.T @ cy)
            sq += ((y[fold == f] - ty.mean() - (x[fold == f] - tx.mean(0)) @ w) ** 2).sum()
        assert got["ridge", alpha]["cv_rmse"] == pytest.approx(math.sqrt(sq / 400), rel=1e-9)
    sums = L.training_sums(df, "id", feats, "y", "fold")
    assert sum(s.n for s in sums.values()) == 400
    everything = L._total(list(sums.values()))
    gram, xy, _ = everything.centered()
    cx, cy = x - x.mean(0), y - y.mean()
    assert np.allclose(gram, cx.T @ cx) and np.allclose(xy, cx.T @ cy)
    for l1 in (1.0, 0.5):
        w = L.elastic_net_weights(gram, xy, 400, 0.3, l1)
        slope = cx.T @ (cy - cx @ w) / 400 - 0.3 * (1 - l1) * w
        for j in range(4):
            assert abs(slope[j]) <= 0.3 * l1 + 1e-6 if w[j] == 0 else slope[j] == pytest.approx(0.3 * l1 * np.sign(w[j]), abs=1e-6)
    curve = L.linear_learning_curve(df, "id", feats, "y", "fold").collect()
    assert [r["train_fraction"] for r in curve] == [d / 10 for d in range(1, 11)] and curve[-1]["cv_rmse"] < 1.2


def test_huber_rounds_read_their_rows_without_features(spark, monkeypatch):
    """Quantiles and leaf means of a round come from a kept frame of labels, predictions and leaves, not from the trees run again."""
    from valuator.operators import huber as H
    plans, quantiles = [], H.group_quantiles
    monkeypatch.setattr(H, "group_quantiles", lambda df, *more: plans.append(df._jdf.queryExecution().executedPlan().toString()) or quantiles(df, *more))
    rng = random.Random(1)
    df = spark.createDataFrame([(x, 3 * x + rng.random()) for x in (rng.random() for _ in range(200))], "x double, y double")
    model = M.regression_pipeline(["x"], "y", "huber", params={"maxIter": 3, "maxDepth": 2}).fit(df)
    assert len(model.stages[-1].trees) == len(plans) == 3 and all("InMemoryTableScan" in p for p in plans)


def test_fits_of_large_frames_use_all_cores(spark, monkeypatch):
    from valuator.plans import strategy as S
    monkeypatch.setattr(S, "SPREAD_ROWS", 100)
    pipeline, parts = M.regression_pipeline, []

    class Seen:
        def __init__(self, inner):
            self.inner = inner

        def fit(self, rows):
            parts.append(rows.rdd.getNumPartitions())
            return self.inner.fit(rows)

    monkeypatch.setattr(M, "regression_pipeline", lambda *a, **more: Seen(pipeline(*a, **more)))
    df = spark.createDataFrame(listings(300), SCHEMA).coalesce(1)
    run = M.oof_run(df, "id", ["x"], "price", "fold", "linear")
    M.learning_curve(df, "id", ["x"], "price", "fold", sizes=(0.5, 1.0), kind="linear")
    assert run.oof.count() == 300 and len(parts) > 2 and min(parts) >= spark.sparkContext.defaultParallelism
    assert M.fits_at_a_time(1_000) == M.PARALLEL_FITS and M.fits_at_a_time(10 * M.FIT_ROWS) == 1 and M.fits_at_a_time(0, 3) == 3


def test_linear_curve_from_sums_equals_the_pipeline(spark, monkeypatch):
    """The linear learning curve fits no pipeline, and has the errors of the pipelines that it stands for, gaps filled by each fit's own median."""
    from pyspark.ml.evaluation import RegressionEvaluator
    rng = random.Random(6)
    data = []
    for i in range(400):
        a, b = rng.gauss(50, 20), rng.random()
        data.append((i, None if i % 9 == 0 else a, float("nan") if i % 7 == 0 else b, 3.0, 1000 + 30 * a + 500 * b * b + rng.gauss(0, 40), i % 3))
    df = spark.createDataFrame(data, "id long, a double, b double, c double, price double, fold int")
    feats, sizes = ["a", "b", "c"], (0.3, 1.0)
    rows = M._prepare(df, feats, "price", True).withColumn("_h", M.mix_hash("id", 7) / F.lit(float(M.LCG_MOD)))
    ev = RegressionEvaluator(labelCol="_y", predictionCol="_pred", metricName="rmse")
    want = {}
    for s in sizes:
        for f in range(3):
            part = rows.filter((F.col("fold") != f) & (F.col("_h") < s))
            m = M.regression_pipeline(feats, "_y", "linear").fit(part)
            want[s, f] = ev.evaluate(m.transform(part)), ev.evaluate(m.transform(rows.filter(F.col("fold") == f)))
    monkeypatch.setattr(M, "regression_pipeline", lambda *a, **more: pytest.fail("a pipeline was fitted"))
    for r in M.learning_curve(df, "id", feats, "price", "fold", sizes=sizes, kind="linear").collect():
        for i, c in enumerate(("train_rmse", "cv_rmse")):
            assert r[c] == pytest.approx(sum(want[r["train_fraction"], f][i] for f in range(3)) / 3, rel=1e-7)
    with pytest.raises(ValueError, match="targets"):
        M.learning_curve(df.unionByName(df.limit(1).withColumn("price", F.lit(None).cast("double"))), "id", feats, "price", "fold", sizes=sizes, kind="linear")


def test_forest_groups_hold_little_of_a_task(spark, monkeypatch):
    """A task holds the sums of one group of nodes; four tasks of 1,024 MB each are more than an executor's heap. Trees and depth stay."""
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL
    seen = []

    class Stop(Exception):
        pass

    def pipeline(*a, params=None, **more):
        seen.append(params)
        raise Stop

    monkeypatch.setattr(M, "regression_pipeline", pipeline)
    with pytest.raises(Stop):
        entry.queries()["rf_regression"](spark, SF_SMALL)
    spark.catalog.clearCache()
    assert seen == [{"numTrees": 200, "maxDepth": 12, "maxMemoryInMB": 64}]
