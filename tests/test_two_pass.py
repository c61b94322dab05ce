"""The two-pass run against plain least squares, and what may not reach a row's own prediction."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuator.operators import train as M
from valuator.operators.two_pass import predict_new_rows, segment_columns, two_pass_run

SCHEMA = "id long, c double, x double, price double, fold int"


def listings(n=240, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        group = i % 3 == 0
        x = rng.random()
        out.append((i, (100.0 if group else 0.0) + rng.random(), x, (30_000.0 if group else 9_000.0) * (1 + x) ** 2 * (1 + 0.1 * rng.random()), i % 4))
    return out


def fitted(x, y):
    a = np.column_stack([np.ones(len(x)), x])
    return np.linalg.lstsq(a, np.log1p(y), rcond=None)[0]


def predicted(w, x):
    return np.clip(np.expm1(np.column_stack([np.ones(len(x)), x]) @ w), 700, 2_900_000)


def brute_pass(rows, x, new_rows, new_x):
    """Held-out predictions and those of new rows; the segment is the side of 50 that c lies on."""
    c, y, fold = (np.array([r[i] for r in rows]) for i in (1, 3, 4))
    new_c = np.array([r[1] for r in new_rows])
    held, new = np.zeros(len(rows)), np.zeros(len(new_rows))
    for high in (False, True):
        own, shown = (c > 50) == high, (new_c > 50) == high
        models = []
        for f in sorted(set(fold)):
            w = fitted(x[own & (fold != f)], y[own & (fold != f)])
            held[own & (fold == f)] = predicted(w, x[own & (fold == f)])
            models.append(w)
        new[shown] = np.mean([predicted(w, new_x[shown]) for w in models], axis=0)
    return held, new


def run(spark, rows, new, **settings):
    return two_pass_run(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(new, SCHEMA).drop("price", "fold"), "id", ["c"], ["c", "x"],
                        "price", "fold", **{"learners": ("linear",), "max_k": 3, "restarts": 2, **settings})


def by_id(df):
    got = df.select("id", "prediction").collect()
    assert len({r["id"] for r in got}) == len(got)
    return np.array([r["prediction"] for r in sorted(got, key=lambda r: r["id"])])


def test_both_passes_equal_least_squares(spark):
    rows, new = listings(), [(1000 + r[0], *r[1:]) for r in listings(60, 8)]
    first, second = run(spark, rows, new)
    assert len(first.centers) == 2 and first.silhouettes.count() == 2
    x, new_x = (np.array([r[1:3] for r in part]) for part in (rows, new))
    held, shown = brute_pass(rows, x, new, new_x)
    assert by_id(first.held_out) == pytest.approx(held, rel=1e-4) and by_id(first.new) == pytest.approx(shown, rel=1e-4)
    held2, shown2 = brute_pass(rows, np.column_stack([x, held]), new, np.column_stack([new_x, shown]))
    assert by_id(second.held_out) == pytest.approx(held2, rel=1e-3) and by_id(second.new) == pytest.approx(shown2, rel=1e-3)


def test_own_fold_prices_do_not_reach_the_reference_price(spark):
    rows = listings(120)
    changed = [(*r[:3], r[3] * 5, r[4]) if r[4] == 0 else r for r in rows]
    first, again = (run(spark, part, rows[:3])[0].held_out for part in (rows, changed))
    same = np.array([r[4] == 0 for r in rows])
    a, b = by_id(first), by_id(again)
    assert a[same] == pytest.approx(b[same], rel=1e-9) and not np.allclose(a[~same], b[~same])


def test_missing_values_and_unknown_segments_are_predicted(spark):
    rows = [(*r[:1], None if r[0] % 10 == 0 else r[1], None if r[0] % 7 == 0 else r[2], *r[3:]) for r in listings(160)]
    new = [(2000, None, None, None, None), (2001, 1e9, 0.5, None, None)]
    first, second = run(spark, rows, new)
    for p in (first, second):
        assert len(by_id(p.held_out)) == 160 and not np.isnan(by_id(p.held_out)).any()
        assert len(by_id(p.new)) == 2 and (by_id(p.new) >= 700).all() and (by_id(p.new) <= 2_900_000).all()
    train = spark.createDataFrame(rows, SCHEMA)
    label, _, _ = segment_columns(train, ["c"], 2, 1)
    fits = M.fit_segments(train.withColumn("segment", label), "segment", "fold", ["x"], "price", ("linear",))
    unknown = spark.createDataFrame([(1, 0.5, 77), (2, 0.5, None)], "id long, x double, segment int")
    from valuator.sources.io import scratch_path
    out = predict_new_rows(fits, unknown, "id", "segment", ["x"], ("linear",), scratch_path(spark, "unknown")).collect()
    assert [r["segment"] for r in out] == [M.REST] * 2 and len({r["prediction"] for r in out}) == 1 and out[0]["prediction"] > 0
