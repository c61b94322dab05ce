"""Registered source / sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuator.operators import evaluate as ev
from valuator.plans.common import fx, rnd
from valuator.plans.registry import register
from valuator.sources import holdout as H
from valuator.sources import io as IO
from valuator.sources.tables import scan_listings

_SCAN_SQL = """
SELECT listing_id, power, omv, price FROM listing
"""


@register("scan_listings", _SCAN_SQL, ("listing",))
def q_scan(spark, sf_dir):
    df, _target = scan_listings(fx(spark, sf_dir).listing(), "listing_id", "price", ["power", "omv"])
    return df


_EXPORT_SQL = """
SELECT listing_id AS Id, CAST(round_even(pred_b, 0) AS BIGINT) AS Predicted FROM scored
"""


@register("export_predictions", _EXPORT_SQL, ("scored",))
def q_export(spark, sf_dir):
    path = IO.scratch_path(spark, "predictions")
    s = fx(spark, sf_dir).scored()
    IO.export_predictions(s, "listing_id", "pred_b", path)
    return spark.read.option("header", True).schema("Id long, Predicted long").csv(path)


_LOOKUP_SQL = """
WITH ref AS (SELECT make, avg(price) AS make_mean FROM listing_train WHERE make IS NOT NULL GROUP BY make)
SELECT n.listing_id, round(ref.make_mean, 4) AS make_mean FROM listing_new n LEFT JOIN ref ON n.make = ref.make
"""


def _write_make_lookup(spark, sf_dir) -> str:
    f = fx(spark, sf_dir)
    state = f.listing_train().filter("make IS NOT NULL").groupBy("make").agg(F.avg("price").alias("make_mean"))
    return IO.write_lookup(state, IO.scratch_path(spark, "lookup_make"))


_WRITE_LOOKUP_SQL = """
SELECT make, round(avg(price), 4) AS make_mean FROM listing_train WHERE make IS NOT NULL GROUP BY make
"""


@register("write_lookup", _WRITE_LOOKUP_SQL, ("listing_train",))
def q_write_lookup(spark, sf_dir):
    path = _write_make_lookup(spark, sf_dir)
    return IO.read_lookup(spark, path).select("make", rnd("make_mean", 4).alias("make_mean"))


@register("read_lookup", _LOOKUP_SQL, ("listing_train", "listing_new"))
def q_read_lookup(spark, sf_dir):
    path = _write_make_lookup(spark, sf_dir)
    from valuator.operators.joins import lookup_join
    out = lookup_join(fx(spark, sf_dir).listing_new().select("listing_id", "make"), IO.read_lookup(spark, path), "make")
    return out.select("listing_id", rnd("make_mean", 4).alias("make_mean"))


def _report(spark, sf_dir):
    from valuator.plans.q_evaluate import scored_long
    rep = ev.band_report(scored_long(spark, sf_dir))
    return rep.select("model", "band", "count", rnd("rmse", 4).alias("rmse"))


_REPORT_SQL = """
WITH long AS (
  SELECT 'pred_a' AS model, price - pred_a AS mistake FROM scored
  UNION ALL SELECT 'pred_b', price - pred_b FROM scored
  UNION ALL SELECT 'pred_c', price - pred_c FROM scored
), b AS (SELECT model, mistake, {band} AS band FROM long)
SELECT model, band, count(*) AS count, round(sqrt(avg(mistake * mistake)), 4) AS rmse FROM b GROUP BY model, band
"""


def _band_sql():
    from valuator.operators.segment import ERROR_BANDS
    from valuator.plans.sqlgen import band_case
    return _REPORT_SQL.format(band=band_case("mistake", ERROR_BANDS))


@register("write_report_json", _band_sql(), ("scored",))
def q_write_report(spark, sf_dir):
    path = IO.write_report_json(_report(spark, sf_dir), IO.scratch_path(spark, "report"), partition_by="model")
    return (spark.read.schema("band int, count long, rmse double, model string").json(path)
            .select("model", "band", "count", "rmse"))


@register("collect_reports", _band_sql(), ("scored",))
def q_collect_reports(spark, sf_dir):
    rep = _report(spark, sf_dir)
    base = IO.scratch_path(spark, "reports")
    paths = []
    for m in ("pred_a", "pred_b", "pred_c"):
        p = f"{base}/{m}"
        rep.filter(F.col("model") == m).drop("model").write.mode("overwrite").json(p)
        paths.append(p)
    out = IO.collect_reports(spark, paths, schema="band int, count long, rmse double")
    return out.select("model", "band", "count", "rmse")


_HOLDOUT = """
h AS (
  SELECT *, row_number() OVER (PARTITION BY type_of_vehicle
                               ORDER BY ((((listing_id % 2147483647 * 48271 + 42) % 2147483647) * 48271) % 2147483647), listing_id) AS rn,
         count(*) OVER (PARTITION BY type_of_vehicle) AS cls_n,
         count(*) OVER () AS total
  FROM listing
), t AS (
  SELECT *, rn <= least(round_even(cls_n * (total // 5) / total, 0), cls_n) AS is_test FROM h
)"""

_HOLDOUT_SQL = "WITH " + _HOLDOUT.strip() + """
SELECT listing_id, type_of_vehicle, is_test FROM t
"""


def _holdout(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", "type_of_vehicle", "price")
    n = l.count() // 5
    return l, H.stratified_holdout(l, "listing_id", "type_of_vehicle", n, target="price")


@register("stratified_holdout", _HOLDOUT_SQL, ("listing",))
def q_holdout(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", "type_of_vehicle")
    return H.stratified_flag(l, "listing_id", "type_of_vehicle")


_HOLDOUT_NULLS_SQL = "WITH " + _HOLDOUT.strip().replace("type_of_vehicle", "make").replace("FROM listing", "FROM listing_nulls") + """
SELECT listing_id, make, is_test FROM t
"""


@register("stratified_holdout_null_class", _HOLDOUT_NULLS_SQL, ("listing", "listing_nulls"))
def q_holdout_nulls(spark, sf_dir):
    """S7 where the class may be missing: rows without one are a class."""
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "make")
    return H.stratified_flag(l, "listing_id", "make")


_SHARE_SQL = "WITH " + _HOLDOUT.strip() + """,
o AS (SELECT type_of_vehicle, count(*) / (SELECT count(*) FROM t) AS original_share FROM t GROUP BY type_of_vehicle),
s AS (SELECT type_of_vehicle, count(*) / (SELECT count(*) FROM t WHERE is_test) AS test_share
      FROM t WHERE is_test GROUP BY type_of_vehicle)
SELECT coalesce(o.type_of_vehicle, s.type_of_vehicle) AS type_of_vehicle,
       round(original_share, 6) AS original_share, round(test_share, 6) AS test_share
FROM o FULL OUTER JOIN s ON o.type_of_vehicle = s.type_of_vehicle
"""


@register("holdout_share_report", _SHARE_SQL, ("listing",))
def q_share_report(spark, sf_dir):
    l, (_train, test_x, _y) = _holdout(spark, sf_dir)
    r = H.holdout_share_report(l, test_x, "type_of_vehicle")
    return r.select("type_of_vehicle", rnd("original_share").alias("original_share"),
                    rnd("test_share").alias("test_share"))
