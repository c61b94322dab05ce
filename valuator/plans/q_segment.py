"""Registered binning / rule-segment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuator.operators import segment as B
from valuator.plans.common import fx, rnd, round_all
from valuator.plans.registry import register
from valuator.plans.sqlgen import band_case


def _bin_sql(col: str, q: int) -> str:
    probs = ", ".join(str(i / q) for i in range(q + 1))
    inner = "list_sort(list_distinct(e))"
    return (f"CASE WHEN {col} >= {inner}[1] AND {col} <= {inner}[len({inner})] THEN "
            f"CAST(len(list_filter({inner}[2:len({inner}) - 1], lambda x: {col} > x)) AS INTEGER) END"), \
        f"quantile_cont({col}, [{probs}]) AS e"


_code5, _edges5 = _bin_sql("price", 5)
_QBINS_SQL = f"""
WITH q AS (SELECT {_edges5} FROM listing)
SELECT listing_id, {_code5} AS bin FROM listing CROSS JOIN q
"""


@register("quantile_bins", _QBINS_SQL, ("listing",))
def q_quantile_bins(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", "price")
    return B.quantile_bins(l, "price", 5).select("listing_id", "bin")


_code3, _edges3 = _bin_sql("omv", 3)
_QLAB_SQL = f"""
WITH q AS (SELECT {_edges3} FROM listing)
SELECT listing_id, ['low', 'medium', 'high'][{_code3} + 1] AS bin_label FROM listing CROSS JOIN q
"""


@register("quantile_labels", _QLAB_SQL, ("listing",))
def q_quantile_labels(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", "omv")
    return B.quantile_labels(l, "omv", 3).select("listing_id", "bin_label")


_BAND_SQL = f"""
SELECT listing_id, {band_case('price - pred_c', B.ERROR_BANDS)} AS band,
       {band_case('price - pred_c', B.ERROR_BANDS, 'closed')} AS band_closed FROM scored
"""


@register("error_band", _BAND_SQL, ("scored",))
def q_error_band(spark, sf_dir):
    s = fx(spark, sf_dir).scored()
    err = F.col("price") - F.col("pred_c")
    return s.select("listing_id", B.error_band(err).alias("band"), B.error_band(err, gaps="closed").alias("band_closed"))


_BAND2_SQL = f"""
SELECT listing_id, {band_case('price - pred_c', B.DEFAULT_CUSTOM_BANDS)} AS band FROM scored
"""


@register("error_band_custom", _BAND2_SQL, ("scored",))
def q_error_band_custom(spark, sf_dir):
    s = fx(spark, sf_dir).scored()
    return s.select("listing_id", B.error_band(F.col("price") - F.col("pred_c"), B.DEFAULT_CUSTOM_BANDS).alias("band"))


_BIN_ERR_SQL = """
SELECT listing_id, CAST(abs(price - pred_c) > 2500 AS INTEGER) AS is_large_error FROM scored
"""


@register("binary_error_label", _BIN_ERR_SQL, ("scored",))
def q_binary_error(spark, sf_dir):
    s = fx(spark, sf_dir).scored()
    return s.select("listing_id", B.binary_error_label(F.col("price") - F.col("pred_c"), 2500).alias("is_large_error"))


_THRESH_SQL = """
WITH t AS (SELECT quantile_cont(price, 0.75) AS t FROM listing),
s AS (SELECT l.*, CAST(l.price > t.t AS INTEGER) AS segment FROM listing l CROSS JOIN t)
SELECT segment, min(price) AS min_price, max(price) AS max_price, round(quantile_cont(price, 0.5), 4) AS median_price,
       count(*) AS n, round(avg(price), 4) AS mean_price, round(stddev_samp(price), 4) AS std_price
FROM s GROUP BY segment
"""


@register("threshold_segments", _THRESH_SQL, ("listing",))
def q_threshold_segments(spark, sf_dir):
    _, stats = B.threshold_segments(fx(spark, sf_dir).listing(), "price", 0.75)
    return round_all(stats, 4)


_PRC_SQL = """
WITH m AS (SELECT model, quantile_cont(price, 0.5) AS median_price FROM listing GROUP BY model),
r AS (SELECT quantile_cont(median_price, 0.5) AS mm, quantile_cont(median_price, 0.75) AS mq FROM m)
SELECT model, round(median_price, 4) AS median_price,
  CASE WHEN median_price < 50000 THEN 'low' WHEN median_price < 150000 THEN 'medium' ELSE 'high' END AS price_class,
  CASE WHEN median_price < mm THEN 'low' WHEN median_price > mq THEN 'high' ELSE 'medium' END AS relative_class
FROM m CROSS JOIN r
"""


@register("price_range_class", _PRC_SQL, ("listing",))
def q_price_range_class(spark, sf_dir):
    l = fx(spark, sf_dir).listing()
    a = B.price_range_class(l, "model", mode="absolute")
    r = B.price_range_class(l, "model", mode="relative").select("model", F.col("price_class").alias("relative_class"))
    return a.join(r, "model").select("model", rnd("median_price", 4).alias("median_price"), "price_class",
                                     "relative_class")


_SEGW_SQL = """
SELECT l.listing_id, round(sqrt(t.n / CAST(c.n AS DOUBLE)), 6) AS weight
FROM listing l JOIN (SELECT type_of_vehicle, count(*) AS n FROM listing GROUP BY type_of_vehicle) c
  ON l.type_of_vehicle = c.type_of_vehicle CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS n FROM listing) t
"""


@register("segment_weights", _SEGW_SQL, ("listing",))
def q_segment_weights(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", "type_of_vehicle")
    return B.segment_weights(l, "type_of_vehicle").select("listing_id", rnd("weight").alias("weight"))


@register("segment_weights_null_segment", """
SELECT listing_id, round(sqrt(count(*) OVER () / CAST(count(*) OVER (PARTITION BY make) AS DOUBLE)), 6) AS weight FROM listing_nulls
""", ("listing", "listing_nulls"))
def q_segment_weights_nulls(spark, sf_dir):
    """B8 where the segment may be missing."""
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "make")
    return B.segment_weights(l, "make").select("listing_id", rnd("weight").alias("weight"))


_SEGB_SQL = """
SELECT type_of_vehicle, round(quantile_cont(price, 0.01), 4) AS q01, round(quantile_cont(price, 0.33), 4) AS q33,
       round(quantile_cont(price, 0.67), 4) AS q67, round(quantile_cont(price, 0.99), 4) AS q99
FROM listing GROUP BY type_of_vehicle
"""


@register("segment_bounds", _SEGB_SQL, ("listing",))
def q_segment_bounds(spark, sf_dir):
    return round_all(B.segment_bounds(fx(spark, sf_dir).listing(), "type_of_vehicle"), 4)


_IMB_SQL = """
SELECT round(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) / sum(CASE WHEN label = 1 THEN 1 ELSE 0 END), 6) AS weight
FROM class_scores
"""


@register("class_imbalance_weight", _IMB_SQL, ("class_scores",))
def q_imbalance(spark, sf_dir):
    return B.class_imbalance(fx(spark, sf_dir).class_scores(), "label").select(rnd("weight").alias("weight"))


_ERRW_SQL = """
WITH w AS (SELECT listing_id, 1.0 / (1.0 + abs(price - (pred_a + pred_b) / 2.0)) AS w FROM scored)
SELECT listing_id, round(w / (SELECT avg(w) FROM w), 6) AS weight FROM w
"""


@register("error_row_weights", _ERRW_SQL, ("scored",))
def q_error_row_weights(spark, sf_dir):
    s = fx(spark, sf_dir).scored()
    err = F.col("price") - (F.col("pred_a") + F.col("pred_b")) / 2.0
    return B.error_row_weights(s, err).select("listing_id", rnd("weight").alias("weight"))
