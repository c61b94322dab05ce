"""Registered projection / scalar-expression queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuator.functions import columns as C
from valuator.functions import text as T
from valuator.plans.common import AS_OF, fx, rnd, round_all
from valuator.plans.registry import register
from valuator.sources.tables import Tables

# ------------------------------------------------------------------ P1–P3
_CLEAN_TITLE_SQL = r"""
SELECT listing_id, trim(regexp_replace(
  regexp_replace(regexp_replace(regexp_replace(title, '\(COE till \d{2}/\d{4}\)', '', 'g'),
    '(?i)\b\d{4}\b|\d+(\.\d+)?(cc|l|litre|liter)|[0-9]+\s*(km|kms)', '', 'g'),
    '(?i)\b(auto|manual|diesel|petrol)\b', '', 'g'),
  '\s+', ' ', 'g')) AS cleaned_title
FROM titles
"""


@register("clean_title", _CLEAN_TITLE_SQL, ("titles",))
def q_clean_title(spark, sf_dir):
    t = fx(spark, sf_dir).titles()
    return t.select("listing_id", T.clean_title("title").alias("cleaned_title"))


_EXPIRY_SQL = r"""
SELECT listing_id, nullif(regexp_extract(title, '\(COE till (\d{2}/\d{4})\)', 1), '') AS coe_expiry FROM titles
"""


@register("extract_expiry", _EXPIRY_SQL, ("titles",))
def q_extract_expiry(spark, sf_dir):
    t = fx(spark, sf_dir).titles()
    return t.select("listing_id", T.extract_expiry("title").alias("coe_expiry"))


_TOKEN_SQL = r"""
SELECT p_partkey AS listing_id,
  coalesce(trim(regexp_replace(regexp_replace(replace(lower(p_name || ' Citroën/Été № ' || p_brand), '/', '_'),
       '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', '_', 'g')), '') AS token
FROM part
"""


@register("clean_token", _TOKEN_SQL)
def q_clean_token(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    raw = F.concat(F.col("p_name"), F.lit(" Citroën/Été № "), F.col("p_brand"))
    return p.select(F.col("p_partkey").alias("listing_id"), T.clean_token(raw).alias("token"))


# ------------------------------------------------------------------ P6–P9
_DROP_SQL = """
SELECT listing_id, price, make, type_of_vehicle, manufactured, power, curb_weight, engine_cap, no_of_owners,
       depreciation, coe, road_tax, dereg_value, omv, arf FROM listing
"""


@register("drop_columns", _DROP_SQL, ("listing",))
def q_drop_columns(spark, sf_dir):
    return C.drop_columns(fx(spark, sf_dir).listing(), ["model", "transmission", "reg_date", "not_a_column"])


_NUMERIC_SQL = """
SELECT p_partkey AS id, TRY_CAST(CASE WHEN p_size % 4 = 0 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS num
FROM part
"""


@register("to_numeric_coerce", _NUMERIC_SQL)
def q_to_numeric(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    raw = F.when(F.col("p_size") % 4 == 0, F.col("p_brand")).otherwise(F.col("p_size").cast("string"))
    return p.select(F.col("p_partkey").alias("id"), C.to_numeric_coerce(raw).alias("num"))


_REGDATE_SQL = """
SELECT o_orderkey AS listing_id,
  CAST(CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS reg_date
FROM orders
"""


@register("parse_reg_date", _REGDATE_SQL)
def q_parse_reg_date(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    raw = F.when(F.col("o_orderkey") % 50 == 0, F.lit("not-a-date")).otherwise(
        F.lower(F.date_format("o_orderdate", "dd-MMM-yyyy")))
    return o.select(F.col("o_orderkey").alias("listing_id"), C.parse_reg_date(raw).cast("string").alias("reg_date"))


_AGE_SQL = f"""
SELECT listing_id,
  CAST(floor(datediff('day', reg_date, DATE '{AS_OF}') / 365.2425) AS INTEGER) AS age_mean_year,
  CAST(floor(datediff('day', reg_date, DATE '{AS_OF}') / 365.25) AS INTEGER) AS age_julian_year,
  CAST(floor(datediff('day', reg_date, DATE '{AS_OF}') / 365) AS INTEGER) AS age_days365,
  CAST(year(DATE '{AS_OF}') - year(reg_date)
       - CASE WHEN month(DATE '{AS_OF}') * 100 + day(DATE '{AS_OF}') < month(reg_date) * 100 + day(reg_date)
              THEN 1 ELSE 0 END AS INTEGER) AS age_calendar,
  round(datediff('day', reg_date, DATE '{AS_OF}') / 365.0, 6) AS age_fractional
FROM listing
"""


@register("vehicle_age", _AGE_SQL, ("listing",))
def q_vehicle_age(spark, sf_dir):
    l = fx(spark, sf_dir).listing()
    cols = {f"age_{m}": C.vehicle_age("reg_date", AS_OF, m) for m in C.AGE_MODES}
    out = l.select("listing_id", *[v.alias(k) for k, v in cols.items()])
    return out.withColumn("age_fractional", rnd("age_fractional"))


# ------------------------------------------------------------------ P10–P13
_LOG_SQL = """
SELECT listing_id, round(ln(1 + price), 6) AS log_price, round(exp(ln(1 + price)) - 1, 4) AS back_price
FROM listing
"""


@register("log_target", _LOG_SQL, ("listing",))
def q_log_target(spark, sf_dir):
    l = fx(spark, sf_dir).listing()
    lp = C.log_target("price")
    return l.select("listing_id", rnd(lp).alias("log_price"), rnd(C.exp_target(lp), 4).alias("back_price"))


_EXP_SQL = "SELECT listing_id, round(exp(power / 100.0) - 1, 6) AS value, power IS NULL AS was_null FROM listing_nulls"


@register("exp_target", _EXP_SQL, ("listing_nulls",))
def q_exp_target(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls()
    return l.select("listing_id", rnd(C.exp_target(F.col("power") / 100.0)).alias("value"), F.col("power").isNull().alias("was_null"))


_SAFELOG_SQL = """
SELECT c_custkey, round(ln(1 + CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END), 6) AS log_balance FROM customer
"""


@register("safe_log1p", _SAFELOG_SQL)
def q_safe_log1p(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", rnd(C.safe_log1p("c_acctbal")).alias("log_balance"))


_CLIP_SQL = """
WITH b AS (SELECT min(price) AS lo, max(price) AS hi FROM listing_train)
SELECT s.listing_id,
  CASE WHEN s.pred_c - 100000 < 700 THEN 700.0 WHEN s.pred_c - 100000 > 2900000 THEN 2900000.0
       ELSE s.pred_c - 100000 END AS clipped_fixed,
  CASE WHEN s.pred_c * 1.5 < b.lo THEN b.lo WHEN s.pred_c * 1.5 > b.hi THEN b.hi ELSE s.pred_c * 1.5 END
    AS clipped_train
FROM scored s CROSS JOIN b
"""


@register("clip_prices", _CLIP_SQL, ("scored", "listing_train"))
def q_clip_prices(spark, sf_dir):
    f = fx(spark, sf_dir)
    from valuator.plans.strategy import fit_row
    b = fit_row(f.listing_train(), F.min("price").alias("lo"), F.max("price").alias("hi"))
    s = f.scored()
    return s.select("listing_id",
                    C.clip_prices(F.col("pred_c") - F.lit(100000)).alias("clipped_fixed"),
                    C.clip_prices(F.col("pred_c") * F.lit(1.5), b["lo"], b["hi"]).alias("clipped_train"))


_SAFEDIV_SQL = """
SELECT listing_id,
  CASE WHEN d = 0 THEN 0.0 ELSE dereg_value / d END AS div_zero,
  dereg_value / CASE WHEN d < 1 THEN 1.0 ELSE d END AS div_max1,
  dereg_value / (d + 1.0) AS div_plus1
FROM (SELECT listing_id, dereg_value, CAST(listing_id % 5 AS DOUBLE) AS d FROM listing)
"""


@register("safe_divide", _SAFEDIV_SQL, ("listing",))
def q_safe_divide(spark, sf_dir):
    l = fx(spark, sf_dir).listing().withColumn("d", (F.col("listing_id") % 5).cast("double"))
    return l.select("listing_id", C.safe_divide("dereg_value", "d", "zero").alias("div_zero"),
                    C.safe_divide("dereg_value", "d", "max1").alias("div_max1"),
                    C.safe_divide("dereg_value", "d", "plus1").alias("div_plus1"))


# ------------------------------------------------------------------ P14–P16
_AGE = f"CAST(floor(datediff('day', reg_date, DATE '{AS_OF}') / 365.2425) AS INTEGER)"
_COST_SQL = f"""
SELECT listing_id,
  omv + arf + coe AS total_cost,
  CASE WHEN omv + arf + coe = 0 THEN 0.0 ELSE dereg_value / (omv + arf + coe) END AS value_retention,
  depreciation / 12.0 AS monthly_depreciation,
  road_tax * age AS maintenance_cost,
  CASE WHEN power = 0 THEN 0.0 ELSE (omv + arf + coe) / power END AS cost_per_power,
  CASE WHEN omv = 0 THEN 0.0 ELSE depreciation / omv END AS depreciation_rate,
  road_tax + arf AS totaltax
FROM (SELECT *, {_AGE} AS age FROM listing)
"""


@register("cost_features", _COST_SQL, ("listing",))
def q_cost_features(spark, sf_dir):
    l = fx(spark, sf_dir).listing().withColumn("vehicle_age", C.vehicle_age("reg_date", AS_OF))
    cols = C.cost_features("vehicle_age")
    return l.select("listing_id", *[v.alias(k) for k, v in cols.items()])


_RATIO_SQL = f"""
SELECT listing_id,
  CASE WHEN curb_weight = 0 THEN 0.0 ELSE power / curb_weight END AS power_to_weight,
  CASE WHEN engine_cap = 0 THEN 0.0 ELSE power / engine_cap END AS power_per_engine,
  CASE WHEN omv = 0 THEN 0.0 ELSE depreciation / omv END AS dep_to_omv,
  CASE WHEN omv = 0 THEN 0.0 ELSE coe / omv END AS coe_to_omv,
  CASE WHEN omv + arf + coe = 0 THEN 0.0 ELSE dereg_value / (omv + arf + coe) END AS dereg_to_total,
  CASE WHEN engine_cap = 0 THEN 0.0 ELSE road_tax / engine_cap END AS tax_per_engine,
  CASE WHEN engine_cap = 0 THEN 0.0 ELSE omv / engine_cap END AS omv_per_engine,
  CASE WHEN omv = 0 THEN 0.0 ELSE (arf + coe) / omv END AS arf_coe_to_omv,
  CASE WHEN depreciation * age = 0 THEN NULL ELSE dereg_value / (depreciation * age) END AS dereg_per_dep_age,
  CASE WHEN engine_cap * power = 0 THEN NULL ELSE omv / (engine_cap * power) END AS omv_per_engine_power
FROM (SELECT *, {_AGE} AS age FROM listing)
"""


@register("ratio_features", _RATIO_SQL, ("listing",))
def q_ratio_features(spark, sf_dir):
    l = fx(spark, sf_dir).listing().withColumn("vehicle_age", C.vehicle_age("reg_date", AS_OF))
    cols = C.ratio_features("vehicle_age")
    return l.select("listing_id", *[v.alias(k) for k, v in cols.items()])


_POLY_SQL = f"""
SELECT listing_id, age * age AS age_squared, age * age * age AS age_cubed, 2024 - age AS age_year
FROM (SELECT listing_id, {_AGE} AS age FROM listing)
"""


@register("age_polynomials", _POLY_SQL, ("listing",))
def q_age_polynomials(spark, sf_dir):
    l = fx(spark, sf_dir).listing().withColumn("vehicle_age", C.vehicle_age("reg_date", AS_OF))
    cols = C.age_polynomials("vehicle_age", 2024)
    return l.select("listing_id", *[v.alias(k) for k, v in cols.items()])


# ------------------------------------------------------------------ P17–P20
_FLAGS = """
  CASE WHEN type_of_vehicle = '1-URGENT' THEN 1 ELSE 0 END AS type_urgent,
  CASE WHEN type_of_vehicle = '2-HIGH' THEN 1 ELSE 0 END AS type_high,
  CASE WHEN type_of_vehicle = '5-LOW' THEN 1 ELSE 0 END AS type_low,
  CASE WHEN transmission = 'F' THEN 1 ELSE 0 END AS rare_exotic,
  CASE WHEN make = 'AUTOMOBILE' THEN 1 ELSE 0 END AS premium_ad_car"""


def _flags(df):
    return df.withColumns({
        "type_urgent": (F.col("type_of_vehicle") == "1-URGENT").cast("int"),
        "type_high": (F.col("type_of_vehicle") == "2-HIGH").cast("int"),
        "type_low": (F.col("type_of_vehicle") == "5-LOW").cast("int"),
        "rare_exotic": (F.col("transmission") == "F").cast("int"),
        "premium_ad_car": (F.col("make") == "AUTOMOBILE").cast("int"),
    })


_SEGFLAG_SQL = f"""
WITH f AS (SELECT *, {_AGE} AS vehicle_age, {_FLAGS} FROM listing)
SELECT listing_id,
  CAST(greatest(type_urgent, type_high, 0) AS INTEGER) AS is_luxury,
  CAST(greatest(type_low, 0) AS INTEGER) AS is_economic,
  greatest(type_urgent, type_high, 0) * power AS luxury_power,
  greatest(type_urgent, type_high, 0) * engine_cap AS luxury_engine,
  vehicle_age * power AS age_power,
  vehicle_age * depreciation AS age_depreciation
FROM f
"""


@register("segment_flags", _SEGFLAG_SQL, ("listing",))
def q_segment_flags(spark, sf_dir):
    l = _flags(fx(spark, sf_dir).listing().withColumn("vehicle_age", C.vehicle_age("reg_date", AS_OF)))
    out = C.segment_flags(l, ["type_urgent", "type_high", "type_missing"], ["type_low"])
    return out.select("listing_id", "is_luxury", "is_economic", "luxury_power", "luxury_engine", "age_power",
                      "age_depreciation")


_LUX_SQL = f"""
WITH f AS (SELECT listing_id, {_FLAGS} FROM listing)
SELECT listing_id, CAST(3 * type_urgent + 2 * rare_exotic + 1 * premium_ad_car AS INTEGER) AS luxury_score FROM f
"""


@register("luxury_score", _LUX_SQL, ("listing",))
def q_luxury_score(spark, sf_dir):
    l = _flags(fx(spark, sf_dir).listing())
    score = C.luxury_score({"type_urgent": 3, "rare_exotic": 2, "premium_ad_car": 1, "absent_flag": 5}, l.columns)
    return l.select("listing_id", score.alias("luxury_score"))


_PAIR_SQL = f"""
WITH f AS (SELECT listing_id, {_FLAGS} FROM listing)
SELECT listing_id,
  type_urgent * type_high AS inter_type_urgent_type_high, type_urgent * rare_exotic AS inter_type_urgent_rare_exotic,
  type_urgent * premium_ad_car AS inter_type_urgent_premium_ad_car, type_high * rare_exotic AS inter_type_high_rare_exotic,
  type_high * premium_ad_car AS inter_type_high_premium_ad_car, rare_exotic * premium_ad_car AS inter_rare_exotic_premium_ad_car
FROM f
"""


@register("pairwise_interactions", _PAIR_SQL, ("listing",))
def q_pairwise(spark, sf_dir):
    l = _flags(fx(spark, sf_dir).listing())
    cols = C.pairwise_interactions(["type_urgent", "type_high", "rare_exotic", "premium_ad_car"])
    return l.select("listing_id", *[v.alias(k) for k, v in cols.items()])


_ALIGN_SQL = f"""
WITH f AS (SELECT listing_id, {_FLAGS} FROM listing)
SELECT listing_id, type_urgent, 0 AS type_medium, type_high, 0 AS vintage_cars, rare_exotic FROM f
"""


@register("align_to_schema", _ALIGN_SQL, ("listing",))
def q_align(spark, sf_dir):
    l = _flags(fx(spark, sf_dir).listing()).select("listing_id", "type_urgent", "type_high", "rare_exotic")
    return C.align_to_schema(l, ["type_urgent", "type_medium", "type_high", "vintage_cars", "rare_exotic"])


# ------------------------------------------------------------------ P21–P28
_INF_SQL = """
SELECT listing_id, CASE WHEN isnan(x) OR isinf(x) THEN NULL ELSE x END AS x
FROM (SELECT listing_id, CASE WHEN listing_id % 9 = 0 THEN exp(1000.0) WHEN listing_id % 9 = 1 THEN -exp(1000.0)
             ELSE power END AS x FROM listing)
"""


@register("inf_to_null", _INF_SQL, ("listing",))
def q_inf_to_null(spark, sf_dir):
    l = fx(spark, sf_dir).listing()
    x = (F.when(F.col("listing_id") % 9 == 0, F.exp(F.lit(1000.0)))
         .when(F.col("listing_id") % 9 == 1, -F.exp(F.lit(1000.0))).otherwise(F.col("power")))
    return l.select("listing_id", C.inf_to_null(x).alias("x"))


_FILL_SQL = """
SELECT listing_id, coalesce(power, -999.0) AS power, coalesce(curb_weight, -999.0) AS curb_weight,
       coalesce(make, 'Missing') AS make, coalesce(manufactured, 0) AS manufactured FROM listing_nulls
"""


@register("fill_constant", _FILL_SQL, ("listing_nulls",))
def q_fill_constant(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "power", "curb_weight", "make", "manufactured")
    return C.fill_constant(l, {"power": -999.0, "curb_weight": -999.0, "make": "Missing", "manufactured": 0})


_COALESCE_SQL = r"""
SELECT listing_id, coalesce(make, upper(split_part(trim(title), ' ', 1))) AS make_filled FROM listing_titles
"""


@register("coalesce_columns", _COALESCE_SQL, ("listing_titles",))
def q_coalesce(spark, sf_dir):
    l = fx(spark, sf_dir).listing_titles()
    return l.select("listing_id", C.coalesce_columns("make", F.upper(T.first_word("title"))).alias("make_filled"))


_ROWMEAN_SQL = """
SELECT listing_id,
  CASE WHEN n = 0 THEN NULL ELSE s / n END AS row_mean
FROM (SELECT listing_id,
        coalesce(power, 0.0) + coalesce(curb_weight, 0.0) + coalesce(engine_cap, 0.0) AS s,
        (CASE WHEN power IS NULL THEN 0 ELSE 1 END) + (CASE WHEN curb_weight IS NULL THEN 0 ELSE 1 END)
        + (CASE WHEN engine_cap IS NULL THEN 0 ELSE 1 END) AS n
      FROM listing_nulls)
"""


@register("row_mean_skip_null", _ROWMEAN_SQL, ("listing_nulls",))
def q_row_mean(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls()
    return l.select("listing_id", C.row_mean_skip_null(["power", "curb_weight", "engine_cap"]).alias("row_mean"))


_P2W_SQL = """
SELECT listing_id, power / curb_weight AS power_to_weight FROM listing_nulls
"""


@register("power_to_weight", _P2W_SQL, ("listing_nulls",))
def q_power_to_weight(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls()
    return l.select("listing_id", C.power_to_weight().alias("power_to_weight"))


_BOXCOX_SQL = """
SELECT listing_id, round((pow(1.0 + depreciation, 0.15) - 1.0) / 0.15, 6) AS depreciation_bc,
       round(ln(1 + power), 6) AS power_bc FROM listing
"""


@register("boxcox1p_apply", _BOXCOX_SQL, ("listing",))
def q_boxcox_apply(spark, sf_dir):
    l = fx(spark, sf_dir).listing()
    return l.select("listing_id", rnd(C.boxcox1p("depreciation", 0.15)).alias("depreciation_bc"),
                    rnd(C.boxcox1p("power", 0.0)).alias("power_bc"))


_DROPNA_SQL = """
SELECT listing_id, power, omv FROM listing_nulls WHERE power IS NOT NULL AND omv IS NOT NULL
"""


@register("drop_incomplete_rows", _DROPNA_SQL, ("listing_nulls",))
def q_dropna(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().select("listing_id", "power", "omv")
    return C.drop_incomplete_rows(l, ["power", "omv"])


__all__ = ["round_all"]
