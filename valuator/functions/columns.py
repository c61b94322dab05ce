"""Scalar column builders (P6–P28). Column in -> Column out, no actions.

All divisions that the reference leaves unguarded use ``try_divide`` so ANSI
mode never raises; nulls propagate the way the reference's NaN does.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ P6, P7, P8
def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    present = set(df.columns)
    return df.drop(*[c for c in cols if c in present])


def to_numeric_coerce(c: str | Column) -> Column:
    """Non-numeric text -> null (try_cast, ANSI-safe)."""
    return _col(c).try_cast("double")


def parse_reg_date(c: str | Column, fmt: str = "dd-MMM-yyyy") -> Column:
    """P8: '08-mar-2018' -> date; unparsable -> null. Month case is normalised first."""
    s = F.initcap(F.lower(F.trim(_col(c))))
    return F.try_to_timestamp(s, F.lit(fmt)).cast("date")


# ------------------------------------------------------------------ P9
AGE_MODES = ("mean_year", "julian_year", "days365", "calendar", "fractional")


def vehicle_age(reg_date: str | Column, as_of: _dt.date | str, mode: str = "mean_year") -> Column:
    """Age at ``as_of`` in one of five conventions of the reference.

    mean_year  floor(days / 365.2425)   (numpy '<m8[Y]')
    julian_year floor(days / 365.25)
    days365    days // 365
    calendar   completed calendar years
    fractional days / 365
    """
    d = _col(reg_date)
    ref = F.lit(as_of if isinstance(as_of, str) else as_of.isoformat()).cast("date")
    days = F.datediff(ref, d)
    if mode == "mean_year":
        return F.floor(days / F.lit(365.2425)).cast("int")
    if mode == "julian_year":
        return F.floor(days / F.lit(365.25)).cast("int")
    if mode == "days365":
        return F.floor(days / F.lit(365)).cast("int")
    if mode == "calendar":
        before = (F.month(ref) * 100 + F.dayofmonth(ref)) < (F.month(d) * 100 + F.dayofmonth(d))
        return (F.year(ref) - F.year(d) - F.when(before, 1).otherwise(0)).cast("int")
    if mode == "fractional":
        return days / F.lit(365.0)
    raise ValueError(f"mode must be one of {AGE_MODES}")


# ------------------------------------------------------------------ P10–P13
def log_target(c: str | Column) -> Column:
    return F.log1p(_col(c))


def exp_target(c: str | Column) -> Column:
    return F.expm1(_col(c))


def safe_log1p(c: str | Column) -> Column:
    """log1p(max(x, 0)); null stays null."""
    x = _col(c)
    return F.log1p(F.when(x < 0, F.lit(0.0)).otherwise(x))


PRICE_FLOOR = 700.0
PRICE_CAP = 2_900_000.0


def clip(c: str | Column, lo: float | Column | None, hi: float | Column | None) -> Column:
    """Null-preserving clamp (``greatest``/``least`` would skip nulls)."""
    x = _col(c)
    out = x
    if lo is not None:
        lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
        out = F.when(out < lo_c, lo_c).otherwise(out)
    if hi is not None:
        hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
        out = F.when(out > hi_c, hi_c).otherwise(out)
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def clip_prices(c: str | Column, lo: float = PRICE_FLOOR, hi: float = PRICE_CAP) -> Column:
    """Clamp to [700, 2 900 000] (or train min/max passed in)."""
    return clip(c, lo, hi)


def safe_divide(a: str | Column, b: str | Column, mode: str = "zero") -> Column:
    """a/b with a guard: 'zero' -> 0 where b = 0; 'max1' -> a/max(b,1); 'plus1' -> a/(b+1)."""
    a, b = _col(a), _col(b)
    if mode == "zero":
        return F.when(b == 0, F.lit(0.0)).otherwise(F.try_divide(a, b))
    if mode == "max1":
        return F.try_divide(a, F.when(b < 1, F.lit(1.0)).otherwise(b))
    if mode == "plus1":
        return F.try_divide(a, b + F.lit(1.0))
    raise ValueError("mode must be zero|max1|plus1")


# ------------------------------------------------------------------ P14–P19
def cost_features(age: str | Column = "vehicle_age") -> dict[str, Column]:
    """Cost-derived columns (names as in the reference)."""
    age = _col(age)
    omv, arf, coe = F.col("omv"), F.col("arf"), F.col("coe")
    return {
        "total_cost": omv + arf + coe,
        "value_retention": safe_divide("dereg_value", omv + arf + coe),
        "monthly_depreciation": F.col("depreciation") / F.lit(12.0),
        "maintenance_cost": F.col("road_tax") * age,
        "cost_per_power": safe_divide(omv + arf + coe, "power"),
        "depreciation_rate": safe_divide("depreciation", "omv"),
        "totaltax": F.col("road_tax") + arf,
    }


def ratio_features(age: str | Column = "vehicle_age") -> dict[str, Column]:
    """Ratio columns; unguarded ones in the reference use try_divide (null on /0)."""
    age = _col(age)
    total = F.col("omv") + F.col("arf") + F.col("coe")
    return {
        "power_to_weight": safe_divide("power", "curb_weight"),
        "power_per_engine": safe_divide("power", "engine_cap"),
        "dep_to_omv": safe_divide("depreciation", "omv"),
        "coe_to_omv": safe_divide("coe", "omv"),
        "dereg_to_total": safe_divide("dereg_value", total),
        "tax_per_engine": safe_divide("road_tax", "engine_cap"),
        "omv_per_engine": safe_divide("omv", "engine_cap"),
        "arf_coe_to_omv": safe_divide(F.col("arf") + F.col("coe"), "omv"),
        "dereg_per_dep_age": F.try_divide(F.col("dereg_value"), F.col("depreciation") * age),
        "omv_per_engine_power": F.try_divide(F.col("omv"), F.col("engine_cap") * F.col("power")),
    }


def age_polynomials(age: str | Column, as_of_year: int) -> dict[str, Column]:
    """age², age³ and as-of-year − age."""
    a = _col(age)
    return {"age_squared": a * a, "age_cubed": a * a * a, "age_year": F.lit(as_of_year) - a}


def any_flag(flags: Sequence[str], present: Iterable[str]) -> Column:
    """OR of 0/1 flag columns; missing flags count as 0."""
    have = set(present)
    cols = [F.coalesce(F.col(f), F.lit(0)) for f in flags if f in have]
    if not cols:
        return F.lit(0)
    return F.greatest(*cols, F.lit(0)).cast("int") if len(cols) > 0 else F.lit(0)


def segment_flags(df: DataFrame, luxury: Sequence[str], economic: Sequence[str],
                  age: str = "vehicle_age") -> DataFrame:
    """is_luxury / is_economic flags and their interaction products."""
    lux = any_flag(luxury, df.columns)
    eco = any_flag(economic, df.columns)
    return df.withColumns({
        "is_luxury": lux,
        "is_economic": eco,
        "luxury_power": lux * F.col("power"),
        "luxury_engine": lux * F.col("engine_cap"),
        "age_power": F.col(age) * F.col("power"),
        "age_depreciation": F.col(age) * F.col("depreciation"),
    })


def luxury_score(weights: Mapping[str, int], present: Iterable[str]) -> Column:
    """Weighted sum of flag columns (missing component = 0)."""
    have = set(present)
    total = F.lit(0)
    for name, w in weights.items():
        if name in have:
            total = total + F.lit(w) * F.coalesce(F.col(name), F.lit(0))
    return total.cast("int")


def pairwise_interactions(cols: Sequence[str], prefix: str = "inter_") -> dict[str, Column]:
    """Product of every pair (i < j)."""
    out: dict[str, Column] = {}
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            out[f"{prefix}{a}_{b}"] = F.col(a) * F.col(b)
    return out


def align_to_schema(df: DataFrame, required: Sequence[str], fill=0) -> DataFrame:
    """P20: add missing required columns as ``fill`` and fix the order."""
    have = set(df.columns)
    extra = [c for c in df.columns if c not in set(required)]
    cols = [F.col(c) if c in have else F.lit(fill).alias(c) for c in required]
    return df.select(*extra, *cols)


def inf_to_null(c: str | Column) -> Column:
    """±inf and NaN -> null."""
    x = _col(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill nulls with sentinels per column (numeric and string)."""
    missing = [c for c in values if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in frame: {missing}")
    return df.fillna(dict(values))


def coalesce_columns(*cols: str | Column) -> Column:
    """First non-null."""
    return F.coalesce(*[_col(c) for c in cols])


def row_mean_skip_null(cols: Sequence[str | Column]) -> Column:
    """Mean of k columns ignoring nulls; null when all are null."""
    cs = [_col(c) for c in cols]
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in cs), F.lit(0.0))
    n = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in cs), F.lit(0))
    return F.when(n == 0, F.lit(None)).otherwise(total / n)


def power_to_weight(power: str | Column = "power", weight: str | Column = "curb_weight") -> Column:
    """P25: unguarded ratio made null-safe."""
    return F.try_divide(_col(power), _col(weight))


def boxcox1p(c: str | Column, lam: float | Column) -> Column:
    """((1+x)^λ − 1)/λ, log1p(x) when λ = 0."""
    x = _col(c)
    lam_c = lam if isinstance(lam, Column) else F.lit(float(lam))
    return F.when(lam_c == 0, F.log1p(x)).otherwise((F.pow(F.lit(1.0) + x, lam_c) - F.lit(1.0)) / lam_c)


def prediction_error(price: str | Column = "price", pred: str | Column = "inference_price") -> dict[str, Column]:
    """mistake = price − prediction, and |mistake|."""
    m = _col(price) - _col(pred)
    return {"mistake": m, "mistake_abs": F.abs(m)}


def drop_incomplete_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Remove rows with a null in any of ``subset``."""
    return df.dropna(how="any", subset=list(subset))


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Boundary conversion: NaN/±inf in double columns -> null."""
    dbl = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    targets = [c for c in (cols or df.columns) if c in dbl]
    return df.withColumns({c: inf_to_null(c) for c in targets}) if targets else df
