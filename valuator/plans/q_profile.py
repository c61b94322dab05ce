"""Registered profiling / statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuator.operators import normality as R
from valuator.operators import profile as N
from valuator.plans.common import NUMERIC_FEATURES, fx, rnd, round_all
from valuator.plans.registry import register

_SCALE = ["curb_weight", "power", "engine_cap", "depreciation"]

_STD_SQL = """
WITH s AS (SELECT {stats} FROM listing_train)
SELECT n.listing_id, {cols} FROM listing_new n CROSS JOIN s
""".format(
    stats=", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALE),
    cols=", ".join(f"round((n.{c} - s.m_{c}) / CASE WHEN s.s_{c} = 0 THEN 1.0 ELSE s.s_{c} END, 6) AS {c}"
                   for c in _SCALE))


@register("standard_scale", _STD_SQL, ("listing_train", "listing_new"))
def q_standard_scale(spark, sf_dir):
    f = fx(spark, sf_dir)
    st = N.fit_standard(f.listing_train(), _SCALE, ddof=0)
    out = N.apply_standard(f.listing_new().select("listing_id", *_SCALE), st)
    return round_all(out)


_ZSELF_SQL = """
WITH s AS (SELECT {stats} FROM listing_new)
SELECT n.listing_id, {cols} FROM listing_new n CROSS JOIN s
""".format(
    stats=", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _SCALE),
    cols=", ".join(f"round((n.{c} - s.m_{c}) / CASE WHEN s.s_{c} = 0 THEN 1.0 ELSE s.s_{c} END, 6) AS {c}"
                   for c in _SCALE))


@register("zscore_self", _ZSELF_SQL, ("listing_new",))
def q_zscore_self(spark, sf_dir):
    new = fx(spark, sf_dir).listing_new().select("listing_id", *_SCALE)
    return round_all(N.apply_standard(new, N.fit_standard(new, _SCALE, ddof=1)))


_ROBUST_COLS = ["power", "depreciation", "price"]


def _robust_sql(lo: float, hi: float, clip_at: float | None) -> str:
    stats = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, {hi}) - quantile_cont({c}, {lo}) AS r_{c}"
                      for c in _ROBUST_COLS)
    cols = []
    for c in _ROBUST_COLS:
        v = f"(l.{c} - s.m_{c}) / CASE WHEN s.r_{c} = 0 THEN 1.0 ELSE s.r_{c} END"
        if clip_at is not None:
            v = f"CASE WHEN {v} < -{clip_at} THEN -{clip_at} WHEN {v} > {clip_at} THEN {clip_at} ELSE {v} END"
        cols.append(f"round({v}, 6) AS {c}")
    return f"WITH s AS (SELECT {stats} FROM listing) SELECT l.listing_id, {', '.join(cols)} FROM listing l CROSS JOIN s"


@register("robust_scale", _robust_sql(0.25, 0.75, None), ("listing",))
def q_robust_scale(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", *_ROBUST_COLS)
    return round_all(N.apply_robust(l, N.fit_robust(l, _ROBUST_COLS)))


@register("robust_scale_wide", _robust_sql(0.01, 0.99, 10.0), ("listing",))
def q_robust_scale_wide(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", *_ROBUST_COLS)
    return round_all(N.apply_robust(l, N.fit_robust(l, _ROBUST_COLS, 0.01, 0.99), clip_at=10.0))


_SKEW_COLS = ["price", *NUMERIC_FEATURES]
_LONG_LISTING = ("lst AS (UNPIVOT (SELECT listing_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _SKEW_COLS)
                 + " FROM listing) ON " + ", ".join(_SKEW_COLS) + " INTO NAME feature VALUE x)")
_MOMENTS = """
mom AS (
  SELECT feature, count(*) AS n, avg(x) AS m FROM lst GROUP BY feature
), cm AS (
  SELECT l.feature, avg(power(l.x - mom.m, 2)) AS m2, avg(power(l.x - mom.m, 3)) AS m3
  FROM lst l JOIN mom ON l.feature = mom.feature GROUP BY l.feature
), sk AS (SELECT feature, m3 / power(m2, 1.5) AS skewness FROM cm)"""

_LOGSKEW_SQL = "WITH " + _LONG_LISTING + "," + _MOMENTS + """
SELECT feature, round(skewness, 6) AS skewness, skewness > 0.5 AS selected FROM sk
"""


@register("log_skewed", _LOGSKEW_SQL, ("listing",))
def q_log_skewed(spark, sf_dir):
    l = fx(spark, sf_dir).listing()
    _, chosen = N.log_skewed(l, _SKEW_COLS)
    t = N.skewness_table(l, _SKEW_COLS)
    return t.select(F.col("column").alias("feature"), rnd("skewness").alias("skewness"),
                    F.col("column").isin(chosen).alias("selected"))


_BC_COLS = ["price", "depreciation", "arf", "power", "omv", "price_sq", "power_cube"]
_BC_DERIVED = "price * price / 100000.0 AS price_sq, power * power * power / 10000.0 AS power_cube"
_BOXCOX_SQL = ("WITH lst AS (UNPIVOT (SELECT listing_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _BC_COLS)
               + f" FROM (SELECT *, {_BC_DERIVED} FROM listing_nulls)) ON " + ", ".join(_BC_COLS) + " INTO NAME feature VALUE x)," + _MOMENTS + """,
chosen AS (SELECT feature, skewness FROM sk WHERE abs(skewness) > 0.3),
grid AS (SELECT round(-2.0 + 0.1 * i, 1) AS lam FROM range(41) t(i)),
base AS (SELECT l.feature, sum(ln(1 + l.x)) AS s, count(*) AS n FROM lst l JOIN chosen c ON l.feature = c.feature
         WHERE l.x > -1 GROUP BY l.feature),
v AS (
  SELECT l.feature, g.lam,
         var_pop(CASE WHEN g.lam = 0 THEN ln(1 + l.x) ELSE (pow(1 + l.x, g.lam) - 1.0) / g.lam END) AS v
  FROM lst l JOIN chosen c ON l.feature = c.feature CROSS JOIN grid g WHERE l.x > -1 GROUP BY l.feature, g.lam
), llf AS (
  SELECT v.feature, v.lam, (v.lam - 1.0) * b.s - b.n / 2.0 * ln(v.v) AS llf FROM v JOIN base b ON v.feature = b.feature
  WHERE v.v > 0
)
SELECT feature, round(skewness, 6) AS skewness, lam AS lambda FROM (
  SELECT llf.feature, c.skewness, llf.lam, row_number() OVER (PARTITION BY llf.feature ORDER BY llf.llf DESC, llf.lam) AS r
  FROM llf JOIN chosen c ON llf.feature = c.feature) WHERE r = 1
""")


@register("boxcox_fit", _BOXCOX_SQL, ("listing_nulls",))
def q_boxcox_fit(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().withColumns({
        "price_sq": F.col("price") * F.col("price") / F.lit(100000.0),
        "power_cube": F.col("power") * F.col("power") * F.col("power") / F.lit(10000.0)})
    t = N.boxcox_fit(l, _BC_COLS)
    return t.select(F.col("column").alias("feature"), rnd("skewness").alias("skewness"), "lambda")


_WINS_SQL = """
WITH q AS (SELECT quantile_cont(price, 0.01) AS a1, quantile_cont(price, 0.99) AS b1,
                  quantile_cont(omv, 0.01) AS a2, quantile_cont(omv, 0.99) AS b2 FROM listing)
SELECT listing_id,
  CASE WHEN price < a1 - 1.5 * (b1 - a1) THEN a1 - 1.5 * (b1 - a1) WHEN price > b1 + 1.5 * (b1 - a1)
       THEN b1 + 1.5 * (b1 - a1) ELSE price END AS price,
  CASE WHEN omv < a2 - 1.5 * (b2 - a2) THEN a2 - 1.5 * (b2 - a2) WHEN omv > b2 + 1.5 * (b2 - a2)
       THEN b2 + 1.5 * (b2 - a2) ELSE omv END AS omv
FROM listing CROSS JOIN q
"""


@register("winsorize_tails", _WINS_SQL, ("listing",))
def q_winsorize(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", "price", "omv")
    return round_all(N.winsorize_tails(l, ["price", "omv"]), 6)


def _iqr_step(src: str, c: str, name: str) -> str:
    return f"""{name}_q AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {src}),
{name} AS (SELECT s.* FROM {src} s CROSS JOIN {name}_q
           WHERE s.{c} >= q1 - 1.5 * (q3 - q1) AND s.{c} <= q3 + 1.5 * (q3 - q1))"""


_IQR_COLS = ["price", "omv", "depreciation"]
_IQR_SQL = ("WITH " + _iqr_step("listing", "price", "f1") + ",\n" + _iqr_step("f1", "omv", "f2") + ",\n"
            + _iqr_step("f2", "depreciation", "f3") + "\nSELECT listing_id FROM f3")


@register("iqr_filter", _IQR_SQL, ("listing",))
def q_iqr_filter(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", *_IQR_COLS)
    return N.iqr_filter(l, _IQR_COLS).select("listing_id")


_DESC_COLS = ["price", "power", "omv", "coe"]
_DESC_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column, CAST(count({c}) AS DOUBLE) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
       round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
       CAST(max({c}) AS DOUBLE) AS max FROM listing""" for c in _DESC_COLS)


@register("describe_column", _DESC_SQL, ("listing",))
def q_describe(spark, sf_dir):
    return round_all(N.describe_columns(fx(spark, sf_dir).listing(), _DESC_COLS))


_VC_SQL = """
SELECT model, count(*) AS n FROM listing GROUP BY model ORDER BY n DESC, model LIMIT 20
"""


@register("value_counts_top", _VC_SQL, ("listing",))
def q_value_counts(spark, sf_dir):
    return N.value_counts_top(fx(spark, sf_dir).listing(), "model", 20)


_SHARE_SQL = """
SELECT type_of_vehicle, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM listing GROUP BY type_of_vehicle
"""


@register("class_share", _SHARE_SQL, ("listing",))
def q_class_share(spark, sf_dir):
    return round_all(N.class_share(fx(spark, sf_dir).listing(), "type_of_vehicle"))


_NULL_COLS = ["make", "manufactured", "power", "curb_weight", "engine_cap", "no_of_owners", "depreciation", "coe",
              "road_tax", "dereg_value", "omv", "arf", "price"]
_NULLS_SQL = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) - count({c}) AS nulls FROM listing_nulls" for c in _NULL_COLS) + ") WHERE nulls > 0"


@register("null_counts", _NULLS_SQL, ("listing_nulls",))
def q_null_counts(spark, sf_dir):
    return N.null_counts(fx(spark, sf_dir).listing_nulls(), _NULL_COLS)


_F_FEATS = ["power", "curb_weight", "engine_cap", "depreciation", "road_tax", "dereg_value", "omv", "arf"]
_FSCORE_SQL = """
WITH c AS (SELECT * FROM listing_nulls WHERE {nn}),
w AS (SELECT count(*) AS n, {corrs} FROM c),
l AS (UNPIVOT w ON {feats} INTO NAME feature VALUE r)
SELECT feature, round(r, 6) AS r, round(r * r / (1.0 - r * r) * (n - 2), 4) AS f_score, rank FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY round(r * r / (1.0 - r * r) * (n - 2), 6) DESC NULLS LAST, feature) AS INTEGER) AS rank FROM l)
WHERE rank <= 5
""".format(nn=" AND ".join(f"{c} IS NOT NULL" for c in [*_F_FEATS, "price"]),
           corrs=", ".join(f"corr({c}, price) AS {c}" for c in _F_FEATS), feats=", ".join(_F_FEATS))


@register("f_score_select", _FSCORE_SQL, ("listing_nulls",))
def q_f_score(spark, sf_dir):
    t = N.f_score_select(fx(spark, sf_dir).listing_nulls(), _F_FEATS, "price", 5)
    return t.select("feature", rnd("r").alias("r"), rnd("f_score", 4).alias("f_score"), "rank")


_MI_FEATS = ["power", "depreciation", "omv", "dereg_value", "coe"]


def _mi_sql() -> str:
    cols = ["price", *_MI_FEATS]
    edges = ", ".join(f"quantile_cont({c}, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS e_{c}" for c in cols)

    def code(c: str) -> str:
        inner = f"list_sort(list_distinct(e_{c}))"
        return (f"CASE WHEN {c} >= {inner}[1] AND {c} <= {inner}[len({inner})] THEN "
                f"len(list_filter({inner}[2:len({inner}) - 1], lambda e: {c} > e)) END")

    binned = ", ".join(f"{code(c)} AS b_{c}" for c in cols)
    unions = " UNION ALL ".join(f"SELECT '{f}' AS feature, b_price AS t, b_{f} AS b FROM binned" for f in _MI_FEATS)
    return f"""
WITH e AS (SELECT {edges} FROM listing),
binned AS (SELECT {binned} FROM listing CROSS JOIN e),
lng AS (SELECT * FROM ({unions}) WHERE t IS NOT NULL AND b IS NOT NULL),
joint AS (SELECT feature, t, b, count(*) AS nab FROM lng GROUP BY feature, t, b),
j AS (SELECT *, sum(nab) OVER (PARTITION BY feature) AS n, sum(nab) OVER (PARTITION BY feature, b) AS na,
             sum(nab) OVER (PARTITION BY feature, t) AS nb FROM joint)
SELECT feature, round(mi, 6) AS mutual_info FROM (SELECT feature, sum(nab / n * ln(nab * n / (na * nb))) AS mi FROM j GROUP BY feature)
WHERE mi > 0 ORDER BY round(mi, 9) DESC, feature LIMIT 3
"""


@register("mutual_info_select", _mi_sql(), ("listing",))
def q_mutual_info(spark, sf_dir):
    return round_all(N.mutual_info_select(fx(spark, sf_dir).listing(), _MI_FEATS, "price", 10, k=3))


_CM_COLS = ["power", "curb_weight", "engine_cap", "depreciation", "omv"]
_CORRM_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM listing_nulls"
    for i, a in enumerate(_CM_COLS) for b in _CM_COLS[i + 1:])


@register("corr_matrix", _CORRM_SQL, ("listing_nulls",))
def q_corr_matrix(spark, sf_dir):
    return round_all(N.corr_matrix(fx(spark, sf_dir).listing_nulls(), _CM_COLS))


_CT_FEATS = ["power", "curb_weight", "depreciation", "dereg_value", "omv", "arf", "road_tax"]
_CORRT_SQL = """
WITH w AS (SELECT {corrs} FROM listing), l AS (UNPIVOT w ON {feats} INTO NAME feature VALUE corr)
SELECT feature, round(corr, 6) AS corr, rank FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY round(abs(corr), 9) DESC, feature) AS INTEGER) AS rank FROM l WHERE abs(corr) > 0.1)
WHERE rank <= 3
""".format(corrs=", ".join(f"corr({c}, price) AS {c}" for c in _CT_FEATS), feats=", ".join(_CT_FEATS))


@register("corr_threshold_select", _CORRT_SQL, ("listing",))
def q_corr_threshold(spark, sf_dir):
    t = N.corr_threshold_select(fx(spark, sf_dir).listing(), _CT_FEATS, "price", 0.1, 3)
    return t.select("feature", rnd("corr").alias("corr"), "rank")


_QP_SQL = """
SELECT grp, {qs}, round(greatest(0.0, quantile_cont(value, 0.001)), 6) AS lower,
       round(1.2 * quantile_cont(value, 0.999), 6) AS upper,
       round(avg(ln(1 + value)), 6) AS log_mean, round(stddev_pop(ln(1 + value)), 6) AS log_std
FROM vals GROUP BY grp
""".format(qs=", ".join(f"round(quantile_cont(value, {p}), 6) AS q{str(p).replace('.', '_')}"
                        for p in N.QUANTILE_PROFILE_PROBS))


@register("quantile_profile", _QP_SQL, ("vals",))
def q_quantile_profile(spark, sf_dir):
    return round_all(N.quantile_profile(fx(spark, sf_dir).values(), "value", "grp"))


_HIST_SQL = """
WITH mm AS (SELECT grp, min(value) AS lo, max(value) AS hi FROM vals GROUP BY grp),
b AS (
  SELECT v.grp, mm.lo, mm.hi,
    CAST(CASE WHEN mm.hi - mm.lo = 0 THEN 0 ELSE least(floor((v.value - mm.lo) / (mm.hi - mm.lo) * 50), 49) END AS INTEGER) AS bin
  FROM vals v JOIN mm ON v.grp = mm.grp WHERE v.value IS NOT NULL
)
SELECT grp, bin, round(lo + bin * (hi - lo) / 50, 6) AS bin_start, round(lo + (bin + 1) * (hi - lo) / 50, 6) AS bin_end,
       count(*) AS n
FROM b GROUP BY grp, bin, lo, hi
"""


@register("histogram", _HIST_SQL, ("vals",))
def q_histogram(spark, sf_dir):
    return round_all(N.histogram(fx(spark, sf_dir).values(), "value", 50, "grp"))


_GINI_SQL = """
WITH r AS (SELECT grp, value AS x, row_number() OVER (PARTITION BY grp ORDER BY value) - 1 AS i FROM vals WHERE value IS NOT NULL),
a AS (SELECT grp, count(*) AS n, sum(x) AS sx, sum(i * x) AS six FROM r GROUP BY grp)
SELECT grp, n, round(CASE WHEN sx = 0 THEN 0.0 ELSE least(greatest((n + 1 - 2 * (n * sx - six) / sx) / n, 0.0), 1.0) END, 6) AS gini
FROM a
"""


@register("gini_coefficient", _GINI_SQL, ("vals",))
def q_gini(spark, sf_dir):
    return round_all(N.gini_coefficient(fx(spark, sf_dir).values(), "value", "grp"))


@register("gini_coefficient_null_group", """
WITH r AS (SELECT make, price AS x, row_number() OVER (PARTITION BY make ORDER BY price, listing_id) - 1 AS i FROM listing_nulls),
a AS (SELECT make, count(*) AS n, sum(x) AS sx, sum(i * x) AS six FROM r GROUP BY make)
SELECT make, n, round(CASE WHEN sx = 0 THEN 0.0 ELSE least(greatest((n + 1 - 2 * (n * sx - six) / sx) / n, 0.0), 1.0) END, 6) AS gini FROM a
""", ("listing", "listing_nulls"))
def q_gini_nulls(spark, sf_dir):
    """N19 where the group may be missing: rows without one are a group."""
    return round_all(N.gini_coefficient(fx(spark, sf_dir).listing_nulls(), "price", "make"))


_PEAKS_SQL = """
WITH st AS (SELECT min(value) AS lo, max(value) AS hi, stddev_samp(value) AS sd, count(value) AS n FROM vals),
h AS (
  SELECT CAST(CASE WHEN st.hi - st.lo = 0 THEN 0 ELSE least(floor((v.value - st.lo) / (st.hi - st.lo) * 256), 255) END AS INTEGER) AS bin,
         count(*) AS w
  FROM vals v CROSS JOIN st WHERE v.value IS NOT NULL GROUP BY bin
), c AS (SELECT h.bin, st.lo + (h.bin + 0.5) * (st.hi - st.lo) / 256 AS c, CAST(h.w AS DOUBLE) AS w FROM h CROSS JOIN st),
g AS (SELECT i AS id, st.lo + i * ((st.hi - st.lo) / 999) AS x FROM range(1000) t(i) CROSS JOIN st),
bw AS (SELECT sd * pow(n, -1.0 / 5.0) AS bw, n FROM st),
d AS (
  SELECT g.id, g.x, sum(c.w * exp(-pow((g.x - c.c) / bw.bw, 2) / 2.0)) / (bw.n * bw.bw * sqrt(2 * pi())) AS density
  FROM g CROSS JOIN c CROSS JOIN bw GROUP BY g.id, g.x, bw.n, bw.bw
), p AS (SELECT *, lag(density) OVER (ORDER BY id) AS pd, lead(density) OVER (ORDER BY id) AS nd FROM d)
SELECT round(x, 6) AS x, round(density, 8) AS density FROM p WHERE density > pd AND density > nd
"""


@register("distribution_peaks", _PEAKS_SQL, ("vals",))
def q_peaks(spark, sf_dir):
    p = N.distribution_peaks(fx(spark, sf_dir).values(), "value")
    return p.select(rnd("x", 6).alias("x"), rnd("density", 8).alias("density"))


# ---------------------------------------------------------------------- normal scores, neighbours
def _sql_ratio(z: str, fraction) -> str:
    def poly(cs):
        out = f"{cs[-1]!r}::DOUBLE"
        for c in reversed(cs[:-1]):
            out = f"({out} * {z} + {c!r}::DOUBLE)"
        return out
    return f"{poly(fraction[0])} / {poly(fraction[1])}"


def _normal_scores_sql() -> str:
    passes, before = [], "SELECT feature, 0.0::DOUBLE AS lam FROM score GROUP BY feature"
    for i, step in enumerate((0.1, 0.005, 0.00025)):
        passes.append(f"""
t{i} AS (SELECT b.feature, round((round(b.lam / {step}::DOUBLE) + g.j) * {step}::DOUBLE, 6) AS lam FROM ({before}) b CROSS JOIN range(-20, 21) g(j)),
r{i} AS (SELECT s.feature, t.lam, corr(s.m, CASE WHEN t.lam = 0 THEN ln(s.x1) ELSE (pow(s.x1, t.lam) - 1.0) / t.lam END) AS r
         FROM score s JOIN t{i} t ON s.feature = t.feature GROUP BY s.feature, t.lam),
b{i} AS (SELECT feature, lam, r FROM r{i} QUALIFY row_number() OVER (PARTITION BY feature ORDER BY r DESC, lam) = 1)""")
        before = f"SELECT feature, lam FROM b{i}"
    head = _BOXCOX_SQL.split("grid AS")[0]
    return head + f"""pos AS (SELECT l.feature, 1.0 + l.x AS x1, row_number() OVER (PARTITION BY l.feature ORDER BY l.x) AS rn,
               count(*) OVER (PARTITION BY l.feature) AS n
        FROM lst l JOIN chosen c ON l.feature = c.feature WHERE l.x > -1),
p AS (SELECT feature, x1, CASE WHEN rn = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n) WHEN rn = 1 THEN 1.0 - pow(0.5::DOUBLE, 1.0::DOUBLE / n)
                          ELSE (rn - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM pos),
z AS (SELECT feature, x1, p - 0.5 AS q, 0.180625::DOUBLE - (p - 0.5) * (p - 0.5) AS c, sqrt(-ln(least(p, 1.0 - p))) AS r,
             r - 1.6::DOUBLE AS r1, r - 5.0::DOUBLE AS r5 FROM p),
score AS (SELECT feature, x1, CASE WHEN abs(q) <= 0.425 THEN q * ({_sql_ratio('c', R.CENTRE)})
                              WHEN r <= 5 THEN sign(q) * ({_sql_ratio('r1', R.SHOULDER)}) ELSE sign(q) * ({_sql_ratio('r5', R.TAIL)}) END AS m FROM z),
{",".join(passes)}
SELECT b.feature, round(c.skewness, 6) AS skewness, b.lam AS lambda, round(b.r, 6) AS corr FROM b2 b JOIN chosen c ON b.feature = c.feature
"""


@register("boxcox_normal_scores", _normal_scores_sql(), ("listing_nulls",))
def q_boxcox_normal_scores(spark, sf_dir):
    l = fx(spark, sf_dir).listing_nulls().withColumns({
        "price_sq": F.col("price") * F.col("price") / F.lit(100000.0),
        "power_cube": F.col("power") * F.col("power") * F.col("power") / F.lit(10000.0)})
    t = R.boxcox_normal_scores(l, _BC_COLS)
    return t.select(F.col("column").alias("feature"), rnd("skewness").alias("skewness"), "lambda", rnd("corr").alias("corr"))


def _sql_digamma(m: str) -> str:
    z = f"({m} + 10.0::DOUBLE)"
    return (f"(ln({z}) - 0.5 / {z} - 1.0 / (12.0 * {z} * {z}) + 1.0 / (120.0 * {z} * {z} * {z} * {z})"
            + "".join(f" - 1.0::DOUBLE / ({m} + {i})" for i in range(10)) + ")")


_NMI_FEATS = ["power", "depreciation", "coe"]
_NMI_COLS = [*_NMI_FEATS, "price"]
_NMI_SQL = f"""
WITH st AS (SELECT {", ".join(f"round(avg({c}), 6) AS m_{c}, round(stddev_pop({c}), 6) AS s_{c}" for c in _NMI_COLS)} FROM listing_nulls),
q AS (SELECT {", ".join(f"CAST(floor(({c} - m_{c}) / s_{c} * 1048576.0::DOUBLE + 0.5) AS BIGINT) AS {c}" for c in _NMI_COLS)}
      FROM listing_nulls CROSS JOIN st),
pts AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x, price AS y FROM q WHERE {c} IS NOT NULL AND price IS NOT NULL" for c in _NMI_FEATS)}),
own AS (SELECT feature, x, y FROM pts GROUP BY feature, x, y),
near AS (SELECT a.feature, a.x, a.y, greatest(min(greatest(abs(a.x - b.x), abs(a.y - b.y)), 4)[4] - 1, 0) AS reach
         FROM own a JOIN pts b ON a.feature = b.feature GROUP BY a.feature, a.x, a.y),
each_row AS (SELECT p.feature, p.x, p.y, n.reach FROM pts p JOIN near n ON p.feature = n.feature AND p.x = n.x AND p.y = n.y),
counted AS (SELECT feature, count(*) OVER (PARTITION BY feature ORDER BY x RANGE BETWEEN reach PRECEDING AND reach FOLLOWING) AS nx,
                   count(*) OVER (PARTITION BY feature ORDER BY y RANGE BETWEEN reach PRECEDING AND reach FOLLOWING) AS ny FROM each_row),
means AS (SELECT feature, count(*) AS n, avg({_sql_digamma("nx")}) + avg({_sql_digamma("ny")}) AS psi FROM counted GROUP BY feature)
SELECT feature, n, round(greatest({_sql_digamma("n")} + {_sql_digamma("3")} - psi, 0.0), 6) AS mutual_info FROM means
"""


@register("neighbour_mutual_info", _NMI_SQL, ("listing_nulls",))
def q_neighbour_mutual_info(spark, sf_dir):
    return round_all(R.neighbour_mutual_info(fx(spark, sf_dir).listing_nulls(), _NMI_FEATS, "price", stats_digits=6))
