"""Registered encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuator.operators import encode as E
from valuator.plans.common import fx, rnd, round_all
from valuator.plans.registry import register

_SPLIT_EXPLODE_SQL = r"""
SELECT listing_id, unnest(string_split_regex(trim(vehicle_words), '\s+')) AS token FROM titles
"""


@register("split_explode", _SPLIT_EXPLODE_SQL, ("titles",))
def q_split_explode(spark, sf_dir):
    t = fx(spark, sf_dir).titles().select("listing_id", "vehicle_words")
    return E.split_explode(t, "vehicle_words").select("listing_id", "token")


_CATS = """
cats AS (
  SELECT listing_id,
    CASE WHEN category IS NULL OR trim(category) = '' OR trim(category) = '-' THEN CAST([] AS VARCHAR[])
         ELSE list_transform(string_split(category, ','), lambda s: trim(s)) END AS cats
  FROM titles
)"""

_SPLIT_CATS_SQL = "WITH " + _CATS.strip() + """
SELECT listing_id, array_to_string(cats, '|') AS categories_joined, CAST(len(cats) AS INTEGER) AS n_categories FROM cats
"""


def _cats(spark, sf_dir):
    t = fx(spark, sf_dir).titles()
    return t.select("listing_id", "type_of_vehicle", E.split_categories("category").alias("cats"))


@register("split_categories", _SPLIT_CATS_SQL, ("titles",))
def q_split_categories(spark, sf_dir):
    c = _cats(spark, sf_dir)
    return c.select("listing_id", F.array_join("cats", "|").alias("categories_joined"),
                    F.size("cats").alias("n_categories"))


_CAT_COUNTS_SQL = "WITH " + _CATS.strip() + """
SELECT token, count(*) AS n FROM (SELECT unnest(cats) AS token FROM cats) GROUP BY token
"""


@register("category_counts", _CAT_COUNTS_SQL, ("titles",))
def q_category_counts(spark, sf_dir):
    return E.category_counts(_cats(spark, sf_dir), "cats")


_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_ONE_HOT_SQL = """
SELECT listing_id, {cols} FROM listing
""".format(cols=", ".join(
    f"CASE WHEN type_of_vehicle = '{v}' THEN 1 ELSE 0 END AS {n}"
    for v, n in zip(_TYPES, E.one_hot_names(_TYPES, "vehicle_type_"))))


@register("one_hot", _ONE_HOT_SQL, ("listing",))
def q_one_hot(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", "type_of_vehicle")
    st = E.fit_one_hot(l, "type_of_vehicle", "vehicle_type_")
    return E.apply_one_hot(l, st)


_TOKENS = ["direct owner sale", "low mileage car", "parf car", "premium ad car", "rare & exotic"]
_MULTI_HOT_SQL = "WITH " + _CATS.strip() + """
SELECT listing_id, {cols} FROM cats
""".format(cols=", ".join(
    f"CAST(list_contains(cats, '{v}') AS INTEGER) AS {n}" for v, n in zip(_TOKENS, E.one_hot_names(_TOKENS, "cat_"))))


@register("multi_hot", _MULTI_HOT_SQL, ("titles",))
def q_multi_hot(spark, sf_dir):
    c = _cats(spark, sf_dir).select("listing_id", "cats")
    st = E.fit_multi_hot(c, "cats", "cat_")
    return E.apply_multi_hot(c, st)


_MAKES_TRAIN = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
_OH_IGNORE_SQL = """
SELECT listing_id, {cols} FROM listing_new
""".format(cols=", ".join(
    f"CASE WHEN make = '{v}' THEN 1 ELSE 0 END AS {n}" for v, n in zip(_MAKES_TRAIN, E.one_hot_names(_MAKES_TRAIN, "make_"))))


@register("one_hot_ignore_unknown", _OH_IGNORE_SQL, ("listing_train", "listing_new"))
def q_one_hot_ignore_unknown(spark, sf_dir):
    f = fx(spark, sf_dir)
    st = E.fit_one_hot(f.listing_train(), "make", "make_")
    return E.apply_one_hot(f.listing_new().select("listing_id", "make"), st)


_OH_DROP_SQL = """
SELECT listing_id, {cols} FROM listing
""".format(cols=", ".join(
    f"CASE WHEN type_of_vehicle = '{v}' THEN 1 ELSE 0 END AS {n}"
    for v, n in zip(_TYPES[1:], E.one_hot_names(_TYPES[1:], "vehicle_type_"))))


@register("one_hot_drop_first", _OH_DROP_SQL, ("listing",))
def q_one_hot_drop_first(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", "type_of_vehicle")
    st = E.fit_one_hot(l, "type_of_vehicle", "vehicle_type_", drop_first=True)
    return E.apply_one_hot(l, st)


_LABEL_SQL = """
WITH codes AS (
  SELECT model, CAST(row_number() OVER (ORDER BY model) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT model FROM listing_train WHERE model IS NOT NULL)
), mk AS (
  SELECT make, CAST(row_number() OVER (ORDER BY make) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT make FROM listing_train WHERE make IS NOT NULL)
)
SELECT n.listing_id, CAST(coalesce(c.code, -1) AS INTEGER) AS model_code,
       CAST(coalesce(m.code, (SELECT count(*) FROM mk)) AS INTEGER) AS make_code
FROM listing_new n LEFT JOIN codes c ON n.model = c.model LEFT JOIN mk m ON n.make = m.make
"""


@register("label_encode", _LABEL_SQL, ("listing_train", "listing_new"))
def q_label_encode(spark, sf_dir):
    f = fx(spark, sf_dir)
    tr, new = f.listing_train(), f.listing_new().select("listing_id", "model", "make")
    out = E.apply_label_codes(new, "model", E.fit_label_codes(tr, "model"), "minus_one")
    out = E.apply_label_codes(out, "make", E.fit_label_codes(tr, "make"), "new")
    return out.select("listing_id", "model_code", "make_code")


_TE_SQL = """
WITH prior AS (SELECT avg(price) AS p FROM listing_train),
st AS (SELECT model, avg(price) AS m, count(*) AS n FROM listing_train WHERE model IS NOT NULL GROUP BY model),
enc AS (
  SELECT model,
    CASE WHEN n = 1 THEN p
         ELSE p * (1.0 - 1.0 / (1.0 + exp(-(n - 1) / 2.0))) + m * (1.0 / (1.0 + exp(-(n - 1) / 2.0))) END AS e,
    (n * m + 10.0 * p) / (n + 10.0) AS e2
  FROM st, prior
)
SELECT l.listing_id, round(coalesce(enc.e, prior.p), 4) AS model_te, round(coalesce(enc.e2, prior.p), 4) AS model_te_m
FROM listing_new l CROSS JOIN prior LEFT JOIN enc ON l.model = enc.model
"""


@register("target_encode", _TE_SQL, ("listing_train", "listing_new"))
def q_target_encode(spark, sf_dir):
    f = fx(spark, sf_dir)
    tr, new = f.listing_train(), f.listing_new().select("listing_id", "model")
    st, prior = E.fit_target_encoder(tr, "model", "price", "sigmoid", smoothing=2.0, min_samples_leaf=1)
    st2, prior2 = E.fit_target_encoder(tr, "model", "price", "m_estimate", m=10.0)
    out = E.apply_target_encoder(new, "model", st, prior, "model_te")
    out = E.apply_target_encoder(out, "model", st2, prior2, "model_te_m")
    return out.select("listing_id", rnd("model_te", 4).alias("model_te"), rnd("model_te_m", 4).alias("model_te_m"))


_REF2_SQL = """
WITH t AS (SELECT type_of_vehicle, avg(price) AS r FROM listing_train GROUP BY type_of_vehicle),
mm AS (SELECT make || '_' || model AS mm, avg(price) AS r FROM listing_train
       WHERE make || '_' || model IS NOT NULL GROUP BY make || '_' || model)
SELECT n.listing_id, round(t.r, 4) AS ref_type_of_vehicle_price, round(coalesce(mm.r, t.r), 4) AS ref_model_price
FROM listing_new n LEFT JOIN t ON n.type_of_vehicle = t.type_of_vehicle
LEFT JOIN mm ON n.make || '_' || n.model = mm.mm
"""


@register("ref_price_2level", _REF2_SQL, ("listing_train", "listing_new"))
def q_ref_price_2level(spark, sf_dir):
    f = fx(spark, sf_dir)
    st = E.fit_ref_price_2level(f.listing_train())
    out = E.apply_ref_price_2level(f.listing_new(), st)
    return out.select("listing_id", rnd("ref_type_of_vehicle_price", 4).alias("ref_type_of_vehicle_price"),
                      rnd("ref_model_price", 4).alias("ref_model_price"))


_REF3_SQL = """
WITH mk AS (SELECT make, avg(price) AS r FROM listing_train WHERE make IS NOT NULL GROUP BY make),
md AS (SELECT model, avg(price) AS r FROM listing_train WHERE model IS NOT NULL GROUP BY model),
ty AS (SELECT type_of_vehicle, avg(price) AS r FROM listing_train GROUP BY type_of_vehicle)
SELECT n.listing_id,
  round(CASE WHEN mk.r IS NULL THEN ty.r ELSE coalesce(md.r, mk.r) END, 4) AS model_price_ref,
  round(CASE WHEN mk.r IS NULL THEN ty.r ELSE mk.r END, 4) AS make_price_ref
FROM listing_new n LEFT JOIN mk ON n.make = mk.make LEFT JOIN md ON n.model = md.model
LEFT JOIN ty ON n.type_of_vehicle = ty.type_of_vehicle
"""


@register("ref_price_3level", _REF3_SQL, ("listing_train", "listing_new"))
def q_ref_price_3level(spark, sf_dir):
    f = fx(spark, sf_dir)
    st = E.fit_ref_price_3level(f.listing_train())
    out = E.apply_ref_price_3level(f.listing_new(), st)
    return out.select("listing_id", rnd("model_price_ref", 4).alias("model_price_ref"),
                      rnd("make_price_ref", 4).alias("make_price_ref"))


_FUZZY_SQL = r"""
WITH w AS (SELECT listing_id, make, lower(split_part(trim(title), ' ', 1)) AS word FROM listing_titles),
words AS (SELECT DISTINCT word FROM w WHERE make IS NULL),
known AS (SELECT DISTINCT make FROM w WHERE make IS NOT NULL),
sc AS (
  SELECT word, make, 1.0 - levenshtein(word, lower(make)) / greatest(length(word), length(make)) AS score
  FROM words CROSS JOIN known
), best AS (
  SELECT word, make FROM (
    SELECT *, row_number() OVER (PARTITION BY word ORDER BY score DESC, make) AS r FROM sc WHERE score >= 0.8)
  WHERE r = 1
)
SELECT w.listing_id, coalesce(w.make, best.make, w.word) AS make
FROM w LEFT JOIN best ON w.word = best.word
"""


@register("fuzzy_fill_make", _FUZZY_SQL, ("listing_titles",))
def q_fuzzy_fill(spark, sf_dir):
    l = fx(spark, sf_dir).listing_titles().select("listing_id", "make", "title")
    return E.fuzzy_fill_make(l).select("listing_id", "make")


__all__ = ["round_all"]
