"""Array handling and categorical encoding.

Every encoder is ``fit(train) -> state`` plus ``apply(df, state)``. State is
either a short sorted value list (one-hot / multi-hot: it *defines* output
columns, so it is necessarily small and lives on the driver) or a key→value
table joined back with a size-checked broadcast (label codes, target means,
reference prices), falling back to a shuffle join when large.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuator.functions.text import clean_token, first_word
from valuator.plans.strategy import attach_state, collect_bounded, fit_row, ranked

#: Values become columns: an error beyond this many, unless the caller allows more.
MAX_ONE_HOT_VALUES = 1000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ E1–E3
def split_explode(df: DataFrame, col: str, out: str = "token") -> DataFrame:
    """One row per whitespace-separated element (explode_outer keeps empties)."""
    return df.withColumn(out, F.explode_outer(F.split(F.trim(F.col(col)), r"\s+")))


def split_categories(c: str | Column) -> Column:
    """Comma list -> trimmed array; '-', '' and null -> empty array."""
    x = _col(c)
    empty = x.isNull() | (F.trim(x) == "") | (F.trim(x) == "-")
    arr = F.transform(F.split(x, ","), lambda s: F.trim(s))
    return F.when(empty, F.array().cast("array<string>")).otherwise(arr)


def category_counts(df: DataFrame, arr_col: str) -> DataFrame:
    """Distinct tokens and their frequency over exploded lists."""
    return df.select(F.explode(F.col(arr_col)).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ E4–E7
@dataclass
class OneHotState:
    column: str
    prefix: str
    values: list[str]

    def names(self) -> list[str]:
        return [f"{self.prefix}{_flag_name(v)}" for v in self.values]


def _flag_name(v: str) -> str:
    import re
    s = v.lower().replace("/", "_")
    s = re.sub(r"[^a-z0-9_\s]", "", s)
    return re.sub(r"\s+", "_", s).strip()


def fit_one_hot(df: DataFrame, col: str, prefix: str | None = None, drop_first: bool = False,
                max_values: int = MAX_ONE_HOT_VALUES) -> OneHotState:
    """Sorted distinct non-null values (bounded: they become columns)."""
    rows = collect_bounded(df.select(F.col(col).cast("string").alias("v")).filter("v IS NOT NULL").distinct(),
                           max_values)
    if rows is None:
        raise ValueError(f"{col} has more than {max_values} distinct values; use label/target encoding")
    values = sorted(r["v"] for r in rows)
    if drop_first:
        values = values[1:]
    return OneHotState(col, prefix if prefix is not None else f"{col}_", values)


def apply_one_hot(df: DataFrame, state: OneHotState, keep_source: bool = False) -> DataFrame:
    """0/1 column per fitted value; null and unseen -> all zeros.
    Single projection, no shuffle."""
    src = F.col(state.column).cast("string")
    cols = {n: F.when(src == F.lit(v), 1).otherwise(0) for n, v in zip(state.names(), state.values)}
    out = df.withColumns(cols)
    return out if keep_source else out.drop(state.column)


def fit_multi_hot(df: DataFrame, arr_col: str, prefix: str = "", max_values: int = MAX_ONE_HOT_VALUES) -> OneHotState:
    rows = collect_bounded(df.select(F.explode(F.col(arr_col)).alias("v")).distinct(), max_values)
    if rows is None:
        raise ValueError(f"{arr_col} has more than {max_values} distinct tokens")
    return OneHotState(arr_col, prefix, sorted(r["v"] for r in rows))


def apply_multi_hot(df: DataFrame, state: OneHotState, keep_source: bool = False) -> DataFrame:
    """E5: 0/1 per fitted token via array_contains."""
    arr = F.col(state.column)
    cols = {n: F.coalesce(F.array_contains(arr, F.lit(v)).cast("int"), F.lit(0))
            for n, v in zip(state.names(), state.values)}
    out = df.withColumns(cols)
    return out if keep_source else out.drop(state.column)


# ------------------------------------------------------------------ E8
def fit_label_codes(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct value -> 0..n−1 (state table; ranked without a single-task window)."""
    vals = df.select(F.col(col).alias("_v")).filter("_v IS NOT NULL").distinct()
    rows = collect_bounded(vals)
    if rows is not None:  # usual case: a bounded vocabulary, numbered on the driver
        ordered = sorted(r["_v"] for r in rows)
        schema = f"`{col}` {dict(vals.dtypes)['_v']}, _code int"
        return df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(ordered)], schema)
    return ranked(vals, [], ["_v"], out="_rn").select(F.col("_v").alias(col), (F.col("_rn") - 1).cast("int").alias("_code"))


def apply_label_codes(df: DataFrame, col: str, codes: DataFrame, unseen: str = "minus_one",
                      out: str | None = None) -> DataFrame:
    """Join codes; unseen/null -> −1, or (unseen='new') one shared new code n."""
    out = out or f"{col}_code"
    j = attach_state(df, codes, col, "left")
    if unseen == "minus_one":
        fill = F.lit(-1)
    elif unseen == "new":
        n = codes.count()
        fill = F.lit(int(n))
    else:
        raise ValueError("unseen must be minus_one|new")
    return j.withColumn(out, F.coalesce(F.col("_code"), fill).cast("int")).drop("_code")


# ------------------------------------------------------------------ E9
def fit_target_encoder(df: DataFrame, col: str, target: str, form: str = "sigmoid", smoothing: float = 1.0,
                       min_samples_leaf: int = 1, m: float = 10.0) -> tuple[DataFrame, float]:
    """Per-category blend of the category mean and the prior (global mean).

    form='sigmoid': λ = 1/(1+exp(−(n − min_samples_leaf)/smoothing)),
    categories seen once get the prior; form='m_estimate': (n·mean + m·prior)/(n+m).
    """
    prior = fit_row(df, F.avg(target).alias("p"))["p"]
    st = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.avg(target).alias("_mean"),
                                                           F.count(F.lit(1)).alias("_n"))
    p = F.lit(float(prior))
    if form == "sigmoid":
        lam = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("_n") - F.lit(min_samples_leaf)) / F.lit(float(smoothing))))
        enc = F.when(F.col("_n") == 1, p).otherwise(p * (F.lit(1.0) - lam) + F.col("_mean") * lam)
    elif form == "m_estimate":
        enc = (F.col("_n") * F.col("_mean") + F.lit(float(m)) * p) / (F.col("_n") + F.lit(float(m)))
    else:
        raise ValueError("form must be sigmoid|m_estimate")
    return st.select(col, enc.alias("_enc")), float(prior)


def apply_target_encoder(df: DataFrame, col: str, state: DataFrame, prior: float,
                         out: str | None = None) -> DataFrame:
    out = out or f"{col}_te"
    j = attach_state(df, state, col, "left")
    return j.withColumn(out, F.coalesce(F.col("_enc"), F.lit(prior))).drop("_enc")


# ------------------------------------------------------------------ E10, E11
def fit_ref_price_2level(train: DataFrame, price: str = "price") -> tuple[DataFrame, DataFrame]:
    make_model = F.concat(F.col("make"), F.lit("_"), F.col("model"))
    t = train.groupBy("type_of_vehicle").agg(F.avg(price).alias("ref_type_of_vehicle_price"))
    mm = (train.withColumn("_make_model", make_model).filter("_make_model IS NOT NULL")
          .groupBy("_make_model").agg(F.avg(price).alias("_ref_model")))
    return t, mm


def apply_ref_price_2level(df: DataFrame, state: tuple[DataFrame, DataFrame], fallback: bool = True) -> DataFrame:
    """Type mean and make+model mean; unseen make+model -> type mean."""
    t, mm = state
    j = attach_state(df, t, "type_of_vehicle", "left")
    j = j.withColumn("_make_model", F.concat(F.col("make"), F.lit("_"), F.col("model")))
    j = attach_state(j, mm, "_make_model", "left")
    ref = F.coalesce(F.col("_ref_model"), F.col("ref_type_of_vehicle_price")) if fallback else F.col("_ref_model")
    return j.withColumn("ref_model_price", ref).drop("_make_model", "_ref_model")


def fit_ref_price_3level(train: DataFrame, price: str = "price") -> dict[str, DataFrame]:
    return {k: train.filter(F.col(k).isNotNull()).groupBy(k).agg(F.avg(price).alias(f"_ref_{k}"))
            for k in ("make", "model", "type_of_vehicle")}


def apply_ref_price_3level(df: DataFrame, state: dict[str, DataFrame]) -> DataFrame:
    """Model mean, falling back to make mean; when the make is unseen both
    columns take the type mean (the reference's overwrite rule)."""
    j = df
    for k, st in state.items():
        j = attach_state(j, st, k, "left")
    make_unseen = F.col("_ref_make").isNull()
    model_ref = F.when(make_unseen, F.col("_ref_type_of_vehicle")).otherwise(
        F.coalesce(F.col("_ref_model"), F.col("_ref_make")))
    make_ref = F.when(make_unseen, F.col("_ref_type_of_vehicle")).otherwise(F.col("_ref_make"))
    return (j.withColumns({"model_price_ref": model_ref, "make_price_ref": make_ref})
            .drop("_ref_make", "_ref_model", "_ref_type_of_vehicle"))


# ------------------------------------------------------------------ E12
def _padded_bigrams(c: Column) -> Column:
    s = F.concat(F.lit("#"), c, F.lit("#"))
    return F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.substring(s, i, 2))


def fuzzy_fill_make(df: DataFrame, make: str = "make", title: str = "title", threshold: float = 0.8,
                    out: str | None = None) -> DataFrame:
    """Null make <- best known make for the first title word when the
    similarity 1 − levenshtein/max_len ≥ threshold (ties: smallest name), else
    the word itself.

    Exact candidate generation without an all-pairs product: for threshold
    ≥ 0.5 two strings that are that similar always share a padded bigram
    (at most 2 bigrams change per edit), so words and makes are joined on
    bigrams (an equi-join), then scored exactly.
    """
    if threshold < 0.5:
        raise ValueError("bigram blocking is exact only for threshold >= 0.5")
    out = out or make
    word = F.lower(first_word(title))
    with_word = df.withColumn("_word", word)
    words = with_word.filter(F.col(make).isNull()).select("_word").distinct()
    known = df.filter(F.col(make).isNotNull()).select(F.col(make).alias("_make")).distinct()
    wg = words.select("_word", F.explode(_padded_bigrams(F.col("_word"))).alias("_g")).distinct()
    kg = known.select("_make", F.explode(_padded_bigrams(F.lower("_make"))).alias("_g")).distinct()
    cand = wg.join(kg, "_g").select("_word", "_make").distinct()
    lw, lm = F.col("_word"), F.lower("_make")
    score = F.lit(1.0) - F.levenshtein(lw, lm) / F.greatest(F.length(lw), F.length(lm))
    cand = cand.withColumn("_score", score).filter(F.col("_score") >= F.lit(threshold))
    w = Window.partitionBy("_word").orderBy(F.col("_score").desc(), F.col("_make"))
    best = cand.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("_word", "_make")
    fill = words.join(best, "_word", "left").select("_word", F.coalesce("_make", "_word").alias("_fill"))
    # only rows without a make meet the words, so a common word of known makes moves no row
    open_rows = attach_state(with_word.filter(F.col(make).isNull()), fill, "_word", "left")
    known_rows = df.filter(F.col(make).isNotNull()).withColumn(out, F.col(make))
    return known_rows.unionByName(open_rows.withColumn(out, F.col("_fill")).drop("_word", "_fill"))


def one_hot_names(values: Sequence[str], prefix: str) -> list[str]:
    return [f"{prefix}{_flag_name(v)}" for v in values]

