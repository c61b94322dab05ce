"""Listing-shaped views derived from the driver tables.

The reference works on a used-car listing table that is not shipped. These
views map the driver tables onto that data model (see FIXTURES.md §5). Each
view exists twice: as a Spark DataFrame built here, and as SQL text (valid in
DuckDB) used by the oracle. Both use the same integer/IEEE arithmetic so the
values are identical; every view reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuator.sources.tables import Tables

# fixed values of the fixture mapping (not from the reference)
LCG_MULT = 48271
LCG_MOD = 2147483647
FOLD_SEED = 42
NEW_FOLD = 0          # fold of the hash split that plays the unlabelled data
UNSEEN_MAKE = "MACHINERY"  # make kept out of the training part


def _d(c: Column) -> Column:
    return c.cast("double")


def _mod_expr(key: Column, mult: int, mod: int) -> Column:
    return (key * F.lit(mult)) % F.lit(mod)


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.t = Tables(spark, sf_dir)
        self.spark = spark

    # ------------------------------------------------------------------ listing
    def listing(self) -> DataFrame:
        o = self.t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                                 "o_orderdate", "o_orderpriority")
        c = self.t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
        j = o.join(c, o.o_custkey == c.c_custkey, "inner")
        k = F.col("o_orderkey")
        p = F.col("o_totalprice")
        return j.select(
            k.alias("listing_id"),
            p.alias("price"),
            F.col("c_mktsegment").alias("make"),
            F.concat(F.col("c_mktsegment"), F.lit("_"), (F.col("c_nationkey") % 5).cast("string")).alias("model"),
            F.col("o_orderpriority").alias("type_of_vehicle"),
            F.col("o_orderstatus").alias("transmission"),
            F.to_date("o_orderdate").alias("reg_date"),
            (F.year("o_orderdate") - k % 3).cast("int").alias("manufactured"),
            _d(F.lit(50) + _mod_expr(k, 37, 400)).alias("power"),
            _d(F.lit(800) + _mod_expr(k, 91, 1500)).alias("curb_weight"),
            _d(F.lit(900) + _mod_expr(k, 53, 3000)).alias("engine_cap"),
            _d(F.lit(1) + _mod_expr(k, 13, 6)).alias("no_of_owners"),
            (p / F.lit(10.0) + _d(_mod_expr(k, 71, 5000))).alias("depreciation"),
            (F.lit(20000) + _mod_expr(k, 29, 80000)).cast("long").alias("coe"),
            _d(F.lit(500) + _mod_expr(k, 17, 3000)).alias("road_tax"),
            (p * F.lit(0.4) + _d(_mod_expr(k, 43, 20000))).alias("dereg_value"),
            (p * F.lit(0.3) + _d(_mod_expr(k, 61, 30000))).alias("omv"),
            _d(_mod_expr(k, 67, 200000)).alias("arf"),
        )

    def listing_nulls(self) -> DataFrame:
        l = self.listing()
        k = F.col("listing_id")

        def nul(name: str, m: int) -> Column:
            return F.when(k % m == 0, F.lit(None)).otherwise(F.col(name)).alias(name)

        return l.select(
            "listing_id", "price", nul("make", 19), "model", "type_of_vehicle", "transmission", "reg_date",
            nul("manufactured", 23), nul("power", 10), nul("curb_weight", 13), nul("engine_cap", 17),
            nul("no_of_owners", 29), nul("depreciation", 11), "coe", nul("road_tax", 7),
            nul("dereg_value", 41), nul("omv", 31), nul("arf", 37),
        )

    def listing_features(self) -> DataFrame:
        """listing_nulls with a comma list of categories."""
        k = F.col("listing_id")
        category = F.when(k % 7 == 0, F.lit("-")).otherwise(F.concat_ws(
            ", ", F.when(k % 2 == 0, F.lit("parf car")), F.when(k % 3 == 0, F.lit("premium ad car")), F.when(k % 5 == 0, F.lit("direct owner sale")),
            F.when(k % 11 == 0, F.lit("rare & exotic"))))
        return self.listing_nulls().withColumn("category", category)

    @staticmethod
    def split_fold(key: Column) -> Column:
        return (((key % F.lit(LCG_MOD)) * F.lit(LCG_MULT) + F.lit(FOLD_SEED)) % F.lit(LCG_MOD)) % F.lit(5)

    def listing_train(self, base: DataFrame | None = None) -> DataFrame:
        base = self.listing() if base is None else base
        return base.filter((self.split_fold(F.col("listing_id")) != NEW_FOLD)
                           & (F.col("make").isNull() | (F.col("make") != UNSEEN_MAKE)))

    def listing_labelled(self, base: DataFrame | None = None) -> DataFrame:
        """All rows that are not new, every make included: what a model is trained on."""
        base = self.listing() if base is None else base
        return base.filter(self.split_fold(F.col("listing_id")) != NEW_FOLD)

    def listing_new(self, base: DataFrame | None = None) -> DataFrame:
        base = self.listing() if base is None else base
        return base.filter(self.split_fold(F.col("listing_id")) == NEW_FOLD)

    # ------------------------------------------------------------------ text
    def titles(self) -> DataFrame:
        p = self.t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
        k, s = F.col("p_partkey"), F.col("p_size")
        coe = F.when(s % 3 == 0, F.lit("")).otherwise(
            F.concat(F.lit(" (COE till "), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lit("/"),
                     (F.lit(2020) + k % 10).cast("string"), F.lit(")")))
        title = F.concat(
            F.col("p_name"), F.lit(" "), F.col("p_brand"), F.lit(" 1.6L "),
            F.when(s % 2 == 0, F.lit("Auto")).otherwise(F.lit("Manual")), coe, F.lit(" "),
            (F.lit(2000) + k % 25).cast("string"), F.lit(" "), (s * 1000).cast("string"), F.lit(" km"))
        category = F.when(s % 7 == 0, F.lit("-")).otherwise(F.concat_ws(
            ", ",
            F.when(s % 2 == 0, F.lit("parf car")),
            F.when(s % 3 == 0, F.lit("premium ad car")),
            F.when(s % 5 == 0, F.lit("low mileage car")),
            F.when(s % 4 == 1, F.lit("direct owner sale")),
            F.when(k % 11 == 0, F.lit("rare & exotic")),
        ))
        return p.select(k.alias("listing_id"), title.alias("title"), category.alias("category"),
                        F.col("p_type").alias("type_of_vehicle"), F.col("p_name").alias("vehicle_words"))

    def listing_titles(self) -> DataFrame:
        """listing_nulls plus a title whose first word is the make, sometimes misspelt."""
        l = self.listing_nulls()
        k = F.col("listing_id")
        seg = self.t.customer.select("c_custkey", "c_mktsegment")
        o = self.t.orders.select("o_orderkey", "o_custkey")
        src = o.join(seg, o.o_custkey == seg.c_custkey).select(
            F.col("o_orderkey").alias("listing_id"), F.lower("c_mktsegment").alias("raw_make"))
        word = (F.when(k % 4 == 1, F.expr("substring(raw_make, 1, length(raw_make) - 1)"))
                .when(k % 4 == 2, F.lit("unknownbrand"))
                .when(k % 4 == 3, F.concat(F.col("raw_make"), F.lit("s")))
                .otherwise(F.col("raw_make")))
        return (l.join(src, "listing_id")
                .withColumn("title", F.concat(word, F.lit(" "), F.col("model"), F.lit(" "),
                                              F.col("manufactured").cast("string")))
                .drop("raw_make"))

    # ------------------------------------------------------------------ predictions
    def scored(self) -> DataFrame:
        l = self.listing()
        k, p = F.col("listing_id"), F.col("price")
        return l.select(
            "*",
            (p * (F.lit(0.95) + _d(_mod_expr(k, 7919, 1000)) / F.lit(10000.0))).alias("pred_a"),
            (p * (F.lit(0.9) + _d(_mod_expr(k, 104729, 2000)) / F.lit(10000.0))).alias("pred_b"),
            F.when(k % 97 == 0, p + F.lit(2000.5))
             .when(k % 89 == 0, p - F.lit(25000.0))
             .otherwise(p + _d(_mod_expr(k, 31, 6000)) - F.lit(3000.0)).alias("pred_c"),
        )

    def class_scores(self) -> DataFrame:
        lb = self.t.labels.select("doc_id", "quality", "toxic")
        d = self.t.documents.select("doc_id", "n_chars", "lang")
        return lb.join(d, "doc_id").select(
            "doc_id", F.col("quality").alias("label"), "toxic",
            (_d(F.col("n_chars") % 97) / F.lit(97.0)).alias("score"), "lang")

    def values(self) -> DataFrame:
        return self.t.events.select("event_id", F.col("event_type").alias("grp"), "value")


# ---------------------------------------------------------------------- SQL text
_LISTING_SQL = """
listing AS (
  SELECT o.o_orderkey AS listing_id,
         o.o_totalprice AS price,
         c.c_mktsegment AS make,
         c.c_mktsegment || '_' || CAST(c.c_nationkey % 5 AS VARCHAR) AS model,
         o.o_orderpriority AS type_of_vehicle,
         o.o_orderstatus AS transmission,
         CAST(o.o_orderdate AS DATE) AS reg_date,
         CAST(year(o.o_orderdate) - o.o_orderkey % 3 AS INTEGER) AS manufactured,
         CAST(50 + (o.o_orderkey * 37) % 400 AS DOUBLE) AS power,
         CAST(800 + (o.o_orderkey * 91) % 1500 AS DOUBLE) AS curb_weight,
         CAST(900 + (o.o_orderkey * 53) % 3000 AS DOUBLE) AS engine_cap,
         CAST(1 + (o.o_orderkey * 13) % 6 AS DOUBLE) AS no_of_owners,
         o.o_totalprice / CAST(10.0 AS DOUBLE) + CAST((o.o_orderkey * 71) % 5000 AS DOUBLE) AS depreciation,
         CAST(20000 + (o.o_orderkey * 29) % 80000 AS BIGINT) AS coe,
         CAST(500 + (o.o_orderkey * 17) % 3000 AS DOUBLE) AS road_tax,
         o.o_totalprice * CAST(0.4 AS DOUBLE) + CAST((o.o_orderkey * 43) % 20000 AS DOUBLE) AS dereg_value,
         o.o_totalprice * CAST(0.3 AS DOUBLE) + CAST((o.o_orderkey * 61) % 30000 AS DOUBLE) AS omv,
         CAST((o.o_orderkey * 67) % 200000 AS DOUBLE) AS arf
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

_LISTING_NULLS_SQL = """
listing_nulls AS (
  SELECT listing_id, price,
    CASE WHEN listing_id % 19 = 0 THEN NULL ELSE make END AS make,
    model, type_of_vehicle, transmission, reg_date,
    CASE WHEN listing_id % 23 = 0 THEN NULL ELSE manufactured END AS manufactured,
    CASE WHEN listing_id % 10 = 0 THEN NULL ELSE power END AS power,
    CASE WHEN listing_id % 13 = 0 THEN NULL ELSE curb_weight END AS curb_weight,
    CASE WHEN listing_id % 17 = 0 THEN NULL ELSE engine_cap END AS engine_cap,
    CASE WHEN listing_id % 29 = 0 THEN NULL ELSE no_of_owners END AS no_of_owners,
    CASE WHEN listing_id % 11 = 0 THEN NULL ELSE depreciation END AS depreciation,
    coe,
    CASE WHEN listing_id % 7 = 0 THEN NULL ELSE road_tax END AS road_tax,
    CASE WHEN listing_id % 41 = 0 THEN NULL ELSE dereg_value END AS dereg_value,
    CASE WHEN listing_id % 31 = 0 THEN NULL ELSE omv END AS omv,
    CASE WHEN listing_id % 37 = 0 THEN NULL ELSE arf END AS arf
  FROM listing
)"""

_SPLIT = "((listing_id % 2147483647 * 48271 + 42) % 2147483647) % 5"

_LISTING_TRAIN_SQL = f"""
listing_train AS (
  SELECT * FROM listing WHERE {_SPLIT} <> 0 AND (make IS NULL OR make <> 'MACHINERY')
)"""
_LISTING_NEW_SQL = f"""
listing_new AS (SELECT * FROM listing WHERE {_SPLIT} = 0)"""
_NULLS_TRAIN_SQL = f"""
nulls_train AS (
  SELECT * FROM listing_nulls WHERE {_SPLIT} <> 0 AND (make IS NULL OR make <> 'MACHINERY')
)"""
_NULLS_NEW_SQL = f"""
nulls_new AS (SELECT * FROM listing_nulls WHERE {_SPLIT} = 0)"""

_TITLES_SQL = """
titles AS (
  SELECT p_partkey AS listing_id,
    p_name || ' ' || p_brand || ' 1.6L ' || CASE WHEN p_size % 2 = 0 THEN 'Auto' ELSE 'Manual' END ||
    CASE WHEN p_size % 3 = 0 THEN '' ELSE ' (COE till ' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0')
         || '/' || CAST(2020 + p_partkey % 10 AS VARCHAR) || ')' END ||
    ' ' || CAST(2000 + p_partkey % 25 AS VARCHAR) || ' ' || CAST(p_size * 1000 AS VARCHAR) || ' km' AS title,
    CASE WHEN p_size % 7 = 0 THEN '-' ELSE concat_ws(', ',
        CASE WHEN p_size % 2 = 0 THEN 'parf car' END,
        CASE WHEN p_size % 3 = 0 THEN 'premium ad car' END,
        CASE WHEN p_size % 5 = 0 THEN 'low mileage car' END,
        CASE WHEN p_size % 4 = 1 THEN 'direct owner sale' END,
        CASE WHEN p_partkey % 11 = 0 THEN 'rare & exotic' END) END AS category,
    p_type AS type_of_vehicle,
    p_name AS vehicle_words
  FROM part
)"""

_LISTING_TITLES_SQL = """
listing_titles AS (
  SELECT ln.*,
    CASE WHEN ln.listing_id % 4 = 1 THEN substring(lower(c.c_mktsegment), 1, length(c.c_mktsegment) - 1)
         WHEN ln.listing_id % 4 = 2 THEN 'unknownbrand'
         WHEN ln.listing_id % 4 = 3 THEN lower(c.c_mktsegment) || 's'
         ELSE lower(c.c_mktsegment) END
    || ' ' || ln.model || ' ' || CAST(ln.manufactured AS VARCHAR) AS title
  FROM listing_nulls ln JOIN orders o ON ln.listing_id = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
)"""

_SCORED_SQL = """
scored AS (
  SELECT l.*,
    l.price * (CAST(0.95 AS DOUBLE) + CAST((l.listing_id * 7919) % 1000 AS DOUBLE) / CAST(10000.0 AS DOUBLE)) AS pred_a,
    l.price * (CAST(0.9 AS DOUBLE) + CAST((l.listing_id * 104729) % 2000 AS DOUBLE) / CAST(10000.0 AS DOUBLE)) AS pred_b,
    CASE WHEN l.listing_id % 97 = 0 THEN l.price + CAST(2000.5 AS DOUBLE)
         WHEN l.listing_id % 89 = 0 THEN l.price - CAST(25000.0 AS DOUBLE)
         ELSE l.price + CAST((l.listing_id * 31) % 6000 AS DOUBLE) - CAST(3000.0 AS DOUBLE) END AS pred_c
  FROM listing l
)"""

_CLASS_SCORES_SQL = """
class_scores AS (
  SELECT lb.doc_id, lb.quality AS label, lb.toxic,
         CAST(d.n_chars % 97 AS DOUBLE) / CAST(97.0 AS DOUBLE) AS score, d.lang
  FROM labels lb JOIN documents d ON lb.doc_id = d.doc_id
)"""

_VALUES_SQL = """
vals AS (SELECT event_id, event_type AS grp, value FROM events)"""

# name -> (sql, dependencies)
VIEW_SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "listing": (_LISTING_SQL, ()),
    "listing_nulls": (_LISTING_NULLS_SQL, ("listing",)),
    "listing_train": (_LISTING_TRAIN_SQL, ("listing",)),
    "listing_new": (_LISTING_NEW_SQL, ("listing",)),
    "nulls_train": (_NULLS_TRAIN_SQL, ("listing_nulls",)),
    "nulls_new": (_NULLS_NEW_SQL, ("listing_nulls",)),
    "titles": (_TITLES_SQL, ()),
    "listing_titles": (_LISTING_TITLES_SQL, ("listing_nulls",)),
    "scored": (_SCORED_SQL, ("listing",)),
    "class_scores": (_CLASS_SCORES_SQL, ()),
    "vals": (_VALUES_SQL, ()),
}


def with_views(body: str, *views: str) -> str:
    """Prefix ``body`` with the CTEs for ``views`` and their dependencies."""
    order: list[str] = []

    def visit(v: str) -> None:
        if v in order:
            return
        for dep in VIEW_SQL[v][1]:
            visit(dep)
        order.append(v)

    for v in views:
        visit(v)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",".join(VIEW_SQL[v][0] for v in order) + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ",".join(VIEW_SQL[v][0] for v in order) + ",\n" + body[5:]
    return "WITH " + ",".join(VIEW_SQL[v][0] for v in order) + "\n" + body
