"""Registered row-combining queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuator.operators import joins as J
from valuator.plans.common import fx, rnd
from valuator.plans.registry import register

_LOOKUP_SQL = """
WITH ref AS (SELECT model, avg(price) AS model_mean FROM listing_train GROUP BY model)
SELECT n.listing_id, round(ref.model_mean, 4) AS model_mean FROM listing_new n LEFT JOIN ref ON n.model = ref.model
"""


@register("lookup_join", _LOOKUP_SQL, ("listing_train", "listing_new"))
def q_lookup_join(spark, sf_dir):
    f = fx(spark, sf_dir)
    ref = f.listing_train().groupBy("model").agg(F.avg("price").alias("model_mean"))
    out = J.lookup_join(f.listing_new().select("listing_id", "model"), ref, "model")
    return out.select("listing_id", rnd("model_mean", 4).alias("model_mean"))


_COLOCATED_SQL = """
WITH ref AS (SELECT make, model, avg(price) AS ref_price, count(*) AS n FROM listing_train GROUP BY make, model)
SELECT n.listing_id, round(ref.ref_price, 4) AS ref_price, CAST(ref.n AS DOUBLE) AS n FROM listing_new n
LEFT JOIN ref ON n.make = ref.make AND n.model = ref.model
"""


@register("colocated_lookup", _COLOCATED_SQL, ("listing_train", "listing_new"))
def q_colocated_lookup(spark, sf_dir):
    f = fx(spark, sf_dir)
    ref = f.listing_train().groupBy("make", "model").agg(F.avg("price").alias("ref_price"), F.count(F.lit(1)).alias("n"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = J.colocate(f.listing_new().select("listing_id", "make", "model"), ref, ["make", "model"], "listing_id", buckets, spread=4)
    return J.colocated_join(spark, *names, ["make", "model"]).select("listing_id", rnd("ref_price", 4).alias("ref_price"), F.col("n").cast("double").alias("n"))


_MERGE_SQL = """
SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_acctbal
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""


@register("merge_inner", _MERGE_SQL)
def q_merge_inner(spark, sf_dir):
    from valuator.sources.tables import Tables
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("c_custkey"))
    c = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return J.merge_inner(o, c, "c_custkey").drop("c_custkey")


_PARTS = """
first_res AS (SELECT listing_id, pred_a AS prediction FROM scored WHERE abs(price - pred_a) <= 2000),
second_res AS (SELECT listing_id, pred_b AS prediction FROM scored WHERE type_of_vehicle IN ('1-URGENT', '2-HIGH'))"""

_PREFER_SQL = "WITH " + _PARTS.strip() + """
SELECT l.listing_id, coalesce(a.prediction, b.prediction) AS prediction
FROM listing l LEFT JOIN first_res a ON l.listing_id = a.listing_id LEFT JOIN second_res b ON l.listing_id = b.listing_id
"""


def _parts(spark, sf_dir):
    s = fx(spark, sf_dir).scored()
    a = s.filter(F.abs(F.col("price") - F.col("pred_a")) <= 2000).select("listing_id", F.col("pred_a").alias("prediction"))
    b = s.filter(F.col("type_of_vehicle").isin("1-URGENT", "2-HIGH")).select(
        "listing_id", F.col("pred_b").alias("prediction"))
    return s, a, b


@register("prefer_first", _PREFER_SQL, ("scored",))
def q_prefer_first(spark, sf_dir):
    s, a, b = _parts(spark, sf_dir)
    return J.prefer_first(a, b, s, "listing_id", "prediction")


_UNROUTED_SQL = "WITH " + _PARTS.strip() + """
SELECT listing_id FROM listing
WHERE listing_id NOT IN (SELECT listing_id FROM first_res) AND listing_id NOT IN (SELECT listing_id FROM second_res)
"""


@register("unrouted_rows", _UNROUTED_SQL, ("scored",))
def q_unrouted(spark, sf_dir):
    s, a, b = _parts(spark, sf_dir)
    return J.unrouted_rows(s, [a, b], "listing_id")


_STACK_SQL = """
SELECT listing_id, price, make, 'train' AS part, NULL::VARCHAR AS note FROM listing_train
UNION ALL SELECT listing_id, price, make, 'new' AS part, 'unlabelled' AS note FROM listing_new
"""


@register("stack_rows", _STACK_SQL, ("listing_train", "listing_new"))
def q_stack(spark, sf_dir):
    f = fx(spark, sf_dir)
    tr = f.listing_train().select("listing_id", "price", "make", F.lit("train").alias("part"))
    nw = f.listing_new().select("listing_id", "price", "make", F.lit("new").alias("part"),
                                F.lit("unlabelled").alias("note"))
    return J.stack_rows([tr, nw])


_BIND_SQL = """
SELECT a.listing_id, a.power, a.omv, b.make, b.model FROM listing_nulls a LEFT JOIN listing b ON a.listing_id = b.listing_id
"""


@register("bind_columns", _BIND_SQL, ("listing_nulls",))
def q_bind(spark, sf_dir):
    f = fx(spark, sf_dir)
    a = f.listing_nulls().select("listing_id", "power", "omv")
    b = f.listing().select("listing_id", "make", "model", "power")
    return J.bind_columns(a, b, "listing_id")


_GROUP_SQL = """
SELECT l.listing_id, l.type_of_vehicle, round(g.type_mean, 4) AS type_mean, g.type_n
FROM listing l JOIN (SELECT type_of_vehicle, avg(manufactured) AS type_mean, count(*) AS type_n
                     FROM listing GROUP BY type_of_vehicle) g ON l.type_of_vehicle = g.type_of_vehicle
"""


@register("group_broadcast", _GROUP_SQL, ("listing",))
def q_group_broadcast(spark, sf_dir):
    l = fx(spark, sf_dir).listing().select("listing_id", "type_of_vehicle", "manufactured")
    out = J.group_broadcast(l, "type_of_vehicle", {"type_mean": F.avg("manufactured"), "type_n": F.count(F.lit(1))})
    return out.select("listing_id", "type_of_vehicle", rnd("type_mean", 4).alias("type_mean"), "type_n")
