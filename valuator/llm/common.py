"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuator.session import cut_lineage


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, component) of an undirected edge list; the component is its smallest node.

    Alternates large-star and small-star steps until the edge set stands
    still, O(log n) rounds. A step is one map-side combined minimum per node
    and one join of the edges with it, whose large keys adaptive execution may
    split, so the centre of a large star needs no task that holds the star.
    Each round is a reliable checkpoint. Nodes without an edge are not
    returned; self loops and null ends are dropped.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    e = cut_lineage(e)

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                                F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter(F.col("u") != F.col("v")).distinct())
        e = cut_lineage(small)
        after = state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return (e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


#: A key with more than this share of all rows is joined by broadcast; there are at most as many such keys as fit in 1.
HOT_SHARE = 1 / 1000


def join_counted(rows: DataFrame, state: DataFrame, on: list[str], n: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with one ``state`` row per key, where ``n`` counts the rows of the key.

    Keys that hold more than ``HOT_SHARE`` of ``total`` rows, at most 1,000 by
    counting, are broadcast, so that their rows stay where they are; all other
    keys are shuffled, and none of them is large. ``n`` is dropped.
    """
    limit = max(1, int(total * HOT_SHARE))
    hot = state.filter(F.col(n) > limit).drop(n)
    cold = state.filter(F.col(n) <= limit).drop(n)
    return (rows.join(F.broadcast(hot), on)
            .unionByName(rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on, how)))
