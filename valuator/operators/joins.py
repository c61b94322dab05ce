"""Row-combining operators (J1–J8), keyed — never positional."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuator.plans.strategy import attach_state


def lookup_join(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Dictionary map by key, missing -> null (size-checked broadcast)."""
    return attach_state(df, lookup, key, "left")


def merge_inner(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner equi-join; Catalyst/AQE pick the strategy."""
    return a.join(b, on, "inner")


#: Column that spreads the rows of one key over several buckets.
SPREAD = "_spread"


def colocate(big: DataFrame, lookup: DataFrame, on: Sequence[str], row_key: str, buckets: int, spread: int = 1) -> tuple[str, str]:
    """J1/J2 on large lookups that are joined again and again: both sides written once as co-bucketed tables; returns their names.

    With ``spread`` over 1 the rows of a key go to as many buckets, by a hash of
    ``row_key``, and the lookup has a copy for each, so that a key with a third
    of the rows (null included) is not one task."""
    from valuator.sources.io import write_bucketed
    keys = [*on, SPREAD]
    rows = big.withColumn(SPREAD, F.pmod(F.xxhash64(F.col(row_key).cast("string")), F.lit(spread)).cast("int"))
    copies = lookup.withColumn(SPREAD, F.explode(F.array(*[F.lit(i) for i in range(spread)])))
    return write_bucketed(rows, keys, buckets, "rows"), write_bucketed(copies, keys, buckets, "lookup")


def colocated_join(spark: SparkSession, rows: str, lookup: str, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join of two tables of ``colocate``: no exchange on either side. Null keys match nothing, as in any join."""
    return spark.table(rows).join(spark.table(lookup), [*on, SPREAD], how).drop(SPREAD)


def prefer_first(first: DataFrame, second: DataFrame, keys: DataFrame, key: str, value: str) -> DataFrame:
    """Combine two partial results, first non-null wins, re-expressed on the full key set."""
    a = first.select(key, F.col(value).alias("_a"))
    b = second.select(key, F.col(value).alias("_b"))
    both = a.join(b, key, "full_outer").select(key, F.coalesce("_a", "_b").alias(value))
    return keys.select(key).join(both, key, "left")


def unrouted_rows(keys: DataFrame, covered: Sequence[DataFrame], key: str) -> DataFrame:
    """Keys not covered by any of the results (left anti joins)."""
    out = keys.select(key)
    for c in covered:
        out = out.join(c.select(key), key, "left_anti")
    return out


def stack_rows(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Append frames by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def bind_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Add the columns of ``right`` to ``left`` by key (there is no row position)."""
    dup = [c for c in right.columns if c in left.columns and c != key]
    return left.join(right.drop(*dup), key, "left")


def group_broadcast(df: DataFrame, group: str | Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Group aggregates returned to every row.

    Aggregate with map-side combine, then join back (size-checked broadcast),
    rather than ``Window.partitionBy(group)`` which would put a hot group's
    rows into a single task.
    """
    group = [group] if isinstance(group, str) else list(group)
    st = df.groupBy(*group).agg(*[v.alias(k) for k, v in aggs.items()])
    return attach_state(df, st, group, "left")


def nearest_center_join(df: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]],
                        out: str = "cluster") -> DataFrame:
    """Argmin over k centres as one expression (centres are literals)."""
    from valuator.operators.cluster import nearest_center
    return df.withColumn(out, nearest_center(features, centers))
