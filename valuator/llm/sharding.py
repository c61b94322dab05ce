"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows each input partition sends to each bucket is drawn before any
row moves, from the distribution that a uniform random permutation of all rows
would give: the row counts of the matrix are the partitions' sizes, the column
counts the buckets' sizes. It is drawn along a binary tree over the
partitions, where each node splits its bucket counts between its two halves by
a multivariate hypergeometric draw seeded with the node's place. A task walks
from the root to its own partition, so no one holds the matrix, and the
numbers do not depend on which task asks or how often.

Then a partition's rows get a random permutation among themselves, the first
ones go to bucket 0, the next to bucket 1 and so on; rows move; and each
bucket is permuted again by a keyed hash of where its rows came from. Buckets
are slices of shards, so a shard of any size is spread over many tasks, and
since every bucket's size is known in advance, slots have no gaps.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A bucket, which one task sorts in the second permutation, has about so many rows; more where there would be over MAX_BUCKETS.
BUCKET_ROWS, MAX_BUCKETS = 4_000, 200_000


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes at most one apart, the larger ones first."""
    return np.array([rows // shards + (i < rows % shards) for i in range(shards)], dtype=np.int64)


def bucket_sizes(rows: int, shards: int, bucket_rows: int = BUCKET_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size, shard, and place in the shard where it begins, of each bucket."""
    bucket_rows = max(bucket_rows, rows // MAX_BUCKETS)
    size, shard, start = [], [], []
    for s, n in enumerate(shard_sizes(rows, shards)):
        parts = shard_sizes(int(n), max(1, -(-int(n) // bucket_rows)))
        size += parts.tolist()
        shard += [s] * len(parts)
        start += (np.cumsum(parts) - parts).tolist()
    return np.array(size, np.int64), np.array(shard, np.int64), np.array(start, np.int64)


def _split(rng: np.random.Generator, sizes: np.ndarray, draws: int) -> np.ndarray:
    """How many of ``draws`` rows, drawn without replacement, fall to each bucket; exact, one bucket after the other."""
    out = np.zeros_like(sizes)
    left = int(sizes.sum())
    for i in np.flatnonzero(sizes):
        n = int(sizes[i])
        left -= n
        if draws == 0:
            break
        out[i] = draws if left == 0 else _hypergeometric(rng, n, left, draws)
        draws -= int(out[i])
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    # numpy takes populations below 10^9: larger ones are split into parts that are drawn from in turn
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    half = (good + bad) // 2
    # half of the population, in random order, is drawn from first: how many good ones it has, and how many draws
    good_first = _large(rng, good, bad, half)
    draws_first = _large(rng, half, good + bad - half, draws)
    return (_hypergeometric(rng, good_first, half - good_first, draws_first)
            + _hypergeometric(rng, good - good_first, good + bad - half - (good - good_first), draws - draws_first))


def _large(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Near-hypergeometric draw (its normal limit) for populations of 10^9 and more; margins stay exact."""
    total = good + bad
    mean = draws * good / total
    sd = (mean * (bad / total) * ((total - draws) / max(1, total - 1))) ** 0.5
    return int(min(max(round(rng.normal(mean, sd)), max(0, draws - bad)), min(good, draws)))


def matrix_row(counts: np.ndarray, sizes: np.ndarray, part: int, seed: int) -> np.ndarray:
    """Rows that partition ``part`` sends to each bucket, for partitions of ``counts`` rows."""
    low, high, own = 0, len(counts), np.array(sizes, dtype=np.int64)
    while high - low > 1:
        mid = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        first = _split(rng, own, int(counts[low:mid].sum()))
        if part < mid:
            own, high = first, mid
        else:
            own, low = own - first, mid
    return own


def assignment(counts: np.ndarray, sizes: np.ndarray, part: int, seed: int) -> np.ndarray:
    """Bucket of each row of a partition, by place: the matrix row dealt out to a random permutation of the rows."""
    row = matrix_row(counts, sizes, part, seed)
    order = np.random.default_rng([seed, part, 1 << 32]).permutation(int(counts[part]))
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.repeat(np.arange(len(sizes)), row)
    return out


def shard_uniformly(rows: DataFrame, shards: int = 8, seed: int = 17, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with shard (0 to shards - 1) and slot (from 0, without gaps), which replace columns of these names.

    A uniform random shuffle: shard sizes are at most one row apart, and every
    assignment of rows to slots is as likely as any other. Rows count as they
    are, repeated and null ones too. An empty table stays empty. The draw is
    fixed by the seed and by how the table lies in partitions.

    ``rows`` must give the same rows in the same partitions each time it is
    read, as a scan of files or a checkpoint does; a partition that turns out
    to have another size than counted is an error, never a lost row.
    """
    at = rows.withColumn("__at", F.monotonically_increasing_id())
    sizes_by_part = (at.select(F.shiftright("__at", 33).alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"))).collect()
    parts = 1 + max((r["p"] for r in sizes_by_part), default=0)
    counts = np.zeros(parts, dtype=np.int64)
    for r in sizes_by_part:
        counts[r["p"]] = r["n"]
    total = int(counts.sum())
    size, shard, start = bucket_sizes(total, shards, bucket_rows)

    last: dict[int, np.ndarray] = {}  # a task has one partition

    def buckets_of(part: int) -> np.ndarray:
        if part not in last:
            last.clear()
            last[part] = assignment(counts, size, part, seed)
        return last[part]

    @F.pandas_udf("long")
    def bucket(place: pd.Series) -> pd.Series:
        a = place.to_numpy(np.int64)
        out = np.empty(len(a), dtype=np.int64)
        for p in np.unique(a >> 33):
            mine = (a >> 33) == p
            rows_of = buckets_of(int(p))
            nth = a[mine] & ((1 << 33) - 1)
            if len(nth) and nth.max() >= len(rows_of):
                raise RuntimeError("a partition changed while its rows were dealt out")
            out[mine] = rows_of[nth]
        return pd.Series(out)

    dealt = at.withColumn("__bucket", bucket("__at"))
    again = Window.partitionBy("__bucket").orderBy(F.xxhash64(F.lit(seed), "__at"), "__at")
    names = [F.col(f"`{c}`") for c in rows.columns if c not in ("shard", "slot")]
    placed = dealt.withColumn("__nth", F.row_number().over(again) - 1)

    @F.pandas_udf("shard int, slot long")
    def place(b: pd.Series, nth: pd.Series) -> pd.DataFrame:
        i = b.to_numpy(np.int64)
        return pd.DataFrame({"shard": shard[i].astype(np.int32), "slot": start[i] + nth.to_numpy(np.int64)})

    return (placed.withColumn("__place", place("__bucket", "__nth"))
            .select(*names, F.col("__place.shard").alias("shard"), F.col("__place.slot").alias("slot")))
