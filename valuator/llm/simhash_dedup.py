"""SimHash near-dedup by anchor-point covering.

Fingerprints are 64 bits over word shingles. Bits 0 to 62 are covered by the
perfect Hamming code of length 63, whose codewords are the anchors: every
63-bit word is within covering radius 1 of exactly one codeword. Two
fingerprints at most ``d`` bits apart have a word half way between them, at
most ceil(d/2) from either, and that word's anchor is within
1 + ceil(d/2) of both. So each fingerprint goes to every anchor within the
covering radius plus half the threshold, from both sides, and all linked pairs
meet at an anchor; there they are compared in all 64 bits.

At an anchor there are at most as many distinct fingerprints as the ball has
words (4,034 for d = 2), whatever the input is: equal fingerprints are one
row, so a group of copies of any size adds nothing to the comparison.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuator.llm.common import connected_components, join_counted
from valuator.session import cut_lineage

#: Words hashed at a time, so that a very long text needs bounded memory.
CHUNK_WORDS = 200_000
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def simhash64(text: str | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of a text; a bit is set if it is set in over half the shingle hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    votes, total = np.zeros(64, dtype=np.int64), 0
    last = max(1, len(words) - shingle + 1)
    for start in range(0, last, CHUNK_WORDS):
        part = words[start:min(start + CHUNK_WORDS, last) + shingle - 1]
        grams = [b" ".join(g) for g in zip(*(part[i:] for i in range(shingle)))] or [b" ".join(part)]
        h = np.array([xxhash.xxh64_intdigest(g, 42) for g in grams], dtype=">u8").view(np.uint8).reshape(-1, 8)
        votes += np.concatenate([np.bincount(h[:, i], minlength=256) @ _BITS for i in range(8)])
        total += len(grams)
    return int.from_bytes(np.packbits(2 * votes > total).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint as a signed long; a null text counts as empty (fingerprint 0)."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash64(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(out, fingerprints(F.coalesce(F.col(text), F.lit(""))))


def flips(radius: int) -> list[tuple[int, int]]:
    """(syndrome, mask): flipping a mask turns a word of that syndrome into a codeword at most ``radius`` away."""
    out = []
    for weight in range(radius + 1):
        for at in combinations(range(1, 64), weight):
            s = 0
            for i in at:
                s ^= i
            out.append((s, sum(1 << (i - 1) for i in at)))
    return out


def syndrome(fp) -> F.Column:
    masks = [sum(1 << (i - 1) for i in range(1, 64) if i >> k & 1) for k in range(6)]
    return sum(((F.bit_count(fp.bitwiseAND(F.lit(m))) % 2) * (1 << k) for k, m in enumerate(masks)), F.lit(0)).cast("int")


def linked_fingerprints(fps: DataFrame, max_bits: int = 2, col: str = "fp") -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at most ``max_bits`` (0 to 4) bits apart; none is missed."""
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0 to 4")
    spark = fps.sparkSession
    # 2,017 rows for a threshold of 2, 41,728 for 4: a table fixed by the threshold
    table = spark.createDataFrame(flips(1 + (max_bits + 1) // 2), "s int, mask long")
    at = (fps.select(F.col(col).alias("a")).filter(F.col("a").isNotNull()).distinct().withColumn("s", syndrome(F.col("a")))
          .join(F.broadcast(table), "s")
          .select("a", F.col("a").bitwiseAND(F.lit((1 << 63) - 1)).bitwiseXOR(F.col("mask")).alias("anchor")))
    other = at.select(F.col("a").alias("b"), "anchor")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return (at.join(other.withColumnRenamed("anchor", "anchor_b"), (F.col("anchor") == F.col("anchor_b"))
                    & (F.col("a") < F.col("b")) & near).select("a", "b").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: id, fp (signed long), component_id.

    Groups: documents whose fingerprints are linked by steps of at most
    ``max_bits`` bits; component_id is the group's smallest id. A null or empty
    text has fingerprint 0 and is linked like any other. Rows that repeat an id
    stay rows of their own; a null id is never a component_id unless the group
    has no other. An empty table gives an empty result. Other columns of
    ``docs`` are not read.
    """
    fps = cut_lineage(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")),
                                       "text", "fp", shingle).select("id", "fp"))
    firsts = fps.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = connected_components(linked_fingerprints(fps, max_bits))
    named = groups.join(firsts, F.col("node") == F.col("fp")).select("fp", "component", "first")
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    linked = named.join(names, "component").select("fp", F.col("component_id").alias("linked_id"))
    labels = (firsts.join(linked, "fp", "left")
              .select("fp", "n", F.when(F.col("linked_id").isNotNull(), F.col("linked_id")).otherwise(F.col("first")).alias("component_id")))
    return join_counted(fps, labels, ["fp"], "n", fps.count()).select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                     max_bits: int = 2) -> DataFrame:
    """Rows of ``docs`` less all but one of each group: the smallest id, of equal ids the smallest text hash, of equal rows one.

    Rows with a null id have no place in the order: they stay only if their
    group has no row with an id.
    """
    key = [F.col(id_col).alias("__id"), F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("__hash")]
    rows = docs.select(*key, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    fps = cut_lineage(with_fingerprint(rows, "__text", "__fp", shingle).drop("__text"))
    groups = connected_components(linked_fingerprints(fps, max_bits, "__fp")).withColumnRenamed("node", "__fp")
    firsts = fps.groupBy("__fp", "__id", "__hash").agg(F.count(F.lit(1)).alias("__n"))
    whole = firsts.join(groups, "__fp", "left").withColumn("__group", F.coalesce("component", "__fp"))
    # a struct has its nulls first, so a null id is marked to sort last
    best = whole.groupBy("__group").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__hash", "__n")).alias("__best"))
    keep = best.select("__best.__id", "__best.__hash", "__best.__n").withColumnsRenamed(
        {"__id": "__k", "__hash": "__h", "__n": "__m"})
    kept = (docs.withColumn("__hash", key[1]).join(keep, F.col(id_col).eqNullSafe(F.col("__k")) & (F.col("__hash") == F.col("__h"))))
    single = kept.filter("__m = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
    repeated = kept.filter("__m > 1").select(*[F.col(f"`{c}`") for c in docs.columns]).dropDuplicates([id_col, text])
    return single.unionByName(repeated)
