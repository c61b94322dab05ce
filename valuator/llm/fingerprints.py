"""Document fingerprints by weighted SimHash, and search within a Hamming radius by permuted block tables.

A text's terms are its word shingles, lower-cased, weighing 1 + ln(times it
has them). Each of 128 bits takes the sign of the weighted vote of the terms'
hashes. Search cuts fingerprints into blocks, more than the radius; two
fingerprints within the radius agree in all blocks but as many as the radius,
so one table for each choice of the other blocks finds every pair by equality.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuator.llm.common import shuffle_partitions

BITS = 128
_SIGNS = 2.0 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) - 1
#: Cuts of the id range that are fitted to the data.
CUT_ACCURACY = 10_000


def fingerprint(text: str | None, shingle: int = 3) -> bytes:
    """16 bytes; a text without words has all bits 0, one with fewer words than a shingle is one term."""
    words = (text or "").lower().split()
    if not words:
        return bytes(BITS // 8)
    terms = Counter(zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else Counter([tuple(words)])
    h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(" ".join(t)) for t in terms), dtype=np.uint8).reshape(-1, BITS // 8)
    weight = 1 + np.log(np.fromiter(terms.values(), dtype=np.float64, count=len(terms)))
    votes = np.concatenate([np.bincount(h[:, i], weight, 256) @ _SIGNS for i in range(BITS // 8)])
    return np.packbits(votes > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal bits."""
    return 1 - (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count() / BITS


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint as 32 hex digits; a null text counts as empty."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle).hex() for t in texts], dtype=object)

    return docs.withColumn(out, of(F.coalesce(F.col(text), F.lit(""))))


def _block(fp: Column, i: int, blocks: int) -> Column:
    digits = BITS // 4
    first = i * digits // blocks
    return F.substring(fp, first + 1, (i + 1) * digits // blocks - first)


def _distance(a: Column, b: Column) -> Column:
    half = lambda x, i: F.conv(F.substring(x, 1 + 16 * i, 16), 16, -10).cast("long")
    return sum((F.bit_count(half(a, i).bitwiseXOR(half(b, i))) for i in range(BITS // 64)), F.lit(0))


def within_radius(queries: DataFrame, rows: DataFrame, radius: int = 3, blocks: int | None = None, col: str = "fingerprint") -> DataFrame:
    """(query, fingerprint, bits): every different fingerprint of ``rows`` at most ``radius`` bits from one of ``queries``.

    Equal fingerprints are one row on either side. A pair is given by the
    first table that has it, within the join, so pairs are neither repeated
    nor shuffled. Nulls are left out.
    """
    n = blocks or radius + 1
    if n <= radius or n > BITS // 4:
        raise ValueError("blocks must be more than the radius and at most a block for each hex digit")
    choices = list(combinations(range(n), n - radius))

    def tables(frame: DataFrame, name: str) -> DataFrame:
        fp = F.col(col)
        keys = [F.struct(F.lit(t).alias("t"), F.concat(*[_block(fp, i, n) for i in c]).alias("key")) for t, c in enumerate(choices)]
        return (frame.select(col).filter(fp.isNotNull()).distinct().withColumn("k", F.explode(F.array(*keys)))
                .select(fp.alias(name), F.col("k.t").alias(f"{name}_t"), F.col("k.key").alias(f"{name}_key")))

    q, r = tables(queries, "query"), tables(rows, "found")
    a, b = F.col("query"), F.col("found")
    first = F.coalesce(*[F.when(_all([_block(a, i, n) == _block(b, i, n) for i in c]), F.lit(t)) for t, c in enumerate(choices)])
    met = q.join(r, (F.col("query_t") == F.col("found_t")) & (F.col("query_key") == F.col("found_key"))
                 & (_distance(a, b) <= radius) & (first == F.col("query_t")))
    return met.select("query", F.col("found").alias(col), _distance(a, b).alias("bits"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many, or all, of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    A text's edited form takes its second half from the next document, in
    descending order of id and then of the text's hash; null ids come last,
    and after the last row comes the first. A null text counts as empty. A
    table of one row is followed by itself; an empty table stays empty. Ids
    are whole numbers; other columns are not read.

    Plan: one exchange of the texts, by ranges of id whose cuts come from an
    approximate quantile pass over the ids. A range's first document is also
    sent to the range before it, so that each task streams its sorted rows and
    holds two texts at a time.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    cuts = ids.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)] or [0.5], CUT_ACCURACY)).first()[0] or []
    edges = np.unique(np.array(cuts, dtype=np.int64))
    count = len(edges) + 2  # the last part has the null ids

    @F.pandas_udf("int")
    def part_of(i: pd.Series) -> pd.Series:
        known = i.notna().to_numpy()
        up = np.searchsorted(edges, i.fillna(0).to_numpy(np.int64), side="right")
        return pd.Series(np.where(known, len(edges) - up, count - 1).astype(np.int32))

    heads = {r["part"]: r["first"] for r in ids.withColumn("part", part_of("id")).groupBy("part").agg(F.max("id").alias("first")).collect()}
    full = sorted(heads)
    # the rows with the first id of a part also go to the part before, the very first ones to the last
    sent = [(heads[p], full[i - 1]) for i, p in enumerate(full)]
    at = spark.createDataFrame([(f, t) for f, t in sent if f is not None], "head long, part_before int")
    known = rows.withColumn("part", part_of("id")).withColumn("guest", F.lit(False))
    guests = (rows.join(F.broadcast(at), F.col("id") == F.col("head"))
              .select("id", "text", F.col("part_before").alias("part"), F.lit(True).alias("guest")))
    if None in heads.values():
        nulls = rows.filter("id IS NULL").withColumn("part", F.lit(next(t for f, t in sent if f is None)).cast("int")).withColumn("guest", F.lit(True))
        guests = guests.unionByName(nulls)
    order = [F.col("part"), F.col("guest"), F.col("id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    sorted_rows = (known.unionByName(guests).repartitionById(max(1, count), F.col("part")).sortWithinPartitions(*order)
                   .select("id", "text", "guest"))
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, str, bytes] | None = None
        types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        ended = False
        for b in batches:
            out: list[tuple] = []
            for i, body, guest in zip(b["id"], b["text"], b["guest"]):
                if ended:
                    break
                body = body.as_py()
                own = fingerprint(body, shingle)
                if last is not None:
                    was, before, fp = last
                    new = edited(before, body)
                    changed = fingerprint(new, shingle)
                    out.append((was, len(before), hashlib.sha256(new.encode()).hexdigest(), fp.hex(), changed.hex(),
                                likeness(fp, changed), likeness(fp, own)))
                ended = guest.as_py()  # one guest ends the part
                last = (i.as_py(), body, own)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types)], names=names)
        if last is not None and not ended:
            raise RuntimeError("a part without the document that follows it")

    return sorted_rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
