"""Best-fit packing of token sequences by bin completion.

Texts become pieces of at most ``capacity`` tokens. What a packing needs to
know of a corpus is how many pieces there are of each length: ``capacity``
numbers at most, which is what reaches the driver. On them, bin completion
fills a sequence around the longest open piece: it enumerates the undominated
fillings of the room left, tries them from the smallest waste on (the best-fit
filling is the first, and the first descent the first incumbent), repeats a
filling as often as its pieces last, and prunes where the waste so far leaves
no way below the incumbent; it stops at a lower bound or after ``MAX_NODES``
fillings, with the best packing it has.

The plan it returns has a row per (length, run of equal fillings), again
bounded by the capacity. Pieces are numbered within their length, by partition
and place there, so that a length that many pieces share is spread over all
partitions; number and length then give sequence and offset.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuator.llm import byte_bpe
from valuator.session import cut_lineage

CAPACITY = 2048
END_ID = 0
#: Fillings tried after the first packing, before the search settles for the best one found.
MAX_NODES = 2_000
#: Fillings kept for each open sequence, by smallest waste, and longest pieces a filling of three may begin with.
MAX_FILLINGS, MAX_HEADS = 24, 48


# ------------------------------------------------------------------ plan
def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Least number of sequences by total size and by pieces longer than half (Martello and Toth's second bound)."""
    sizes = np.arange(len(counts))
    total = int((counts * sizes).sum())
    best = -(-total // capacity)
    n, s = np.cumsum(counts), np.cumsum(counts * sizes)
    half = capacity // 2
    for k in range(half + 1):
        over = int(n[-1] - n[capacity - k])
        mid, mid_size = int(n[capacity - k] - n[half]), int(s[capacity - k] - s[half])
        small = int(s[half] - (s[k - 1] if k else 0))
        best = max(best, over + mid + max(0, -(-(small - (mid * capacity - mid_size)) // capacity)))
    return best


def fillings(counts: np.ndarray, room: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room``, longest pieces first, smallest waste first.

    A piece that fills the room dominates everything. Otherwise a filling is
    dominated by one whose pieces can hold its own, one by one; those of up to
    three pieces are compared so, and one that takes the longest piece that
    fits again and again stands for the longer ones.
    """
    sizes = np.flatnonzero(counts[: room + 1])
    if not len(sizes):
        return [()]
    if sizes[-1] == room:
        return [(room,)]
    longest = np.zeros(room + 1, dtype=np.int64)  # available and at most so long
    longest[sizes] = sizes
    longest = np.maximum.accumulate(longest)

    def pairs(within: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """For each longer piece x up to most, the longest partner that fits, not longer than x."""
        x = sizes[(sizes <= min(within, most))][::-1]
        left = np.minimum(within - x, x)
        y = longest[left]
        alone = (y == x) & (counts[x] < 2)
        y[alone] = longest[np.maximum(x[alone] - 1, 0)]
        return x, y

    found: set[tuple[int, ...]] = set()
    x, y = pairs(room, room)
    for a, b in zip(x.tolist(), y.tolist()):
        found.add((a, b) if b else (a,))
    for a in x[:MAX_HEADS].tolist():
        counts[a] -= 1
        b, c = pairs(room - a, a)
        if len(b):
            ok = counts[b] > 0
            b, c = b[ok], c[ok]
            if len(b):
                i = int((b + c).argmax())
                if c[i] and (c[i] != b[i] or counts[b[i]] > 1):
                    found.add((a, int(b[i]), int(c[i])))
        counts[a] += 1
    greedy, left, used = [], room, {}
    while left > 0:
        z = int(longest[min(left, room)])
        while z and counts[z] - used.get(z, 0) <= 0:
            z = int(longest[z - 1])
        if not z:
            break
        greedy.append(z)
        used[z] = used.get(z, 0) + 1
        left -= z
    found.add(tuple(greedy))
    ranked = sorted(found, key=lambda f: (room - sum(f), len(f), [-v for v in f]))
    kept: list[tuple[int, ...]] = []
    for f in ranked:
        if not any(len(g) >= len(f) and all(u >= v for u, v in zip(g, f)) for g in kept):
            kept.append(f)
        if len(kept) == MAX_FILLINGS:
            break
    return kept


def complete_bins(counts: np.ndarray, capacity: int = CAPACITY, max_nodes: int = MAX_NODES) -> list[tuple[int, tuple[int, ...]]]:
    """(times, pieces of a sequence, longest first) for ``counts`` pieces by length (index 0 unused)."""
    counts = np.array(counts, dtype=np.int64)
    target = lower_bound(counts, capacity)
    sizes = np.arange(len(counts))
    rest = int((counts * sizes).sum())
    best: list[tuple[int, tuple[int, ...]]] | None = None
    best_bins, bins, nodes, longest = 0, 0, 0, capacity
    stack: list[list] = []  # [longest piece, fillings, next, times applied]

    def apply(piece: int, filling: tuple[int, ...], times: int) -> None:
        nonlocal rest, bins
        for v in (piece, *filling):
            counts[v] -= times
        rest -= times * (piece + sum(filling))
        bins += times

    while True:
        while longest and not counts[longest]:
            longest -= 1
        done = longest == 0
        if done and (best is None or bins < best_bins):
            nodes = nodes if best else 0
            best, best_bins = [(f[3], (f[0], *f[1][f[2] - 1])) for f in stack], bins
            if best_bins <= target:
                break
        if not done and (best is None or bins + -(-rest // capacity) < best_bins):
            counts[longest] -= 1
            options = fillings(counts, capacity - longest)
            counts[longest] += 1
            stack.append([longest, options, 0, 0])
        # undo and go on where a filling is left
        while stack:
            top = stack[-1]
            if top[2]:
                apply(top[0], top[1][top[2] - 1], -top[3])
                top[3] = 0
            if top[2] < len(top[1]) and (best is None or (nodes < max_nodes and bins + -(-rest // capacity) < best_bins)):
                filling = top[1][top[2]]
                top[2] += 1
                need: dict[int, int] = {}
                for v in (top[0], *filling):
                    need[v] = need.get(v, 0) + 1
                top[3] = int(min(counts[v] // k for v, k in need.items()))
                apply(top[0], filling, top[3])
                nodes += 1
                longest = top[0]
                break
            longest = top[0]
            stack.pop()
        else:
            break
        if best is not None and nodes >= max_nodes:
            break
    return best or []


def slots(plan: list[tuple[int, tuple[int, ...]]], capacity: int) -> dict[str, np.ndarray]:
    """Runs of places in order of (length, first number): length, number, sequence, offset."""
    rows, sequence, taken = [], 0, np.zeros(capacity + 1, dtype=np.int64)
    for times, pieces in plan:
        offset = 0
        for v in pieces:
            rows.append((v, int(taken[v]), sequence, offset))
            taken[v] += times
            offset += v
        sequence += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "number", "sequence", "offset"), cols.T))


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, max_nodes: int = MAX_NODES) -> DataFrame:
    """``pieces`` with sequence_id (from 0) and offset; sequences hold at most ``capacity`` and have no gaps.

    Every row is placed, rows that repeat included. A length that is null,
    below 1 or above the capacity is an error. An empty table stays empty.
    The input is written once (a checkpoint), so that numbering and rows come
    from the same copy whatever executors are lost.
    """
    rows = cut_lineage(pieces.withColumn("__at", F.monotonically_increasing_id()))
    rows = rows.withColumn("__part", F.shiftright("__at", 33).cast("int"))
    runs = rows.groupBy(F.col(length).alias("__size"), "__part").agg(F.count(F.lit(1)).alias("__n"))
    sizes = runs.groupBy("__size").agg(F.sum("__n").alias("n")).limit(capacity + 2).collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in sizes:
        if r["__size"] is None or not 1 <= r["__size"] <= capacity:
            raise ValueError(f"a piece of length {r['__size']}; lengths go from 1 to {capacity}")
        counts[r["__size"]] = r["n"]
    at = slots(complete_bins(counts, capacity, max_nodes), capacity)
    span = 1 << 40
    starts = at["length"] * span + at["number"] if len(at) else np.zeros(0, np.int64)

    @F.pandas_udf("sequence long, offset long")
    def place(size: pd.Series, number: pd.Series) -> pd.DataFrame:
        key = size.to_numpy(np.int64) * span + number.to_numpy(np.int64)
        i = np.searchsorted(starts, key, side="right") - 1
        return pd.DataFrame({"sequence": at["sequence"][i] + key - starts[i], "offset": at["offset"][i]})

    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__size").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = runs.withColumn("__before", before).drop("__n").withColumnsRenamed({"__size": "__s", "__part": "__p"})
    nth = F.row_number().over(Window.partitionBy(length, "__part").orderBy("__at")) - 1
    numbered = rows.withColumn("__nth", nth).join(first, (F.col(length) == F.col("__s")) & (F.col("__part") == F.col("__p")))
    placed = numbered.withColumn("__place", place(F.col(length), F.col("__nth") + F.col("__before")))
    names = [F.col(f"`{c}`") for c in pieces.columns if c not in ("sequence_id", "offset")]
    return placed.select(*names, F.col("__place.sequence").alias("sequence_id"), F.col("__place.offset").alias("offset"))


# ------------------------------------------------------------------ pieces
def cuts(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full but the first."""
    first = n - (n - 1) // capacity * capacity
    yield 0, first
    for start in range(first, n, capacity):
        yield start, capacity


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 with_ids: bool = False) -> DataFrame:
    """Pieces of every text: id, piece (from 0), start, length, ids_crc32, and ids if asked for.

    A text's ids are those of the byte-level BPE file ``tokenizer`` plus a last
    ``END_ID``; a null text counts as empty. Texts longer than the capacity are
    cut, the first piece being the shorter one. ids_crc32 is of the ids as
    little-endian unsigned 32-bit numbers.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe.load(tokenizer)
        for b in batches:
            owner, nth, at, size, crc, ids = [], [], [], [], [], []
            for i, body in enumerate(b["text"]):
                data = np.append(np.frombuffer(bpe.ids(body.as_py() or ""), dtype="u4"), np.uint32(END_ID)).astype("<u4")
                for k, (start, n) in enumerate(cuts(len(data), capacity)):
                    part = data[start: start + n]
                    owner.append(i), nth.append(k), at.append(start), size.append(n), crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            cols = {"id": b["id"].take(pa.array(owner, pa.int64())), "piece": pa.array(nth, pa.int32()), "start": pa.array(at, pa.int64()),
                    "length": pa.array(size, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                cols["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(cols)

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids (at most the capacity) of packed pieces that carry ids."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
