"""Hard-negative mining by maximum inner product over cover trees.

Candidates are dealt into blocks of about ``BLOCK`` rows, and each block has a
cover tree. Vectors are augmented by a coordinate that gives all rows of the
block the length of its longest one, while an anchor gets a zero there: inner
products stay as they are, and the distance from a node's centre to the
farthest row below it bounds them all, by the angle that this covering radius
spans. The covering radius halves from level to level, centres of a level are
farther apart than it, and rows no centre of a level covers but itself hang as leaves.

An anchor descends best first: the node whose bound is highest is opened next,
nodes whose bounds lie outside the window of wanted scores, or under the scores
already found, are skipped, and what is left at the leaves is verified with
exact integer products. Trees go to one task each and anchors stream through
it in batches, first for the positives, then for the windows that they define; a
rank over the few best of each block gives the result. No pair of rows leaves
a task but those few.

Defined cases: rows with a null id, label or vector, or with a null or
non-finite component, take no part, nor do rows whose squared length after
scaling is 2^62 or more, whose products may not fit a long. A vector that is shorter than others is
taken with zeros. Equal scores go by the smaller id; rows that repeat an id are rows of
their own, and an anchor's repetition is another row than the anchor. An empty
table, or one without anchors, gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuator.session import cut_lineage

#: Rows of a block about, rows below which a node is not parted.
BLOCK, LEAF = 4096, 48
LONGEST = float(1 << 62)


class CoverTree:
    """Cover tree of integer vectors; rows below a node are contiguous in ``order``."""

    def __init__(self, points: np.ndarray) -> None:
        n = len(points)
        real = points.astype(np.float64)
        square = (real * real).sum(1)
        self.longest = float(np.sqrt(square.max())) if n else 0.0
        lifted = np.concatenate([real, np.sqrt(np.maximum(square.max() - square, 0.0))[:, None]], 1) if n else real
        self.order = np.arange(n)
        center, radius, start, stop, first, last = [], [], [], [], [], []

        def node(rows: np.ndarray, at: int, c: int) -> float:
            self.order[at:at + len(rows)] = rows
            center.append(c)
            radius.append(float(np.sqrt(((lifted[rows] - lifted[c]) ** 2).sum(1).max())))
            start.append(at)
            stop.append(at + len(rows))
            first.append(0)
            last.append(0)
            return radius[-1]

        todo = []
        if n:
            todo = [(0, node(np.arange(n), 0, 0) / 2)]
        while todo:
            i, cover = todo.pop()
            if stop[i] - start[i] <= LEAF or radius[i] == 0.0:
                continue
            # a level at which everything stays together, or nothing does, is passed over
            cover = min(cover, radius[i] / 2)
            rows = self.order[start[i]:stop[i]].copy()
            parts = _cover(lifted, rows, center[i], cover)
            if len(parts) == 1:  # distances that rounding hides: a leaf
                continue
            first[i] = len(center)
            at = start[i]
            for c, own in parts:
                j = len(center)
                node(own, at, c)
                at += len(own)
                todo.append((j, cover / 2))
            last[i] = len(center)
        self.center, self.radius = np.array(center, dtype=np.int64), np.array(radius)
        self.start, self.stop = np.array(start, dtype=np.int64), np.array(stop, dtype=np.int64)
        self.first, self.last = np.array(first, dtype=np.int64), np.array(last, dtype=np.int64)
        # the rows in tree order, and the angle that the covering radius spans, rounded up
        self.points = points[self.order]
        half = np.minimum(self.radius * (1 + 1e-9) / (2 * self.longest), 1.0) if self.longest else np.zeros(len(center))
        self.angle = 2 * np.arcsin(half) + 1e-7
        place = np.empty(n, dtype=np.int64)
        place[self.order] = np.arange(n)
        self.place = place[self.center] if n else self.center
        self.kind = np.float64 if self.longest < 2.0 ** 26 else np.int64

    def products(self, where: np.ndarray | slice, anchor: np.ndarray) -> np.ndarray:
        """Exact integer products of the anchor with rows in tree order."""
        kind = np.float64 if self.kind is np.float64 and float(np.dot(anchor.astype(np.float64), anchor.astype(np.float64))) < 2.0 ** 52 else np.int64
        return (self.exact(kind)[where] @ anchor.astype(kind)).astype(np.int64)

    def exact(self, kind) -> np.ndarray:
        """The rows as doubles where all sums of products are whole numbers below 2^53, else as longs."""
        if not hasattr(self, "_exact"):
            self._exact = {}
        if kind not in self._exact:
            self._exact[kind] = self.points.astype(kind)
        return self._exact[kind]

    def bounds(self, nodes: np.ndarray, anchor: np.ndarray, length: float, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest product with any row below each of the nodes, whose centres have ``scores``."""
        most = length * self.longest
        if most == 0.0:
            return np.zeros(len(nodes)), np.zeros(len(nodes))
        angle = np.arccos(np.clip(scores / most, -1.0, 1.0))
        slack = 1e-6 * most + 1e-6
        return (most * np.cos(np.minimum(angle + self.angle[nodes], np.pi)) - slack,
                most * np.cos(np.maximum(angle - self.angle[nodes], 0.0)) + slack)

    def search(self, anchor: np.ndarray, want: np.ndarray, ids: np.ndarray, k: int, windows: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
        """For each window (lo, hi) the ``k`` highest (score, id, place) of rows with ``want``, by score, then smaller id.

        ``want`` and ``ids`` are in tree order.
        """
        found: list[list[tuple[int, int, int]]] = [[] for _ in windows]
        if not len(self.center) or not windows:
            return found
        length = float(np.sqrt(np.dot(anchor.astype(np.float64), anchor.astype(np.float64))))
        floor = [lo for lo, _ in windows]  # what a score must reach to matter
        top = max(hi for _, hi in windows)

        def verify(where: np.ndarray) -> None:
            where = where[want[where]]
            if not len(where):
                return
            scores = self.products(where, anchor)
            for j, (_, hi) in enumerate(windows):
                fit = np.flatnonzero((scores >= floor[j]) & (scores <= hi))
                if not len(fit):
                    continue
                if len(fit) > k:
                    least = np.partition(scores[fit], len(fit) - k)[len(fit) - k]
                    fit = fit[scores[fit] >= least]
                    # of a score that many rows have, the smallest ids
                    fit = fit[np.lexsort((ids[where[fit]], -scores[fit]))[:k]]
                found[j] = heapq.nsmallest(k, found[j] + [(int(scores[x]), int(ids[where[x]]), int(where[x])) for x in fit],
                                           key=lambda x: (-x[0], x[1]))
                if len(found[j]) == k:
                    floor[j] = max(floor[j], found[j][-1][0])

        def wanted(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            keep = np.zeros(len(lower), dtype=bool)
            for j, (_, hi) in enumerate(windows):
                keep |= (upper >= floor[j]) & (lower <= hi)
            return keep

        root = np.array([0])
        lower, upper = self.bounds(root, anchor, length, self.products(self.place[root], anchor))
        heap = [(-float(min(upper[0], top)), 0, float(lower[0]), float(upper[0]))]
        while heap:
            _, i, lo, up = heapq.heappop(heap)
            if not wanted(np.array([lo]), np.array([up]))[0]:
                continue
            if self.first[i] == self.last[i]:
                verify(np.arange(self.start[i], self.stop[i]))
                continue
            nodes = np.arange(self.first[i], self.last[i])
            lower, upper = self.bounds(nodes, anchor, length, self.products(self.place[nodes], anchor))
            keep = wanted(lower, upper)
            nodes, lower, upper = nodes[keep], lower[keep], upper[keep]
            single = self.stop[nodes] - self.start[nodes] == 1
            if single.any():
                # leaves of one row: their bounds are their scores, one call verifies them all
                verify(self.start[nodes[single]])
            for j, a, b in zip(nodes[~single].tolist(), lower[~single].tolist(), upper[~single].tolist(), strict=True):
                heapq.heappush(heap, (-min(b, top), j, a, b))
        return found


def _cover(lifted: np.ndarray, rows: np.ndarray, center: int, cover: float) -> list[tuple[int, np.ndarray]]:
    """(centre, rows) of a level: greedy centres more than ``cover`` apart, the node's own centre first; a row goes to the first that covers it."""
    rows = np.concatenate([[center], rows[rows != center]])
    out, square, chunk = [], cover * cover, 512
    while len(rows):
        heads = rows[:chunk]
        near = _distances(lifted[heads], lifted[rows]) <= square
        free = np.ones(len(rows), dtype=bool)
        for i in range(len(heads)):
            if free[i]:
                own = near[i] & free
                own[i] = True
                free &= ~own
                out.append((int(heads[i]), rows[own]))
        rows = rows[free]
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances; rounding may put a row with another centre, which costs nothing, as radii are measured after."""
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)


def vectors(rows: DataFrame, id_col: str, label: Column, vector: Column, scale: float) -> DataFrame:
    """(row, id, label, v): rows that take part, their components scaled and floored to longs; checkpointed, as row is a number."""
    real = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), vector.cast("array<double>").alias("x"))
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("double"))
    size = F.aggregate(F.transform("x", lambda c: F.pow(F.floor(c * F.lit(float(scale))).cast("double"), F.lit(2.0))), F.lit(0.0), lambda a, b: a + b)
    kept = real.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).filter(whole).filter(size < LONGEST)
    out = kept.select("id", "label", F.transform(scaled, lambda c: c.cast("long")).alias("v")).withColumn("row", F.monotonically_increasing_id())
    return cut_lineage(out)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, v in enumerate(column):
        x = v.values.to_numpy(zero_copy_only=False)
        out[i, :len(x)] = x
    return out


def _pass(candidates: DataFrame, anchors: DataFrame, blocks: int, width: int, k: int, same_label: bool) -> DataFrame:
    """(anchor, place, row, id, score): the ``k`` best of each block in every window of each anchor.

    anchors: (row, label, v, windows). A block's rows come first in its task and make its tree; anchors follow.
    """
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    trees = candidates.select(block.alias("block"), F.lit(0).alias("part"), "row", "id", "label", "v",
                              F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>").alias("windows"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("part"), "row",
                           F.lit(0).cast("long").alias("id"), "label", "v", "windows")
    dealt = trees.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "part", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "place", "row", "id", "score"]
        now, tree, parts, state = None, None, [], None
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            of, part = col["block"].to_numpy(), col["part"].to_numpy()
            cuts = [0, *(np.flatnonzero((of[1:] != of[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if s == e:
                    continue
                if of[s] != now:
                    now, tree, parts, state = of[s], None, [], None
                piece = [col[n].slice(s, e - s) for n in ("row", "id", "label", "v", "windows")]
                if part[s] == 0:
                    parts.append((*(c.to_numpy() for c in piece[:3]), _matrix(piece[3], width)))
                    continue
                if tree is None:
                    row, ids, labels, points = (np.concatenate([p[i] for p in parts]) if parts else np.zeros((0, width) if i == 3 else 0, dtype=np.int64) for i in range(4))
                    tree, parts = CoverTree(points), []
                    state = row[tree.order], ids[tree.order], labels[tree.order]
                row, ids, labels = state
                out: list[list] = [[] for _ in names]
                v = _matrix(piece[3], width)
                windows = piece[4].to_pylist()
                for i, (anchor, label) in enumerate(zip(piece[0].to_pylist(), piece[2].to_pylist(), strict=True)):
                    want = (labels == label) & (row != anchor) if same_label else labels != label
                    best = tree.search(v[i], want, ids, k, [(w["lo"], w["hi"]) for w in windows[i]])
                    for place, hits in enumerate(best):
                        for score, id_, at in hits:
                            for c, x in zip(out, (anchor, place, int(row[at]), id_, score), strict=True):
                                c.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    return dealt.mapInArrow(run, "anchor bigint, place bigint, row bigint, id bigint, score bigint")


def mine(rows: DataFrame, anchors: Column, label: Column | None = None, vector: str = "embedding", id_col: str = "vec_id", scale: float = 256.0,
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on the column ``id``. The positives of an anchor are the
    best ``positives`` other rows of its label; the negatives of an anchor and a positive
    are the best ``negatives`` rows of other labels whose score is from ``low``
    to ``high`` percent of the positive's. Percents are compared in whole numbers.
    """
    known = vectors(rows, id_col, F.col("label") if label is None else label, F.col(vector), scale)
    n, width = known.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK))
    chosen = known.filter(anchors)
    everything = F.array(F.struct(F.lit(-(1 << 62)).cast("long").alias("lo"), F.lit(1 << 62).cast("long").alias("hi")))
    near = _pass(known, chosen.select("row", "label", "v", everything.alias("windows")), blocks, width, positives, True)
    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "row")
    pos = cut_lineage(near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives))

    def bound(percent: int, up: bool) -> Column:
        """Whole-number ends of low * positive <= 100 * negative <= high * positive; no window where the positive's score is negative."""
        exact = F.lit(percent).cast("decimal(38,0)") * F.col("score").cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")
        return (F.ceil(exact) if up else F.floor(exact)).cast("long")

    windows = pos.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct(
        "place", bound(low, True).alias("lo"), bound(high, False).alias("hi")))).alias("w"))
    asked = (chosen.join(windows, chosen["row"] == windows["anchor"])
             .select("row", "label", "v", F.transform("w", lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"))).alias("windows")))
    far = _pass(known, asked, blocks, width, negatives, False)
    rank = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "id", "row")
    neg = (far.select("anchor", (F.col("place") + 1).alias("place"), "score", "id", "row")
           .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= negatives))
    ids = chosen.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    pairs = pos.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (neg.join(pairs.withColumn("place", F.col("place").cast("long")), ["anchor", "place"]).join(ids, "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
