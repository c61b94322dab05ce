"""Plan-shape helpers shared by the operators.

* ``fit_row``: run one aggregate and bring back its single row (fitted state
  such as means, medians or quantile edges; bounded by the number of columns).
* ``attach_state``: join a fitted state table to the data. The state is
  pulled to the driver only after proving it has at most ``max_rows`` rows
  (``limit(max_rows + 1)``) and is broadcast from a local relation if its
  values are small in bytes too; larger state falls back to a shuffle join
  (AQE may still pick broadcast at run time from measured sizes). Nothing
  unbounded reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from valuator.session import cut_lineage

#: State that is pulled to the driver: rows, and bytes of their values about, beyond which it is not broadcast.
MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES = 50_000, 16 << 20


def fit_row(df: DataFrame, *aggs: Column) -> Row:
    rows = df.agg(*aggs).collect()
    return rows[0]


def collect_bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> list[Row] | None:
    """Rows of ``df`` when it has at most ``max_rows`` rows, else None."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def localize(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Materialise a small state frame as a local relation (checked by rows, then by bytes)."""
    rows = collect_bounded(df, max_rows)
    if rows is None:
        return df, False
    local = df.sparkSession.createDataFrame(rows, df.schema)
    return local, sum(len(str(r)) for r in rows) <= MAX_BROADCAST_BYTES


def attach_state(big: DataFrame, state: DataFrame, on: str | Sequence[str] | Column, how: str = "left",
                 max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    known, is_small = localize(state, max_rows)
    return big.join(F.broadcast(known) if is_small else known, on, how)


def attach_groups(big: DataFrame, state: DataFrame, groups: Sequence[str], how: str = "left",
                  max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``attach_state`` on group columns in which a null is a group like any other."""
    groups = list(groups)
    # fields of a struct compare null with null as equal, and the struct itself is never null
    keyed = state.withColumn("_group", F.struct(*groups)).drop(*groups)
    return attach_state(big.withColumn("_group", F.struct(*groups)), keyed, "_group", how, max_rows).drop("_group")


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return int(n)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


#: Rows from which a frame that is fitted on is spread over the cores, and rows of a part at most.
SPREAD_ROWS, PART_ROWS = 50_000, 2_000_000


def spread(df: DataFrame, rows: int, cols: Sequence[str]) -> DataFrame:
    """``df`` in as many parts as there are cores, or a multiple, by a hash of ``cols``: a small file, or one of few row groups,
    is read by few tasks, and each of the hundreds of passes of a fit would have no more. Small frames stay as they are."""
    if rows < SPREAD_ROWS:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * math.ceil(rows / (cores * PART_ROWS)), *cols)


def spread_once(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A large frame that many steps read, spread and written once; a small one as it is."""
    rows = df.count()
    return df if rows < SPREAD_ROWS else cut_lineage(spread(df, rows, cols))


def ranked(df: DataFrame, part_cols: Sequence[str], order_cols: Sequence[Column | str], out: str = "rn",
           num_partitions: int | None = None) -> DataFrame:
    """Exact 1-based ``row_number()`` within ``part_cols`` ordered by ``order_cols``
    without sending a whole group (or the whole table) to one task.

    Plan: range-partition and sort by (group, order) — one shuffle whose
    partitions have bounded size even when one group holds a third of the
    rows — then number rows by their position in the sorted partition
    (``monotonically_increasing_id`` low bits) and add the count of the same
    group's rows in earlier partitions. The offsets come from a
    (partition, group) aggregate, which is small.
    Callers should include a unique key last in ``order_cols`` for determinism.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in (*part_cols, *order_cols)]
    rp = (df.repartitionByRange(_partitions(df, num_partitions), *keys)
          .sortWithinPartitions(*keys)
          .withColumn("_mid", F.monotonically_increasing_id()))
    rp = rp.withColumn("_pid", F.shiftright("_mid", 33))
    # range bounds come from sampling, which depends on the arrival order of
    # rows after a shuffle: freeze the layout with a reliable checkpoint so the
    # offsets and the rows come from the same materialisation (also survives
    # executor loss, unlike a cache).
    rp = cut_lineage(rp)
    stats = rp.groupBy("_pid", *part_cols).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = (Window.partitionBy(*part_cols) if part_cols else Window.partitionBy()).orderBy("_pid")
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                                 F.lit(0)))
    stats = stats.select("_pid", *part_cols, "_first", "_off")
    joined = attach_groups(rp, stats, ["_pid", *part_cols], "inner") if part_cols else attach_state(rp, stats, "_pid", "inner")
    return (joined.withColumn(out, (F.col("_mid") - F.col("_first") + F.col("_off") + 1).cast("long"))
            .drop("_mid", "_pid", "_first", "_off"))


def _cuts_below(v: Column, cuts: Sequence[float]) -> Column:
    """How many of the ascending ``cuts`` are below the value: a binary search in one literal array, however many there are."""
    if not cuts:
        return F.lit(0)
    # decimal text of a double is the double; infinite ends have names of their own
    table = F.expr("array(" + ", ".join(f"double('{c}')" if math.isinf(c) or math.isnan(c) else f"{c!r}D" for c in cuts) + ")")
    steps = [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda n, s: F.when(F.get(table, n + s - 1) < v, n + s).otherwise(n))


def prefix_sums(df: DataFrame, order: str, sum_cols: Sequence[str], descending: bool = False, suffix: str = "_cum",
                num_partitions: int | None = None) -> DataFrame:
    """Running sums over the global order of a numeric column.

    Ranges of the column are a bucket column, a pure function of the value, so
    that one exchange on it serves the running sums inside a bucket; what lies
    before a bucket comes from one small aggregate. Nulls are the last bucket.
    ``df`` is read three times: it should be a checkpoint or a scan."""
    n = _partitions(df, num_partitions)
    probs = [i / n for i in range(1, n)]
    cuts = sorted(set(df.agg(F.percentile_approx(F.col(order).cast("double"), probs, 10_000)).first()[0] or [])) if probs else []
    above = _cuts_below(F.col(order).cast("double"), cuts)
    bucket = F.when(F.col(order).isNull(), F.lit(len(cuts) + 1)).otherwise(F.lit(len(cuts)) - above if descending else above)
    b = df.withColumn("_b", bucket)
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tot = b.groupBy("_b").agg(*[F.sum(c).alias(c) for c in sum_cols])
    tot = tot.select("_b", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    key = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_last()
    inside = Window.partitionBy("_b").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return attach_state(b, tot, "_b", "inner").select(
        *df.columns, *[(F.sum(c).over(inside) + F.col(f"_off_{c}")).alias(c + suffix) for c in sum_cols])


# ---------------------------------------------------------------------- exact quantiles
#: Buckets that an interval is cut into in one pass, and values of an interval that are looked at one by one
#: (on the driver for columns, in a task for groups).
BUCKETS, FEW_VALUES, FEW_OF_GROUP = 1024, 2048, 16384


def _value(c: str | Column) -> Column:
    """The column as a double; NaN is a missing value, here and so in every quantile."""
    v = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(v), v)


def _interpolate(position: float, lo_v: float, hi_v: float) -> float:
    lower, higher = math.floor(position), math.ceil(position)
    if higher == lower or lo_v == hi_v:
        return float(lo_v)
    return (higher - position) * lo_v + (position - lower) * hi_v


def _bucket(v: Column, lo: Column, hi: Column) -> Column:
    """0 to BUCKETS, not falling with v; infinite ends have buckets of their own."""
    # quarters, so that the width of any finite interval is finite
    share = (v * 0.25 - lo * 0.25) / (hi * 0.25 - lo * 0.25)
    return F.floor(F.least(share, F.lit(1.0)) * BUCKETS).cast("double")


def fit_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float] | None]:
    """Exact linear-interpolation quantiles of several columns by histogram
    refinement; None for a column without values.

    One pass counts the values of the open intervals of all columns by bucket
    (map-side combined, so a value that a third of the rows share is one
    number), the buckets that hold a wanted rank become the next intervals,
    from their smallest to their largest value, and intervals of a few values
    are read off. What a pass brings to the driver is bounded by columns,
    probabilities and BUCKETS, whatever the number of rows or of different
    values, and there is no other method for other sizes.
    """
    probs, inf = [float(p) for p in probs], float("inf")
    cols = list(cols)
    vals = df.select(*[_value(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    aggs = []
    for i in range(len(cols)):
        v = F.col(f"_v{i}")
        finite = F.when(F.abs(v) < inf, v)
        aggs += [F.count(v).alias(f"n{i}"), F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}"),
                 F.count(finite).alias(f"f{i}"), F.count(F.when(v == -inf, 1)).alias(f"m{i}")]
    r = fit_row(vals, *aggs)
    positions = {i: [(r[f"n{i}"] - 1) * p for p in probs] for i in range(len(cols)) if r[f"n{i}"]}
    got: dict[tuple[int, int], float] = {}
    open_: list[tuple[int, float, float, int, int, list[int]]] = []  # column, lo, hi, first rank, values, ranks
    for i, pos in positions.items():
        below, mid = r[f"m{i}"], r[f"f{i}"]
        ranks = sorted({math.floor(x) for x in pos} | {math.ceil(x) for x in pos})
        for k in ranks:
            if k < below:
                got[i, k] = -inf
            elif k >= below + mid:
                got[i, k] = inf
        inner = [k for k in ranks if below <= k < below + mid]
        if inner:
            open_.append((i, r[f"lo{i}"], r[f"hi{i}"], below, mid, inner))
    while True:
        for i, lo, hi, _, _, ranks in open_:
            if lo == hi:
                got.update({(i, k): lo for k in ranks})
        open_ = [t for t in open_ if t[1] < t[2]]
        if not open_:
            break
        entries = []
        for i in {t[0] for t in open_}:
            v = F.col(f"_v{i}")
            which, key = F.lit(None).cast("int"), F.lit(None).cast("double")
            for j, (c, lo, hi, _, n, _) in enumerate(open_):
                if c == i:
                    inside = (v >= F.lit(lo)) & (v <= F.lit(hi))
                    which = F.when(inside, F.lit(j)).otherwise(which)
                    key = F.when(inside, v if n <= FEW_VALUES else _bucket(v, F.lit(lo), F.lit(hi))).otherwise(key)
            entries.append(F.struct(which.alias("j"), key.alias("key"), v.alias("v")))
        # the entries of one column need no generator
        each = entries[0] if len(entries) == 1 else F.explode(F.array(*entries))
        hist = (vals.select(each.alias("e")).select("e.*").filter("j IS NOT NULL")
                .groupBy("j", "key").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        hist.sort(key=lambda x: (x["j"], x["key"]))
        nxt, at = [], 0
        for j, (i, _, _, first, _, ranks) in enumerate(open_):
            while at < len(hist) and hist[at]["j"] == j:
                b = hist[at]
                own = [k for k in ranks if first <= k < first + b["n"]]
                if own:
                    nxt.append((i, b["lo"], b["hi"], first, b["n"], own))
                first += b["n"]
                at += 1
        open_ = nxt
    return {c: [_interpolate(x, got[i, math.floor(x)], got[i, math.ceil(x)]) for x in positions[i]] if i in positions else None
            for i, c in enumerate(cols)}


def group_quantiles(df: DataFrame, group: Sequence[str], col: str | Column, probs: Sequence[float],
                    out: str = "_q") -> DataFrame:
    """Exact per-group quantiles (linear interpolation) as an array column, by
    the same refinement with the intervals in a table: a group of any size is
    counted by bucket in all tasks, and at most FEW_OF_GROUP values of an
    interval meet in one. Null group values are a group; groups without a
    value are not returned."""
    group, probs = list(group), [float(p) for p in probs]
    v = df.select(F.struct(*group).alias("_k"), _value(col).alias("_v")).filter("_v IS NOT NULL")
    n = F.count(F.lit(1))
    stats = v.groupBy("_k").agg(n.alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = F.array_sort(F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor((F.col("_n") - 1) * p).cast("long"), F.ceil((F.col("_n") - 1) * p).cast("long")) for p in probs]))))
    stats = cut_lineage(stats.withColumn("_ranks", wanted))
    state = stats.select("_k", "_lo", "_hi", F.lit(0).cast("long").alias("_first"), F.col("_n").alias("_cnt"), "_ranks")
    large = (F.col("_cnt") > FEW_OF_GROUP) & (F.col("_lo") < F.col("_hi"))
    by = Window.partitionBy("_k", "_lo").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    while state.filter(large).limit(1).count():
        todo = state.filter(large)
        # an infinite end has no width: the finite part is cut, the ends are buckets of their own
        inf = float("inf")
        rows = attach_state(v, todo, "_k", "inner").filter("_v BETWEEN _lo AND _hi")
        lo, hi = F.greatest("_lo", F.lit(-1.7e308)), F.least("_hi", F.lit(1.7e308))
        b = (F.when(F.col("_v") == -inf, -1.0).when(F.col("_v") == inf, BUCKETS + 1.0)
             .otherwise(F.greatest(_bucket(F.col("_v"), lo, hi), F.lit(0.0))))
        hist = rows.withColumn("_b", b).groupBy("_k", "_lo", "_b").agg(
            n.alias("_m"), F.min("_v").alias("_l"), F.max("_v").alias("_h"), F.first("_first").alias("_first"), F.first("_ranks").alias("_ranks"))
        hist = hist.withColumn("_start", F.col("_first") + F.coalesce(F.sum("_m").over(by), F.lit(0)))
        own = F.filter("_ranks", lambda k: (k >= F.col("_start")) & (k < F.col("_start") + F.col("_m")))
        new = hist.withColumn("_own", own).filter(F.size("_own") > 0).select(
            "_k", F.col("_l").alias("_lo"), F.col("_h").alias("_hi"), F.col("_start").alias("_first"), F.col("_m").alias("_cnt"), F.col("_own").alias("_ranks"))
        state = cut_lineage(state.filter(~large).unionByName(new))
    flat = state.filter("_lo = _hi").select("_k", F.explode("_ranks").alias("_r"), F.col("_lo").alias("_x"))
    few = state.filter("_lo < _hi")
    listed = (attach_state(v, few, "_k", "inner").filter("_v BETWEEN _lo AND _hi").groupBy("_k", "_lo")
              .agg(F.sort_array(F.collect_list("_v")).alias("_all"), F.first("_first").alias("_first"), F.first("_ranks").alias("_ranks"))
              .select("_k", F.explode("_ranks").alias("_r"), "_first", "_all")
              .select("_k", "_r", F.get("_all", (F.col("_r") - F.col("_first")).cast("int")).alias("_x")))
    values = flat.unionByName(listed).groupBy("_k").agg(F.map_from_entries(F.collect_list(F.struct("_r", "_x"))).alias("_at"))
    both = stats.select("_k", "_n").join(values, "_k")

    def one(p: float) -> Column:
        pos = (F.col("_n") - 1) * F.lit(p)
        a, b = F.floor(pos).cast("long"), F.ceil(pos).cast("long")
        x, y = F.element_at("_at", a), F.element_at("_at", b)
        return F.when((a == b) | (x == y), x).otherwise((F.ceil(pos) - pos) * x + (pos - F.floor(pos)) * y)

    return both.select(*[F.col("_k")[g].alias(g) for g in group], F.array(*[one(p) for p in probs]).alias(out))
