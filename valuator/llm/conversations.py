"""Conversation structure repair: cheapest edits that give a conversation a
legal order of roles, by a dynamic program over persistent audits.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Rows
are taken by turn (nulls first; rows of one turn by role, the first 32
characters of the text and a digest, equal rows being alike). Each row is kept (K), gets the role user or
assistant (R), or is deleted (D); empty user and assistant rows may be inserted
(I). Blank and repeated rows must be deleted.

The program goes through the rows with one cheapest audit per state of the
pattern. Audits are linked nodes that share their prefixes. Of audits of equal
cost the ASCII-least stays: their longest common prefix is found by binary
lifting over rolling hashes, and equal hashes are verified on the characters.

A conversation of any length is many tasks' work: rows without their texts are
put in order by range partitions and cut into blocks of at most ``BLOCK`` rows.
A block gives, for every state at its start, the cheapest audit to every state
at its end (insertions stand before rows, or at the very end, so no such audit
is the beginning of another). Blocks of one conversation are then chained on
costs and on the order of audits alone, 32 numbers a block. Texts move once, to
the rows' conversation, where they stream through in order beside the audits.

Defined cases: null role and text are one space, null turns come first, null
conv_id is a conversation; an empty table gives empty results; columns other
than conv_id, turn, role, text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuator.llm.common import shuffle_partitions
from valuator.session import cut_lineage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows of one block of the program, a power of two.
BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS
#: States of the pattern: nothing yet, after s, after u, after a. Accepting: 0 and 3.
START, S, U, A = 0, 1, 2, 3
ACCEPT = (START, A)
_AFTER = {("s", START): S, ("u", START): U, ("u", S): U, ("u", A): U, ("a", U): A}
_TURN = {START: U, S: U, U: A, A: U}  # state after an inserted or reroled row
_MOD, _BASE = (1 << 61) - 1, 911382323


class Audits:
    """Persistent strings: a node is a prefix and one more character. Node 0 is the empty string."""

    def __init__(self) -> None:
        self.up: list[list[int]] = [[]]
        self.char, self.depth, self.hash = [""], [0], [0]

    def add(self, parent: int, char: str) -> int:
        anc, j = [parent], 0
        while j < len(self.up[anc[j]]):
            anc.append(self.up[anc[j]][j])
            j += 1
        self.up.append(anc)
        self.char.append(char)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(char)) % _MOD)
        return len(self.char) - 1

    def lift(self, node: int, depth: int) -> int:
        n, j = self.depth[node] - depth, 0
        while n:
            if n & 1:
                node = self.up[node][j]
            n >>= 1
            j += 1
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two prefixes of one length are equal; equal hashes are verified back to where the chains meet."""
        if a == b:
            return True
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.char[a] != self.char[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, x: str, b: int, y: str) -> bool:
        """Whether string a + x comes before string b + y."""
        if a == b:
            return x < y
        da, db = self.depth[a], self.depth[b]
        m = min(da, db)
        p, q = self.lift(a, m), self.lift(b, m)
        if self.same(p, q):
            if da == db:
                return x < y
            if da < db:
                return x <= self.char[self.lift(b, m + 1)]
            return self.char[self.lift(a, m + 1)] < y
        for j in range(len(self.up[p]) - 1, -1, -1):
            if j < len(self.up[p]) and not self.same(self.up[p][j], self.up[q][j]):
                p, q = self.up[p][j], self.up[q][j]
        return self.char[p] < self.char[q]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def cheapest(rows: Iterable[tuple[str, str]], entry: int, last: bool) -> dict[int, tuple[int, str]]:
    """Cost and least audit to each state after ``rows`` that ``entry`` reaches.

    rows: (initial of the role, fault), fault being '' (none), 'x' (blank or
    repeated) or 't' (truncated). ``last``: rows may be inserted after the last
    one, and only accepting states are given.
    """
    t = Audits()
    tips: dict[int, tuple[int, int]] = {entry: (0, 0)}

    def offer(into: dict, state: int, cost: int, parent: int, char: str) -> None:
        known = into.get(state)
        if known is None or cost < known[0] or (cost == known[0] and t.less(parent, char, known[1], known[2])):
            into[state] = (cost, parent, char)

    def with_inserts(tips: dict) -> dict:
        """Up to two insertions in a row, which reach every state that can be reached."""
        frontier = tips
        for _ in range(2):
            found: dict = {}
            for state, (cost, node) in frontier.items():
                to = _TURN[state]
                have = tips.get(to)
                if have is None or cost + INSERT <= have[0]:
                    offer(found, to, cost + INSERT, node, "I")
            frontier = {}
            for state, (cost, parent, char) in found.items():
                have = tips.get(state)
                if have is None or cost < have[0] or t.less(parent, char, t.up[have[1]][0] if have[1] else 0, t.char[have[1]]):
                    frontier[state] = (cost, t.add(parent, char))
            tips = {**tips, **frontier}
        return tips

    for initial, fault in rows:
        found: dict = {}
        for state, (cost, node) in with_inserts(tips).items():
            offer(found, state, cost + DELETE, node, "D")
            if fault != "x":
                more = cost + (TRUNCATED if fault == "t" else 0)
                kept = _AFTER.get((initial, state))
                if kept is not None:
                    offer(found, kept, more + KEEP, node, "K")
                offer(found, _TURN[state], more + REROLE, node, "R")
        tips = {state: (cost, t.add(parent, char)) for state, (cost, parent, char) in found.items()}
    if last:
        tips = {state: tip for state, tip in with_inserts(tips).items() if state in ACCEPT}
    return {state: (cost, t.text(node)) for state, (cost, node) in tips.items()}


def _fault(text: Column) -> Column:
    """blank, truncated or neither, from the text alone."""
    end = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*+\z", 1)
    return F.when(end == "", "b").when(~end.rlike("[.!?]"), "t").otherwise("")


def _sorted_columns() -> list[Column]:
    """Order of the rows of a conversation, in values of bounded size."""
    text = F.col("text")
    return [F.col("turn").isNotNull().alias("has_turn"), F.col("turn"), F.col("role"), F.left(text, F.lit(32)).alias("head"),
            F.unhex(F.md5(text.cast("binary"))).alias("digest")]


def _filled(rows: DataFrame) -> DataFrame:
    one = F.lit(" ")
    return rows.select(F.struct("conv_id").alias("conv"), "turn", F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"))


_ORDER = ["has_turn", "turn", "role", "head", "digest"]


def audits(conversations: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """One row a block, in order of ``block``: conv (struct of conv_id), block, the key of its first row, rows, least and greatest turn,
    distinct turns that no earlier block has, blank, duplicate, truncated, illegal, cost and audit.

    Sums over the blocks of a conversation, and its audits in order, are the values of the conversation.
    """
    spark = conversations.sparkSession
    light = _filled(conversations).select(
        "conv", *_sorted_columns(), F.left("role", F.lit(1)).alias("initial"), _fault(F.col("text")).alias("fault"),
        F.unhex(F.md5(F.concat(F.to_json("conv"), F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).alias("same"),
        F.monotonically_increasing_id().alias("spread"))
    # equal rows are alike, so spread may part them between two ranges
    keys = ["conv", *_ORDER, "spread"]
    light = light.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys).drop("spread")
    light = cut_lineage(light.withColumn("at", F.monotonically_increasing_id()))
    firsts = (light.filter("fault <> 'b'").groupBy("same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").drop("n"))
    coded = light.join(firsts, "same", "left").withColumn(
        "fault", F.when((F.col("fault") != "b") & (F.col("at") > F.col("first")), "d").otherwise(F.col("fault")))
    block = F.shiftright("at", BLOCK_BITS).alias("block")
    key = F.struct(*_ORDER)
    blocks = coded.groupBy("conv", block).agg(
        F.min_by(key, "at").alias("key"), F.count(F.lit(1)).alias("rows"),
        F.min_by("turn", "at").alias("first_turn"), F.max_by("turn", "at").alias("last_turn"),
        F.min("turn").alias("low_turn"), F.max("turn").alias("high_turn"),
        F.min_by("initial", "at").alias("first_initial"), F.max_by("initial", "at").alias("last_initial"),
        *[F.count_if(F.col("fault") == x).alias(name) for x, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
        F.array_sort(F.collect_list(F.struct("at", "turn", "initial", "fault"))).alias("codes"))
    turns = F.array_distinct(F.transform("codes", lambda c: c["turn"]))
    blocks = cut_lineage(blocks.withColumn("turns", F.size(F.filter(turns, lambda x: x.isNotNull())).cast("long")))
    # a window over what is left of the blocks of a conversation: one short row for each BLOCK rows
    w = Window.partitionBy("conv").orderBy("block")
    short = blocks.select("conv", "block", "first_turn", "last_turn", "first_initial", "last_initial").withColumns({
        "turn_before": F.lag("last_turn").over(w), "initial_before": F.lag("last_initial").over(w),
        "number": F.row_number().over(w), "is_last": F.lead("block").over(w).isNull()})
    pair = F.concat("initial_before", "first_initial")
    border = short.select("conv", "block", "number", "is_last",
                          F.coalesce(F.col("turn_before") == F.col("first_turn"), F.lit(False)).cast("long").alias("turn_again"),
                          (F.col("initial_before").isNotNull() & ~pair.isin("su", "ua", "au")).cast("long").alias("illegal_border"))
    joined = blocks.join(border, ["conv", "block"])
    pairs = F.transform(F.slice("codes", 2, F.greatest(F.size("codes") - 1, F.lit(0))),
                        lambda c, i: F.concat(F.get("codes", i)["initial"], c["initial"]).isin("su", "ua", "au"))
    run = joined.select("conv", "block", "number", "is_last",
                        F.transform("codes", lambda c: c["initial"]).alias("initials"), F.transform("codes", lambda c: c["fault"]).alias("faults"))
    solved = cut_lineage(run.mapInArrow(_solve, "conv struct<conv_id:bigint>, block bigint, number int, is_last boolean, "
                                                "way array<struct<entry:int,exit:int,cost:bigint,rank:int,audit:string>>"
                                        .replace("conv_id:bigint", f"conv_id:{conversations.schema['conv_id'].dataType.simpleString()}")))
    alone = solved.filter("number = 1 AND is_last").select("conv", "block", F.lit(0).alias("entry"), F.get("way", F.lit(0))["exit"].alias("exit"))
    many = solved.filter("NOT (number = 1 AND is_last)").select(
        "conv", "block", "is_last", F.transform("way", lambda x: F.struct(x["entry"], x["exit"], x["cost"], x["rank"])).alias("way"))
    chain = many.groupBy("conv").applyInArrow(_chain, f"conv {solved.schema['conv'].dataType.simpleString()}, block bigint, entry int, exit int")
    chosen = alone.unionByName(chain)
    picked = solved.join(chosen, ["conv", "block"]).select(
        "conv", "block", F.get(F.filter("way", lambda x: (x["entry"] == F.col("entry")) & (x["exit"] == F.col("exit"))), F.lit(0)).alias("x"))
    return (joined.withColumn("illegal", F.size(F.filter(pairs, lambda ok: ~ok)) + F.col("illegal_border"))
            .join(picked, ["conv", "block"])
            .select("conv", "block", "key", "rows", "low_turn", "high_turn", (F.col("turns") - F.col("turn_again")).alias("turns"),
                    "blank", "duplicate", "truncated", "illegal", F.col("x.cost").alias("cost"), F.col("x.audit").alias("audit")))


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ways through each block: for each state at the start, the cost, the audit and its order among those of other ends."""
    way = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("audit", pa.string())]))
    for b in batches:
        out = []
        cols = [b.column(i).to_pylist() for i in (2, 3, 4, 5)]
        for number, last, initials, faults in zip(*cols, strict=True):
            rows = [(i, {"b": "x", "d": "x"}.get(f, f)) for i, f in zip(initials, faults, strict=True)]
            ways = []
            for entry in (START,) if number == 1 else (START, S, U, A):
                ends = cheapest(rows, entry, last)
                if last:
                    # one end: the cheapest, of equal ones the least
                    state = min(ends, key=lambda s: ends[s])
                    ends = {state: ends[state]}
                for rank, (state, (cost, audit)) in enumerate(sorted(ends.items(), key=lambda x: x[1][1])):
                    ways.append({"entry": entry, "exit": state, "cost": cost, "rank": rank, "audit": audit})
            out.append(ways)
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(out, way)], ["conv", "block", "number", "is_last", "way"])


def _chain(table: pa.Table) -> pa.Table:
    """States between the blocks of one conversation: least cost to the end from the back, least audit among the cheapest from the front."""
    table = table.sort_by("block")
    ways = [[(x["entry"], x["exit"], x["cost"], x["rank"]) for x in w] for w in table["way"].to_pylist()]
    final = len(ways) - 1
    rest: list[dict[int, int]] = [{} for _ in ways]

    def after(i: int, state: int) -> int | None:
        return 0 if i == final else rest[i + 1].get(state)

    for i in range(final, -1, -1):
        for entry, end, cost, _ in ways[i]:
            more = after(i, end)
            if more is not None and (entry not in rest[i] or cost + more < rest[i][entry]):
                rest[i][entry] = cost + more
    state, out = START, []
    for i, way in enumerate(ways):
        good = [(rank, end) for entry, end, cost, rank in way
                if entry == state and after(i, end) is not None and cost + after(i, end) == rest[i][state]]
        out.append((state, min(good)[1]))
        state = out[-1][1]
    return table.select(["conv", "block"]).append_column("entry", pa.array([x[0] for x in out], pa.int32())).append_column(
        "exit", pa.array([x[1] for x in out], pa.int32()))


def repaired(conversations: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv_id, pos, edit, turn, role, text): the conversations after their edits, deleted rows too, in which ``edit`` is D.

    ``solved``: ``audits(conversations)``. All rows of a conversation are in
    one partition, in order of pos: they stream through it with the audits of
    their blocks, which stand before the first row of the block, so that what a task holds
    at a time is a batch and the audit of a block or two.
    """
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    texts = _filled(conversations).select("conv", *_sorted_columns(), F.lit(1).alias("part"), F.lit(0).cast("long").alias("block"), "text")
    edits = solved.select("conv", *[F.col(f"key.{c}").alias(c) for c in _ORDER], F.lit(0).alias("part"), "block", F.col("audit").alias("text"))
    keys = ["conv", *_ORDER, "part", "block"]
    rows = (texts.unionByName(edits).repartition(shuffle_partitions(conversations.sparkSession), "conv").sortWithinPartitions(*keys)
            .select(F.col("conv.conv_id").alias("conv_id"), "part", "turn", "role", "text"))
    return rows.mapInArrow(_apply, f"conv_id {id_type}, pos bigint, edit string, turn {conversations.schema['turn'].dataType.simpleString()}, role string, text string")


def _edits(audit: str) -> Iterator[tuple[int, str]]:
    """(insertions before, edit) of each row; what is inserted after the last row has the edit ''."""
    n = 0
    for c in audit:
        if c == "I":
            n += 1
        else:
            yield n, c
            n = 0
    if n:
        yield n, ""


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from collections import deque

    nobody = object()
    conv, state, pos, waiting = nobody, START, 0, deque()
    names = ["conv_id", "pos", "edit", "turn", "role", "text"]
    role_of = {U: "user", A: "assistant"}
    types = None
    for b in batches:
        out: list[tuple] = []
        types = types or [b.schema.field("conv_id").type, pa.int64(), pa.string(), b.schema.field("turn").type, pa.string(), pa.string()]

        def insert(n: int) -> None:
            nonlocal state, pos
            for _ in range(n):
                state = _TURN[state]
                out.append((conv, pos, "I", None, role_of[state], ""))
                pos += 1

        def finish() -> None:
            while waiting and waiting[0][1] == "":
                insert(waiting.popleft()[0])

        for c, part, turn, role, text in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            if conv is nobody or c != conv:
                if conv is not nobody:
                    finish()
                conv, state, pos = c, START, 0
                waiting.clear()
            if part == 0:
                waiting.extend(_edits(text))
                continue
            n, edit = waiting.popleft()
            insert(n)
            if edit == "K":
                state = _AFTER[role[:1], state]
            elif edit == "R":
                state = _TURN[state]
                role = role_of[state]
            out.append((c, pos, edit, turn, role, text))
            pos += 1
            if waiting and waiting[0][1] == "":
                finish()
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(x, ty) for x, ty in zip(columns, types, strict=True)], names)


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired``: SHA-256 of the role:text of rows that stay, newline-joined.

    Reads the partitions of ``repaired`` as they are; the hash of a
    conversation is one chain, which streams through one task.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    return rows.select("conv_id", "edit", "role", "text").mapInArrow(_digest, f"conv_id {id_type}, repaired_sha256 string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    nobody = object()
    conv, h, first, kind = nobody, None, True, None
    for b in batches:
        kind = b.schema.field("conv_id").type
        out: list[tuple] = []
        for c, edit, role, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if conv is nobody or c != conv:
                if conv is not nobody:
                    out.append((conv, h.hexdigest()))
                conv, h, first = c, hashlib.sha256(), True
            if edit != "D":
                h.update((("" if first else "\n") + role + ":").encode())
                h.update(text.encode())
                first = False
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], kind), pa.array([x[1] for x in out], pa.string())], ["conv_id", "repaired_sha256"])
    if conv is not nobody:
        yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([h.hexdigest()], pa.string())], ["conv_id", "repaired_sha256"])
