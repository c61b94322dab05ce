"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and items are sequences of lower-cased words. The CGK random walk reads
a word at each step and moves on, or stays, by a random bit of (step, word):
an insertion or deletion shifts the two walks of similar sequences against
each other only until they meet again, so edit distance becomes Hamming
distance between the words read. A repetition draws its own walk bits and
samples a few steps; windows that read the same words at the sampled steps as
an item collide.

Windows begin at every word of every text. Since a walk only depends on where
it begins, one walk serves the windows of all item sizes that share sampled
steps, and it goes on only for windows whose words so far collide with some
item. The item side embeds the item from several offsets, so that edits near
its beginning do not hide it. Walks alone miss some matches of short items, so
the run of words that the allowed edits must leave unchanged is read in full
as well, from every word of the item. A collision names an item and where it would
begin; the item-sized window there, with room for the allowed edits, is
verified by exact (bit-parallel) edit distance over words.

Plan: items are sent to all tasks, in blocks of bounded size; the texts are
read once per block and never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Share of an item's words that may be edited: similarity 0.8 or more.
SIMILARITY = 0.8
#: Independent walks. With p the chance of a collision in one, a match is found with 1 - (1 - p)^REPETITIONS.
REPETITIONS = 8
#: (least words of an item, steps of the walk, sampled steps, words between the item's offsets): longer items share a walk.
CLASSES = ((12, 18, 6, 5), (4, 5, 3, 3), (1, 1, 1, 1))
#: Words walked at a time; a text is never split.
CHUNK_WORDS = 200_000
#: UTF-8 bytes of items that are sent to all tasks at once; more are done in further passes.
BLOCK_BYTES = 8 << 20
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def best_end(pattern: Sequence[int], text: Sequence[int], most: int) -> list[tuple[int, int]]:
    """(end, edits) for each end in ``text`` of a match of the whole pattern with at most ``most`` edits."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    eq: dict[int, int] = {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    pv, mv, score, out = full, 0, m, []
    for at, c in enumerate(text):
        e = eq.get(c, 0)
        xv = e | mv
        xh = ((((e & pv) + pv) ^ pv) | e) & full
        ph, mh = (mv | ~(xh | pv)) & full, pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1) & full, (mh << 1) & full  # a match may begin anywhere
        pv, mv = (mh | ~(xv | ph)) & full, ph & xv
        if score <= most:
            out.append((at + 1, score))
    return out


def _edits(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Edit distance of ``a`` to each prefix of ``b``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row


def unchanged_run(words: int, edits: int) -> int:
    """Words in a row that so many edits leave unchanged at least."""
    return max(1, -(-(words - edits) // (edits + 1)))


class Matcher:
    """Finds items (lists of words) in texts."""

    def __init__(self, items: Sequence[str], similarity: float = SIMILARITY, repetitions: int = REPETITIONS, seed: int = 11):
        words = [words_of(t) for t in items]
        self.vocabulary = {w: i + 2 for i, w in enumerate(sorted({w for x in words for w in x}))}  # 0: no item's word, 1: edge of a text
        self.items = [np.array([self.vocabulary[w] for w in x], dtype=np.intp) for x in words]
        self.own = [frozenset(x.tolist()) for x in self.items]
        self.most = [int((1 - similarity) * len(x) + 1e-9) for x in self.items]
        self.size = len(self.vocabulary) + 2
        self.walks = []
        above = None
        for least, steps, samples, apart in CLASSES:
            own = [i for i, x in enumerate(self.items) if len(x) >= least and (above is None or len(x) < above)]
            above = least
            if own:
                for r in range(repetitions if steps > 1 else 1):
                    self.walks.append(_Walk(self, own, least, steps, samples, apart, np.random.default_rng([seed, least, r])))
        # a run that stays unchanged wherever the edits are is read in full from each of the item's words
        runs: dict[int, list[int]] = {}
        for i, x in enumerate(self.items):
            if self.most[i]:
                runs.setdefault(unchanged_run(len(x), self.most[i]), []).append(i)
        for run, own in sorted(runs.items()):
            self.walks.append(_Walk(self, own, run, run, run, 1, np.random.default_rng([seed, 0, run]), stay=False))

    def find(self, texts: Sequence[str | None]) -> Iterator[list[tuple[int, int, int, int]]]:
        """For each text, its matches in order: (item, first word, word after the last, edits).

        Of matches of an item that overlap, the one with the fewest edits stays
        (then the shortest, then the first).
        """
        part: list[np.ndarray] = []
        n = 0
        for t in texts:
            w = words_of(t)
            part.append(np.fromiter(map(self.vocabulary.get, w, repeat(0)), dtype=np.intp, count=len(w)))
            n += len(w) + 1
            if n >= CHUNK_WORDS:
                yield from self._find(part)
                part, n = [], 0
        yield from self._find(part)

    def _find(self, texts: list[np.ndarray]) -> Iterator[list[tuple[int, int, int, int]]]:
        if not texts:
            return
        edge = np.ones(1, dtype=np.intp)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        x = np.concatenate([y for t in texts for y in (t, edge)] + [np.ones(max((w.steps for w in self.walks), default=0) + 1, np.intp)])
        met = [w.collisions(x, int(starts[-1])) for w in self.walks]
        found = np.unique(np.concatenate(met), axis=0) if met else np.zeros((0, 2), np.int64)
        owner = np.searchsorted(starts, found[:, 0] + 0, side="right") - 1 if len(found) else []
        by_text: dict[int, set[tuple[int, int]]] = {}
        for (at, which), o in zip(found.tolist(), np.asarray(owner).tolist()):
            item, offset = divmod(which, 1 << 20)
            by_text.setdefault(o, set()).add((item, at - int(starts[o]) - offset))
        for i, t in enumerate(texts):
            yield self._verified(t, by_text[i]) if i in by_text else []

    def _verified(self, text: np.ndarray, candidates: set[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        places: dict[int, list[int]] = {}
        for item, begin in candidates:
            places.setdefault(item, []).append(begin)
        out = []
        for item, begins in places.items():
            pattern, most = self.items[item].tolist(), self.most[item]
            m = len(pattern)
            windows: list[list[int]] = []  # joined where they overlap
            for b in sorted(begins):
                low, high = max(0, b - 2 * most), min(len(text), b + m + 2 * most)
                if windows and low <= windows[-1][1]:
                    windows[-1][1] = max(windows[-1][1], high)
                else:
                    windows.append([low, high])
            hits = []
            for low, high in windows:
                part = text[low:high].tolist()
                if sum(map(self.own[item].__contains__, part)) < m - most:
                    continue  # so many of the item's words must be there
                for end, edits in best_end(pattern, part, most):
                    near = part[max(0, end - m - edits):end][::-1]
                    row = _edits(pattern[::-1], near)
                    size = row.index(edits)
                    hits.append((edits, size, low + end - size, low + end))
            taken: list[tuple[int, int, int]] = []
            for edits, _, a, b in sorted(hits):
                if all(b <= c or a >= d for c, d, _ in taken):
                    taken.append((a, b, edits))
            out += [(item, a, b, e) for a, b, e in taken]
        return sorted(out, key=lambda h: (h[1], h[0], h[2]))


_FILTER_SIZE = 1 << 18


def _spread(key: np.ndarray) -> np.ndarray:
    """Place of each key in a filter of _FILTER_SIZE."""
    return (key * 2654435761 >> 13) & (_FILTER_SIZE - 1)


class _Walk:
    """One repetition: walk bits, sampled steps, and the items' words read there."""

    def __init__(self, matcher: Matcher, own: list[int], least: int, steps: int, samples: int, apart: int, rng: np.random.Generator,
                 stay: bool = True):
        self.steps = steps
        self.sampled = sorted(rng.choice(steps, samples, replace=False).tolist())
        self.moves = rng.integers(0 if stay else 1, 2, (steps, matcher.size)).astype(np.intp)
        self.size = matcher.size
        names, begins, parts, at = [], [], [], 0
        for i in own:
            x = matcher.items[i]
            for o in sorted({*range(0, len(x) - least + 1, apart), len(x) - least}):
                names.append(i << 20 | o)
                begins.append(at + o)
            parts += [x, np.ones(steps + 1, dtype=np.intp)]
            at += len(x) + steps + 1
        read = self._read(np.concatenate(parts), np.array(begins))
        self.names = np.array(names, dtype=np.int64)
        self.first = np.full(self.size, -1, dtype=np.int64)
        state, self.keys, self.seen = np.zeros(len(names), dtype=np.int64), [], []
        for depth in range(samples):
            key = state * self.size + read[depth]
            kept, state = np.unique(key, return_inverse=True)
            self.keys.append(kept)
            if depth == 0:
                self.first[kept] = np.arange(len(kept))
            seen = np.zeros(_FILTER_SIZE, dtype=bool)
            seen[_spread(kept)] = True
            self.seen.append(seen)
        self.order = np.argsort(state, kind="stable")
        self.bounds = np.searchsorted(state[self.order], np.arange(len(self.keys[-1]) + 1))

    def _read(self, x: np.ndarray, pos: np.ndarray) -> list[np.ndarray]:
        out = []
        for step in range(self.sampled[-1] + 1):
            here = x[pos]
            if step in self.sampled:
                out.append(here.astype(np.int64))
            pos = pos + self.moves[step][here]
        return out

    def collisions(self, x: np.ndarray, n: int) -> np.ndarray:
        """(place, item and offset) of the windows, beginning before n, that collide with an item."""
        pos = begin = np.arange(n)
        state, depth = None, 0
        for step in range(self.sampled[-1] + 1):
            here = x.take(pos) if step else x[:n]
            if step == self.sampled[depth]:
                if depth == 0:
                    got = self.first.take(here)
                    ok = np.flatnonzero(got >= 0)
                    state = got.take(ok)
                else:
                    # most windows fail the small filter; the others are looked up
                    key = state * self.size + here
                    ok = np.flatnonzero(self.seen[depth].take(_spread(key)))
                    key = key.take(ok)
                    state = np.searchsorted(self.keys[depth], key)
                    state[state == len(self.keys[depth])] = 0
                    true = self.keys[depth][state] == key
                    ok, state = ok[true], state[true]
                pos, begin, here = pos.take(ok), begin.take(ok), here.take(ok)
                depth += 1
                if not len(pos):
                    return np.zeros((0, 2), dtype=np.int64)
                if depth == len(self.sampled):
                    break
            pos = pos + self.moves[step].take(here)
        each = self.bounds[state + 1] - self.bounds[state]
        place = np.repeat(begin.astype(np.int64), each)
        nth = np.arange(len(place)) - np.repeat(np.cumsum(each) - each, each)
        return np.stack([place, self.names[self.order[np.repeat(self.bounds[state], each) + nth]]], axis=1)


def item_blocks(benchmark: DataFrame, id_col: str, text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """(id, text) lists of at most about ``block_bytes``; items without a word are left out."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text).alias("text")).filter(F.col("text").rlike(r"\w"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (block_bytes // 2)))
    for b in range(blocks if size else 0):
        rows = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("text", "id"), F.lit(blocks)) == b)
        yield sorted(((r["id"], r["text"]) for r in rows.collect()), key=lambda r: (r[0] is None, r))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", similarity: float = SIMILARITY, repetitions: int = REPETITIONS) -> DataFrame:
    """One row per place where a document has an item: id, item_id, start, end (code points), edits, similarity.

    Words are runs of letters, digits and underscores, lower-cased; a match has
    at most (1 - similarity) times the item's words in word edits. Verification
    is exact; so are the candidates of items with edits, as a run of words that
    the edits must leave unchanged is looked up besides the walks. Null or empty texts, and items without a word, match nothing;
    repeated rows match as often as they are there. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind, item_kind = dict(rows.dtypes)["id"], dict(benchmark.dtypes)[item_id]
    schema = f"id {kind}, item_id {item_kind}, start long, end long, edits int, similarity double"
    out = None
    item_type = to_arrow_type(benchmark.schema[item_id].dataType)
    for block in item_blocks(benchmark, item_id, item_text):
        got = rows.mapInArrow(_finder(block, item_type, similarity, repetitions), schema)
        out = got if out is None else out.unionByName(got)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnsRenamed({"id": id_col, "item_id": item_id})


def _finder(block: list[tuple], item_type: pa.DataType, similarity: float, repetitions: int):
    ids, texts = [i for i, _ in block], [t for _, t in block]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(texts, similarity, repetitions)
        for b in batches:
            bodies = b["text"].to_pylist()
            owner, item, start, end, edits, like = [], [], [], [], [], []
            for i, hits in enumerate(matcher.find(bodies)):
                spans = _spans(bodies[i]) if hits else []
                for which, first, after, e in hits:
                    owner.append(i), item.append(ids[which]), edits.append(e)
                    start.append(spans[first][0]), end.append(spans[after - 1][1])
                    like.append(1 - e / len(matcher.items[which]))
            yield pa.RecordBatch.from_pydict({
                "id": b["id"].take(pa.array(owner, pa.int64())), "item_id": pa.array(item, item_type),
                "start": pa.array(start, pa.int64()), "end": pa.array(end, pa.int64()), "edits": pa.array(edits, pa.int32()),
                "similarity": pa.array(like, pa.float64())})

    return run


def _spans(text: str) -> list[tuple[int, int]]:
    """Places of the words; where lower-casing changes a text's length, those of the lower-cased text, held to its bounds."""
    low = text.lower()
    if len(low) == len(text):
        return [m.span() for m in _WORD.finditer(low)]
    at = [k for k, c in enumerate(text) for _ in c.lower()] + [len(text)]
    return [(at[m.start()], at[m.end() - 1] + 1) for m in _WORD.finditer(low)]


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  similarity: float = SIMILARITY, repetitions: int = REPETITIONS) -> DataFrame:
    """``docs`` less the rows in which an item occurs; all others stay as they are, null texts included."""
    out = docs
    for block in item_blocks(benchmark, item_id, item_text):
        out = out.filter(~F.coalesce(_has(block, similarity, repetitions)(F.col(text)), F.lit(False)))
    return out


def _has(block: list[tuple], similarity: float, repetitions: int):
    items = [t for _, t in block]

    @F.pandas_udf("boolean")
    def has(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(items, similarity, repetitions)
        for texts in batches:
            yield pd.Series([bool(hits) for hits in matcher.find(list(texts))], dtype=bool)

    return has
