"""Language ID by rank-order profiles.

A text's letters, lower-cased, form words padded by a space; its 1- to 3-grams
that stay within a word are counted, and the most frequent ones, in order, are
its profile. A language's profile is made in the same way from all its
labelled texts. A document gets the language with the smallest out-of-place
distance: the sum, over its own profile, of the difference of the two ranks,
or the profile length where the language does not have the n-gram.

Learning is one pass that counts n-grams per language in each task and sums
them up by (language, n-gram); only the profiles (languages times profile
length) reach the driver. Prediction is a projection without a shuffle.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROFILE_SIZE = 300
#: Profiles sent to the driver and to every task: an error beyond that many languages.
MAX_LANGUAGES = 2_000
UNDETERMINED = "und"
_SPACE, _BITS = 32, 21
#: Characters counted at a time while learning.
LEARN_CHARS = 1_000_000


@functools.cache
def _is_letter() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased words, one space before, between and after them; empty if there is no letter."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ok = _is_letter()[c]
    if not ok.any():
        return np.zeros(0, dtype=np.int64)
    before = np.concatenate([[False], ok[:-1]])
    out = np.where(ok, c, _SPACE)[ok | before]
    parts = ([_SPACE], out, [_SPACE] if out[-1] != _SPACE else [])
    return np.concatenate(parts).astype(np.int64)


def gram_counts(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """1- to 3-grams (21 bits a character) in ascending order, and their counts."""
    present = np.flatnonzero(np.bincount(c))
    size = len(present)
    lut = np.zeros(present[-1] + 1, dtype=np.int64)
    lut[present] = np.arange(size)
    a, space = lut[c], c == _SPACE
    keys, counts = [], []
    for n in (1, 2, 3):
        if len(a) < n:
            break
        code, ok = a[: len(a) - n + 1], ~space[: len(a)] if n == 1 else np.ones(len(a) - n + 1, dtype=bool)
        for i in range(1, n):
            code = code * size + a[i: len(a) - n + 1 + i]
            if i < n - 1:
                ok = ok & ~space[i: len(a) - n + 1 + i]
        code = code[ok]
        if size ** n <= max(4 * len(code), 1 << 16):
            bins = np.bincount(code, minlength=1)
            found = np.flatnonzero(bins)
            counts.append(bins[found])
        else:
            found, n_each = np.unique(code, return_counts=True)
            counts.append(n_each)
        key, scale = np.zeros(len(found), dtype=np.int64), size ** (n - 1)
        for _ in range(n):
            key = (key << _BITS) | present[found // scale % size]
            scale = max(1, scale // size)
        keys.append(key)
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    return key[order], count[order]


def top_grams(text: str | None, size: int = PROFILE_SIZE) -> np.ndarray:
    """The text's profile, most frequent first; of equal counts the smaller n-gram first."""
    c = letters(text)
    if not len(c):
        return c
    key, count = gram_counts(c)
    return key[np.argsort(-count, kind="stable")[:size]]


def fit_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Profile of each language over all rows with a label; rows without text or letters add nothing."""
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}

        def add(name: str) -> None:
            key, n = gram_counts(np.concatenate([*waiting.pop(name), [_SPACE]]))
            size[name] = 0
            if name in total:
                old, m = total[name]
                both, at = np.unique(np.concatenate([old, key]), return_inverse=True)
                key, n = both, np.bincount(at, np.concatenate([m, n])).astype(np.int64)
            total[name] = key, n

        for frame in frames:
            for name, body in zip(frame["lang"], frame["text"]):
                c = letters(body)
                if len(c):
                    waiting.setdefault(name, []).append(c[:-1])
                    size[name] = size.get(name, 0) + len(c)
                    if sum(size.values()) > LEARN_CHARS:
                        for full in list(waiting):
                            add(full)
        for name in list(waiting):
            add(name)
        for name, (key, n) in total.items():
            yield pd.DataFrame({"lang": name, "gram": key, "n": n})

    grams = rows.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = grams.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("rank") <= size)
    got = best.select("lang", "rank", "gram").limit(MAX_LANGUAGES * size + 1).collect()
    if len(got) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out: dict[str, list[int]] = {}
    for r in sorted(got, key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class Ranker:
    """Out-of-place distances to a set of profiles."""

    def __init__(self, profiles: Mapping[str, list[int]], size: int = PROFILE_SIZE):
        self.names, self.size = sorted(profiles), size
        self.keys = np.unique(np.concatenate([np.array(profiles[x], dtype=np.int64) for x in self.names] or [np.zeros(0, np.int64)]))
        self.ranks = np.full((len(self.names), len(self.keys) + 1), -1, dtype=np.int64)
        for i, name in enumerate(self.names):
            self.ranks[i, np.searchsorted(self.keys, profiles[name])] = np.arange(len(profiles[name]))

    def best(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 less the distance over the largest possible one. The first name wins a tie."""
        grams = top_grams(text, self.size)
        if not len(grams) or not self.names:
            return UNDETERMINED, 0.0
        at = np.searchsorted(self.keys, grams)
        at[at == len(self.keys)] = 0
        at = np.where(self.keys[at] == grams, at, len(self.keys))
        ranks = self.ranks[:, at]
        distance = np.where(ranks >= 0, np.abs(ranks - np.arange(len(grams))), self.size).sum(axis=1)
        i = int(distance.argmin())
        return self.names[i], 1 - float(distance[i]) / (self.size * len(grams))


def predict(docs: DataFrame, profiles: Mapping[str, list[int]], text: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1), which replace columns of these names.

    A null text, or one without letters, gets ``und`` and 0; so does every
    text if there are no profiles. Only the text is read.
    """
    ranker = Ranker(profiles, size)

    @F.pandas_udf("lang string, score double")
    def name(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([ranker.best(t) for t in texts], columns=["lang", "score"])

    # not deterministic to the planner: a filter on the result would otherwise run the function once more
    best = name.asNondeterministic()(F.col(text))
    return (docs.withColumn("__best", best).withColumn("lang_pred", F.col("__best.lang"))
            .withColumn("score", F.col("__best.score")).drop("__best"))


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that learning does not see: crc32 of the id as text leaves 2 when divided by 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with held_out, lang_pred and score, learnt from the labelled rows that are not held out."""
    profiles = fit_profiles(docs.filter(~held_out(id_col)), text, lang)
    return predict(docs.withColumn("held_out", held_out(id_col)), profiles, text)
