"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each
character of a segment; dynamic programming keeps, for each place, the best
score and the number of pieces of the path that has it, and never the path.
Ties go as in unigram tokenizers that scan starts from left to right and
replace a path only by a better one: of equal scores the piece that starts
earliest wins, and the unknown character comes last.

Spaces count as ``MARK`` and a text gets one in front. No piece of a usual
vocabulary holds a MARK after another character, or a line end, so the best
path of a text is the chain of the best paths of its words, which repeat: each
task keeps the results of its words in a bounded cache. Where the vocabulary
does hold such a piece, segments are not cut there.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the character that stands for a space in sentencepiece vocabularies.
MARK = "▁"
#: Fixed value: an unknown character scores so much below the worst piece.
UNKNOWN_PENALTY = 10.0
#: Segments a task keeps, some 150 bytes each; the cache starts anew when it is full.
CACHE_SEGMENTS = 500_000


class Unigram:
    """Best score and piece count of texts under (piece, score) pairs.

    With ``byte_fallback`` an unknown character counts a piece per byte of its
    UTF-8 form; otherwise a run of unknown characters is one piece.
    """

    def __init__(self, pieces: Sequence[tuple[str, float]], worst: float | None = None, byte_fallback: bool = True):
        import ahocorasick

        self.unknown = (min((s for _, s in pieces), default=0.0) if worst is None else worst) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        self.automaton = ahocorasick.Automaton()
        for piece, score in reversed(pieces):  # of a repeated piece the first counts
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not any(p for p, _ in pieces)
        cuts_words = not any(MARK in p.lstrip(MARK) for p, _ in pieces)
        # without byte fallback a run of unknown characters may go over a line end
        self.cuts_lines = byte_fallback and cuts_words and not any("\n" in p for p, _ in pieces)
        self.segment = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+" if cuts_words and byte_fallback else r"(?s).+")
        self.bare, self.marked = _Cache(self.best, ""), _Cache(self.best, MARK)

    def best(self, segment: str) -> complex:
        """Count (real part) and score (imaginary part): one number that ``sum`` adds up."""
        n = len(segment)
        score, count, single, unknown = [0.0] + [float("-inf")] * n, [0] * (n + 1), [False] * (n + 1), [False] * (n + 1)
        done = 0

        def settle(upto: int) -> None:
            nonlocal done
            while done < upto:
                e = done + 1
                if not single[e] and score[done] + self.unknown > score[e]:
                    score[e] = score[done] + self.unknown
                    pieces = len(segment[done].encode("utf-8", "surrogatepass")) if self.byte_fallback else int(not unknown[done])
                    count[e], unknown[e] = count[done] + pieces, True
                done = e

        for last, (size, value) in () if self.empty else self.automaton.iter(segment):
            end = last + 1
            if done < last:
                settle(last)
            start = end - size
            if size == 1:
                single[end] = True
            if score[start] + value > score[end]:
                score[end], count[end] = score[start] + value, count[start] + 1
        settle(n)
        return complex(count[n], score[n])

    def of(self, text: str | None) -> tuple[int, float]:
        """(pieces, best score) of a text; an empty or null text has none."""
        if not text:
            return 0, 0.0
        total, bare, marked = 0j, self.bare.__getitem__, self.marked.__getitem__
        lines = text.split("\n") if self.cuts_lines else [text]
        for i, line in enumerate(lines):
            if self.cuts_lines and "  " not in line and MARK not in line and (i or line[:1] != " "):
                words = line.split(" ")
                total += sum(map(marked, words if i == 0 else words[1:]))
                if i:
                    total += bare(words[0])
            else:
                total += sum(map(bare, self.segment.findall((MARK if i == 0 else "") + line.replace(" ", MARK))))
        if self.cuts_lines:
            total += (len(lines) - 1) * self.bare["\n"]
        return int(total.real), total.imag


class _Cache(dict):
    def __init__(self, best, prefix: str):
        super().__init__()
        self.best, self.prefix = best, prefix

    def __missing__(self, word: str) -> complex:
        if len(self) >= CACHE_SEGMENTS:
            self.clear()
        value = self[word] = self.best(self.prefix + word) if self.prefix or word else 0j
        return value


@functools.cache
def load(model: str) -> Unigram:
    """Pieces and scores of a sentencepiece model file; control, unknown and byte pieces match no text."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = range(sp.get_piece_size())
    scores = [sp.get_score(i) for i in ids]
    pieces = [(sp.id_to_piece(i), scores[i]) for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return Unigram(pieces, min(scores), any(map(sp.is_byte, ids)))


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, score.

    ``model`` is a sentencepiece file whose pieces and scores are taken as a
    unigram vocabulary. Null and empty texts count 0 pieces. Scores add up
    exactly while they are whole numbers below 2^53, as in rank-scored files;
    otherwise ties hold to within rounding. Other columns are not read.
    """

    @F.pandas_udf("n long, score double")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = load(model)
        for texts in batches:
            yield pd.DataFrame([vocabulary.of(t) for t in texts], columns=["n", "score"])

    both = docs.select(F.col(id_col), count(F.col(text)).alias("__count"))
    return both.select(F.col(id_col), F.col("__count.n").alias("n_tokens"), F.col("__count.score").alias("score"))
