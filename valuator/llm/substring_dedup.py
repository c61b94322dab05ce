"""Substring dedup by line or paragraph hashing.

Units (lines or paragraphs) are normalised and hashed to 128 bits; digests are
grouped over the whole table; the earliest ranked occurrence of a digest stays
and every other one is a span to remove, with its place in the original text.
Passages are also pasted into the middle of a line, where no line repeats: so
the sentences of a unit, from a number of words on, can be units of a second
level, hashed and ranked in the same way. A passage cut at both ends shares no
sentence either: so on a third level borders follow from single words, and
copies of a passage have the same borders inside wherever they stand. Only
digests and places are
shuffled, never text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuator.llm.common import join_counted
from valuator.session import cut_lineage

_LINE = re.compile(r"[^\n]+")
#: A paragraph ends at a line without visible characters.
_PARAGRAPH = re.compile(r"[^\n]*\S[^\n]*(?:\n[^\n]*\S[^\n]*)*")
#: A sentence ends after its stops; every character of a unit is in one sentence.
_SENTENCE = re.compile(r"[^.!?]*[.!?]+|[^.!?]+")
_WORD = re.compile(r"\S+")
#: A passage unit ends after a word whose hash is 0 modulo this; its words are cut in so many ways, each a level.
BORDER_EVERY, CUTS = 8, 4
#: Units sent on at a time.
BATCH_UNITS = 50_000


def units_of(text: str | None, unit: str = "line", min_words: int = 1,
             sentence_words: int | None = None, passage_words: int | None = None) -> Iterator[tuple[int, int, int, int, str]]:
    """(level, unit, start, end, normalised); offsets are code points of the original.

    Level 0: units with visible characters and ``min_words`` words, numbered
    from 0 (shorter ones count). Level 1: sentences of ``sentence_words`` words
    or more, of units with several sentences; they bear their unit's number.
    Levels 2 and more: runs of ``passage_words`` words or more between words
    that are borders, in any unit; one level for each way to choose borders.
    """
    number = -1
    for m in (_LINE if unit == "line" else _PARAGRAPH).finditer(text or ""):
        norm = " ".join(m[0].lower().split())
        if not norm:
            continue
        number += 1
        if norm.count(" ") + 1 >= min_words:
            yield 0, number, m.start(), m.end(), norm
        if passage_words is not None:
            yield from _passages(m[0], number, m.start(), passage_words)
        if sentence_words is None:
            continue
        for x in _SENTENCE.finditer(m[0]):
            if x.end() - x.start() == len(m[0]):
                break
            part = " ".join(x[0].lower().split())
            if part and part.count(" ") + 1 >= sentence_words:
                yield 1, number, m.start() + x.start(), m.start() + x.end(), part


def _passages(body: str, number: int, begin: int, least: int) -> Iterator[tuple[int, int, int, int, str]]:
    words = [(w[0].lower(), w.start(), w.end()) for w in _WORD.finditer(body)]
    marks = [xxhash.xxh64_intdigest(w) for w, _, _ in words]
    for cut in range(CUTS):
        first = 0
        for k, mark in enumerate(marks):
            if (mark >> 16 * cut & 0xffff) % BORDER_EVERY == 0 or k == len(marks) - 1:
                if k + 1 - first >= least:
                    yield 2 + cut, number, begin + words[first][1], begin + words[k][2], " ".join(w for w, _, _ in words[first:k + 1])
                first = k + 1


def hashed_units(docs: DataFrame, id_col: str, text: str, unit: str, min_words: int, sentence_words: int | None,
                 passage_words: int | None = None) -> DataFrame:
    """id, row, level, unit, start, end, h1, h2 of each unit."""
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["id"]
    fields = ["id", "row", "level", "unit", "start", "end", "h1", "h2"]

    def run(batches):
        out: dict[str, list] = {c: [] for c in fields}
        id_type = None
        for b in batches:
            id_type = b.schema.field("id").type
            for i, row, body in zip(b["id"].to_pylist(), b["row"].to_pylist(), b["text"]):
                for level, k, start, end, norm in units_of(body.as_py(), unit, min_words, sentence_words, passage_words):
                    h = xxhash.xxh128_intdigest(norm)
                    for c, v in zip(fields, (i, row, level, k, start, end, (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63))):
                        out[c].append(v)
                    if len(out["id"]) >= BATCH_UNITS:
                        yield _batch(out, id_type)
                        out = {c: [] for c in fields}
        if out["id"]:
            yield _batch(out, id_type)

    return rows.mapInArrow(run, f"id {kind}, row long, level int, unit int, start long, end long, h1 long, h2 long")


def _batch(cols: dict[str, list], id_type: pa.DataType) -> pa.RecordBatch:
    types = {"id": id_type, "level": pa.int32(), "unit": pa.int32()}
    return pa.RecordBatch.from_pydict({c: pa.array(v, types.get(c, pa.int64())) for c, v in cols.items()})


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", unit: str = "line",
                   min_words: int = 1, sentence_words: int | None = None, passage_words: int | None = None) -> DataFrame:
    """Spans to remove: id, row, level (0: unit, 1: sentence, 2 and more: passage), unit (number in its text), start, end, n (occurrences), first_id, first_unit.

    Two units are equal if they are after lower-casing, trimming and turning
    white space into single spaces. Occurrences rank by id, then by the row's
    place in the input (for rows that repeat an id), then by place in the
    text; null ids rank last. The earliest stays, the others are returned.
    With ``sentence_words``, so are repeated sentences of so many words, but
    for those in a unit that goes as a whole (the first place of a sentence is
    never in such a unit). Spans of one text do not overlap, but for those of
    ``passage_words``, which are looked for in the same way. A null or empty
    text and units without visible characters have nothing to remove; an empty
    table gives an empty result. ``row`` is the number that
    ``monotonically_increasing_id`` gives the row. Other columns are not read.
    """
    if unit not in ("line", "paragraph"):
        raise ValueError("unit must be line or paragraph")
    units = cut_lineage(hashed_units(docs, id_col, text, unit, min_words, sentence_words, passage_words))
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "row", "start", "unit")
    keys = ["level", "h1", "h2"]
    firsts = units.groupBy(*keys).agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = firsts.withColumn("count", F.col("n"))
    again = join_counted(units, firsts, keys, "count", units.count())
    later = again.filter((F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start")))
    if sentence_words is not None or passage_words is not None:
        later = cut_lineage(later)
        gone = later.filter("level = 0").select("row", "unit")
        later = later.filter("level = 0").unionByName(later.filter("level > 0").join(gone, ["row", "unit"], "left_anti"))
    return later.select(F.col("id").alias(id_col), "row", "level", "unit", "start", "end", "n",
                        F.col("first.id").alias("first_id"), F.col("first.unit").alias("first_unit"))


def without_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the spans of ``repeated_spans(docs)`` cut out, units with the line end after them.

    ``docs`` must be the frame that the spans came from (a table read again
    gives rows the same numbers). A null text stays null; all columns stay.
    """
    per_row = spans.groupBy(F.col("row").alias("__row")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "level"))).alias("__cut"))

    @F.udf("string", useArrow=True)
    def cut(body, spans):
        if body is None or spans is None:
            return body
        out, at = [], 0
        for start, end, level in ((s["start"], s["end"], s["level"]) for s in spans):
            out.append(body[at:max(at, start)])
            at = max(at, end + (level == 0 and body[end:end + 1] == "\n"))
        return "".join([*out, body[at:]])

    return (docs.withColumn("__row", F.monotonically_increasing_id()).join(per_row, "__row", "left")
            .withColumn(text, cut(F.col(text), F.col("__cut"))).select(*[F.col(f"`{c}`") for c in docs.columns]))
