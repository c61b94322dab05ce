"""Personal data in texts: labelers vote on candidate spans, expectation-
maximisation weighs the votes, and a span classifier learnt from the weighed
votes decides. DataFrame functions only.

Base spans are the matches of four patterns that pass their check (``KINDS``);
they are always returned. Further candidates are the matches that fail their
check, national telephone numbers, written-out addresses and keys. On every
candidate, base or not, five labelers vote for (1), against (-1) or not (0):

* ``format``   regex: the strict form of the kind,
* ``check``    Luhn, number ranges, mix of characters,
* ``gazetteer`` lists of top-level domains, issuer prefixes, calling codes and key prefixes,
* ``context``  cue words in the characters before the span,
* ``border``   the characters that touch the span.

Votes are counted by kind and pattern of votes (at most 6 x 3^5 rows, however
many candidates there are); the reliabilities of the labelers follow from EM on
these counts. The classifier is naive Bayes over features of the span and its
surroundings, trained on the probabilities of all candidates; a candidate that
is no base span is added where it gives more than a half, unless it overlaps a base span or an
accepted one that starts earlier.

Nothing but counts, bounded by labelers and feature values, reaches the driver.
Offsets are code points, the end exclusive.

Defined cases: a null text is an empty one; a document without a span has zero
counts, the hash of the empty string and an empty ``spans``; rows that repeat a
doc_id, or whose doc_id is null, are answered one by one; an empty table gives
an empty result; other columns of the input, whatever their names, are not
read. Patterns are possessive and anchored at run starts, so their time is
linear in the text and the regular expression engine does not recurse.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuator.session import cut_lineage

#: Base kinds in the order in which spans that start together are listed. A run
#: start is where the class does not precede, or where the last match ended.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further candidates; a letter-digit run is a key candidate from 16 characters on.
MORE = {
    "phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{1,64}+"
             r"(?:(?:\.|\x20?(?:\[dot\]|\(dot\))\x20?)[A-Za-z0-9-]{1,64}+){1,8}+",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+",
}
ORDER = ["email", "ip", "card", "phone", "secret"]
LABELERS = ("format", "check", "gazetteer", "context", "border")
#: Characters of text before a candidate in which cue words are looked for.
CONTEXT = 32

_TLD = r"\.(com|org|net|edu|gov|int|info|biz|io|co|de|fr|es|uk|eu|us|ca|au|nl|it|ch|at|be|pl|br|in|jp|cn|ru)$"
_OCTETS = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
_CUES = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|reach|from|to|cc|mailto)\b",
    "ip": r"(?i)\b(ip|host|server|address|from|client|login|addr)\b",
    "card": r"(?i)\b(card|visa|master|amex|credit|debit|payment|pan)\b",
    "phone": r"(?i)\b(phone|tel|telephone|call|mobile|cell|fax|contact|whatsapp)\b",
    "secret": r"(?i)(token|secret|password|passwd|api[_-]?key|key|bearer|auth)\W{0,4}$",
}
_AGAINST = r"(?i)\b(isbn|issn|version|ver|page|pages|fig|figure|table|invoice|order|chapter|section|doi|sha|commit|id)\W{0,3}$"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _passes(kind: str, match: Column) -> Column:
    """Whether a match of a base pattern passes its check."""
    digits = _digits(match)
    n = F.length(digits)
    if kind == "ip":
        return match.rlike(_OCTETS)
    if kind == "card":
        return F.when(n.between(14, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _entries(kind: str, base: bool, gaps: str, found: str) -> Column:
    """Array of (kind, base pattern, number, gap, match, what stands before and after) from the pieces between matches and the matches."""
    def entry(match: Column, i: Column) -> Column:
        gap = F.get(gaps, i)
        before = F.concat(F.coalesce(F.get(found, i - 1), F.lit("")), gap)
        return F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), i.alias("k"), F.length(gap).cast("long").alias("gap"),
                        match.alias("match"), F.right(before, F.lit(CONTEXT)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"))

    return F.transform(found, entry)


def candidates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(row, id, kind, base, ok, start, end, match, before, after), a row with a null kind for each document without a candidate.

    ``base`` tells the matches of the base patterns, ``ok`` those that pass
    their check. Patterns are tried only where the text has a character that
    they need.
    """
    t = F.col("text")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digit = t.rlike("[0-9]")
    needs = {"email": t.contains("@"), "ip": digit & t.contains("."), "card": t.rlike(r"[0-9][\x20-]?[0-9]"), "phone": t.contains("+")}
    more = {"phone": t.rlike(r"[0-9]{3}[-.\x20][0-9]{4}"), "email": t.rlike(r"[\[(]at[\])]"), "secret": t.rlike(r"[A-Za-z0-9_-]{16}") & digit}
    patterns = [(k, p, True, needs[k]) for k, p in KINDS.items()] + [(k, p, False, more[k]) for k, p in MORE.items()]
    pieces = {}
    # split and regexp_extract_all go through the same matches, so the pieces between them give the offsets
    for i, (_, pattern, _, where) in enumerate(patterns):
        pieces[f"gaps{i}"] = F.when(where, F.split(t, pattern, -1))
        pieces[f"found{i}"] = F.when(where, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    parted = rows.select("row", "id", *[v.alias(k) for k, v in pieces.items()])
    spans = parted.select("row", "id", F.concat(*[_entries(k, base, f"gaps{i}", f"found{i}")
                                                  for i, (k, _, base, _) in enumerate(patterns)]).alias("all"))
    flat = spans.select("row", "id", F.explode_outer("all").alias("m")).select("row", "id", "m.*")
    before = Window.partitionBy("row", "kind", "base").orderBy("k")
    size = F.length("match").cast("long")
    flat = flat.withColumn("end", F.sum(F.col("gap") + size).over(before)).withColumn("start", F.col("end") - size)
    ok = F.lit(False)
    for kind in KINDS:
        ok = F.when(F.col("base") & (F.col("kind") == kind), _passes(kind, F.col("match"))).otherwise(ok)
    digits = F.length(_digits(F.col("match")))
    # a match of a base pattern that is far from its check is text, not a candidate
    near = (F.when(F.col("kind") == "card", digits.between(12, 19)).when((F.col("kind") == "phone") & F.col("base"), digits.between(8, 16))
            .when(F.col("kind") == "secret", F.col("match").rlike("[0-9]") & F.col("match").rlike("[A-Za-z]")).otherwise(True))
    flat = flat.withColumn("ok", ok).withColumn("kind", F.when(near, F.col("kind")))
    return flat.select("row", "id", "kind", F.coalesce("base", F.lit(False)).alias("base"), "ok", "start", "end", "match", "before", "after")


def votes(found: DataFrame) -> DataFrame:
    """``found`` with a column per labeler: 1, -1 or 0."""
    kind, match, before, after = (F.col(c) for c in ("kind", "match", "before", "after"))
    digits = _digits(match)

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    strict = (F.when(kind == "email", match.rlike("^[A-Za-z0-9]") & match.rlike(r"\.[A-Za-z]{2,24}$"))
              .when(kind == "ip", match.rlike(r"^([1-9][0-9]{0,2}|0)(\.([1-9][0-9]{0,2}|0)){3}$"))
              .when(kind == "card", match.rlike(r"^([0-9]{14,19}|[0-9]{4}([\x20-])[0-9]{4}\2[0-9]{4}\2[0-9]{2,7})$"))
              .when(kind == "phone", match.rlike(r"^(\+[0-9]{1,3}[\x20.-]?)?(\([0-9]{1,4}\)|[0-9]{1,4})([\x20.-]?[0-9]{2,4}){2,4}$"))
              .otherwise(match.rlike(r"^([0-9a-f]{20,}|[0-9A-F]{20,}|[A-Za-z]{2,4}[_-][A-Za-z0-9_-]{16,}|[A-Za-z0-9_-]{24,})$")))
    changes = F.length(F.regexp_replace(F.regexp_replace(match, "[0-9]+", "0"), "[A-Za-z_-]+", "a"))
    check = (F.when((kind == "card") & F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).when(kind == "card", False)
             .when(kind == "ip", match.rlike(_OCTETS)).when(kind == "phone", F.length(digits).between(10, 15))
             .when(kind == "email", F.length(match) <= 254).otherwise(changes >= 6))
    known = (F.when(kind == "email", F.lower(match).rlike(_TLD))
             .when(kind == "card", digits.rlike("^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38)"))
             .when(kind == "phone", match.rlike(r"^(\+(1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9])"))
             .when(kind == "ip", ~match.rlike(r"^(0|127|255)\.|^([0-9]\.){3}[0-9]$"))
             .otherwise(match.rlike("^(sk|pk|ghp|gho|xox[abp]|AKIA|AIza|eyJ)")))
    # a list that does not know a key, or the issuer of a number, says nothing about it
    silent = kind.isin("secret", "phone", "card")
    cue = F.lit(False)
    for k, pattern in _CUES.items():
        cue = F.when(kind == k, before.rlike(pattern)).otherwise(cue)
    touched = before.rlike(r"[\p{L}\p{N}_]$") | after.rlike(r"^[\p{L}\p{N}_]")
    return found.withColumns({
        "format": vote(strict, ~strict), "check": vote(check, ~check), "gazetteer": vote(known, ~known & ~silent),
        "context": vote(cue, before.rlike(_AGAINST)), "border": vote(before.rlike(r"(^|[\s\"'=:(<\[])$") & ~touched, touched)})


def reliabilities(counts: Iterable[tuple], rounds: int = 100) -> tuple[dict[str, float], dict[tuple, float], dict[tuple, float]]:
    """EM over (kind, votes, count): prior by kind, P(vote | labeler, class), P(personal | kind, votes).

    One latent class a candidate, votes independent given the class, one pseudo
    count each; it starts from the majority of the votes and ends after
    ``rounds`` or when no probability moves by a millionth.
    """
    rows = sorted((k, tuple(v), n) for k, v, n in counts)
    post = {(k, v): 0.9 if sum(v) > 0 else 0.5 if sum(v) == 0 else 0.1 for k, v, _ in rows}
    prior, like = {}, {}
    for _ in range(rounds):
        for kind in {k for k, _, _ in rows}:
            n = sum(m for k, _, m in rows if k == kind)
            prior[kind] = (1 + sum(m * post[k, v] for k, v, m in rows if k == kind)) / (2 + n)
        for i in range(len(LABELERS)):
            for cls in (0, 1):
                part = {x: 1.0 for x in (-1, 0, 1)}
                for k, v, m in rows:
                    part[v[i]] += m * (post[k, v] if cls else 1 - post[k, v])
                total = sum(part.values())
                like.update({(i, cls, x): part[x] / total for x in part})
        new = {}
        for k, v, _ in rows:
            a, b = math.log(prior[k]), math.log(1 - prior[k])
            for i, x in enumerate(v):
                a, b = a + math.log(like[i, 1, x]), b + math.log(like[i, 0, x])
            new[k, v] = 1 / (1 + math.exp(min(700.0, b - a)))
        moved = max((abs(new[x] - post[x]) for x in post), default=0.0)
        post = new
        if moved < 1e-6:
            break
    return prior, like, post


def _features() -> dict[str, Column]:
    """Features of the classifier; each has a bounded number of values."""
    kind, match = F.col("kind"), F.col("match")
    with_kind = lambda c: F.concat_ws("|", kind, c.cast("string"))
    side = lambda c: F.when(c == "", "edge").when(c.rlike(r"\s"), "space").when(c.rlike(r"[\p{L}]"), "letter").when(c.rlike(r"\p{N}"), "digit").otherwise("mark")
    kinds_of = F.concat(*[F.when(match.rlike(p), s).otherwise("") for p, s in (("[0-9]", "9"), ("[a-z]", "a"), ("[A-Z]", "A"), (r"[^A-Za-z0-9]", "."))])
    word = F.lower(F.regexp_extract("before", r"(\p{L}+)\P{L}*$", 1))
    return {
        "length": with_kind(F.least(F.length(match), F.lit(48))),
        "digits": with_kind(F.least(F.length(_digits(match)), F.lit(32))),
        "letters": with_kind(kinds_of),
        "left": with_kind(side(F.right("before", F.lit(1)))),
        "right": with_kind(side(F.col("after"))),
        "word": with_kind(F.pmod(F.xxhash64(word), F.lit(256))),
        "format": with_kind(F.col("format")), "check": with_kind(F.col("check")),
        "gazetteer": with_kind(F.col("gazetteer")), "context": with_kind(F.col("context")),
    }


def _values(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A table of a few thousand rows of kinds, feature values (letters, digits, bars) and numbers, written as SQL."""
    def literal(x) -> str:
        return f"'{x}'" if isinstance(x, str) else f"{x!r}D" if isinstance(x, float) else str(x)

    lines = ", ".join(f"({', '.join(map(literal, r))})" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {lines} AS t({', '.join(f'`{n}`' for n in names)})")


def classify(voted: DataFrame) -> DataFrame:
    """``voted`` candidates with ``p``, the classifier's probability that they are personal data."""
    patterns = voted.filter("kind IS NOT NULL").groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()
    _, _, post = reliabilities([(r["kind"], tuple(r[x] for x in LABELERS), r["n"]) for r in patterns])
    if not post:
        return voted.withColumn("p", F.lit(None).cast("double"))
    spark = voted.sparkSession
    table = _values(spark, [(k, *v, p) for (k, v), p in sorted(post.items())], ["kind", *LABELERS, "soft"])
    weighed = voted.join(F.broadcast(table), ["kind", *LABELERS], "left")
    feats = _features()
    named = weighed.withColumns({f"f_{k}": v for k, v in feats.items()})
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), F.col(f"f_{k}").alias("value")) for k in feats])).alias("e")
    known = named.filter("kind IS NOT NULL")
    # per feature at most 5 kinds x 256 values
    seen = (known.select("soft", pairs).groupBy("e.feature", "e.value")
            .agg(F.sum("soft").alias("yes"), F.sum(1 - F.col("soft")).alias("no")).collect())
    total = known.groupBy("kind").agg(F.sum("soft").alias("yes"), F.sum(1 - F.col("soft")).alias("no")).collect()
    base = {r["kind"]: (r["yes"] + 1, r["no"] + 1) for r in total}
    values: dict[tuple[str, str], set] = {}
    for r in seen:
        values.setdefault((r["feature"], r["value"].split("|")[0]), set()).add(r["value"])
    odds = []
    for r in seen:
        kind = r["value"].split("|")[0]
        size = len(values[r["feature"], kind])
        yes, no = base[kind]
        odds.append((r["feature"], r["value"], math.log((r["yes"] + 1) / (yes + size)) - math.log((r["no"] + 1) / (no + size))))
    score = F.lit(0.0)
    for kind, (yes, no) in sorted(base.items()):
        score = F.when(F.col("kind") == kind, F.lit(math.log(yes / no))).otherwise(score)
    weights = _values(spark, sorted(odds), ["feature", "value", "w"])
    for k in feats:
        part = weights.filter(F.col("feature") == k).select(F.col("value").alias(f"f_{k}"), F.col("w").alias(f"w_{k}"))
        named = named.join(F.broadcast(part), f"f_{k}", "left")
        score = score + F.coalesce(f"w_{k}", F.lit(0.0))
    p = F.when(F.col("kind").isNotNull(), 1 / (1 + F.exp(-score)))
    return named.withColumn("p", p).select(*voted.columns, "p")


def spans(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row a document: ``row``, the id, ``base`` and ``added``, arrays of (start, rank of the kind, end, kind, match, p) in order."""
    found = cut_lineage(classify(votes(cut_lineage(candidates(docs, text, id_col)))))
    rank = F.array_position(F.array(*[F.lit(k) for k in ORDER]), F.col("kind")).cast("int")
    is_base = F.coalesce(F.col("base") & F.col("ok") & F.col("kind").isNotNull(), F.lit(False))
    taken = found.withColumns({"rank": rank, "own": is_base}).withColumn("taken", F.col("own") | F.coalesce(F.col("p") > 0.5, F.lit(False)))
    order = Window.partitionBy("row").orderBy("start", F.col("own").desc(), "end", "rank")
    ended = F.max(F.when(F.col("taken"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # backwards, as a frame that ends at the last row takes the square of the rows
    back = Window.partitionBy("row").orderBy(F.col("start").desc(), "own", F.col("end").desc(), F.col("rank").desc())
    begins = F.min(F.when(F.col("own"), F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    clear = (F.coalesce(ended, F.lit(0)) <= F.col("start")) & (F.coalesce(begins, F.col("end")) >= F.col("end"))
    one = F.struct("start", "rank", "end", "kind", "match", "p")
    marked = taken.withColumn("more", F.col("taken") & ~F.col("own") & clear)
    return marked.groupBy("row").agg(
        F.first("id").alias(id_col), F.sort_array(F.collect_list(F.when(F.col("own"), one))).alias("base"),
        F.sort_array(F.collect_list(F.when(F.col("more"), one))).alias("added"))


def count_of(items: Column | str, kind: str) -> Column:
    return F.size(F.filter(items, lambda s: s["kind"] == kind)).cast("long")


def listed(items: Column) -> Column:
    """kind:start:end of an array of spans, in its order, comma-joined."""
    return F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, start, end, kind, match, p): one row a span of ``spans``, for masking or review."""
    return (spans(docs, text, id_col).select(id_col, F.explode(F.sort_array(F.concat("base", "added"))).alias("s"))
            .select(id_col, "s.start", "s.end", "s.kind", "s.match", "s.p"))
