from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from valuator.llm import line_dedup, simhash_dedup, substring_dedup
from valuator.llm.common import connected_components
from valuator.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def oracle_rows(name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    d = con.execute(ORACLE[name])
    cols = [c[0] for c in d.description]
    return sorted(tuple(dict(zip(cols, r))[c] for c in sorted(cols)) for r in d.fetchall())


def spark_rows(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def test_components_match_union_find(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(2000, 2001 + i) for i in range(200)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(frame(spark, edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(frame(spark, [], "a long, b long")).count() == 0


# ------------------------------------------------------------------ substring dedup
def test_repeated_lines_match_sql(spark):
    assert spark_rows(QUERIES["op1_substring_dedup"](spark, SF)) == oracle_rows("op1_substring_dedup")


def test_repeated_spans_edges(spark):
    docs = frame(spark, [(2, "One  two\n\nb"), (1, "x\none Two\nx"), (None, "x"), (3, None), (4, ""), (5, "\n \n"), (2, "b"), (6, "é b\nÉ  b")])
    got = {(r["doc_id"], r["unit"], r["start"], r["end"], r["n"], r["first_id"], r["first_unit"])
           for r in substring_dedup.repeated_spans(docs).collect()}
    assert got == {(2, 0, 0, 8, 2, 1, 1), (1, 2, 10, 11, 3, 1, 0), (None, 0, 0, 1, 3, 1, 0), (2, 0, 0, 1, 2, 2, 1), (6, 1, 4, 8, 2, 6, 0)}
    assert substring_dedup.repeated_spans(docs.filter("doc_id > 99")).count() == 0
    spans = substring_dedup.repeated_spans(docs)
    texts = sorted((str(r[0]), r[1]) for r in substring_dedup.without_spans(docs, spans).collect())
    assert texts == sorted([("2", "\nb"), ("1", "x\none Two\n"), ("None", ""), ("3", None), ("4", ""), ("5", "\n \n"), ("2", ""), ("6", "é b\n")])


def test_paragraph_units_and_clashing_columns(spark):
    docs = frame(spark, [(1, "a b\nc\n\nd e", 7, "q"), (2, "A  B\nC\n \nz", 8, "q")], "doc_id long, text string, unit int, h1 string")
    got = substring_dedup.repeated_spans(docs, unit="paragraph", min_words=3).collect()
    assert [(r["doc_id"], r["start"], r["end"], r["first_id"]) for r in got] == [(2, 0, 6, 1)]


def test_short_lines_stay(spark):
    docs = frame(spark, [(i, f"And.\nOf the.\nthree words here\nown {i}\n\nAnd.") for i in range(4)] + [(9, None), (10, "And.")])
    spans = substring_dedup.repeated_spans(docs, min_words=3, sentence_words=8)
    assert sorted((r["doc_id"], r["unit"], r["first_id"]) for r in spans.collect()) == [(i, 2, 0) for i in (1, 2, 3)]
    text = {r["doc_id"]: r["text"] for r in substring_dedup.without_spans(docs, spans).collect()}
    assert text[0] == "And.\nOf the.\nthree words here\nown 0\n\nAnd." and text[2] == "And.\nOf the.\nown 2\n\nAnd." and text[10] == "And."


def test_passages_inside_lines_are_found(spark):
    passage = ". ".join(" ".join(f"w{i}x{j}" for j in range(9)) for i in range(6)) + "."
    docs = frame(spark, [(i, f"own{i} words, {passage} then on {i} ends.\nshort same. line {i}\n{'whole line here. ' * (i > 5)}") for i in range(8)])
    spans = substring_dedup.repeated_spans(docs, sentence_words=8).collect()
    # the first sentence is joined with what stands before it, the other five repeat; short ones do not count
    inner = [r for r in spans if r["level"] == 1]
    assert sorted(r["doc_id"] for r in inner) == sorted(i for i in range(1, 8) for _ in range(5)) and {r["first_id"] for r in inner} == {0}
    assert [(r["doc_id"], r["level"]) for r in spans if r["level"] == 0] == [(7, 0)]
    text = {r["doc_id"]: r["text"] for r in substring_dedup.without_spans(docs, substring_dedup.repeated_spans(docs, sentence_words=8)).collect()}
    assert text[3] == "own3 words, w0x0 w0x1 w0x2 w0x3 w0x4 w0x5 w0x6 w0x7 w0x8. then on 3 ends.\nshort same. line 3\n"
    again = substring_dedup.repeated_spans(frame(spark, [(1, "a b c. d e f."), (2, "a b c. d e f.")]), sentence_words=2).collect()
    assert [(r["doc_id"], r["level"]) for r in again] == [(2, 0)]


def test_passages_cut_at_both_ends_are_found(spark):
    rng = np.random.default_rng(50)
    own = lambda n: " ".join(f"u{x}" for x in rng.integers(0, 10**9, n))
    passages = [" ".join(f"p{x}" for x in rng.integers(0, 10**6, 50)) for _ in range(100)]
    rows = [(k, f"{own(7)} {p} {own(9)}") for k, p in enumerate(passages)] + [(100 + k, f"{own(12)} {p}  {own(3)}") for k, p in enumerate(passages)]
    docs = frame(spark, rows)
    assert substring_dedup.repeated_spans(docs, sentence_words=8).count() == 0
    spans = substring_dedup.repeated_spans(docs, sentence_words=8, passage_words=8)
    texts = dict(rows)
    found = {}
    for r in spans.collect():
        assert r["doc_id"] == 100 + r["first_id"] and texts[r["doc_id"]][r["start"]:r["end"]] in passages[r["first_id"]]
        found.setdefault(r["first_id"], set()).update(texts[r["doc_id"]][r["start"]:r["end"]].split())
    share = [len(found.get(k, ())) / 50 for k in range(100)]
    print("coverage", np.mean(share), min(share), sum(x < 0.5 for x in share))
    assert min(share) > 0 and np.mean(share) > 0.6
    left = {r["doc_id"]: r["text"].split() for r in substring_dedup.without_spans(docs, spans).collect()}
    assert all(left[k] == texts[k].split() for k in range(100))
    assert all(left[100 + k] == [w for w in texts[100 + k].split() if w not in found[k]] for k in range(100))


def test_long_passages_are_found_in_all_copies(spark):
    body = " ".join(f"w{i}" for i in range(60))
    docs = frame(spark, [(i, f"start {i}\n{body}\nend {i}") for i in range(40)])
    got = substring_dedup.repeated_spans(docs, min_words=20)
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(1, 40))


# ------------------------------------------------------------------ line dedup
def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left = row[:]
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(left[j] + 1, row[j - 1] + 1, left[j - 1] + (x != y)))
    return row[-1]


def mutated(rng, s, k):
    s = list(s)
    for _ in range(k):
        at = int(rng.integers(0, len(s)))
        kind = int(rng.integers(0, 3))
        if kind == 0:
            s[at] = "#"
        elif kind == 1:
            s.insert(at, "é")
        else:
            del s[at]
    return "".join(s)


@pytest.mark.parametrize("max_edits", [1, 2, 3])
def test_linked_lines_match_brute_force(spark, max_edits):
    rng = np.random.default_rng(max_edits)
    base = ["".join(rng.choice(list("abc "), 24)).strip().ljust(20, "x") for _ in range(30)]
    lines = sorted({mutated(rng, b, int(rng.integers(0, 4))) for b in base for _ in range(6)})
    want = {frozenset((a, b)) for i, a in enumerate(lines) for b in lines[:i] if edits(a, b) <= max_edits and min(len(a), len(b)) >= 16}
    df = frame(spark, [(i, x) for i, x in enumerate(lines)], "h long, line string")
    got = {frozenset((lines[r["a"]], lines[r["b"]])) for r in line_dedup.linked_lines(df, max_edits, 16).collect()}
    assert got == want


def within(a, b, most):
    """a and b are at most so many edits apart; an edit changes two letter counts at most."""
    if abs(len(a) - len(b)) > most:
        return False
    x, y = Counter(a), Counter(b)
    return sum(((x - y) | (y - x)).values()) <= 2 * most and edits(a, b) <= most


def brute_lines(rows, max_edits, min_chars):
    lines = [(d, k, x.strip(" \t\r").lower()) for d, t in rows for k, x in enumerate((t or "").split("\n")) if x.strip(" \t\r")]
    big = lambda d: (d is None, d)
    first, count = {}, {}
    for d, k, x in lines:
        r = (d is None, d or 0, k)
        first[x] = min(first.get(x, r), r)
        count[x] = count.get(x, 0) + 1
    near = {x: [y for y in first if y != x and min(len(x), len(y)) >= min_chars and within(x, y, max_edits)] for x in first}
    return sorted((str(d), k, count[x], len(near[x]), (d is None, d or 0, k) == min([first[x], *(first[y] for y in near[x])])) for d, k, x in lines)


def test_line_classes_match_brute_force(spark):
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcdefgh "), 40)).strip().ljust(36, "y") for _ in range(20)]
    rows = [(i, "\n".join(mutated(rng, base[int(j)], int(rng.integers(0, 3))) if rng.random() < 0.5 else base[int(j)].upper()
                          for j in rng.integers(0, 20, 5))) for i in range(30)]
    rows += [(100, None), (101, ""), (102, " \n\n"), (None, base[0]), (103, "ab\nab\nac"), (103, "ab")]
    got = line_dedup.line_classes(frame(spark, rows))
    assert sorted((str(r["doc_id"]), r["line_no"], r["n_copies"], r["n_links"], r["keep"]) for r in got.collect()) == brute_lines(rows, 2, 32)
    assert line_dedup.line_classes(frame(spark, [])).count() == 0


def test_edits_grow_with_the_line(spark, monkeypatch):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 9)))) for _ in range(60)]
    base = [" ".join(rng.choice(words, n)) for n in (12, 13, 14, 20, 30, 60, 100) for _ in range(3)]
    lines = {mutated(rng, b, int(rng.integers(0, len(b) // 16))) for b in base for _ in range(5)}
    changed = [b.split() for b in base]
    for w in changed:
        w[len(w) // 2] = "zzzz"
    lines = sorted(lines | {" ".join(w) for w in changed} | set(base))
    size = {x: len(x) for x in lines}
    want = {frozenset((a, b)) for i, a in enumerate(lines) for b in lines[:i]
            if min(size[a], size[b]) >= 32 and within(a, b, max(2, min(size[a], size[b]) // 20))}
    assert sum(1 for p in want if not within(*p, 2)) > 40
    df = frame(spark, [(i, x) for i, x in enumerate(lines)], "h long, line string")
    for common, piece in ((64, 200), (2, 50)):
        monkeypatch.setattr(line_dedup, "COMMON_GRAM", common)
        monkeypatch.setattr(line_dedup, "PIECE_CHARS", piece)
        got = [frozenset((lines[r["a"]], lines[r["b"]])) for r in line_dedup.linked_lines(df, 2, 32, None, 0.05).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_short_lines_are_linked(spark):
    rng = np.random.default_rng(12)
    base = ["".join(rng.choice(list("abcd "), n)).strip().ljust(n, "x") for n in (9, 11, 12, 13, 15, 16, 17, 24, 31, 33) for _ in range(3)]
    lines = sorted({mutated(rng, b, int(rng.integers(0, 4))) for b in base for _ in range(6)} | {"heti eror anesti.", "heti, eror anesti."})
    allowed = lambda n: 0 if n < 12 else 1 if n < 16 else 2
    want = {frozenset((a, b)) for i, a in enumerate(lines) for b in lines[:i] if 0 < edits(a, b) <= allowed(min(len(a), len(b)))}
    got = line_dedup.line_classes(frame(spark, [(i, x) for i, x in enumerate(lines)])).filter("n_links > 0")
    assert {r["doc_id"]: r["n_links"] for r in got.collect()} == Counter(lines.index(x) for p in want for x in p)
    kept = line_dedup.without_repeated_lines(frame(spark, [(1, "heti eror anesti."), (2, "heti, eror anesti."), (3, "ab"), (4, "ac")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_unchanged_runs_hold_a_window():
    for least, window in line_dedup.gram_classes(60, 0.05)[:12]:
        for n in range(least, least + 300):
            assert -(-(n - n // 20) // (n // 20 + 1)) >= window + line_dedup.GRAM - 1


def test_texts_lose_repeated_lines(spark):
    long = "this is a line of more than thirty-two characters"
    docs = frame(spark, [(1, f"a\n{long}\n\nb", 1), (2, f"c\n\n{long}s\nA\nd", 2), (3, f"{long}", 3), (4, None, 4), (5, "", 5), (None, "a", 6)],
                 "doc_id long, text string, line_no int")
    got = {(r["doc_id"], r["text"], r["line_no"]) for r in line_dedup.without_repeated_lines(docs).collect()}
    assert got == {(1, f"a\n{long}\n\nb", 1), (2, "c\n\nd", 2), (4, None, 4), (5, "", 5), (None, "a", 6)}


def test_line_join_is_native(spark):
    plan = QUERIES["op6_line_dedup"](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ------------------------------------------------------------------ SimHash near-dedup
def plain_simhash(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def test_every_word_has_one_anchor_within_the_covering_radius(spark):
    rows = [(int(x),) for x in np.random.default_rng(0).integers(-2**63, 2**63 - 1, 50)]
    got = [r["s"] for r in frame(spark, rows, "fp long").select(simhash_dedup.syndrome(simhash_dedup.F.col("fp")).alias("s")).collect()]
    for (x,), s in zip(rows, got):
        want = 0
        for i in range(1, 64):
            want ^= i if x >> (i - 1) & 1 else 0
        assert s == want
    near = simhash_dedup.flips(1)
    assert sorted(s for s, _ in near) == list(range(64))


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_no_link_is_missed(spark, max_bits):
    rng = np.random.default_rng(max_bits)
    base = [int(x) for x in rng.integers(0, 2**64, 40, dtype=np.uint64)]
    words = set(base)
    for b in base:
        for _ in range(6):
            x = b
            for bit in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                x ^= 1 << int(bit)
            words.add(x)
    words = sorted(words)
    signed = {x: x - (1 << 64) if x >> 63 else x for x in words}
    want = {frozenset((signed[a], signed[b])) for i, a in enumerate(words) for b in words[:i] if (a ^ b).bit_count() <= max_bits}
    got = simhash_dedup.linked_fingerprints(frame(spark, [(x,) for x in signed.values()], "fp long"), max_bits)
    assert {frozenset((r["a"], r["b"])) for r in got.collect()} == want


def test_groups_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(9001, None), (9002, ""), (9003, " \t"), (9004, "One two"), (9005, "one TWO"), (9006, rows[0][1]), (9006, rows[0][1])]
    fp = {i: plain_simhash(t) for i, t in rows}
    parent = {i: i for i in fp}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fp)
    for i in ids:
        for j in ids:
            if j < i and (fp[i] ^ fp[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    got = simhash_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == sorted((i, fp[i], find(i)) for i, _ in rows)
    kept = simhash_dedup.keep_one_of_each(frame(spark, rows + [(None, "one two"), (None, "no other one")]))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted([str(i) for i in ids if find(i) == i] + ["None"])


def test_long_texts_hash_in_chunks(monkeypatch):
    text = " ".join(f"W{i % 97} x" for i in range(500))
    monkeypatch.setattr(simhash_dedup, "CHUNK_WORDS", 7)
    assert simhash_dedup.simhash64(text) == plain_simhash(text)


def test_simhash_of_no_rows(spark):
    assert simhash_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_grams_are_made_once(spark):
    """The count of common grams and both sides of the join read one exchange: a filter that only some of them had made it twice."""
    lines = frame(spark, [(i, f"line number {i} " * 6) for i in range(40)], "h long, line string").withColumn("size", F.length("line"))
    found = line_dedup.gram_candidates(lines, 60, 0.05)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    made = [x for x in plan.split("\n") if "REPARTITION_BY_COL" in x and "Reused" not in x]
    assert len(made) == 1 and "ReusedExchange" in plan


def test_short_lines_are_read_once(spark, monkeypatch):
    """With a share, segments are cut from kept short lines only: each range and side had read, trimmed and lowered all lines anew."""
    seen, plain = [], line_dedup.segment_candidates
    monkeypatch.setattr(line_dedup, "segment_candidates", lambda rows, ranges: seen.append(rows) or plain(rows, ranges))
    df = frame(spark, [(1, "a line of about thirty characters"), (2, "a line of about thirty charakters"), (3, "a much longer line " * 5)], "h long, line string")
    got = line_dedup.linked_lines(df, 2, 32, None, 0.05, ((12, 1), (16, 2))).collect()
    assert [sorted((r["a"], r["b"])) for r in got] == [[1, 2]]
    assert sorted(r["size"] for r in seen[0].collect()) == [33, 33] and seen[0]._jdf.queryExecution().optimizedPlan().toString().startswith("LogicalRDD")
