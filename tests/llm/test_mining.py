"""Personal data, conversation repair and hard negatives against brute force, with their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from valuator.llm import conversations, hard_negatives, private_data, queries

# ------------------------------------------------------------------ op11
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c)
        total += (x * 2 - 9 if x > 4 else x * 2) if i % 2 else x
    return total % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")))
                    or (kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)) or (kind == "phone" and 10 <= len(digits) <= 15)):
                out.append((m.start(), rank, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(out)]


def spans_of(rows, which):
    return [(s.start, s.end, s.kind) for s in rows[which]]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(5)
    chars = "a1 2.@+-()[]0:5é😀%_\n"
    rows = [(i, None if i == 0 else "".join(rng.choice(chars) for _ in range(rng.choice([0, 5, 40, 200])))) for i in range(1500)]
    rows += [(7, "me@x.org 4111 1111 1111 1111"), (7, "+1 (234) 567-8901"), (None, "a@b.c_d@e.f 1.2.3.4.5.6.7.8 001.2.3.256")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = private_data.spans(docs).collect()
    assert Counter((r.doc_id, tuple(spans_of(r, "base"))) for r in got) == Counter((i, tuple(base_spans(t or ""))) for i, t in rows)


def test_long_runs_end(spark):
    """Runs that make a plain pattern quadratic or recursive; one match each where there is one."""
    n = 100_000
    rows = [(0, "1" * n), (1, "a" * n), (2, "a@" + "b." * n + "c"), (3, "+1" + "(" * n), (4, "1-" * n + "1"), (5, "1.2.3.4 " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: spans_of(r, "base") for r in private_data.spans(docs).collect()}
    assert got[0] == got[1] == got[3] == got[4] == []
    assert got[2] == [(0, 2 * n + 3, "email")]
    assert got[5] == [(8 * i, 8 * i + 7, "ip") for i in range(5000)]


def test_private_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    out = queries.op11_private_data(spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        want = base_spans(docs[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for _, _, k in want) for x in PATTERNS)
        listed = [x for x in r.spans.split(",") if x]
        assert {f"{k}:{s}:{e}" for s, e, k in want} <= set(listed)
        starts = [int(x.split(":")[1]) for x in listed]
        assert starts == sorted(starts)


def test_labelers_find_more_than_patterns(spark):
    """Keys after cue words and national numbers come in; hashes of commits, dates, long words and failed cards stay out."""
    rng = random.Random(2)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    rows = [(i, f'set token = "{h}" and go') for i, h in enumerate(hexes)]
    rows += [(100 + i, f"call me at ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)} today") for i in range(60)]
    rows += [(200 + i, f"phone +1 {rng.randint(200, 999)} {rng.randint(200, 999)} {rng.randint(1000, 9999)} or x{i}@mail.org") for i in range(60)]
    rows += [(300 + i, f"order 99999999999999{i:02d}9x, the antidisestablishmentarianism of 2024-01-{i % 28 + 1:02d} is long") for i in range(60)]
    got = {r.doc_id: r for r in private_data.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = lambda lo, kind: sum(any(s.kind == kind for s in got[lo + i].added) for i in range(60))
    assert found(0, "secret") >= 57
    assert found(100, "phone") >= 57
    assert sum(len(got[300 + i].added) for i in range(60)) <= 3
    for r in got.values():
        both = sorted(spans_of(r, "base") + spans_of(r, "added"))
        assert all(a[1] <= b[0] for a, b in zip(both, both[1:]) if a in spans_of(r, "added") or b in spans_of(r, "added"))


def test_em_finds_reliabilities_of_simulated_labelers():
    rng = random.Random(0)
    right = [0.95, 0.9, 0.8, 0.7, 0.9]
    counts, truth = Counter(), {}
    for _ in range(20000):
        y = rng.random() < 0.4
        votes = tuple(0 if rng.random() < 0.2 else (1 if y == (rng.random() < p) else -1) for p in right)
        counts[votes] += 1
        truth.setdefault(votes, []).append(y)
    prior, like, post = private_data.reliabilities([("k", v, n) for v, n in counts.items()])
    assert abs(prior["k"] - 0.4) < 0.03
    for i, p in enumerate(right):
        assert abs(like[i, 1, 1] / (like[i, 1, 1] + like[i, 1, -1]) - p) < 0.04
    hits = sum(sum(y == (post["k", v] > 0.5) for y in ys) for v, ys in truth.items())
    assert hits / 20000 > 0.95


def test_private_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert private_data.spans(empty).collect() == []
    odd = spark.createDataFrame([("a", "x@y.zz", 1, "k", 5)], "doc_id string, text string, row int, kind string, base int")
    assert spans_of(private_data.spans(odd).first(), "base") == [(0, 6, "email")]
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted((r.doc_id, r.base, r.added) for r in private_data.spans(blank).collect()) == [(1, [], []), (2, [], [])]


def test_private_plan_is_native(spark):
    plan = private_data.candidates(spark.createDataFrame([(1, "a")], "doc_id long, text string").select("doc_id", "text"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", text)


# ------------------------------------------------------------------ op12
WHITE = " \t\n\x0b\x0c\r"
ROLE, NEXT = {2: "user", 3: "assistant"}, {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if h:
            x = "" if h == 1 else re.sub("[.!?]", "", x) if h == 2 else x
            out += [(c, t, "user" if h == 4 else r, x)] * (2 if h == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for r, x in rows:
        s = x.strip(WHITE)
        out.append("b" if not s else "d" if (r, x) in seen else "" if s[-1] in ".!?" else "t")
        seen.add((r, x))
    return out


def cheapest_way(rows, faults):
    """Dynamic program over whole strings."""
    def put(d, k, v):
        if k not in d or v[:2] < d[k][:2]:
            d[k] = v

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for k, (c, a, t) in list(best.items()):
                put(best, NEXT[k], (c + 5, a + "I", t + ((ROLE[NEXT[k]], ""),)))
        return best

    best = {0: (0, "", ())}
    for (r, x), f in zip(rows, faults):
        new = {}
        for k, (c, a, t) in inserted(best).items():
            put(new, k, (c + 2, a + "D", t))
            if f not in ("b", "d"):
                extra = 5 if f == "t" else 0
                if (r[:1], k) in KEPT:
                    put(new, KEPT[r[:1], k], (c + extra, a + "K", t + ((r, x),)))
                put(new, NEXT[k], (c + extra + 1, a + "R", t + ((ROLE[NEXT[k]], x),)))
        best = new
    return min((v for k, v in inserted(best).items() if k in (0, 3)), key=lambda v: v[:2])


def brute_conversations(rows):
    groups, out = {}, {}
    for r in damage(rows):
        groups.setdefault(r[0], []).append(r)
    for c in {r[0] for r in rows}:
        mine = sorted(groups.get(c, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:32], hashlib.md5(r[3].encode()).digest()))
        turns = [r[1] for r in mine if r[1] is not None]
        pairs = [(r[2], r[3]) for r in mine]
        f = faults_of(pairs)
        cost, audit, left = cheapest_way(pairs, f)
        initials = [r[:1] for r, _ in pairs]
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, f.count("b"), f.count("d"), f.count("t"),
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                  hashlib.sha256("\n".join(f"{r}:{x}" for r, x in left).encode()).hexdigest())
    return out


def odd_conversations(seed, ids):
    rng = random.Random(seed)
    texts = [None, "", "Hi.", "Hi", "What?", "Ok!  ", " ", "Longer text of thirty-two characters and more."]
    return [(c, rng.choice([None, i, i, i, i + 3]), rng.choice(["user", "assistant", "system", "user", "assistant", None, "tool", ""]),
             rng.choice([*texts, f"Row {i}.", f"Row {i}"])) for c in ids for i in range(rng.choice([1, 2, 3, 9, 40, 150]))]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("bits", [12, 3])
def test_repair_equals_brute_force(spark, tmp_path, monkeypatch, bits):
    """Nulls in every column, repeated rows, tied turns; with blocks of 8 rows conversations are chained."""
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = odd_conversations(bits, [None, *range(30)])
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_conversation_repair(spark, str(tmp_path)).collect()
    want = brute_conversations(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id


def test_repair_long_conversation_over_blocks(spark, tmp_path, monkeypatch):
    """One conversation holds most rows: it is parted into many blocks, and its audit equals that of one program over all rows."""
    monkeypatch.setattr(conversations, "BLOCK_BITS", 6)
    rng = random.Random(3)
    rows = [(1, i, "user" if rng.random() < 0.9 else "assistant", f"Text {i}" + rng.choice([".", ".", "", "?"])) for i in range(1500)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_conversation_repair(spark, str(tmp_path)).collect()
    assert [tuple(r)[1:] for r in got] == [brute_conversations(rows)[1]]


def test_repaired_rows_are_legal(spark):
    rows = [r for r in odd_conversations(9, range(12)) if r[3] is not None]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", pos int, edit string")
    done = conversations.repaired(frame, conversations.audits(frame)).collect()
    by = {}
    for r in sorted(done, key=lambda r: (r.conv_id, r.pos)):
        by.setdefault(r.conv_id, []).append(r)
    for c, rs in by.items():
        assert [r.pos for r in rs] == list(range(len(rs)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in rs if r.edit != "D"))
        assert sum(r.edit != "I" for r in rs) == sum(x[0] == c for x in rows)


def test_repair_oracle_and_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op12_conversation_repair(spark, str(tmp_path)).collect() == []
    rows = odd_conversations(4, range(15))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = {r[0]: r[1:] for r in con.execute(queries.ORACLE["op12_conversation_repair"]).fetchall()}
    assert got == brute_conversations(rows)


def test_audits_compare_like_strings_even_when_hashes_collide(monkeypatch):
    rng = random.Random(1)
    for mod in (conversations._MOD, 3):  # with 3 hashes collide all the time
        monkeypatch.setattr(conversations, "_MOD", mod)
        t = conversations.Audits()
        text = {0: ""}
        for _ in range(400):
            p = rng.randrange(len(text))
            c = rng.choice("DIKR")
            if text[p] + c not in text.values():
                text[t.add(p, c)] = text[p] + c
        nodes = list(text)
        for _ in range(3000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            x, y = rng.choice("DIKR"), rng.choice("DIKR")
            if not ((text[a] + x).startswith(text[b] + y) or (text[b] + y).startswith(text[a] + x)):
                assert t.less(a, x, b, y) == (text[a] + x < text[b] + y)
        assert all(t.text(n) == text[n] for n in nodes)


# ------------------------------------------------------------------ op13
EMB = "vec_id long, embedding array<float>, label int"


def brute_negatives(rows):
    import math
    known = []
    for n, (i, v, y) in enumerate(rows):
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        known.append((n, i, (y + 1) % 10 if i % 7 == 0 else y, [math.floor(256 * x) for x in v]))
    out = []
    for n, i, y, v in known:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m, z == y) for m, j, z, w in known if m != n)
        for s, j, _, _ in [x for x in scored if x[3]][:5]:
            fit = [x for x in scored if not x[3] and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, j, rank + 1, x[1], -s, -x[0]) for rank, x in enumerate(fit)]
    return sorted(out)


def vectors(seed, n, dim, shape):
    import struct
    rng = random.Random(seed)
    f32 = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    centers = [[rng.gauss(0, 0.4) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.choice(centers)
        spread = {"clusters": 0.05, "flat": 1.0, "tied": 0.0}[shape]
        rows.append((i, [f32(x + rng.gauss(0, spread)) for x in c], rng.randrange(10)))
    return rows


@pytest.mark.parametrize("shape", ["clusters", "flat", "tied"])
def test_negatives_equal_brute_force(spark, tmp_path, monkeypatch, shape):
    monkeypatch.setattr(hard_negatives, "BLOCK", 256)
    rows = vectors(7, 900, 12, shape)
    rows += [(50, None, 1), (100, rows[3][1], None), (None, rows[4][1], 2), (150, [float("nan")] * 12, 1), (200, [None] * 12, 1),
             (250, [float("inf")] + [0.0] * 11, 3), (50, rows[50][1], rows[50][2]), (-50, rows[9][1], 4), (1000, [0.0] * 12, 3), (1050, [], 3)]
    spark.createDataFrame([(*r, 1, "x") for r in rows], EMB + ", score int, id string").repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r) for r in queries.op13_hard_negatives(spark, str(tmp_path)).collect())
    want = brute_negatives(rows)
    assert want and got == want


def test_tree_covers_and_skips():
    import numpy as np
    rng = np.random.default_rng(0)
    centers = rng.integers(-200, 200, (20, 16))
    points = (centers[rng.integers(0, 20, 3000)] + rng.integers(-3, 4, (3000, 16))).astype(np.int64)
    tree = hard_negatives.CoverTree(points)
    assert sorted(tree.order) == list(range(3000))
    long = float(np.sqrt((points.astype(float) ** 2).sum(1).max()))
    lifted = np.concatenate([points, np.sqrt(np.maximum(long ** 2 - (points ** 2).sum(1), 0))[:, None]], 1)
    for i in range(len(tree.center)):
        below = tree.order[tree.start[i]:tree.stop[i]]
        assert np.sqrt(((lifted[below] - lifted[tree.center[i]]) ** 2).sum(1)).max() <= tree.radius[i] + 1e-6
        assert tree.order[tree.place[i]] == tree.center[i]
    seen = []
    products = tree.products
    tree.products = lambda where, anchor: (seen.append(len(where)), products(where, anchor))[1]
    ids = tree.order.astype(np.int64)
    best = tree.search(points[5], np.ones(3000, bool), ids, 5, [(-(1 << 62), 1 << 62)])[0]
    scores = points @ points[5]
    assert [x[:2] for x in best] == sorted(((int(s), i) for i, s in enumerate(scores)), key=lambda x: (-x[0], x[1]))[:5]
    assert sum(seen) < 1500  # most rows lie under nodes that were skipped


def test_negatives_empty_and_large(spark, tmp_path):
    spark.createDataFrame([], EMB).write.parquet(f"{tmp_path}/a/embeddings.parquet")
    assert queries.op13_hard_negatives(spark, f"{tmp_path}/a").collect() == []
    big = [(0, [1e5, 3.0], 1), (1, [1e5, 2.0], 2), (2, [9e4, 1.0], 1), (3, [1e30, 0.0], 1), (4, [5e4, 0.0], 3)]
    spark.createDataFrame(big, EMB).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    got = sorted(tuple(r) for r in queries.op13_hard_negatives(spark, f"{tmp_path}/b").collect())
    assert got == brute_negatives([r for r in big if r[0] != 3])  # products with row 3 do not fit a long
