import hashlib
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from valuator.llm import byte_bpe, decontaminate, fingerprints, language_id, packing, sharding
from valuator.llm.queries import QUERIES
from tests.llm.test_dedup import brute_lines, plain_simhash

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------ fingerprints
def plain_edits(rows):
    """n_chars, hash of the edited text, and likenesses, by id order; rows are (id, text) with different ids."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        new = t[:len(t) - half] + nxt[:half]
        a, b, c = (fingerprints.fingerprint(x) for x in (t, new, nxt))
        out[d] = (len(t), hashlib.sha256(new.encode()).hexdigest(), a.hex(), b.hex(), fingerprints.likeness(a, b), fingerprints.likeness(a, c))
    return out


COLS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_fingerprint_is_the_weighted_vote():
    import xxhash
    text = "a b c a b c a b d"
    words = text.split()
    votes = np.zeros(128)
    for t, n in Counter(zip(words, words[1:], words[2:])).items():
        h = int.from_bytes(xxhash.xxh3_128_digest(" ".join(t)), "big")
        votes += (1 + np.log(n)) * np.array([1 if h >> (127 - k) & 1 else -1 for k in range(128)])
    assert fingerprints.fingerprint(text) == sum(1 << (127 - k) for k in range(128) if votes[k] > 0).to_bytes(16, "big")
    assert fingerprints.fingerprint(None) == fingerprints.fingerprint(" ") == bytes(16)


def test_edited_fingerprints_match_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in QUERIES["op4_document_fingerprints"](spark, SF).collect()}
    assert got == plain_edits(rows)
    near = [r for r in got.values() if r[0] > 400]
    assert sum(r[4] > r[5] for r in near) > 0.95 * len(near)


@pytest.mark.parametrize("rows", [
    [], [(1, "only one é"), ], [(5, None), (None, "last of all"), (3, ""), (2, "x"), (9, "abcdé fgh ijk"), (-4, "日本語テキスト")],
    [(i * 7 % 101, f"text {i} " * (i % 5)) for i in range(101)], [(None, "a b"), ]])
def test_following_documents(spark, rows):
    got = fingerprints.edited_fingerprints(frame(spark, rows)).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLS) for r in got} == plain_edits(rows) and len(got) == len(rows)


def test_repeated_ids_keep_all_rows(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, None), (None, None), (0, "d")] * 5
    got = fingerprints.edited_fingerprints(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((d, len(t or "")) for d, t in rows)


@pytest.mark.parametrize("radius, blocks", [(0, None), (2, None), (3, 4), (3, 6), (5, 8)])
def test_block_tables_miss_nothing(spark, radius, blocks):
    rng = np.random.default_rng(radius)
    words = []
    for _ in range(30):
        base = int.from_bytes(rng.bytes(16), "big")
        words += [base] + [base ^ sum(1 << int(b) for b in rng.choice(128, int(rng.integers(1, 8)), replace=False)) for _ in range(4)]
    fps = [f"{w:032x}" for w in words]
    got = fingerprints.within_radius(frame(spark, [(f,) for f in fps[::3]], "fingerprint string"), frame(spark, [(f,) for f in fps] * 2 + [(None,)], "fingerprint string"), radius, blocks)
    got = [(r["query"], r["fingerprint"], r["bits"]) for r in got.collect()]
    want = {(a, b, (int(a, 16) ^ int(b, 16)).bit_count()) for a, b in product(fps[::3], fps) if (int(a, 16) ^ int(b, 16)).bit_count() <= radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_near_counts_match_brute_force(spark):
    got = QUERIES["op4_document_fingerprints"](spark, SF).collect()
    for r in got:
        near = sum(r["doc_id"] != x["doc_id"] and (int(r["fingerprint"], 16) ^ int(x["fingerprint"], 16)).bit_count() <= 3 for x in got)
        assert r["n_near"] == (near if r["doc_id"] % 50 == 0 else None)


# ------------------------------------------------------------------ sharding
def check_shards(got, shards):
    n = len(got)
    sizes = Counter(r["shard"] for r in got)
    assert sorted(sizes.values(), reverse=True) == sorted((x for x in sharding.shard_sizes(n, shards).tolist() if x), reverse=True)
    for s, size in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(size))


def test_shards_are_exact_and_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op8_sharding"](spark, SF).collect()
    check_shards(got, 8)
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


@pytest.mark.parametrize("n, shards, bucket_rows", [(0, 3, 10), (1, 3, 10), (7, 8, 10), (1000, 8, 9), (1000, 1, 100), (64, 8, 1)])
def test_shard_sizes_of_any_table(spark, n, shards, bucket_rows):
    rows = spark.range(n, numPartitions=7).selectExpr("IF(id % 3 = 0, NULL, id) AS doc_id", "'x' AS shard")
    check_shards(sharding.shard_uniformly(rows, shards, bucket_rows=bucket_rows).collect(), shards)


def test_same_seed_same_shuffle_and_another_seed_another(spark):
    rows = spark.range(500, numPartitions=5)
    a, b, c = ({r["id"]: (r["shard"], r["slot"]) for r in sharding.shard_uniformly(rows, 4, seed=s).collect()} for s in (1, 1, 2))
    assert a == b and a != c


def test_matrix_has_exact_margins_and_the_right_law():
    counts, sizes = np.array([5, 0, 20, 7, 100]), np.array([33, 33, 33, 33])
    m = np.array([sharding.matrix_row(counts, sizes, p, 3) for p in range(5)])
    assert m.sum(axis=0).tolist() == sizes.tolist() and m.sum(axis=1).tolist() == counts.tolist()
    # a cell of a uniform shuffle is hypergeometric: its mean and variance over many seeds
    cells = np.array([sharding.matrix_row(np.array([6, 10]), np.array([8, 8]), 0, s)[0] for s in range(4000)])
    mean, var = 6 * 8 / 16, 6 * (8 / 16) * (8 / 16) * (10 / 15)
    assert abs(cells.mean() - mean) < 0.08 and abs(cells.var() - var) < 0.12


def test_every_row_goes_everywhere_alike(spark):
    places = Counter()
    for seed in range(120):
        out = np.concatenate([sharding.assignment(np.array([3, 5]), np.array([4, 4]), p, seed) for p in (0, 1)])
        places.update(enumerate(out.tolist()))
    assert all(35 <= places[i, b] <= 85 for i in range(8) for b in (0, 1))


def test_large_populations_keep_their_margins():
    counts, sizes = np.array([3 * 10**9, 10**9, 7]), np.array([10**9, 3 * 10**9, 7])
    rows = [sharding.matrix_row(counts, sizes, p, 1) for p in range(3)]
    assert sum(rows).tolist() == sizes.tolist() and [int(r.sum()) for r in rows] == counts.tolist() and min(r.min() for r in rows) >= 0


# ------------------------------------------------------------------ packing
@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'stmdlrev.,!1²Ⅷ 　\x1c"), st.characters(codec="utf-8")), max_size=40))
def test_ids_match_the_tokenizer(text):
    bpe = byte_bpe.load(BPE)
    assert list(bpe.ids(text)) == bpe.whole.encode(text, add_special_tokens=False).ids


def test_special_names_are_as_the_tokenizer_has_them():
    bpe = byte_bpe.load(BPE)
    text = "a <|endoftext|> b"
    assert list(bpe.ids(text)) == bpe.whole.encode(text, add_special_tokens=False).ids


def check_packing(got, capacity=2048):
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_sequences_of_all_documents(spark):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(BPE)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op9_best_fit_packing"](spark, SF).collect()
    want = set()
    total = 0
    for r in docs.collect():
        ids = np.array(whole.encode(r["text"] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        total += len(ids)
        pieces = -(-len(ids) // 2048)
        start = 0
        for k in range(pieces):
            size = len(ids) - 2048 * (pieces - 1) if k == 0 else 2048
            want.add((r["doc_id"], k, start, size, zlib.crc32(ids[start:start + size].tobytes())))
            start += size
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    assert check_packing(got) == -(-total // 2048)
    packed = packing.pack(packing.token_pieces(docs, BPE, with_ids=True))
    seqs = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in seqs) == total and max(len(r["ids"]) for r in seqs) <= 2048


def test_packing_edges(spark):
    docs = frame(spark, [(1, None), (None, ""), (2, "a" * 9000), (2, "a" * 9000), (3, "the " * 10000)])
    got = packing.pack(packing.token_pieces(docs, BPE)).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in got if r["length"] == 1) == [("1", 1), ("None", 1)]
    check_packing(got)
    assert packing.pack(packing.token_pieces(docs.filter("doc_id > 9"), BPE)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(frame(spark, [(1, 2049)], "doc_id long, length long"))


def best_fit_decreasing(sizes, capacity):
    rooms = []
    for v in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= v]
        if fits:
            r = min(fits)
            rooms[rooms.index(r)] -= v
        else:
            rooms.append(capacity - v)
    return len(rooms)


def optimum(sizes, capacity):
    sizes, best = sorted(sizes, reverse=True), len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                go(i + 1, rooms[:k] + [rooms[k] - sizes[i]] + rooms[k + 1:])
        go(i + 1, rooms + [capacity - sizes[i]])

    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=11))
def test_bin_completion_is_valid_and_near_the_optimum(sizes):
    counts = np.bincount(sizes, minlength=41)
    plan = packing.complete_bins(counts, 40, 3000)
    assert Counter(v for t, f in plan for v in f for _ in range(t)) == Counter(sizes)
    assert all(sum(f) <= 40 for _, f in plan)
    bins = sum(t for t, _ in plan)
    assert optimum(sizes, 40) <= bins <= best_fit_decreasing(sizes, 40) and bins >= packing.lower_bound(counts, 40)
    if len(set(sizes)) == len(sizes):
        assert bins == optimum(sizes, 40)


# ------------------------------------------------------------------ pipeline
def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(9001, "12 34 !!", None, "x", 8), (9002, None, "en", "x", None), (9003, docs.first()["text"], None, "x", 1)]
    docs = docs.unionByName(frame(spark, extra, docs.schema))
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), None) if name != corpus_pipeline.STAGES[-1][0] else stage(spark, docs, SF)
        out[name] = before, docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert sorted(docs.columns) == sorted(columns)
    before, after = out["language_id"]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {9001, 9002}
    assert all(r["lang"] for r in after)
    before, after = out["line_dedup"]
    lines = brute_lines([(r["doc_id"], r["text"]) for r in before], 2, 32)
    lost = {(int(d), k) for d, k, _, _, keep in lines if not keep}
    want = {}
    for r in before:
        rest = [x for k, x in enumerate(r["text"].split("\n")) if (r["doc_id"], k) not in lost]
        if any(x.strip(" \t\r") for x in rest):
            want[r["doc_id"]] = "\n".join(rest)
    assert {r["doc_id"]: r["text"] for r in after} == want and all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = out["simhash_near_dedup"]
    kept = {r["doc_id"] for r in after}
    fp = {r["doc_id"]: plain_simhash(r["text"]) for r in before}
    group = {i: i for i in fp}
    for _ in fp:
        for i in fp:
            for j in fp:
                if (fp[i] ^ fp[j]).bit_count() <= 2 and group[j] < group[i]:
                    group[i] = group[j]
    assert kept == {i for i in fp if group[i] == i}
    before, after = out["benchmark_decontamination"]
    matcher = decontaminate.Matcher([r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r, hits in zip(before, matcher.find([r["text"] for r in before])) if not hits}
    before, after = out["best_fit_packing"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    check_packing(after)


def test_language_stage_predicts_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = corpus_pipeline.identify_language(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_run_is_the_chain_of_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    key = lambda rows: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows)
    assert key(corpus_pipeline.run(spark, SF).collect()) == key(docs.collect())


def test_rows_that_share_an_id_lose_their_own_lines_only(spark):
    from valuator.llm import line_dedup
    a, b = "the first of the two lines is here", "quite another line that nobody repeats"
    rows = [(0, a, "x"), (1, a, "y"), (1, b, "z"), (2, None, "n"), (2, "", "e"), (2, f"{b}\n\n{a}\nwholly new words at the end", "w"), (None, a, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = {r.source: r.text for r in line_dedup.without_repeated_lines(docs).collect()}
    assert got == {"x": a, "z": b, "n": None, "e": "", "w": "\nwholly new words at the end", "k": a}
