"""One query per operator, over the whole of its table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuator.llm import (
    conversations,
    decontaminate,
    fingerprints,
    hard_negatives,
    html_extract,
    language_id,
    line_dedup,
    packing,
    private_data,
    sharding,
    simhash_dedup,
    substring_dedup,
    token_counts,
)
from valuator.llm.common import documents
from valuator.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


#: Words of a line from which on a repeated one is a copy; the SQL has the same number.
LINE_WORDS = 3


@query("op1_substring_dedup", """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents),
placed AS (
  SELECT doc_id, line_no, line, length(line) AS size,
         coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         trim(regexp_replace(lower(line), '\\s+', ' ', 'g')) AS norm
  FROM lines),
units AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS unit FROM placed WHERE norm <> ''),
parts AS (
  SELECT doc_id, unit, start, unnest(pieces) AS part, unnest(range(len(pieces))) AS k
  FROM (SELECT doc_id, unit, start, regexp_extract_all(line, '[^.!?]*[.!?]+|[^.!?]+') AS pieces FROM units) WHERE len(pieces) > 1),
sentences AS (
  SELECT doc_id, unit, length(part) AS size,
         start + coalesce(sum(length(part)) OVER (PARTITION BY doc_id, unit ORDER BY k
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         trim(regexp_replace(lower(part), '\\s+', ' ', 'g')) AS norm
  FROM parts),
ranked AS (
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY level, norm) AS n,
         first_value(doc_id) OVER w AS first_id, first_value(unit) OVER w AS first_unit
  FROM (SELECT 0 AS level, doc_id, unit, start, size, norm FROM units WHERE len(string_split(norm, ' ')) >= 3 UNION ALL
        SELECT 1, doc_id, unit, start, size, norm FROM sentences WHERE len(string_split(norm, ' ')) >= 8)
  WINDOW w AS (PARTITION BY level, norm ORDER BY doc_id, start)),
later AS (SELECT * FROM ranked WHERE rn > 1)
SELECT doc_id, level, unit::INTEGER AS unit, start::BIGINT AS start, (start + size)::BIGINT AS "end", n, first_id,
       first_unit::INTEGER AS first_unit
FROM later l WHERE level = 0 OR NOT EXISTS (SELECT 1 FROM later g WHERE g.level = 0 AND g.doc_id = l.doc_id AND g.unit = l.unit)
""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of lines of 3 words or more, and of sentences of 8 words or more in other lines, that occur earlier in the corpus.
    Shorter lines repeat by chance and stay."""
    return substring_dedup.repeated_spans(documents(spark, sf_dir), min_words=LINE_WORDS, sentence_words=8).drop("row")


@query("op1_pasted_passages")
def op1_pasted_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of op1_substring_dedup, whose SQL knows lines and sentences only, and those of passages cut at both ends."""
    return substring_dedup.repeated_spans(documents(spark, sf_dir), min_words=LINE_WORDS, sentence_words=8, passage_words=8).drop("row")


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the labelled ones that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@query("op3_benchmark_decontamination")
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place where a document holds a benchmark item with at most a fifth of its words edited."""
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op4_document_fingerprints")
def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited form; n_near: for ids divisible by 50, other documents within 3 bits."""
    prints = cut_lineage(fingerprints.edited_fingerprints(documents(spark, sf_dir)))
    chosen = prints.filter("doc_id % 50 = 0")
    pairs = fingerprints.within_radius(chosen, prints, radius=3)
    sizes = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("size"))
    near = pairs.join(sizes, "fingerprint").groupBy("query").agg((F.sum("size") - 1).alias("n_near"))
    asked = chosen.select("doc_id", F.col("fingerprint").alias("query")).join(near, "query").select("doc_id", "n_near").distinct()
    return prints.join(asked, "doc_id", "left")


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces and best score of every document under the 32k vocabulary taken as a unigram model."""
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its class, the links of the class, and whether the line stays."""
    return line_dedup.line_classes(documents(spark, sf_dir))


@query("op7_simhash_near_dedup")
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document: 3-word shingles, 2 bits."""
    out = simhash_dedup.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A uniform shuffle of all documents into 8 shards whose row counts are at most one apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharding.shard_uniformly(documents(spark, sf_dir), shards=8).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, packed into sequences of at most 2,048 tokens."""
    return packing.pack(packing.token_pieces(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")))


@query("op10_html_extraction")
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "has_wrapper")


@query("op11_private_data")
def op11_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans counted by kind and hashed, and all spans."""
    found = private_data.spans(documents(spark, sf_dir).select("doc_id", "text"))
    counts = [private_data.count_of("base", k).alias(f"n_{k}") for k in private_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(private_data.listed(F.col("base")), 256).alias("base_sha256"),
                        private_data.listed(F.sort_array(F.concat("base", "added"))).alias("spans"))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` of conversations with the faults that op12 repairs, drawn by a checksum of conv_id and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    h, role, text = F.col("h"), F.coalesce("role", space), F.coalesce("text", space)
    hit = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("h")).filter("h <> 0")
    text = F.when(h == 1, "").when(h == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return hit.select("conv_id", "turn", F.when(h == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                      F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _repair_sql() -> str:
    """Recursive SQL of op12: per row and state of the pattern the least (cost, audit, text) of all ways, texts of the ways written out."""
    def step(s: str, cost: str, char: str, line: str | None = None) -> str:
        text = f"{s}.t" if line is None else f"{s}.t || chr(10) || {line}"
        return f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + {cost}, 'a': {s}.a || '{char}', 't': {text}}} END"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    user, helper = "'user:'", "'assistant:'"
    one = (f"s0 AS m0, s1 AS m1, {least('s2', *[step(x, '5', 'I', user) for x in ('s0', 's1', 's3')])} AS n2, "
           f"{least('s3', step('s2', '5', 'I', helper))} AS n3")
    two = f"m0, m1, {least('n2', step('n3', '5', 'I', user))} AS m2, {least('n3', step('n2', '5', 'I', helper))} AS m3"
    more = "(CASE WHEN fault = 't' THEN 5 ELSE 0 END)"

    def keep(s: str, initial: str) -> str:
        way = step(s, more, "K", "(role || ':' || txt)")
        return f"CASE WHEN fault NOT IN ('b', 'd') AND role[1] = '{initial}' THEN {way} END"

    def rerole(s: str, role: str) -> str:
        way = step(s, more + " + 1", "R", f"('{role}:' || txt)")
        return f"CASE WHEN fault NOT IN ('b', 'd') THEN {way} END"

    kept = [keep("m0", "s")], [w for m in ("m0", "m1", "m3") for w in (keep(m, "u"), rerole(m, "user"))], [keep("m2", "a"), rerole("m2", "assistant")]
    ends = [least(step(f"m{i}", "2", "D"), *ways) for i, ways in enumerate(([], *kept))]
    return f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda x, y: CASE WHEN x & 1 = 1 THEN xor(3988292384::BIGINT, x >> 1) ELSE x >> 1 END)) AS tab),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
drawn AS (
  SELECT keyed.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(k)), lambda i: ascii(substr(k, i::INT + 1, 1))::BIGINT)),
           lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 20 AS h FROM keyed, crc),
hurt AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(txt, '[.!?]', '', 'g') ELSE txt END AS txt,
         unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy FROM drawn WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(txt, 32), md5(txt)) AS rn,
         regexp_extract(txt, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS tail FROM hurt),
coded AS (
  SELECT *, CASE WHEN tail = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY rn) > 1 THEN 'd'
                 WHEN NOT regexp_matches(tail, '[.!?]') THEN 't' ELSE '' END AS fault,
         lag(role) OVER (PARTITION BY conv_id ORDER BY rn) AS role_before FROM placed),
ways AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS rn, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s1,
         NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s3 FROM conversations
  UNION ALL
  SELECT conv_id, rn, {ends[0]}, {ends[1]}, {ends[2]}, {ends[3]}
  FROM (SELECT conv_id, rn, role, txt, fault, {two} FROM (SELECT w.conv_id, r.rn, r.role, r.txt, r.fault, {one}
        FROM ways w JOIN coded r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.rn = w.rn + 1))),
ended AS (
  SELECT conv_id, {least('m0', 'm3')} AS best FROM (SELECT conv_id, {two} FROM (SELECT conv_id, {one} FROM ways
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY rn DESC) = 1))),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (role_before IS NOT NULL AND left(role_before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM coded GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit,
       sha256(substr(best.t, 2)) AS repaired_sha256
FROM ended e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id"""


@query("op12_conversation_repair", _repair_sql())
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, the cheapest edits that repair it, and the hash of the result."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    hurt = damaged(rows)
    solved = cut_lineage(conversations.audits(hurt))
    conv = F.struct("conv_id").alias("conv")
    sums = solved.groupBy("conv").agg(
        (F.max("high_turn") - F.min("low_turn") + 1 - F.sum("turns")).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_sort(F.collect_list(F.struct("block", "audit"))).alias("audit"))
    hashes = conversations.digests(conversations.repaired(hurt, solved)).select(conv, "repaired_sha256")
    out = rows.select(conv).distinct().join(sums, "conv", "left").join(hashes, "conv", "left")
    longs = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv.conv_id", *longs, F.coalesce(F.array_join(F.transform("audit", lambda x: x["audit"]), ""), F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op13_hard_negatives", """
WITH known AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, k.vec_id AS id, a.label = k.label AS same, list_inner_product(a.v, k.v)::BIGINT AS score
  FROM known a JOIN known k ON a.vec_id <> k.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
negatives AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank,
         id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor (ids divisible by 50) and positive, against all rows; a seventh of the labels is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0, label=moved)
