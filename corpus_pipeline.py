"""Corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark
decontamination, best-fit packing.

STAGES lists (name, function) in order; each function takes (spark, docs,
sf_dir) and returns a DataFrame. All but the last take and return the columns
of documents. ``run`` applies them to the documents table and cuts the lineage
after each with a reliable checkpoint.

ORACLE_SQL is None: n-gram profiles, edit joins, SimHash groups and tokenizer
ids have no SQL form that DuckDB runs; tests compare the stages with
brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuator.llm import decontaminate, language_id, line_dedup, packing, simhash_dedup
from valuator.session import cut_lineage

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter have no language and go; a lang that is missing becomes the predicted one."""
    named = language_id.identify(docs.withColumn("__lang", F.col("lang")), lang="__lang")
    kept = named.filter(F.col("lang_pred") != language_id.UNDETERMINED)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occur earlier, exactly or within 2 edits (lines of 32 characters or more), go; so do documents of which no line is left."""
    left = line_dedup.without_repeated_lines(docs, share=None, short=())
    return left.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of fingerprints linked by at most 2 bits, the smallest doc_id stays."""
    return simhash_dedup.keep_one_of_each(docs, shingle=3, max_bits=2)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to a fifth of its words edited, go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, packed into sequences of at most 2,048 tokens."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
