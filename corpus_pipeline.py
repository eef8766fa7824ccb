"""Corpus pipeline: the documents of a table, stage by stage, to token ids.

Each stage reads all that the stage before kept, is written as Parquet and read
again as the next one's input.  All but the last return the columns of
``documents``; the last adds the token ids.

1. language ID - documents without a recognisable language go;
2. exact dedup - of equal texts the largest doc_id stays;
3. n-gram Jaccard join - of linked documents (PERCENT of their shingles of WORDS
   words in common) the smallest doc_id stays;
4. source mix - documents are left out or repeated towards the target weights;
5. byte-level BPE - every text as token ids, decoded again as a check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import byte_bpe, exact_dedup, language_id, ngram_join, source_mix
from riskloom.llm.common import staged, table

#: Near copies share this much of their word shingles.
WORDS, PERCENT = 5, 80


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, words=WORDS, percent=PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids (little-endian unsigned 32-bit), n_tokens, round_trip (the ids decode to the text)."""
    coded = byte_bpe.encode(docs.select("doc_id", "source", "text"), outputs=("ids", "n_tokens", "decoded_sha256"))
    same = F.col("decoded_sha256") == F.sha2(F.coalesce("text", F.lit("")), 256)
    return coded.select("doc_id", "source", "ids", "n_tokens", same.alias("round_trip"))


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", encode_texts),
]

#: The language model and the sampling of its training rows can't be put in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; a stage's result is a Parquet table in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
