"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from riskloom.llm import (byte_bpe, chat_format, exact_dedup, fingerprints, language_id, merkle, ngram_join, pii, simhash,
                          source_mix, structure_repair, toxicity, wordpiece)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_weighted_fingerprints": fingerprints.op1_weighted_fingerprints,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_byte_bpe": byte_bpe.op3_byte_bpe,
        "op4_source_mix": source_mix.op4_source_mix,
        "op5_ngram_jaccard": ngram_join.op5_ngram_jaccard,
        "op6_wordpiece_counts": wordpiece.op6_wordpiece_counts,
        "op7_chat_format": chat_format.op7_chat_format,
        "op8_pii": pii.op8_pii,
        "op9_language_id": language_id.op9_language_id,
        "op10_exact_dedup": exact_dedup.op10_exact_dedup,
        "op11_simhash": simhash.op11_simhash,
        "op12_merkle_manifest": merkle.op12_merkle_manifest,
        "op13_structure_repair": structure_repair.op13_structure_repair,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_source_mix": source_mix.OP4_SQL, "op10_exact_dedup": exact_dedup.OP10_SQL,
            "op12_merkle_manifest": merkle.OP12_SQL, "op13_structure_repair": structure_repair.OP13_SQL}
