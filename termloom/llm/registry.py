"""The subpackage's queries, and SQL for those that SQL can express."""

from __future__ import annotations

from termloom.llm import forest, jaccard, mixing, pieces, quality, repeats, secrets, sharding, topk, warc


def queries():
    return {
        f.__name__: f
        for f in (
            mixing.op1_mix_sources,
            sharding.op2_shard_bytes,
            quality.op3_quality_rank,
            forest.op4_vector_forest,
            repeats.op5_suffix_repeats,
            secrets.op6_secret_links,
            topk.op7_pivot_topk,
            pieces.op8_sentencepiece,
            jaccard.op9_ngram_jaccard,
            warc.op10_warc,
        )
    }


def oracle_sql():
    return {"op2_shard_bytes": sharding.OP2_SQL, "op4_vector_forest": forest.OP4_SQL, "op5_suffix_repeats": repeats.OP5_SQL, "op7_pivot_topk": topk.OP7_SQL, "op9_ngram_jaccard": jaccard.OP9_SQL, "op10_warc": warc.OP10_SQL}
