"""The queries of this package and the SQL of those that SQL can express. The entry module adds the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandwise.llm import divergence, exact_dedup, katz, mixing, packing, quality, rules, sharding, simhash, token_counts, toxicity, url_filter, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": packing.op1_packing,
        "op2_quality": quality.op2_quality,
        "op3_simhash": simhash.op3_simhash,
        "op4_url_filter": url_filter.op4_url_filter,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_exact_dedup": exact_dedup.op6_exact_dedup,
        "op7_mixing": mixing.op7_mixing,
        "op8_sharding": sharding.op8_sharding,
        "op9_quality_rules": rules.op9_quality_rules,
        "op10_token_counts": token_counts.op10_token_counts,
        "op11_lm_scoring": katz.op11_lm_scoring,
        "op12_source_divergence": divergence.op12_source_divergence,
        "op13_embedding_whitening": whitening.op13_embedding_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_exact_dedup": exact_dedup.OP6_SQL, "op7_mixing": mixing.OP7_SQL, "op8_sharding": sharding.OP8_SQL, "op9_quality_rules": rules.OP9_SQL, "op12_source_divergence": divergence.OP12_SQL}
