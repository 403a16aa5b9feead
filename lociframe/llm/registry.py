"""Queries of this subpackage: thin wrappers that apply each operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_quality, op2_shards, op3_join, op4_extract, op5_rules, op6_licenses, op7_vectors, op8_mix, op9_bpe, op10_lm, op11_toxicity, op12_variants, op13_search, oracles


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_random_indexing_quality(spark, sf_dir):
    return op1_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_hash_tree_shards(spark, sf_dir):
    return op2_shards.slots(_table(spark, sf_dir, "documents"))


def op3_adaptive_prefix_join(spark, sf_dir):
    return op3_join.components(_table(spark, sf_dir, "documents"))


def op4_tree_model_extraction(spark, sf_dir):
    return op4_extract.extract(_table(spark, sf_dir, "pages"), ["page_id", "url"])


def op5_divergence_rules(spark, sf_dir):
    judged = op5_rules.judged(_table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


def op6_license_rules(spark, sf_dir):
    return op6_licenses.scan(_table(spark, sf_dir, "documents"), ["doc_id"]).drop("spans")


def op7_product_quantised_dedup(spark, sf_dir):
    return op7_vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_fair_queue_mix(spark, sf_dir):
    return op8_mix.mix(_table(spark, sf_dir, "documents"))


def op9_tree_bpe(spark, sf_dir):
    return op9_bpe.encode_texts(_table(spark, sf_dir, "documents"), ["doc_id"], with_ids=False)


def op10_cross_entropy_difference(spark, sf_dir):
    good = _table(spark, sf_dir, "labels").where("quality = 1")
    scored = op10_lm.score(_table(spark, sf_dir, "documents"), good)
    return scored.withColumns({c: F.round(c, 6) for c in ("target_loss", "background_loss", "score")})


def op11_ratio_scaled_toxicity(spark, sf_dir):
    return op11_toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_chunked_variants(spark, sf_dir):
    return op12_variants.grouped(_table(spark, sf_dir, "documents"))


def op13_reversed_search(spark, sf_dir):
    return op13_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = (
    op1_random_indexing_quality,
    op2_hash_tree_shards,
    op3_adaptive_prefix_join,
    op4_tree_model_extraction,
    op5_divergence_rules,
    op6_license_rules,
    op7_product_quantised_dedup,
    op8_fair_queue_mix,
    op9_tree_bpe,
    op10_cross_entropy_difference,
    op11_ratio_scaled_toxicity,
    op12_chunked_variants,
    op13_reversed_search,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
