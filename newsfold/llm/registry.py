"""The operators' queries over the driver tables and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import exact_dedup, langid, line_dedup, lm_score, mixing, packing, ranked_search, simhash, spelling, substring_dedup, suffix_dedup, topk, toxicity


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(read_table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % topk.EVERY == 0)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    own = (
        op1_lm_score,
        op2_best_fit_packing,
        op3_mixing,
        op4_suffix_array_dedup,
        op5_language_id,
        op6_simhash_near_dedup,
        op7_toxicity,
        op8_substring_dedup,
        op9_exact_top_k,
        op10_exact_dedup,
        op11_line_dedup,
        op12_spelling_variants,
        op13_ranked_search,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    own = {
        "op1_lm_score": lm_score,
        "op3_mixing": mixing,
        "op4_suffix_array_dedup": suffix_dedup,
        "op8_substring_dedup": substring_dedup,
        "op9_exact_top_k": topk,
        "op10_exact_dedup": exact_dedup,
        "op11_line_dedup": line_dedup,
        "op13_ranked_search": ranked_search,
    }
    return {name: module.ORACLE_SQL for name, module in own.items()}
