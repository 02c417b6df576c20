"""The queries of this subpackage, by the names under which the entry point registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.llm import common, line_winnow, multi_index, ngram_llr, packing, sentencepiece_scan, substring_dedup, token_files, url_rules, vp_simhash, zstd_quality


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the SHA-256 of what they decode to."""
    found = sentencepiece_scan.encode(spark, _table(spark, sf_dir, "documents"), decoded=True)
    return found.select("doc_id", F.size("ids").alias("n_tokens"), "ids", "n_chunks", F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.scratch(spark, "token-files")
    token_files.write_tokens(spark, _table(spark, sf_dir, "documents"), path)
    return token_files.read_documents(spark, path)


def op3_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(spark, _table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(spark, _table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_fpgrowth_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.checkpoint_root(spark)
    return url_rules.filter_urls(spark, _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(spark, packing.token_lengths(spark, _table(spark, sf_dir, "documents")))


def op7_simhash_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_simhash.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def op8_winnowing_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_winnow.remove_repeated_lines(spark, _table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_removed")


def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zstd_quality.quality_scores(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_ngram_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where(F.col("quality") == 1)
    return ngram_llr.quality_rules(spark, _table(spark, sf_dir, "documents"), trusted)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sentencepiece_scan, op2_rans_token_files, op3_recompression_dedup, op4_multi_index_hashing, op5_fpgrowth_url_filter, op6_best_fit_packing, op7_simhash_vp_tree, op8_winnowing_line_dedup, op9_compression_quality, op10_ngram_quality_rules)}


def oracle_sql() -> dict[str, str]:
    return {"op3_recompression_dedup": substring_dedup.oracle_sql(), "op8_winnowing_line_dedup": line_winnow.oracle_sql()}
