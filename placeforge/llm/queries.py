"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chunks, hilbert, lines, media, mixing, neardup, packing, quality, resampling, toxicity, urls, wrapper
from ._common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(table(spark, sf_dir, "pages"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeats(table(spark, sf_dir, "documents")).select("doc_id", "first_doc_id", "start", "length", F.col("n_words").cast("long").alias("n_words"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", F.col("copy").cast("long").alias("copy"))


def op6_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "cell")


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_table(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "codec", "duration_s", "keyframes")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    judged = urls.match_rules(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), "rule", "verdict")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.fit_once(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr_score")


def op10_bagminhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_sentences", "worst_start", "worst_length")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_html_extraction, op2_substring_dedup, op3_line_dedup, op4_best_fit_packing, op5_poisson_mixing, op6_hilbert_sharding, op7_media_columns, op8_url_filters, op9_quality_rules, op10_bagminhash_neardup, op11_tokenizer_alignment, op12_importance_resampling, op13_toxicity)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": lines.ORACLE, "op5_poisson_mixing": mixing.ORACLE, "op8_url_filters": urls.ORACLE, "op12_importance_resampling": resampling.ORACLE}
