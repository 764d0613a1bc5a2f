"""Registered queries of the operators, their SQL, and the pipeline."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arrears.llm import (
    chat_format,
    decontaminate,
    divergence,
    host_rules,
    html_extract,
    licenses,
    mixing,
    packing,
    quality_lm,
    resampling,
    simhash_vpt,
    sql,
    toxicity,
    url_lists,
)
from arrears.llm.common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixture(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = [(chat_format.CONTROL_ID, turn, role, chat_format.CONTROL_TEXT) for turn, role in enumerate(("user", "assistant"))]
    rows = rows.union(spark.createDataFrame(control, "conv_id long, turn long, role string, text string"))
    return chat_format.digests(chat_format.format_threads(chat_format.linear_thread(rows)))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vpt.near_duplicates(table(spark, sf_dir, "documents"))


def op8_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lists.judge_pages(spark, sf_dir)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.page_texts(table(spark, sf_dir, "pages"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_quality_classifier, op3_chat_format, op4_toxicity, op5_host_rules, op6_license_scan,
    op7_simhash, op8_url_lists, op9_html_text, op10_decontaminate, op11_pack_windows, op12_importance_resampling, op13_source_divergence)}
QUERIES["pipeline"] = corpus_pipeline.run

# Operators 2, 4, 7, 9 and 11 have no SQL form: tests/llm holds them against brute force.
ORACLE: dict[str, str] = {
    "op1_mix_sources": sql.MIX_SOURCES,
    "op3_chat_format": sql.CHAT_FORMAT,
    "op5_host_rules": sql.HOST_RULES,
    "op6_license_scan": sql.LICENSE_SCAN,
    "op8_url_lists": sql.URL_LISTS,
    "op10_decontaminate": sql.DECONTAMINATE,
    "op12_importance_resampling": sql.IMPORTANCE_RESAMPLING,
    "op13_source_divergence": sql.SOURCE_DIVERGENCE,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
