"""The operators' registered queries: thin functions of (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    decontam, fill_middle, filter_audit, html_extract, importance, language, line_dedup, mixing, ngram_join, pii, token_counts, topk,
    toxicity,
)
from tessera.llm.common import table

#: target weights of the production mix: the large crawl is held to a fifth
#: of the blocks, the other sources share the rest alike
MIX_WEIGHTS = {"src0": 5.0, **{f"src{k}": 1.0 for k in range(1, 20)}}


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"), MIX_WEIGHTS)


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, str(model_path)).drop("text")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_topk_search": op3_topk_search,
    "op4_toxicity": op4_toxicity,
    "op5_ngram_join": op5_ngram_join,
    "op6_mix_sources": op6_mix_sources,
    "op7_html_extract": op7_html_extract,
    "op8_importance_resample": op8_importance_resample,
    "op9_decontaminate": op9_decontaminate,
    "op10_token_counts": op10_token_counts,
    "op11_language_id": op11_language_id,
    "op12_filter_audit": op12_filter_audit,
    "op13_fill_middle": op13_fill_middle,
}
