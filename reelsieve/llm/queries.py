"""The registered queries of the training-data operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontam, html_text, iblt, line_dedup, mixing, pii, quality, ranked, sharding, simhash, spelling, topk
from .common import table

#: Fixed value: both turns of conversation -1.
OWN_TURN = "</s>[INST] ok [/INST]"


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents"))


def op4_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.edited_likeness(table(spark, sf_dir, "documents"))


def op8_chat_windows(spark: SparkSession, sf_dir: str, vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken") -> DataFrame:
    """All conversations and conversation -1; turns are counted in tokens of the vocabulary, which has to be there: no other count stands in for it."""
    with open(vocabulary, "rb") as file:
        ranks = file.read()
    own = spark.createDataFrame([(-1, 0, "user", OWN_TURN), (-1, 1, "assistant", OWN_TURN)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(chat.format_windows(rows, ranks))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


_ALL = (op1_simhash_near_dedup, op2_html_main_text, op3_line_dedup, op4_extendible_shards, op5_pii_spans, op6_quality_classifier, op7_iblt_fingerprints, op8_chat_windows, op9_decontamination, op10_source_mix, op11_spelling_variants, op12_ranked_search, op13_top_inner_products)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    # op10's shards come from the splitting tree's draws, which SQL has not; tests hold its other columns against mixing.sql().
    return {"op4_extendible_shards": sharding.sql(), "op11_spelling_variants": spelling.sql(), "op12_ranked_search": ranked.sql(), "op13_top_inner_products": topk.sql()}
