"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from oremill.llm import bpe, decontam, embed_dedup, fill_middle, hard_negatives, html_extract, kneser_ney, lang_id, line_dedup, minhash, token_counts, toxicity, warc
from oremill.llm.common import prepare

RANKS, SPEC = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduped(spark, table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.limits(table(spark, sf_dir, "documents"), public_tokenizers.path(SPEC))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.predictions(spark, table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(table(spark, sf_dir, "pages"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(spark, table(spark, sf_dir, "documents"))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.scored(spark, table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(spark, table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_line_dedup,
        op3_embedding_dedup,
        op4_decontamination,
        op5_minhash,
        op6_token_counts,
        op7_toxicity,
        op8_warc,
        op9_language_id,
        op10_html_extraction,
        op11_fill_middle,
        op12_lm_scores,
        op13_hard_negatives,
    )
}
