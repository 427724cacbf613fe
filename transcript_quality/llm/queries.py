"""The registered queries of this package: (spark, sf_dir) -> DataFrame, and DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from transcript_quality.llm import decontaminate, langid, linededup, lm, pieces, quality, repeats, rules, secrets, signatures, simhash, tokenfiles, variants
from transcript_quality.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op3_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.query_rows(table(spark, sf_dir, "documents"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op4_decontaminate"] = decontaminate.ORACLE.strip()


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.read(tokenfiles.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.cut_repeats(table(spark, sf_dir, "documents")))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signatures.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op12_ranked_search"] = signatures.ORACLE.strip()
