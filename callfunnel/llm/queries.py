"""The registered query of each operator, over its whole table, and the SQL that checks it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from callfunnel.llm import (
    ann,
    bpe,
    brown,
    html_text,
    license_scan,
    line_dedup,
    mixing,
    near_dup,
    pii,
    quality_classifier,
    quality_rules,
    spelling,
    whitening,
)
from callfunnel.llm.common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(table(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(spark, table(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.scores(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_line_dedup": op2_line_dedup,
    "op3_mixing": op3_mixing,
    "op4_personal_data": op4_personal_data,
    "op5_license_scan": op5_license_scan,
    "op6_main_text": op6_main_text,
    "op7_nearest": op7_nearest,
    "op8_minhash": op8_minhash,
    "op9_quality_rules": op9_quality_rules,
    "op10_bpe": op10_bpe,
    "op11_spelling": op11_spelling,
    "op12_whitening": op12_whitening,
    "op13_lm_score": op13_lm_score,
}

ORACLE_SQL = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op5_license_scan": license_scan.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
}
